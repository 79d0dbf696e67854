"""Token ids of many texts at a time (numpy and Arrow, for use inside tasks).

A batch of texts is one buffer of bytes. It is cut into pieces where the tokenizer cuts
too, the pieces are dictionary-encoded by Arrow, only pieces not met before go to the
tokenizer, and the ids of the batch are gathered from those of its pieces. The ids are
those of ``Tokenizer.encode`` on the whole text.

Where cuts are safe (for tokenizers whose words end in ``</w>``): the tokenizer never
merges across ASCII white space, and within a word of ASCII and Latin letters its words
are runs of letters or of other signs. A word with anything else in it (an apostrophe,
which may open a contraction; characters that may be recomposed or are a rarer kind of
white space; control characters) is left whole and goes to the tokenizer as it is.
For other tokenizers nothing is cut: whole texts are encoded.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at a time, pieces remembered before rare ones are forgotten, and
#: pieces joined for one call of the tokenizer.
SLICE = 2 << 20
REMEMBERED = 200_000
JOINED = 1000
WORD_END = "</w>"

SPACE, LETTER, OTHER, ODD = range(4)


def _classes() -> np.ndarray:
    """Class per byte; 0xC3 opens À to ÿ, and bytes from 0x80 to 0xBF go on a character."""
    table = np.full(256, ODD, np.uint8)
    table[0x21:0x7F] = OTHER
    table[ord("'")] = ODD
    for first, last in ((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xBF), (0xC3, 0xC3)):
        table[first:last + 1] = LETTER
    table[[0x20, 0x09, 0x0A, 0x0D]] = SPACE
    return table


CLASS = _classes()


class _Grown:
    """An array that is appended to."""

    def __init__(self, dtype):
        self.values, self.size = np.empty(1024, dtype), 0

    def append(self, more: np.ndarray) -> None:
        need = self.size + len(more)
        if need > len(self.values):
            larger = np.empty(max(need, 2 * len(self.values)), self.values.dtype)
            larger[:self.size] = self.values[:self.size]
            self.values = larger
        self.values[self.size:need] = more
        self.size = need


class TextEncoder:
    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values(), default=-1) + 1
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        # words of small ASCII letters go to the model at once if nothing comes before it for them
        self.model = self.tokenizer.model
        self.direct = all([t.id for t in self.model.tokenize(w)] == self.tokenizer.encode(w, add_special_tokens=False).ids
                          for w in ("a", "the", "zyxwvutsrqponmlkjihgfedcba", "straightforwardly"))
        #: Pieces by number, in the order of the arrays: where their ids begin, how many, and
        #: in how many slices they have been met lately.
        self.known: dict[bytes, int] = {}
        self.pool, self.starts, self.counts, self.uses = (_Grown(t) for t in (np.uint32, np.int64, np.int64, np.int32))

    def _forget_rare(self) -> None:
        """Keeps pieces met again, half of ``REMEMBERED`` at most."""
        uses, names = self.uses.values[:self.uses.size], list(self.known)
        most = REMEMBERED // 2
        least = max(2, int(np.partition(uses, -most)[-most]) + 1 if len(uses) > most else 2)
        kept = np.flatnonzero(uses >= least)
        start, count = self.starts.values[kept], self.counts.values[kept]
        before = np.cumsum(count) - count
        ids = self.pool.values[np.repeat(start - before, count) + np.arange(int(count.sum()))]
        uses = uses[kept] // 2
        self.known = {names[i]: k for k, i in enumerate(kept.tolist())}
        self.pool, self.starts, self.counts, self.uses = (_Grown(t) for t in (np.uint32, np.int64, np.int64, np.int32))
        for column, values in ((self.pool, ids), (self.starts, before), (self.counts, count), (self.uses, uses)):
            column.append(values)

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) in order and, per text, where its ids begin (one more for the
        end); ``end_id`` closes each text. ``texts`` holds strings without nulls."""
        if not self.ends.any():
            ids, begins = self._whole(texts)
        else:
            ids, begins = self._pieces(texts)
        if end_id is not None:
            ids = np.insert(ids, begins[1:], np.uint32(end_id))
            begins = begins + np.arange(len(begins))
        return ids, begins

    def _whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [np.asarray(e.ids, np.uint32) for e in
                 self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
        begins = np.concatenate([[0], np.cumsum([len(x) for x in found], dtype=np.int64)])
        return np.concatenate([np.empty(0, np.uint32), *found]), begins

    def _pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = texts.cast(pa.large_binary())
        _, places, content = texts.buffers()
        places = np.frombuffer(places, np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
        first, last = int(places[0]), int(places[-1])
        data = memoryview(content)[first:last] if content is not None else memoryview(b"")
        places = places - first
        begins, total, out, at = np.zeros(len(places), np.int64), 0, [np.empty(0, np.uint32)], 0
        while at < len(data):
            end = self._cut(data, at)
            lo, hi = np.searchsorted(places, [at, end])  # texts that begin in this slice
            ids, begin = self._slice(np.frombuffer(data[at:end], np.uint8), places[lo:hi] - at)
            begins[lo:hi] = total + begin
            out.append(ids)
            total, at = total + len(ids), end
        begins[np.searchsorted(places, len(data)):] = total  # empty texts at the end, and the end
        return np.concatenate(out), begins

    @staticmethod
    def _cut(data: memoryview, at: int) -> int:
        """Where a slice that begins at ``at`` ends: behind a white space."""
        end = at + SLICE
        if end >= len(data):
            return len(data)
        while True:
            spaces = np.flatnonzero(CLASS[np.frombuffer(data[at:end], np.uint8)] == SPACE)
            if len(spaces):
                return at + int(spaces[-1]) + 1
            if end >= len(data):
                return len(data)
            end = min(len(data), end + SLICE)

    def _slice(self, raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a slice, and how many come before each place in ``begins``."""
        kind = CLASS[raw]
        lead = np.flatnonzero(raw[:-1] == 0xC3)
        kind[lead[np.isin(raw[lead + 1], (0x97, 0xB7))]] = ODD  # the signs × and ÷
        edge = np.zeros(len(raw) + 1, bool)
        edge[begins] = True
        edge[0] = edge[-1] = True
        odd = np.flatnonzero(kind == ODD)
        if len(odd):  # their words are of one kind, so that nothing is cut in them
            stops = np.flatnonzero(edge[:-1] | (kind == SPACE))
            after = np.searchsorted(stops, odd, side="right")
            start = stops[after - 1]
            start = start + (kind[start] == SPACE)
            end = np.append(stops, len(raw))[after]
            depth = np.zeros(len(raw) + 1, np.int8)
            start, first = np.unique(start, return_index=True)  # each word once
            depth[start] += 1
            depth[end[first]] -= 1
            kind[np.cumsum(depth[:-1], dtype=np.int8) > 0] = ODD
        edge[1:-1] |= kind[1:] != kind[:-1]
        lowered = raw + ((kind == LETTER) & (raw >= 0x41) & (raw <= 0x5A)) * np.uint8(0x20)
        cuts = np.flatnonzero(edge)
        pieces = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [
            None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(lowered)]).dictionary_encode()
        codes = pieces.indices.to_numpy()
        kinds = np.empty(len(pieces.dictionary), np.uint8)
        kinds[codes] = kind[cuts[:-1]]
        places = self._look_up(pieces.dictionary.to_pylist(), kinds)[codes]
        start, count = self.starts.values[places], self.counts.values[places]
        before = np.concatenate([[0], np.cumsum(count)])
        gather = np.repeat(start - before[:-1], count) + np.arange(before[-1])
        return self.pool.values[gather], before[np.searchsorted(cuts, begins)]

    def _look_up(self, pieces: list[bytes], kinds: np.ndarray) -> np.ndarray:
        known = self.known
        found = np.fromiter((known.get(p, -1) for p in pieces), np.int64, len(pieces))
        new = np.flatnonzero(found < 0)
        if len(new) and len(known) + len(new) > REMEMBERED:
            self._forget_rare()
            known = self.known
            found = np.fromiter((known.get(p, -1) for p in pieces), np.int64, len(pieces))
            new = np.flatnonzero(found < 0)
        if len(new):
            for kind in (SPACE, LETTER, OTHER, ODD):
                some = new[kinds[new] == kind]
                self._learn([pieces[i] for i in some.tolist()], kind)
            found[new] = np.fromiter((known[pieces[i]] for i in new.tolist()), np.int64, len(new))
        self.uses.values[found] += 1
        return found

    def _learn(self, pieces: list[bytes], kind: int) -> None:
        if kind == LETTER:
            if self.direct:
                self._learn_plain([p for p in pieces if p.isascii()])
                pieces = [p for p in pieces if not p.isascii()]
            for at in range(0, len(pieces), JOINED):
                self._learn_words(pieces[at:at + JOINED])
            return
        plain, other = [], []
        for piece in pieces:
            text = piece.decode("utf-8", "replace")
            if kind == SPACE:
                self._keep([piece], np.empty(0, np.uint32), np.zeros(1, np.int64))
            elif max(text) < "Ā":
                plain.append((piece, text))
            else:  # the tokenizer may recompose it
                other.append((piece, text))
        for at in range(0, len(plain), JOINED):
            self._learn_joined(*zip(*plain[at:at + JOINED]))
        for (piece, _), e in zip(other, self.tokenizer.encode_batch_fast([t for _, t in other], add_special_tokens=False)):
            self._keep([piece], np.asarray(e.ids, np.uint32), np.array([len(e.ids)], np.int64))

    def _learn_plain(self, pieces: list[bytes]) -> None:
        """Words of small ASCII letters."""
        tokenize = self.model.tokenize
        found = [[t.id for t in tokenize(p.decode())] for p in pieces]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        self._keep(pieces, np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum())), counts)

    def _learn_words(self, pieces: list[bytes]) -> None:
        """Pieces that are one word each: a word's ids end with one that ends words."""
        e, = self.tokenizer.encode_batch_fast([b" ".join(pieces).decode("utf-8")], add_special_tokens=False)
        ids = np.asarray(e.ids, np.uint32)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(pieces):  # a vocabulary that lacks some word end
            self._learn_joined(pieces, [p.decode("utf-8") for p in pieces])
            return
        self._keep(pieces, ids, np.diff(ends, prepend=0))

    def _learn_joined(self, pieces, texts) -> None:
        """Pieces of several words, told apart by the offsets of the ids."""
        e = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        ends = np.cumsum([len(t) + 1 for t in texts])
        places = np.fromiter((o[0] for o in e.offsets), np.int64, len(e.ids))
        self._keep(pieces, np.asarray(e.ids, np.uint32), np.diff(np.searchsorted(places, ends), prepend=0))

    def _keep(self, pieces, ids: np.ndarray, counts: np.ndarray) -> None:
        at = self.starts.size
        self.known.update(zip(pieces, range(at, at + len(pieces))))
        self.starts.append(self.pool.size + np.cumsum(counts) - counts)
        self.counts.append(counts)
        self.uses.append(np.zeros(len(pieces), np.int32))
        self.pool.append(ids)


def parts(batch: pa.RecordBatch, column: str = "text", size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each (one row at least)."""
    bytes_of = np.cumsum(np.asarray(pc.binary_length(batch.column(column)), np.int64))
    at = 0
    while at < batch.num_rows:
        done = bytes_of[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(bytes_of, done + size, side="right")))
        yield batch.slice(at, end - at)
        at = end


@lru_cache(maxsize=2)
def encoder(tokenizer_json: str) -> TextEncoder:
    """The encoder of this worker process, with the pieces it has met."""
    return TextEncoder(tokenizer_json)


def vocabulary_size(tokenizer_json: str) -> int:
    """One more than the greatest id."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_str(tokenizer_json).get_vocab().values(), default=-1) + 1
