"""Operator 3: packing by non-negative least squares.

1. Tokenise whole texts and store the ids once (uint32, little-endian).
2. Full windows of a document stand alone; its remainder is binned by length.
   Shallow combinations of bins that fill a window exactly (at most ``DEPTH``
   remainders) are enumerated, and non-negative least squares solves how often
   to repeat each so that the bin histogram is used up; counts are rounded. The
   histogram has ``window / GRID`` rows whatever the corpus holds.
3. Documents are dealt to shards of about ``SHARD_DOCS`` by hash. A shard carries
   out its share of the plan on (row, length) pairs; documents the plan leaves
   over are packed greedily: cut into the slack of planned sequences, then into
   further windows, and the last tokens into sequences of a power of two.
4. Pieces rejoin the stored ids by row and cut them JVM-side.

Defined cases: a null or empty text is the closing id alone; repeated rows are
packed each; a null doc_id is carried through; no documents give no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import stored, text_of, with_row_number
from lodgeflow.llm.tokens import encoder, parts

WINDOW = 4096
GRID = 64
DEPTH = 4
SHARD_DOCS = 20_000
#: Slack below this many tokens stays padding instead of taking a crumb.
LEAST_CUT = 16
END_ID = 2

PIECES = "row_id long, start long, length long, sequence_id long, offset long"


def tokenize(docs: DataFrame, tokenizer_json: str, end_id: int = END_ID) -> DataFrame:
    """row_id, doc_id, doc_tokens, ids per document row."""
    model = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = encoder(model.value)
        for batch in chain.from_iterable(map(parts, batches)):
            ids, begins = run.encode(batch.column("text"), end_id)
            cells = pa.LargeBinaryArray.from_buffers(pa.large_binary(), batch.num_rows, [
                None, pa.py_buffer((4 * begins).astype(np.int64)), pa.py_buffer(ids.astype("<u4"))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), batch.column("doc_id"), pa.array(np.diff(begins)), cells.cast(pa.binary())],
                ["row_id", "doc_id", "doc_tokens", "ids"])

    rows = with_row_number(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")))
    return rows.mapInArrow(encode, "row_id long, doc_id long, doc_tokens long, ids binary")


def combinations(units: int, depth: int) -> list[tuple[int, ...]]:
    """Ascending tuples of at most ``depth`` bins that sum to ``units``."""
    found: list[tuple[int, ...]] = []

    def extend(head: tuple[int, ...], left: int) -> None:
        least = head[-1] if head else 1
        if left >= least:
            found.append((*head, left))
        if len(head) + 1 < depth:
            for x in range(least, left // 2 + 1):
                extend((*head, x), left - x)

    extend((), units)
    return found


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """min |ax - b| with x >= 0 by Lawson and Hanson's active sets."""
    x, used = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(rounds):
        gradient = a.T @ (b - a @ x)
        gradient[used] = -np.inf
        best = int(gradient.argmax())
        if gradient[best] <= 1e-9 * max(1.0, np.abs(b).max()):
            break
        used[best] = True
        while True:
            z = np.zeros_like(x)
            z[used] = np.linalg.lstsq(a[:, used], b, rcond=None)[0]
            if (z[used] > 0).all():
                x = z
                break
            low = used & (z <= 0)
            step = min(1.0, float((x[low] / np.maximum(x[low] - z[low], 1e-300)).min()))
            x = x + step * (z - x)
            used &= x > 1e-12
            x[~used] = 0.0
    return x


def repeat_counts(histogram: np.ndarray, units: int, depth: int = DEPTH) -> list[tuple[tuple[int, ...], float]]:
    """Combinations with how often to repeat each. histogram[k]: remainders in bin k + 1."""
    combos = combinations(units, depth)
    a = np.zeros((units, len(combos)))
    for j, combo in enumerate(combos):
        for k in combo:
            a[k - 1, j] += 1
    x = nnls(a, histogram.astype(float))
    return sorted(((c, float(v)) for c, v in zip(combos, x) if v > 0), key=lambda p: (-p[1], p[0]))


def pack_shard(rows: np.ndarray, sizes: np.ndarray, plan, share: float, window: int, grid: int) -> list[np.ndarray]:
    """Pieces of one shard as columns row, start, length, sequence, offset."""
    order = np.lexsort((rows, sizes))
    rows, sizes = rows[order], sizes[order]
    out: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    for r, n in zip(rows.tolist(), sizes.tolist()):
        for w in range(n // window):
            out.append((r, w * window, window, sequence, 0))
            sequence += 1
    rest = sizes % window
    bins = -(-rest // grid)
    waiting = {k: np.flatnonzero(bins == k).tolist() for k in np.unique(bins[rest > 0]).tolist()}
    slack: list[tuple[int, int]] = []
    for combo, count in plan:
        for _ in range(int(round(count * share))):
            if any(len(waiting.get(k, ())) < combo.count(k) for k in set(combo)):
                break
            at = 0
            for k in combo:
                i = waiting[k].pop()
                n = int(rest[i])
                out.append((int(rows[i]), int(sizes[i]) - n, n, sequence, at))
                at += n
            if window - at >= LEAST_CUT:
                slack.append((sequence, at))
            sequence += 1
    # greedy: the longest left over first, cut wherever a sequence is full
    left = sorted((i for queue in waiting.values() for i in queue), key=lambda i: (-rest[i], rows[i]))
    todo = int(sum(rest[i] for i in left))
    free = iter(slack)
    room, at = 0, 0
    for i in left:
        start, n = int(sizes[i] - rest[i]), int(rest[i])
        while n:
            if not room:
                if (gap := next(free, None)) is not None:
                    current, at = gap
                    room = min(window - at, todo)
                else:
                    current, at = sequence, 0
                    sequence += 1
                    room = window if todo >= window else 1 << (todo.bit_length() - 1)
            cut = min(room, n)
            out.append((int(rows[i]), start, cut, current, at))
            start, at, n, room, todo = start + cut, at + cut, n - cut, room - cut, todo - cut
    return [np.array(c, np.int64) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 5


def plan_pieces(lengths: DataFrame, window: int = WINDOW, grid: int = GRID, depth: int = DEPTH) -> DataFrame:
    """lengths: row_id, doc_tokens (stored). One row per piece."""
    rest = F.col("doc_tokens") % F.lit(window)
    counts = lengths.groupBy(F.ceil(rest / F.lit(grid)).cast("int").alias("bin")).count().collect()  # window/grid rows
    units, total = window // grid, sum(r["count"] for r in counts)
    histogram = np.zeros(units)
    for r in counts:
        if r["bin"]:
            histogram[r["bin"] - 1] = r["count"]
    plan = repeat_counts(histogram, units, depth)
    shards = max(1, round(total / SHARD_DOCS))

    def pack(key, group: pd.DataFrame) -> pd.DataFrame:
        row, start, length, sequence, offset = pack_shard(
            group["row_id"].to_numpy(), group["doc_tokens"].to_numpy(), plan, len(group) / max(total, 1), window, grid)
        return pd.DataFrame({"row_id": row, "start": start, "length": length,
                             "sequence_id": (int(key[0]) << 32) + sequence, "offset": offset})

    shard = F.pmod(F.xxhash64("row_id"), F.lit(shards)).alias("shard")
    return lengths.select("row_id", "doc_tokens", shard).groupBy("shard").applyInPandas(pack, PIECES)


def pack_documents(docs: DataFrame, tokenizer_json: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids (binary, uint32), doc_tokens, sequence_id, offset per piece."""
    tokens = stored(tokenize(docs, tokenizer_json, end_id))
    pieces = plan_pieces(tokens.select("row_id", "doc_tokens"), window)
    listed = pieces.groupBy("row_id").agg(  # a document's own pieces only
        F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))
    cut = F.substring(F.col("ids"), (F.col("p.start") * 4 + 1).cast("int"), (F.col("p.length") * 4).cast("int"))
    return (tokens.join(listed, "row_id").withColumn("p", F.explode("pieces"))
            .select("doc_id", "p.start", "p.length", cut.alias("ids"), "doc_tokens", "p.sequence_id", "p.offset"))
