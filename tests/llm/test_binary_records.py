from __future__ import annotations

import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodgeflow.llm import binary_records, tokens
from lodgeflow.llm.checksums import crc32c
from lodgeflow.llm.registry import tokenizer_json
from tests.llm.fixtures import awkward, nothing, prose


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(tokenizer_json())
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def ids_of(texts, end_id=None):
    ids, begins = tokens.TextEncoder(tokenizer_json()).encode(pa.array(texts, pa.string()), end_id)
    assert begins[0] == 0 and begins[-1] == len(ids)
    return [ids[a:b].tolist() for a, b in zip(begins, begins[1:])]


@pytest.mark.parametrize("size", [40, tokens.SLICE])
def test_encodes_like_the_library(library, monkeypatch, size):
    monkeypatch.setattr(tokens, "SLICE", size)
    texts = ["", " ", "a\x1cb \x0b c\xa0d\x85 é x​y  '’s <|endoftext|> İΣΣ don't 'tis ''s ,'s\r\nfoo", prose(1, 500), "\n\n",
             "J̌ ǰ É Ü×÷ 12,5 a1b2 ½² ªº ́x", "x" * 5000, "", ""]
    assert ids_of(texts) == [library(t) for t in texts]
    assert ids_of(texts, 7) == [[*library(t), 7] for t in texts]
    assert ids_of([]) == [] and ids_of([""]) == [[]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("abAB'stremvlld.,;1 2\n\t\r éÉß×÷\xa0\x85İ̇ǰJ̌中😀\x0b\x1c ΣKª²"), max_size=30), max_size=8))
def test_encodes_any_text_like_the_library(library, texts):
    assert ids_of(texts) == [library(t) for t in texts]


def test_forgets_and_learns_again(library, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    run = tokens.TextEncoder(tokenizer_json())
    for seed in range(4):
        text = prose(seed, 200)
        assert run.encode(pa.array([text]))[0].tolist() == library(text)
        assert len(run.known) < 400


def plain_crc32c(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_checksums_equal_the_plain_loop():
    data = np.random.default_rng(3).integers(0, 256, 20_000, dtype=np.uint8)
    start = np.array([0, 1, 7, 100, 64, 3])
    length = np.array([4, 8, 63, 64, 65, 19_000])
    assert crc32c(data, start, length).tolist() == [plain_crc32c(data[a:a + n].tobytes()) for a, n in zip(start, length)]
    check = np.frombuffer(b"123456789", np.uint8)
    assert crc32c(check, np.array([0]), np.array([9])).tolist() == [0xE3069283]  # the published check value


def want(library, df):
    """(doc_id, ids) in ascending doc_id, nulls last, rows of one doc_id in any order."""
    rows = [(r["doc_id"], [*library(r["text"]), 1]) for r in df.collect()]
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def test_round_trip(spark, scratch, library):
    df = awkward(spark)
    # many files, of which the longest document fills one
    binary_records.write_records(df, scratch, tokenizer_json(), file_bytes=2000)
    index = binary_records.write_index(spark, scratch).orderBy("start").collect()
    expected = want(library, df)
    assert [r["doc_id"] for r in index] == [d for d, _ in expected]
    assert sorted((str(r["doc_id"]), r["n_ids"], r["ids_crc32"]) for r in index) == sorted(
        (str(d), len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in expected)
    assert [r["start"] for r in index] == np.cumsum([0, *[r["n_ids"] for r in index]])[:-1].tolist()
    assert len({r["file"] for r in index}) > 2  # the long document and what comes before and after it
    got = binary_records.read_records(spark, scratch).collect()
    as_lists = lambda rows: sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in rows)
    assert as_lists(got) == sorted((str(d), i) for d, i in expected)
    # shuffled reads: every record once, in an order of the seed's
    one, again, two = (binary_records.read_shuffled(spark, scratch, s).collect() for s in (1, 1, 2))
    assert one == again and one != two and as_lists(one) == as_lists(two) == as_lists(got)


def test_no_documents(spark, scratch):
    assert binary_records.encode_documents(nothing(spark), scratch, tokenizer_json()).count() == 0
    assert binary_records.read_shuffled(spark, scratch, 1).count() == 0


def framed(wide=False):
    ids = np.arange(10, dtype=np.uint32) + (70_000 if wide else 0)
    return binary_records.frame([5, None], 0, ids, np.array([0, 4, 10]), wide)


@pytest.mark.parametrize("wide", [False, True])
def test_every_changed_byte_is_noticed(wide):
    records = framed(wide)
    whole = b"".join(records) + binary_records.LAST
    columns = binary_records.parse("f", whole, True)
    assert columns[1] == [0, len(records[0])] and columns[3] == [5, None] and columns[4] == [4, 6]
    assert np.frombuffer(columns[7][1], "<u4").tolist() == [i + (70_000 if wide else 0) for i in range(4, 10)]
    for i in range(len(whole)):
        changed = bytearray(whole)
        changed[i] ^= 1 << (i % 8)
        with pytest.raises(ValueError):
            binary_records.parse("f", bytes(changed), True)
        if i:
            with pytest.raises(ValueError):
                binary_records.parse("f", whole[:i], True)
    with pytest.raises(ValueError):
        binary_records.parse("f", whole + b"x", True)
    assert binary_records.parse("f", b"", True)[0] == []


def test_random_access():
    records = framed()
    file = binary_records.RecordFile(io.BytesIO(b"".join(records) + binary_records.LAST))
    length = len(records[1]) - 16
    assert file.read(len(records[0]), length)[0] is None
    assert file.read(len(records[0]), length)[1].tolist() == list(range(4, 10))
    for offset, n in ((1, length), (len(records[0]), length - 2), (10_000, 8)):
        with pytest.raises(ValueError):
            file.read(offset, n)
