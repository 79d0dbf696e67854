"""Operators 2, 7 and 9 against brute force."""

import hashlib
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgeflow.llm import line_dedup, near_dedup, weighted_sampling
from lodgeflow.llm.components import connected_components
from tests.llm.fixtures import awkward, nothing, prose

ASCII = str.maketrans({c: c + 32 for c in range(65, 91)})


def words(text):
    return (text or "").encode().lower().split()


# --- 2 ---------------------------------------------------------------------------
def weights(text):
    w = words(text)
    return Counter(zip(w, w[1:])) if len(w) > 1 else Counter(w)


def jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_collision_rate_is_generalised_jaccard():
    rng = np.random.default_rng(3)
    errors = []
    for i in range(60):
        a = prose(i, 150).split()
        b = a[:int(len(a) * rng.random())] * 2 + prose(i + 900, 60).split()
        a, b = " ".join(a * 2), " ".join(b)
        got = weighted_sampling.likeness(weighted_sampling.fingerprint(a.encode()),
                                         weighted_sampling.fingerprint(b.encode()))
        errors.append(got - jaccard(weights(a), weights(b)))
    assert abs(np.mean(errors)) < 0.03 and np.abs(errors).max() < 0.25


def test_pieces_of_a_long_text_do_not_change_its_fingerprint(monkeypatch):
    text = prose(5, 3000).encode()
    whole = weighted_sampling.fingerprint(text)
    monkeypatch.setattr(weighted_sampling, "KEPT", 0)
    assert weighted_sampling.fingerprint(text) == whole


@pytest.mark.parametrize("chars", [400, 10 ** 7])
def test_edited_text_and_next_document(spark, monkeypatch, chars):
    monkeypatch.setattr(weighted_sampling, "BLOCK_CHARS", chars)
    df = awkward(spark)
    order = sorted(((r["doc_id"], r["text"] or "") for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    got = weighted_sampling.fingerprint_documents(df).collect()
    want = []
    for i, (doc, text) in enumerate(order):
        after, half = order[(i + 1) % len(order)][1], len(text) // 2
        changed = text[:len(text) - half] + after[:half]
        marks = [weighted_sampling.fingerprint(t.encode()) for t in (text, changed, after)]
        want.append((doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), marks[0].hex(), marks[1].hex(),
                     weighted_sampling.likeness(marks[0], marks[1]), weighted_sampling.likeness(marks[0], marks[2])))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_fingerprints_of_nothing(spark):
    assert weighted_sampling.fingerprint_documents(nothing(spark)).count() == 0
    one = weighted_sampling.fingerprint_documents(nothing(spark).unionByName(awkward(spark).filter("doc_id = 10")))
    assert [r["near_next"] for r in one.collect()] == [1.0]
    empty = weighted_sampling.fingerprint(b" ")
    assert weighted_sampling.likeness(empty, empty) == 1
    assert weighted_sampling.likeness(empty, weighted_sampling.fingerprint(b"a b")) == 0


# --- 9 ---------------------------------------------------------------------------
def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())


def groups(texts):
    """Least index reachable by links of similarity 0.75 or more."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(sets))], sets


def families():
    """Chains of edits, so that links are not transitive, and a hot passage."""
    texts = []
    for f in range(6):
        text = prose(f, 120).split()
        for step in range(7):
            texts.append(" ".join(text))
            text[(step * 17) % 120] = f"edit{f}x{step}"
            text[(step * 31 + 5) % 120] = f"edit{f}y{step}"
    texts += [prose(700 + i, 30) + " " + prose(99, 25) for i in range(30)]
    return texts + [texts[0].upper(), "", " ", "a b", "A  b", "a b c"]


def test_components_equal_brute_force(spark):
    texts = families()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    root, sets = groups(texts)
    got = {r["doc_id"]: r for r in near_dedup.near_duplicates(df).collect()}
    for i, text in enumerate(texts):
        assert got[i]["n_shingles"] == len(sets[i])
        assert got[i]["component_id"] == root[i]
        assert got[i]["kept"] == (root[i] == i)
    kept = sorted(r["doc_id"] for r in near_dedup.drop_near_duplicates(df).collect())
    assert kept == [i for i in range(len(texts)) if root[i] == i]


def test_near_duplicates_edges(spark):
    df = awkward(spark)
    got = near_dedup.near_duplicates(df).collect()
    assert len(got) == df.count()
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[2]["component_id"] == 1 and by_id[3]["component_id"] == 1 and by_id[6]["component_id"] == 6
    out = near_dedup.drop_near_duplicates(df)
    assert out.columns == df.columns
    # 2 and 3 are copies of 1; of the repeated rows of 4 one stays; texts without words stay
    assert sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None) == [-5, 1, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13]
    assert near_dedup.near_duplicates(nothing(spark)).count() == 0
    assert near_dedup.drop_near_duplicates(nothing(spark)).count() == 0


def test_connected_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 200)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}


# --- 7 ---------------------------------------------------------------------------
def plain_lines(text):
    return [w.lower() for w in text.translate({ord(c): " " for c in "\t\r\x0b\x0c"}).split(" ") if w]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, above + (x != y))
    return row[-1]


def deduped(docs):
    """Rows equal in doc_id and text are one document; a line goes when an earlier one is near."""
    unique = sorted({(d is None, d or 0, t or "") for d, t in docs})
    seen, drop = [], {}
    for last, doc, text in unique:
        for n, line in enumerate(text.split("\n")):
            w = plain_lines(line)
            if len(w) >= line_dedup.LEAST_WORDS:
                near = any(w == x or min(len(w), len(x)) >= line_dedup.NEAR_WORDS and distance(w, x) <= 1 for x in seen)
                if near:
                    drop.setdefault((last, doc, text), set()).add(n)
                seen.append(w)
    return drop


def edit_lines():
    line = "the quick brown fox jumps over the lazy dog near the river"
    w = line.split()
    texts = [line, " ".join(w[:3] + w[4:]), " ".join(w[:9] + ["old"] + w[9:]), " ".join(w[:5] + ["leaps"] + w[6:]),
             " ".join(["a"] + w[1:]), " ".join(w[:-1] + ["lake"]), " ".join(w[1:]), " ".join(w[2:]), line.upper(),
             "x x x x x x x x", "x x x x x x x", "x x x x x x x x x", "one two three four", "one two three four",
             "one two three four five", "one two three four six", "\n\n  \n" + line + "\n\nnew text stays here for good"]
    return [(i, t) for i, t in enumerate(texts)]


def check(spark, df):
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    drop = deduped(docs)
    want = []
    for d, t in docs:
        gone = drop.get((d is None, d or 0, t or ""), set())
        kept = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
        want.append((d, kept, 0 if t is None else len(t.split("\n")), len(gone)))
    assert sorted(map(tuple, line_dedup.dedup_lines(df).collect()), key=repr) == sorted(want, key=repr)


def test_lines_equal_brute_force(spark):
    check(spark, spark.createDataFrame(edit_lines(), "doc_id long, text string"))
    check(spark, spark.createDataFrame([(90 - i, t) for i, t in edit_lines()], "doc_id long, text string"))


def dropped(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: (r["text"], r["n_dropped"]) for r in line_dedup.dedup_lines(df).collect()}


def test_short_lines_repeat_once(spark):
    texts = ["Yes\n\nread more here", "yes\nno\n\n", "READ  more here\nread more", "没有空格的一行\n又一行", "没有空格的一行",
             "read more here\nread more there"]
    assert dropped(spark, texts) == {
        0: (texts[0], 0), 1: ("no\n\n", 1), 2: ("read more", 1), 3: (texts[3], 0), 4: ("", 1), 5: ("read more there", 1)}
    df = spark.createDataFrame([(1, "Title\n\nby Someone"), (2, "Title\n\nby Someone")], "doc_id long, text string")
    assert [r["doc_id"] for r in line_dedup.drop_duplicate_lines(df).collect()] == [1]  # no stub is left


def test_lines_within_a_fifth_equal_brute_force(spark):
    """The bound written out: equal, or one edit that is at most a fifth of the shorter line."""
    rng, texts = np.random.default_rng(7), []
    for n in range(1, 12):
        line = [f"n{n}w{i}" for i in range(n)]
        at = int(rng.integers(0, n))
        texts += [line, line[:at] + ["new"] + line[at + 1:], line[:at] + line[at + 1:], line[:at] + ["more"] + line[at:]]
        texts += [[f"f{i}" for i in range(n)], [f"f{i}" for i in range(n)][::-1]]
    texts = [" ".join(t) for t in texts]
    lines = [t.split() for t in texts]
    gone = [any(a == b or 5 * distance(a, b) <= min(len(a), len(b)) and distance(a, b) <= 1 for b in lines[:i])
            for i, a in enumerate(lines)]
    got = dropped(spark, texts)
    assert [got[i][1] for i in range(len(texts))] == [int(g and bool(a)) for g, a in zip(gone, lines)]
    assert dropped(spark, ["a b c d e f g h", "a b c d e f g", "v w x y z", "v w x y q"]) == {
        0: ("a b c d e f g h", 0), 1: ("", 1), 2: ("v w x y z", 0), 3: ("", 1)}


def test_lines_of_a_long_document(spark):
    """Cutting is linear: a quadratic one took minutes over 32,000 lines."""
    lines = [f"line {i} of a document with as many lines as it likes {i}" for i in range(32_000)]
    text = "\n".join(lines[:16_000] + lines)
    start = time.perf_counter()
    assert dropped(spark, [text])[0] == ("\n".join(lines), 16_000)
    assert time.perf_counter() - start < 60


def test_lines_edges(spark):
    df = awkward(spark)
    check(spark, df)
    out = line_dedup.drop_duplicate_lines(df)
    assert out.columns == df.columns
    assert out.filter("n_chars <> length(text)").count() == 0
    assert line_dedup.dedup_lines(nothing(spark)).count() == 0


def test_within_one_equals_distance():
    rng = np.random.default_rng(0)
    for _ in range(2000):
        a, b = (list(rng.integers(0, 3, rng.integers(0, 7))) for _ in range(2))
        assert line_dedup.within_one(a, b) == (distance(a, b) <= 1)


def test_variant_keys_meet_exactly_at_one_edit():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a, b = ([bytes([97 + x]) for x in rng.integers(0, 3, rng.integers(4, 8))] for _ in range(2))
        (wa, fa, pa_), (wb, fb, pb) = line_dedup.variant_keys(a), line_dedup.variant_keys(b)
        meet = wa == wb or wa in set(fb.tolist()) or wb in set(fa.tolist()) or bool(set(pa_.tolist()) & set(pb.tolist()))
        assert meet == (distance(a, b) <= 1)


def test_columns_untouched(spark):
    assert F.col is not None and line_dedup.drop_duplicate_lines(nothing(spark)).columns == nothing(spark).columns
