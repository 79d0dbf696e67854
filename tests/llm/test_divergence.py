from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lodgeflow.llm import divergence
from tests.llm.fixtures import awkward, nothing, prose


def brute(docs, least, ranks):
    """The report by plain loops over (lang, source, text)."""
    count, found = defaultdict(Counter), defaultdict(Counter)
    groups = sorted({(a or "", b or "") for a, b, _ in docs})
    for lang, source, text in docs:
        words = [w.translate({i: i + 32 for i in range(65, 91)}) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        count[lang or "", source or ""].update(words)
        found[lang or ""].update(set(words))
    out = []
    for lang in sorted({a for a, _ in groups}):
        kept = [t for t, n in found[lang].items() if n >= least]
        v, sources = len(kept), [s for a, s in groups if a == lang]
        total = Counter()
        for s in sources:
            total.update({t: count[lang, s][t] for t in kept})

        def share(own):
            n = sum(own[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (own[t] + 5) // (n + 5 * v) for t in kept}

        p, q = {s: share(count[lang, s]) for s in sources}, share(total)
        rank = lambda pairs: sorted(pairs, key=lambda x: (-x[1], x[0].encode()))
        for s in sources:
            pairs = rank([(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s])
            terms = rank([(t, p[s][t] - q[t]) for t in kept if count[lang, s][t] and p[s][t] > q[t]])[:ranks]
            out += [(lang, s, "pair", *x, i) for i, x in enumerate(pairs, 1)]
            out += [(lang, s, "term", *x, i) for i, x in enumerate(terms, 1)]
    return sorted(out)


def compare(spark, docs, least, ranks):
    df = spark.createDataFrame(docs, "lang string, source string, text string").repartition(7)
    got = divergence.audit(df, least, ranks).select("lang", "source", "part", "item", "value", "rank")
    assert sorted(map(tuple, got.collect())) == brute(docs, least, ranks)


def some_docs(n=120, seed=3):
    rng = random.Random(seed)
    words = [prose(i, 1) for i in range(60)] + ["É", "été", "Zß", "中文", "a's", "x1y"]
    return [(rng.choice(["en", "de", None]), rng.choice([None, "a", "b", "ü", "z"]),
             rng.choice([None, "", "1 2 3"]) if rng.random() < 0.1 else " ".join(rng.choices(words, k=rng.randint(1, 80))))
            for _ in range(n)]


def test_equals_brute_force(spark):
    compare(spark, some_docs(), 3, 5)


def test_many_blocks_chunks_and_rounds(spark, monkeypatch):
    for name, value in (("BLOCK", 2), ("CHUNK", 7), ("FAN", 2), ("HELD", 20)):
        monkeypatch.setattr(divergence, name, value)
    compare(spark, some_docs(seed=4), 2, 4)


def test_ties_rank_by_utf8(spark):
    docs = [("en", "a", "zeta Alpha éa beta ω 😀 ﬀ"), ("en", "b", "other"), ("en", "a", "zeta Alpha éa beta ω 😀 ﬀ"), ("xx", "a", "!!")]
    compare(spark, docs, 1, 6)


def test_languages_without_terms_and_single_sources(spark):
    compare(spark, [("en", "a", "x"), ("en", "b", None), ("de", "a", ""), ("fr", None, "y y y")], 2, 3)


def test_terms():
    text = "A1b\x00C'd É×÷ \xa0x\x7f_Z[y"
    assert divergence.terms(text.encode()) == [
        w.translate({i: i + 32 for i in range(65, 91)}).encode() for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]


@pytest.mark.parametrize("k", [1, 2, 5])
def test_skyband_equals_all_pairs(k):
    rng = np.random.default_rng(k)
    for _ in range(40):
        n = int(rng.integers(1, 40))
        count, total = rng.integers(0, 6, n), rng.integers(0, 6, n)
        term = [bytes([97 + i]) + b"x" for i in rng.permutation(n)]
        dominated = [sum(count[j] >= count[i] and total[j] <= total[i] and term[j] < term[i] for j in range(n)) for i in range(n)]
        assert sorted(divergence.skyband(count, total, term, k).tolist()) == [i for i in range(n) if dominated[i] < k]


def test_edges(spark):
    got = divergence.audit(awkward(spark), 1, 50)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    docs = [(r["lang"], r["source"], r["text"]) for r in awkward(spark).collect()]
    assert sorted(map(tuple, got.collect())) == brute(docs, 1, 50)
    assert divergence.audit(nothing(spark)).count() == 0
