"""Operators 5, 6 and 10 against plain Python; no Python nodes in their plans."""

import hashlib
import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgeflow.llm import mixing, outliers, personal
from tests.llm.fixtures import awkward, nothing, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sizes(text):
    return len(WORD.findall(text or ""))


# --- 10 --------------------------------------------------------------------------
def water_level(totals, weights, share):
    left = {i: w for i, w in enumerate(weights)}
    target, budget = {}, share * sum(totals)
    while left:
        level = budget / sum(left.values())
        full = [i for i in left if level * left[i] > 2 * totals[i]]
        if not full:
            target |= {i: level * w for i, w in left.items()}
            break
        for i in full:
            target[i] = 2.0 * totals[i]
            budget -= target[i]
            del left[i]
    return [target[i] for i in range(len(totals))]


def test_mix_targets_and_whole_documents(spark):
    rows = awkward(spark)
    got = mixing.mix_plan(rows).collect()
    assert len(got) == rows.count()
    plain = rows.select("doc_id", "text", "source").collect()
    order = sorted({r["source"] for r in plain}, key=lambda s: (s is None, (s or "").encode()))
    totals = [sum(sizes(r["text"]) for r in plain if r["source"] == s) for s in order]
    want = water_level(totals, [[3, 1, 2][i % 3] for i in range(len(order))], 1.5)
    by_size = {t: w for t, w in zip(totals, want)}
    assert sum(want) == pytest.approx(1.5 * sum(totals))
    for r in got:
        assert r["target"] == pytest.approx(by_size[r["source_size"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"])


def test_mix_comes_near_its_targets(spark):
    rows = [(i, prose(i, 20 + i % 50), "en", "hot" if i % 3 else f"s{i % 5}", 0) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.mix_plan(df).toPandas().groupby(["source_size", "target"]).taken.sum().reset_index()
    assert ((got.taken - got.target).abs() <= 70).all()
    assert mixing.mix_documents(df).count() == sum(
        r["taken"] // r["size"] for r in mixing.mix_plan(df).collect())


def test_mix_keeps_columns_and_stands_empty_tables(spark):
    assert mixing.mix_documents(awkward(spark)).columns == awkward(spark).columns
    assert mixing.mix_plan(nothing(spark)).count() == 0
    assert mixing.mix_documents(nothing(spark)).count() == 0


# --- 6 ---------------------------------------------------------------------------
def counts(text):
    w = WORD.findall(text or "")
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    many = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if many[g] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(covered))


def test_quality_counts(spark):
    rows = awkward(spark)
    got = sorted(tuple(r) for r in outliers.statistics(rows).select(
        F_key(), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect())
    want = sorted((-99 if r["doc_id"] is None else r["doc_id"], *counts(r["text"])) for r in rows.collect())
    assert got == want


def F_key():
    from pyspark.sql import functions as F
    return F.coalesce("doc_id", F.lit(-99))


def test_outliers_rejects_the_odd_and_keeps_the_rest(spark):
    plain = [(i, prose(i, 60 + i % 90), "en", "a" if i % 2 else None, 0) for i in range(600)]
    odd = [(1000 + i, " | ".join(prose(i, 40).split()), "en", "a", 0) for i in range(20)]
    df = spark.createDataFrame(plain + odd, "doc_id long, text string, lang string, source string, n_chars long")
    got = outliers.judge(df).collect()
    assert all(r["kept"] for r in got if r["doc_id"] < 1000)
    assert not any(r["kept"] for r in got if r["doc_id"] >= 1000)


def plain_mcd(x, floors, rng, tries=200):
    """Least log-determinant of random starts with concentration steps to the end, by numpy."""
    h, best = math.ceil(outliers.HALF * len(x)), math.inf
    for _ in range(tries):
        own = x[rng.choice(len(x), x.shape[1] + 2, replace=False)]
        before = math.inf
        while True:
            mean, cov = own.mean(axis=0), np.cov(own.T, bias=True) + 1e-9 * np.eye(x.shape[1])
            distance = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
            own = x[np.argsort(distance, kind="stable")[:h]]
            size = np.linalg.slogdet(np.cov(own.T, bias=True) * outliers.consistency(outliers.HALF))[1]
            if size >= before - 1e-9:
                break
            before = size
        best = min(best, before)
    return best


def test_least_determinant_equals_many_random_starts(spark):
    """Two groups, a fifth of each far off in a cloud of its own and correlated columns."""
    rng = np.random.default_rng(4)
    rows, want = [], {}
    for g in ("2a", "2b"):
        mix = rng.normal(size=(6, 6)) + 2 * np.eye(6)
        x = rng.normal(size=(300, 6)) @ mix * 3
        x[:60] = rng.normal(size=(60, 6)) * 0.5 + 90
        want[g] = plain_mcd(x, None, rng)
        rows += [(g, i % outliers.SALTS, *map(float, v)) for i, v in enumerate(x)]
    usable = spark.createDataFrame(rows, "g string, salt int, " + ", ".join(f"{n} double" for n in outliers.NAMES))
    raw = {r["g"]: r for r in outliers.least_determinant(usable).collect()}
    for g in want:
        assert raw[g]["log_det"] <= want[g] + 0.05
    # the clouds are beyond the cut-off of the reweighted estimate, the rest is not
    far = outliers._distance(usable, outliers.fit(usable)).collect()
    cut = outliers.chi_square_quantile(1 - outliers.TAIL, 6)
    assert [r["d2"] > cut for r in far] == [r["v_words"] > 80 for r in far]


def test_concentration_never_raises_the_determinant(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_t(2, size=(400, 6)) * 4
    usable = spark.createDataFrame([("2", i % outliers.SALTS, *map(float, v)) for i, v in enumerate(x)],
                                   "g string, salt int, " + ", ".join(f"{n} double" for n in outliers.NAMES))
    params = outliers._starts(usable)
    every = usable.withColumn("start", F.explode(F.sequence(F.lit(0), F.lit(outliers.STARTS - 1))))
    sizes = []
    for _ in range(4):
        params = outliers._concentrated(every, params)
        sizes.append({r["start"]: r["log_det"] for r in params.collect()})
    assert all(b[k] <= a[k] + 1e-6 for a, b in zip(sizes, sizes[1:]) for k in a)


def test_floors_are_a_least_not_an_addend(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(500, 6)) * 3
    x[:, 2] = 0.25  # a statistic that does not vary at all
    usable = spark.createDataFrame([("2", i % outliers.SALTS, *map(float, v)) for i, v in enumerate(x)],
                                   "g string, salt int, " + ", ".join(f"{n} double" for n in outliers.NAMES))
    r = outliers._moments(usable, 1.0, ["g"]).first()
    cov = np.cov(np.delete(x, 2, axis=1).T, bias=True)
    assert r["log_det"] == pytest.approx(np.linalg.slogdet(cov)[1] + 2 * math.log(outliers.VECTOR["v_symbols"]))


def test_outliers_edges(spark):
    got = outliers.judge(awkward(spark)).collect()
    assert len(got) == awkward(spark).count()
    assert all(r["base_failed"] and not r["kept"] for r in got if r["n_words"] < 10)
    assert outliers.judge(nothing(spark)).count() == 0


def test_chi_square():
    assert outliers.chi_square_quantile(0.95, 6) == pytest.approx(12.5916, abs=1e-3)
    assert outliers.chi_square_cdf(outliers.chi_square_quantile(0.3, 8), 8) == pytest.approx(0.3)


# --- 5 ---------------------------------------------------------------------------
RULES = [re.compile(p) for p in (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(text):
    d = [int(c) for c in text if c in "0123456789"][::-1]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


def base_spans(text):
    out = []
    for k, rule in enumerate(RULES):
        for m in rule.finditer(text or ""):
            n = sum(c in "0123456789" for c in m[0])
            if (k == 0 or k == 1 and all(int(x) <= 255 for x in m[0].split("."))
                    or k == 2 and 12 <= n <= 19 and luhn(m[0]) or k == 3 and 9 <= n <= 15):
                out.append((m.start(), k, m.end()))
    return sorted(out)


TRICKY = [
    "a@b.c_d@e.f x..y@z.w.v@q.r 1.2.3.4.5.6.7.8 256.1.1.1 1.2.3 00.0.0.0255 +1 (2) 3 12345678901234567890",
    "4111 1111 1111 1111 x4111-1111-1111-1111-5 4111--1111 +12345678 +123456789 +1.2.3.4.5.6.7.8.9.",
    "é😀 a@b.co " * 200 + "1 2 3 4 5 " * 2000, "9" * 30000 + " " + "a.1" * 15000 + "@", "@@@ +++ ...",
]


def test_base_spans_equal_plain_regular_expressions(spark):
    rows = awkward(spark).select("doc_id", "text").unionByName(spark.createDataFrame(
        [(500 + i, t) for i, t in enumerate(TRICKY)], "doc_id long, text string"))
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -99, r["n_email"], r["n_ip"], r["n_card"], r["n_phone"],
                  r["base_sha256"]) for r in personal.find_personal(rows).collect())
    want = []
    for r in rows.collect():
        s = base_spans(r["text"])
        joined = ",".join(f"{personal.KINDS[k]}:{a}:{b}" for a, k, b in s)
        want.append((r["doc_id"] if r["doc_id"] is not None else -99, *[sum(x[1] == k for x in s) for k in range(4)],
                     hashlib.sha256(joined.encode()).hexdigest()))
    assert got == sorted(want)


def test_contexts_discover_unseen_identifiers(spark):
    """Cards behind "kartennummer:" teach the pattern; a number that fails Luhn there is found."""
    rng_cards = ["4111111111111111", "4012888888881881", "5555555555554444", "5105105105105100", "4222222222222220",
                 "6011111111111117", "3530111333300000"]
    cards = [c for c in rng_cards if luhn(c)]
    assert len(cards) >= personal.SUPPORT
    rows = [(i, f"{prose(i, 20)} kartennummer: {c} danke {prose(i + 50, 5)}") for i, c in enumerate(cards)]
    rows += [(100, f"{prose(100, 10)} kartennummer: 4111222233334445 danke sehr"),
             (101, f"{prose(101, 10)} bestellung 998877665544 kam an")]
    got = {r["doc_id"]: r for r in personal.find_personal(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = rows[-2][1]
    at = text.index("4111222233334445")
    assert not luhn("4111222233334445") and got[100]["n_card"] == 0
    assert got[100]["spans"] == f"card:{at}:{at + 16}"
    assert got[101]["spans"] == ""


def test_a_third_of_the_identifiers_unseen(spark):
    """A cue with two thirds known numbers yields the others, whatever follows them."""
    known = [(i, f"{prose(i, 8)} phone: +4369912{i:05d} {prose(i + 400, 6)}") for i in range(60)]
    unseen = [(100 + i, f"{prose(100 + i, 8)} phone: 0699/12{i:05d} {prose(i + 600, 6)}") for i in range(30)]
    # one cue for two kinds tells nothing
    mixed = [(200 + i, f"{prose(200 + i, 5)} contact {c} {prose(i + 800, 3)}") for i, c in enumerate(
        [f"a{k}@mail.example" for k in range(8)] + [f"10.0.0.{k}" for k in range(8)] + ["ticket-4711-x", "ticket-4712-x"])]
    rows = known + unseen + mixed
    got = {r["doc_id"]: r["spans"] for r in personal.find_personal(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in unseen:
        at = text.index("0699/")
        assert got[i] == f"phone:{at}:{at + 12}"
    assert got[216] == got[217] == ""


def plain_scores(places):
    """The rounds by plain loops: token -> (kind, weight)."""
    unknown = len(personal.KINDS)
    seeds = {}
    for token, kind, side, cue in places:
        if kind < unknown:
            seeds.setdefault((side, cue), set()).add(token)
    patterns = {p for p, s in seeds.items() if len(s) >= personal.SUPPORT}
    edges = Counter((p, token, kind) for token, kind, *p in map(list, places) for p in [tuple(p)] if p in patterns)
    total = Counter()
    for (p, _, _), n in edges.items():
        total[p] += n
    sure = {(t, k): 1.0 for _, t, k in edges if k < unknown}
    known, found = dict(sure), {}
    for _ in range(personal.ROUNDS):
        mass = Counter()
        for (p, t, _), n in edges.items():
            for (token, kind), weight in known.items():
                if token == t:
                    mass[p, kind] += n * weight
        scores = {x: m / total[x[0]] for x, m in mass.items() if m / total[x[0]] >= personal.SCORE}
        left = Counter()
        for p, t, k in edges:
            if k == unknown:
                for (q, kind), s in scores.items():
                    if q == p:
                        left[t, kind] += math.log(max(1 - s, 1e-9))
        found = {}
        for (t, kind), x in left.items():
            if 1 - math.exp(x) >= personal.ACCEPT - 1e-12:
                found[t] = max(found.get(t, (0, 0)), (1 - math.exp(x), -kind))
        known = dict(sure) | {(t, -k): w for t, (w, k) in found.items() if not any(u == t for u, _ in sure)}
    return {t: (-k, w) for t, (w, k) in found.items()}


def test_scores_equal_plain_loops(spark):
    rng = random.Random(12)
    for _ in range(3):
        places = []
        for side, cue, kind, share in (("L", "a", 0, 0.7), ("L", "b", 1, 0.55), ("R", "c", 0, 0.6), ("B", "a c", 0, 0.8), ("L", "d", 3, 0.3)):
            for _ in range(40):
                seen = rng.random() < share
                token = f"{'s' if seen else 'u'}{rng.randrange(25)}"
                places.append((token, kind if seen else len(personal.KINDS), side, cue))
        got = {r["token"]: (r["as_kind"], r["weight"]) for r in personal.score_words(
            spark.createDataFrame(places, "token string, kind int, side string, cue string")).collect()}
        want = plain_scores(places)
        assert {t: k for t, (k, _) in got.items()} == {t: k for t, (k, _) in want.items()} and want
        for t in want:
            assert got[t][1] == pytest.approx(want[t][1])


def test_personal_empty(spark):
    assert personal.find_personal(nothing(spark)).count() == 0


def test_no_python_in_native_plans(spark):
    for df in (mixing.mix_plan(awkward(spark)), outliers.judge(awkward(spark)), personal.find_personal(awkward(spark))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
    assert math.isfinite(outliers.consistency(0.75))


def test_scan_is_linear_in_matches(spark):
    """16,000 identifier-like words; a quadratic scan took most of a minute."""
    text = " ".join(f"id{i:05}x" for i in range(16_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.perf_counter()
    words = personal.scan(df).select("words").first()["words"]
    assert time.perf_counter() - start < 20
    assert [text[w["start"]:w["end"]] for w in words] == text.split(" ")
