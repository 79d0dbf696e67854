"""Operators 3, 4 and 8: exact round trips, held-out accuracy, gradients."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lodgeflow.llm import lm_scoring, packing, quality, recurrent
from lodgeflow.llm.common import table
from lodgeflow.llm.registry import tokenizer_json
from tests.llm.fixtures import awkward, nothing, prose

SF = "/root/testdata/sf0.001"


# --- 3 ---------------------------------------------------------------------------
@pytest.fixture(scope="module")
def plain_ids():
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(tokenizer_json())
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def check_packing(df, got, plain_ids, window):
    want = Counter(tuple(plain_ids(r["text"])) for r in df.collect())
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        docs[r["doc_id"], r["doc_tokens"]].append((r["start"], ids))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():  # gapless from 0
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))]
        assert sum(n for _, n in pieces) <= window
    assert sum(len(i) for p in docs.values() for _, i in p) == sum(len(k) * n for k, n in want.items())
    used = [sum(n for _, n in p) for p in sequences.values()]
    return sum(window - u for u in used if u & (u - 1)) / sum(used), docs, want


def test_pack_round_trip(spark, plain_ids):
    df = awkward(spark)
    got = packing.pack_documents(df, tokenizer_json()).collect()
    padding, docs, want = check_packing(df, got, plain_ids, packing.WINDOW)
    assert padding < 0.05
    single = {k: v for k, v in docs.items() if k[0] is not None and k[0] != 4}
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    for (doc, n), pieces in single.items():
        pieces.sort()
        assert [i for _, ids in pieces for i in ids] == plain_ids(texts[doc]) and len(plain_ids(texts[doc])) == n
    assert packing.pack_documents(nothing(spark), tokenizer_json()).count() == 0


def test_pack_pads_little(spark, plain_ids):
    df = table(spark, SF, "documents")
    got = packing.pack_documents(df, tokenizer_json()).collect()
    assert check_packing(df, got, plain_ids, packing.WINDOW)[0] < 0.01


def test_plan_fills_the_histogram():
    combos = packing.combinations(8, 3)
    assert (8,) in combos and (1, 3, 4) in combos and (2, 6) in combos
    assert all(sum(c) == 8 and len(c) <= 3 and list(c) == sorted(c) for c in combos) and len(set(combos)) == len(combos)
    histogram = np.array([4, 0, 6, 0, 6, 0, 4, 9.0])
    plan = dict(packing.repeat_counts(histogram, 8, 2))
    assert plan == pytest.approx({(1, 7): 4, (3, 5): 6, (8,): 9})


def test_nnls_optimality():
    rng = np.random.default_rng(2)
    for _ in range(20):
        a, b = rng.normal(size=(9, 14)), rng.normal(size=9)
        x = packing.nnls(a, b)
        g = a.T @ (b - a @ x)
        assert (x >= 0).all() and (g <= 1e-6).all() and np.abs(g[x > 0]).max(initial=0) < 1e-6


# --- 4 ---------------------------------------------------------------------------
def auc(score, y):
    rank = np.empty(len(score))
    rank[np.argsort(score)] = np.arange(len(score))
    return (rank[y == 1].mean() - rank[y == 0].mean()) / len(score) + 0.5


def test_trees_learn_and_flatten():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    model = quality.fit(x[:2000], y[:2000], trees=40, depth=3)
    assert auc(model.score(x[2000:]), y[2000:]) > 0.97
    slow = []
    for row in x[2000:2050]:
        total = model.prior
        for t in range(len(model.feature)):
            node = 0
            while node < model.feature.shape[1]:
                node = 2 * node + 1 + int(row[model.feature[t, node]] > model.limit[t, node])
            total += model.leaf[t, node - model.feature.shape[1]]
        slow.append(1 / (1 + math.exp(-total)))
    assert np.allclose(slow, model.score(x[2000:2050]))


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    got = quality.score_documents(table(spark, sf, "documents"), table(spark, sf, "labels")).toPandas()
    both = got.merge(table(spark, sf, "labels").toPandas(), on="doc_id")
    assert (both.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in both.doc_id]).all()
    held = both[both.held_out]
    assert auc(held.score.to_numpy(), held.quality.to_numpy()) > 0.95
    assert ((got.score >= 0.3) == (got.predicted == 1)).all()


def test_quality_edges(spark):
    df = awkward(spark)
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (13, 0, 0), (12, 0, 1), (4, None, None), (None, 1, 0), (3, 1, 0),
                                    (3, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality.score_documents(df, labels).collect()
    assert len(got) == df.count() and all(0 <= r["score"] <= 1 for r in got)
    assert quality.keep_good(df, labels).columns == df.columns
    none = quality.score_documents(df, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.score_documents(nothing(spark), labels).count() == 0


# --- 8 ---------------------------------------------------------------------------
def small_model(dtype=np.float64):
    layout = recurrent.Layout(np.array([50, 30, 20, 10, 5, 4, 3, 2, 1]), 3)
    return layout, {k: v.astype(dtype) for k, v in recurrent.start(layout, 4).items()}


def test_gradients_equal_differences():
    layout, p = small_model()
    rng = np.random.default_rng(0)
    h, x, y = rng.normal(size=(3, 4)), rng.integers(0, 9, (5, 3)), rng.integers(0, 9, (5, 3))
    used = np.ones((5, 3), bool)
    used[4, 2] = False
    grad = recurrent.gradients(p, layout, h, x, y, used)[0]
    loss = lambda: recurrent.gradients(p, layout, h, x, y, used)[2] / used.sum()
    for k, v in p.items():
        for _ in range(4):
            i = tuple(rng.integers(0, s) for s in v.shape)
            keep = v[i]
            v[i] = keep + 1e-4
            up = loss()
            v[i] = keep - 1e-4
            down = loss()
            v[i] = keep
            assert grad[k][i] == pytest.approx((up - down) / 2e-4, abs=2e-5, rel=5e-2)


def test_probabilities_sum_to_one_and_windows_do_not_matter():
    layout, p = small_model(np.float32)
    h = np.random.default_rng(1).normal(size=(1, 4)).astype(np.float32)
    each = recurrent.log_probabilities(p, layout, np.repeat(h, 9, 0), np.arange(9))
    assert np.exp(each).sum() == pytest.approx(1, abs=1e-5)
    texts = [np.array(t) for t in ([1, 2, 3, 4, 5, 6, 7, 8, 0], [3, 0], [0], list(range(9)) * 5)]
    long = recurrent.score(p, layout, texts, 0, window=64)
    assert np.allclose(long, recurrent.score(p, layout, texts, 0, window=4, batch=2), atol=1e-4)
    one = 0.0
    state, before = np.zeros((1, 4), np.float32), 0
    for s in texts[0]:
        state = recurrent._step(p, state, np.array([before]))[0]
        one += recurrent.log_probabilities(p, layout, state, np.array([s]))[0]
        before = s
    assert long[0] == pytest.approx(one, abs=1e-4)


def test_training_beats_counts():
    layout, p = small_model(np.float32)
    texts = [np.array([1, 2, 3, 4] * 6 + [0]) for _ in range(200)]
    before = recurrent.score(p, layout, texts[:1], 0)[0]
    recurrent.train(p, layout, texts, 0, recurrent.Adam(p, 0.02), batch=20)
    for _ in range(4):
        recurrent.train(p, layout, texts, 0, recurrent.Adam(p, 0.02), batch=20)
    assert recurrent.score(p, layout, texts[:1], 0)[0] > before / 2


def test_windows_read_every_symbol_once_and_lanes_stay_full():
    """A long text keeps one lane; the short ones share the others instead of waiting for its end."""
    texts = [np.arange(1, 41) % 9, *(np.array([1, 2, 3, i % 9]) for i in range(30))]
    read, last, count = [[] for _ in texts], np.zeros(0, int), 0
    for own, on, block, used in recurrent._windows(texts, 4, 4):
        assert (own[:len(on)] == last[on]).all() and len(own) <= 4
        for k, i in enumerate(own):
            read[i] += block[used[:, k], k].tolist()
        last, count = own, count + 1
    assert [t.tolist() for t in texts] == read
    assert count == 10  # 17 when a group of texts ends before the next one begins, as in training
    layout, p = small_model(np.float32)
    optimiser = recurrent.Adam(p, 0.02)
    assert recurrent.train(p, layout, texts, 0, optimiser, window=4, batch=4)[1] == 160 and optimiser.t == 17
    assert list(recurrent._windows([], 4, 4)) == []


def test_steps_of_unread_symbols_are_made_up_for():
    """As Adam over all rows in every step."""
    p = small_model()[1]
    plain, rng = {k: v.copy() for k, v in p.items()}, np.random.default_rng(3)
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    optimiser = recurrent.Adam(p, 0.01)
    for t in range(1, 41):
        rows = np.sort(rng.choice(9, 3, replace=False))
        grad = {k: rng.normal(size=x.shape) for k, x in p.items()}
        whole = {k: g * 1.0 for k, g in grad.items()}
        whole["g"][np.setdiff1d(np.arange(9), rows)] = 0
        optimiser.settle(p, rows)
        assert np.allclose(p["g"][rows], plain["g"][rows], atol=1e-6)
        optimiser.apply(p, {**grad, "g": grad["g"][rows]}, rows)
        shrink = min(1, 1 / np.sqrt(sum((g * g).sum() for g in whole.values())))
        for k, g in whole.items():
            m[k] = 0.9 * m[k] + 0.1 * shrink * g
            v[k] = 0.999 * v[k] + 0.001 * (shrink * g) ** 2
            rate = 0.01 * np.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t)
            plain[k] -= rate * m[k] / (np.sqrt(v[k]) + 1e-7)
    optimiser.settle(p)
    assert all(np.allclose(p[k], plain[k], atol=1e-6) for k in p)


def test_sums_by_symbol():
    symbols = np.array([[3, 3, 1], [0, 3, 3]] * 9)
    x = np.random.default_rng(4).normal(size=(symbols.size, 5))
    seen = recurrent._Seen(symbols, 9)
    assert seen.rows.tolist() == [0, 1, 3]
    assert np.allclose(seen.sums(x), [x[symbols.ravel() == s].sum(axis=0) for s in (0, 1, 3)])


def test_large_logits_give_probabilities():
    layout, p = small_model(np.float32)
    p["cw"] *= 1e5
    p["ow"] *= 1e5
    h = np.random.default_rng(1).normal(size=(1, 4)).astype(np.float32)
    each = recurrent.log_probabilities(p, layout, np.repeat(h, 9, 0), np.arange(9))
    assert np.exp(each).sum() == pytest.approx(1, abs=1e-5)


def brute(rows):
    tokens = [(r["doc_id"], [*(r["text"] or "").encode().lower().split(), None]) for r in rows]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    c = Counter(w for d, t in tokens if not held(d) for w in t)
    n, v = sum(c.values()), len(c)
    return sorted([(d if d is not None else -99, held(d), len(t), sum(c[w] > 0 for w in t), n,
                    round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 6)) for d, t in tokens])


@pytest.mark.parametrize("hot", [3, 200_000])
def test_base_scores_equal_brute_force(spark, monkeypatch, hot):
    """With three hot words nearly all words take the joined way."""
    monkeypatch.setattr(lm_scoring, "HOT", hot)
    monkeypatch.setattr(lm_scoring.learn_vocabulary, "__defaults__", (hot, lm_scoring.SYMBOLS))
    df = awkward(spark)
    got = lm_scoring.score_documents(df, rounds=1, share=1).collect()
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -99, r["held_out"], r["n_tokens"], r["n_known"],
                   r["train_tokens"], round(r["base_score"], 6)) for r in got) == brute(df.collect())
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_every_training_document_is_learnt_from(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(lm_scoring, "train_round", lambda texts, *rest: rounds.append(texts.collect()))
    rows = [(i if i % 4 else None, f"text {i}") for i in range(400)]
    lm_scoring.score_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in sum(rounds, [])))) == sorted(
        map(repr, (r for r in rows if not held(r[0]))))
    assert all(any(r["doc_id"] is None for r in taught) for taught in rounds)  # they are dealt out too
    with pytest.raises(ValueError):
        lm_scoring.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), rounds=1, share=2)


def test_scores_of_nothing(spark):
    assert lm_scoring.score_documents(nothing(spark)).count() == 0


# --- 8 on held-out documents ------------------------------------------------------
def held_out_sums(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    return lm_scoring.score_documents(docs).filter("held_out").agg({"score": "sum", "base_score": "sum"}).first()


def test_held_out_documents_are_likelier_than_by_counts(spark):
    r = held_out_sums(spark, "sf0.01")
    assert r["sum(score)"] > 0.98 * r["sum(base_score)"]  # logarithms: less is better by 2 % at least


def test_tree_of_means_is_the_mean(spark, monkeypatch):
    flat = held_out_sums(spark, "sf0.001")["sum(score)"]
    monkeypatch.setattr(lm_scoring, "FAN_IN", 2)  # six copies: three levels
    assert held_out_sums(spark, "sf0.001")["sum(score)"] == pytest.approx(flat, rel=1e-4)
