"""Operator 6: quality rules and robust multivariate outliers.

DataFrame functions only. Word and line statistics are worked out inside each row.
Per language and source a minimum-covariance-determinant estimate is fitted to
transformed statistics. It has ``STARTS`` deterministic starts, all around the medians:
quartile ranges alone, the correlation of bounded (tanh) values, and that of
spatial signs. A concentration step keeps the ``HALF`` share of documents nearest by
Mahalanobis distance and re-estimates mean and covariance from them, which never
raises the determinant; after ``TRIALS`` steps the start of the least determinant goes on
for ``STEPS`` more. A reweighting step follows. Documents beyond the chi-square ``TAIL``
of their group are rejected.

No direction gets less variance than the floors in ``VECTOR``, which only matters where a
group hardly varies: a floor is the least a pivot of the Cholesky factor may be, nothing is
added to other covariances.

The transformed vectors are stored once; each step aggregates moments (map-side
first) and joins one row per group, start and salt, so a source with a third of all
documents is neither gathered nor joined in one task.

Defined cases: null text has no words and fails the base rule; a null lang or
source is a value of its own; a group of fewer than ``LEAST`` usable documents
uses its language's estimate, then that of all documents; without any usable
document nothing but the base rule decides; repeated rows count each; no
documents, no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import SPACES, stored, text_of, words_native

WINDOW = 5
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 10
MOST_REPEATED = 20  # percent of words

#: Transformed statistics with the least standard deviation they are given.
VECTOR = {"v_words": 0.5, "v_length": 0.1, "v_symbols": 0.05, "v_lines": 0.15, "v_repeats": 0.1, "v_distinct": 0.05}
HALF = 0.75
STARTS, TRIALS, STEPS = 3, 2, 2
TAIL = 1e-6
LEAST = 200
SALTS = 32
NAMES = list(VECTOR)
D = len(NAMES)


# --- statistics ----------------------------------------------------------------
def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.transform(F.array(value), body)[0]


def _repeated(windows: Column) -> Column:
    """Words covered by windows whose hash occurs again in the array."""

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def places(ranked: Column) -> Column:
        twice = F.filter(ranked, lambda x, k: (x["h"] == F.get(ranked, k - 1)["h"])
                         | (x["h"] == F.get(ranked, k + 1)["h"]))
        return _let(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    ranked = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), _let(ranked, places)).otherwise(0)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source with the five counts, base_failed and two more counts."""
    text = text_of()
    rows = docs.select("doc_id", "lang", "source", text.alias("text"), words_native(text).alias("words"))
    n = F.size("words")
    word_at = lambda i: F.get(F.col("words"), i)
    windows = F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[word_at(i + j) for j in range(WINDOW)])))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    counted = rows.select(
        "doc_id", "lang", "source",
        n.cast("long").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct"))
             ).alias("lines"),
        F.coalesce(_let(windows, _repeated), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.array_distinct("words")).alias("n_distinct"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return counted.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols",
        (F.col("lines.n") - F.col("lines.distinct")).cast("long").alias("n_dup_lines"), "n_repeat_words",
        failed.alias("base_failed"), F.col("lines.n").alias("n_lines"), "n_distinct")


def vectors(stats: DataFrame) -> DataFrame:
    """Adds the transformed statistics (finite for every row)."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return stats.withColumns({
        "v_words": F.log1p(F.col("n_words").cast("double")),
        "v_length": F.log1p(F.col("word_chars") / n),
        "v_symbols": F.sqrt(F.least(F.col("n_symbols") / n, F.lit(4.0))),
        "v_lines": F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        "v_repeats": F.sqrt(F.col("n_repeat_words") / n),
        "v_distinct": F.log1p(F.col("n_distinct").cast("double")) / F.log1p(n),
    })


# --- estimates -------------------------------------------------------------------
def chi_square_cdf(x: float, d: int) -> float:
    """For even d."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(d // 2))


def chi_square_quantile(p: float, d: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, d) < p else (low, mid)
    return (low + high) / 2


def consistency(share: float) -> float:
    """Factor that undoes the shrinkage of a covariance of the nearest share."""
    return share / chi_square_cdf(chi_square_quantile(share, D), D + 2)


def _salted(params: DataFrame) -> DataFrame:
    return params.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _distance(stats: DataFrame, params: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance by the group's mean and whitening factor."""
    near = stats.join(_salted(params), [k for k in ("g", "start", "salt") if k == "salt" or k in params.columns])
    parts = []
    for i in range(D):
        z = sum(((F.col(NAMES[j]) - F.col(f"m{j}")) * F.col(f"w{i}{j}") for j in range(i + 1)), F.lit(0.0))
        parts.append(z * z)
    return near.withColumn("d2", sum(parts, F.lit(0.0)))


PAIRS = [(i, j) for i in range(D) for j in range(i + 1)]


def _moments(rows: DataFrame, factor: float, keys: list[str]) -> DataFrame:
    """Estimate (see ``_factored``) of the given rows per key."""
    sums = [F.sum(NAMES[i]).alias(f"s{i}") for i in range(D)]
    sums += [F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"s{i}{j}") for i, j in PAIRS]
    t = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sums)
    mean = lambda i: F.col(f"s{i}") / F.col("n")
    return _factored(t.select(*keys, "n", *[mean(i).alias(f"m{i}") for i in range(D)], *[
        (F.lit(factor) * (F.col(f"s{i}{j}") / F.col("n") - mean(i) * mean(j))).alias(f"c{i}{j}") for i, j in PAIRS]), keys)


def _factored(t: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n, mean m, inverse Cholesky factor w and logarithm of the determinant, from means
    and covariances; pivots below the floors are raised to them."""
    t = stored(t)
    for i in range(D):  # Cholesky rows; a column per entry keeps the expressions short
        for j in range(i):
            inner = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            t = t.withColumn(f"l{i}{j}", (F.col(f"c{i}{j}") - inner) / F.col(f"l{j}{j}"))
        inner = sum((F.col(f"l{i}{k}") * F.col(f"l{i}{k}") for k in range(i)), F.lit(0.0))
        t = t.withColumn(f"l{i}{i}", F.sqrt(F.greatest(F.col(f"c{i}{i}") - inner, F.lit(VECTOR[NAMES[i]] ** 2))))
    t = stored(t)
    for i in range(D):
        for j in range(i):
            inner = sum((F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)), F.lit(0.0))
            t = t.withColumn(f"w{i}{j}", -inner / F.col(f"l{i}{i}"))
        t = t.withColumn(f"w{i}{i}", 1 / F.col(f"l{i}{i}"))
    log_det = sum((2 * F.log(f"l{i}{i}") for i in range(D)), F.lit(0.0))
    kept = [f"m{i}" for i in range(D)] + [f"w{i}{j}" for i, j in PAIRS]
    return stored(t.select(*keys, "n", *kept, log_det.alias("log_det")))


def _starts(usable: DataFrame) -> DataFrame:
    """One estimate per group and start, around the medians."""
    q = usable.groupBy("g").agg(F.count(F.lit(1)).alias("n"), *[
        F.percentile_approx(v, [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i, v in enumerate(NAMES)])
    spread = lambda i: F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(VECTOR[NAMES[i]]))
    q = stored(q.select("g", "n", *[F.col(f"q{i}")[1].alias(f"m{i}") for i in range(D)],
                        *[spread(i).alias(f"d{i}") for i in range(D)]))
    z = usable.join(_salted(q.drop("n")), ["g", "salt"]).select(
        "g", *[((F.col(NAMES[i]) - F.col(f"m{i}")) / F.col(f"d{i}")).alias(f"z{i}") for i in range(D)])
    length = F.sqrt(sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(D)), F.lit(0.0)))
    z = z.select("g", *[F.tanh(f"z{i}").alias(f"t{i}") for i in range(D)],
                 *[(F.col(f"z{i}") / F.greatest(length, F.lit(1e-9))).alias(f"u{i}") for i in range(D)])
    second = z.groupBy("g").agg(*[F.avg(F.col(f"{v}{i}") * F.col(f"{v}{j}")).alias(f"{v}{i}{j}") for v in "tu" for i, j in PAIRS],
                                *[F.avg(f"t{i}").alias(f"a{i}") for i in range(D)])
    t = q.join(second, "g")
    bounded = lambda i, j: F.col(f"t{i}{j}") - F.col(f"a{i}") * F.col(f"a{j}")
    signs = lambda i, j: F.col(f"u{i}{j}")

    def correlated(of, i: int, j: int) -> Column:
        if i == j:
            return F.lit(1.0)
        size = F.sqrt(of(i, i) * of(j, j))
        return F.when(size > 1e-12, F.greatest(F.least(of(i, j) / size, F.lit(0.99)), F.lit(-0.99))).otherwise(0.0)

    kinds = [lambda i, j: F.lit(1.0 if i == j else 0.0), lambda i, j: correlated(bounded, i, j), lambda i, j: correlated(signs, i, j)]
    out = None
    for start, kind in enumerate(kinds):
        one = t.select("g", F.lit(start).alias("start"), "n", *[f"m{i}" for i in range(D)], *[
            (kind(i, j) * F.col(f"d{i}") * F.col(f"d{j}")).alias(f"c{i}{j}") for i, j in PAIRS])
        out = one if out is None else out.unionByName(one)
    return _factored(out, ["g", "start"])


def _concentrated(rows: DataFrame, params: DataFrame) -> DataFrame:
    """One concentration step per group and start."""
    near = _distance(rows, params)
    edge = near.groupBy("g", "start").agg(F.percentile_approx("d2", HALF, 1000).alias("edge"))
    inside = _distance(rows, params.join(edge, ["g", "start"])).filter("d2 <= edge")
    return _moments(inside, consistency(HALF), ["g", "start"])


def least_determinant(usable: DataFrame) -> DataFrame:
    """Raw estimate per group g of rows with vectors and salt: the best start, concentrated."""
    params = _starts(usable)
    every = usable.withColumn("start", F.explode(F.sequence(F.lit(0), F.lit(STARTS - 1))))
    for _ in range(TRIALS):
        params = _concentrated(every, params)
    best = params.groupBy("g").agg(F.min(F.struct("log_det", "start")).alias("b")).select("g", F.col("b.start").alias("start"))
    params = stored(params.join(best, ["g", "start"]).withColumn("start", F.lit(0)))
    one = usable.withColumn("start", F.lit(0))
    for _ in range(STEPS):
        params = _concentrated(one, params)
    return params.drop("start")


def fit(usable: DataFrame) -> DataFrame:
    """Reweighted estimate per group."""
    inside = _distance(usable, least_determinant(usable)).filter(F.col("d2") <= chi_square_quantile(0.975, D))
    return _moments(inside, consistency(0.975), ["g"]).drop("log_det")


def _grouped(rows: DataFrame) -> DataFrame:
    """Adds g (the finest group with LEAST usable documents) and salt."""
    lang = F.coalesce(F.concat(F.lit("s"), F.col("lang")), F.lit("~"))
    source = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("~"))
    salt = F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int")
    rows = stored(rows.withColumns({"by_lang": lang, "by_source": source, "salt": salt}))
    sizes = rows.filter("NOT base_failed").groupBy("by_lang", "by_source").agg(F.count(F.lit(1)).alias("n_source"))
    langs = sizes.groupBy("by_lang").agg(F.sum("n_source").alias("n_lang"))
    chosen = rows.select("by_lang", "by_source").distinct().join(sizes, ["by_lang", "by_source"], "left").join(
        langs, "by_lang", "left").select("by_lang", "by_source", F.when(
            F.col("n_source") >= LEAST, F.concat_ws("\x1f", F.lit("2"), "by_lang", "by_source")).when(
            F.col("n_lang") >= LEAST, F.concat_ws("\x1f", F.lit("1"), "by_lang")).otherwise("0").alias("g"))
    return rows.join(_salted(chosen), ["by_lang", "by_source", "salt"])


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, kept, distance per document row."""
    rows = stored(_grouped(vectors(statistics(docs))))
    usable = rows.filter("NOT base_failed")
    # coarser groups learn from all documents they cover, not only from those that fell back on them
    levels = [usable.withColumn("g", F.lit("0"))]
    levels.append(usable.withColumn("g", F.concat_ws("\x1f", F.lit("1"), "by_lang")))
    levels.append(usable.filter(F.col("g").startswith("2")))
    needed = rows.select(F.substring("g", 1, 1).alias("level")).distinct().collect()  # three values at most
    params = None
    for level in sorted(r["level"] for r in needed):
        found = fit(levels[int(level)])
        params = found if params is None else params.unionByName(found)
    if params is None:
        return rows.select(*OUT, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance"))
    judged = _distance_left(rows, params)
    cutoff = chi_square_quantile(1 - TAIL, D)
    return judged.select(*OUT, (~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= cutoff)).alias("kept"),
                         F.sqrt("d2").alias("distance"))


OUT = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def _distance_left(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Distances of all rows; null where no estimate exists."""
    known = params.select("g").withColumn("known", F.lit(True))
    marked = rows.join(_salted(known), ["g", "salt"], "left")
    return _distance(marked.filter("known"), params).drop(*[c for c in params.columns if c != "g"]).unionByName(
        marked.filter("known IS NULL").withColumn("d2", F.lit(None).cast("double")))
