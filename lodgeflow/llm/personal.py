"""Operator 5: personal data by bootstrapped contextual extraction.

DataFrame functions only. Seeds are base matches (email, ip, card, phone). An entity's
lexical patterns are the word before it, the word after it, and both as a pair. A pattern
needs ``SUPPORT`` different seeds; its score for a kind is the weight of the known identifiers
of that kind in its place over all identifier-like words that stand there. Patterns of at
least ``SCORE`` count; an identifier-like word in such places gets ``1 - product(1 - score)``.
Both sides are scored in turns for ``ROUNDS`` rounds, and words of at least ``ACCEPT``
add spans of the kind their patterns know.

Positions are counted inside each row: text between matches and the matches have
known lengths, and running sums over blocks of lengths give the offsets. All
quantifiers are possessive or anchored where a run begins, which leaves the
matches as they are and keeps matching linear and free of recursion.

Defined cases: null text is empty; no matches give the digest of the empty text
and empty spans; repeated rows are scanned each; a null doc_id is carried through;
a neighbouring word of over ``REACH`` characters is no pattern; no documents, no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgeflow.llm.common import stored, text_of, with_row_number

KINDS = ["email", "ip", "card", "phone"]
_LOCAL = "[A-Za-z0-9._%+-]"
_SPACE = r"\x20\x09-\x0D"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # words that could be identifiers
    "word": rf"(?<![^{_SPACE}])[^{_SPACE}0-9@]*+[0-9@][^{_SPACE}]*+",
}
#: A cheap test that a text can match at all.
HINTS = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": r"\+[0-9]", "word": "[0-9@]"}
BLOCK = 64
REACH = 100
ROUNDS = 3
SUPPORT = 5  # different seeds a pattern needs
SCORE = 0.5  # patterns below it count nothing
ACCEPT = 0.6
LEAST_CHARS = 5  # of a discovered word


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda a, b: a + b)


def _running(lengths: Column) -> Column:
    """Sums up to and including each element, linear in blocks."""

    def by_blocks(blocks: Column) -> Column:
        before = F.transform(blocks, lambda _, b: _total(F.slice(blocks, F.lit(1), b)))
        return _let(before, lambda base: F.transform(lengths, lambda _, i: F.get(base, F.floor(i / BLOCK).cast("int"))
                    + _total(F.slice(lengths, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK + 1))))

    count = F.ceil(F.size(lengths) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), count - 1), lambda b: _total(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK))))
    return _let(blocks, by_blocks)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    turned = F.split(F.reverse(digits), "")
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    values = F.transform(F.filter(turned, lambda c: c != ""), lambda c, i: F.when(
        i % 2 == 1, doubled(c.cast("int"))).otherwise(c.cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: p.cast("double") <= 255)
    if kind == "card":
        n = F.length(_digits(match))
        return F.when((n >= 12) & (n <= 19), _luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind == "word":
        return F.length(match) >= LEAST_CHARS
    return F.lit(True)


_ITEM = "array<struct<start:int,end:int,kind:int,token:string,before:string,after:string>>"


def _matches(kind: str, text: Column) -> Column:
    """Valid matches with code-point offsets and their neighbouring words."""
    number = [*KINDS, "word"].index(kind)
    word = rf"[^{_SPACE}]"

    def items(found: Column, gaps: Column) -> Column:
        lengths = F.transform(found, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))
        last = lambda gap: F.regexp_extract(F.right(gap, F.lit(REACH)), rf"(?<!{word})({word}++)[{_SPACE}]*+$", 1)
        first = lambda gap: F.regexp_extract(F.left(gap, F.lit(REACH)), rf"^[{_SPACE}]*+({word}++)", 1)
        rows = _let(_let(lengths, _running), lambda ends: F.transform(found, lambda m, i: F.struct(
            (F.get(ends, i) - F.length(m)).alias("start"), F.get(ends, i).alias("end"), F.lit(number).alias("kind"),
            m.alias("token"), F.lower(last(F.get(gaps, i))).alias("before"),
            F.lower(first(F.get(gaps, i + 1))).alias("after"))))
        return F.filter(rows, lambda x: _valid(kind, x["token"]))

    pattern = F.lit(PATTERNS[kind])
    found = _let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda m: F.when(F.size(m) > 0, _let(
        F.split(text, PATTERNS[kind], -1), lambda gaps: items(m, gaps))))
    return F.coalesce(F.when(F.regexp_like(text, F.lit(HINTS[kind])), found), F.array()).cast(_ITEM)


def scan(docs: DataFrame) -> DataFrame:
    """row_id, doc_id, base and words (arrays of items) per document row, stored."""
    rows = with_row_number(docs.select("doc_id", text_of().alias("text")))
    return stored(rows.select("row_id", "doc_id", F.concat(*[_matches(k, F.col("text")) for k in KINDS]).alias("base"),
                              _matches("word", F.col("text")).alias("words")))


def _occurrences(scanned: DataFrame) -> DataFrame:
    """Base items, and identifier-like words that touch none of them."""
    rows = scanned.select("row_id", F.explode(F.concat("base", "words")).alias("i")).select("row_id", "i.*")
    base_end = F.when(F.col("kind") < len(KINDS), F.col("end"))
    base_start = F.when(F.col("kind") < len(KINDS), F.col("start"))
    order = Window.partitionBy("row_id").orderBy("start", "kind")
    rows = rows.withColumns({
        "reached": F.max(base_end).over(order.rowsBetween(Window.unboundedPreceding, 0)),
        "coming": F.min(base_start).over(order.rowsBetween(0, Window.unboundedFollowing))})
    touched = (F.col("kind") == len(KINDS)) & (F.coalesce(F.col("reached") > F.col("start"), F.lit(False))
                                               | F.coalesce(F.col("coming") < F.col("end"), F.lit(False)))
    return rows.filter(~touched).drop("reached", "coming").withColumn("token", F.lower("token"))


def _places(seen: DataFrame) -> DataFrame:
    """token, kind, side, cue: the patterns an entity or word stands in."""
    before, after = F.col("before"), F.col("after")
    place = lambda side, cue: F.struct(F.lit(side).alias("side"), cue.alias("cue"))
    sides = F.array(place("L", before), place("R", after),
                    place("B", F.when((before != "") & (after != ""), F.concat_ws(" ", before, after)).otherwise("")))
    return seen.select("token", "kind", F.explode(sides).alias("p")).select("token", "kind", "p.*").filter("cue <> ''")


def score_words(places: DataFrame) -> DataFrame:
    """token, as_kind, weight of the accepted words: patterns and words scored in turns.
    ``places``: token, kind, side, cue (kind ``len(KINDS)``: identifier-like, unknown)."""
    unknown = len(KINDS)
    supported = (places.filter(F.col("kind") < unknown).groupBy("side", "cue")
                 .agg(F.count_distinct("token").alias("seeds")).filter(F.col("seeds") >= SUPPORT).select("side", "cue"))
    edges = stored(places.join(stored(supported), ["side", "cue"], "left_semi")
                   .groupBy("side", "cue", "token", "kind").agg(F.count(F.lit(1)).alias("n")))
    totals = stored(edges.groupBy("side", "cue").agg(F.sum("n").alias("total")))
    seeds = edges.filter(F.col("kind") < unknown).select("token", F.col("kind").alias("as_kind"),
                                                         F.lit(1.0).alias("weight")).distinct()
    known, wanted = seeds, edges.filter(F.col("kind") == unknown)
    for _ in range(ROUNDS):
        scores = (edges.join(known, "token").groupBy("side", "cue", "as_kind")
                  .agg(F.sum(F.col("n") * F.col("weight")).alias("mass")).join(totals, ["side", "cue"])
                  .select("side", "cue", "as_kind", (F.col("mass") / F.col("total")).alias("score"))
                  .filter(F.col("score") >= SCORE))
        told = (wanted.join(scores, ["side", "cue"]).groupBy("token", "as_kind")
                .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))))).alias("weight")))
        best = told.groupBy("token").agg(F.max(F.struct("weight", -F.col("as_kind"))).alias("b")).select(
            "token", (-F.col("b.col2")).alias("as_kind"), F.col("b.weight").alias("weight"))
        found = stored(best.filter(F.col("weight") >= ACCEPT))
        known = seeds.unionByName(found.join(seeds.select("token"), "token", "left_anti"))
    return found


def discover(scanned: DataFrame) -> DataFrame:
    """row_id, start, end, kind of the words that the patterns reveal."""
    seen = stored(_occurrences(scanned))
    found = score_words(_places(seen))
    return seen.filter(F.col("kind") == len(KINDS)).join(found, "token").select(
        "row_id", "start", "end", F.col("as_kind").alias("kind"))


def _spans(items: Column) -> Column:
    ordered = F.array_sort(F.transform(items, lambda x: F.struct(x["start"], x["kind"], x["end"])))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def find_personal(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans per document row."""
    scanned = scan(docs)
    more = (discover(scanned).groupBy("row_id")  # a document's own spans only
            .agg(F.collect_list(F.struct("start", "end", "kind")).alias("more")))
    base = F.transform("base", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))
    rows = scanned.select("row_id", "doc_id", base.alias("base")).join(more, "row_id", "left")
    nothing = F.array().cast("array<struct<start:int,end:int,kind:int>>")
    of_kind = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    counts = [of_kind(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(_spans(F.col("base")), 256).alias("base_sha256"),
                       _spans(F.concat("base", F.coalesce("more", nothing))).alias("spans"))
