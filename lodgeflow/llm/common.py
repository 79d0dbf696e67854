"""Small helpers the operators share: words, row numbers, scratch tables."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeflow.session import ensure_checkpoint_dir

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
SPACES = " \t\n\x0b\f\r"
_TO_SPACE = {ord(c): " " for c in SPACES}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def words_native(text: Column) -> Column:
    """Array of words, JVM-side: one-character split after mapping the six
    white-space characters to a blank (no regular expression per character)."""
    return F.array_remove(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), "")


def split_words(text: str) -> list[str]:
    """Words of a text. ``str.split()`` alone would also split at other Unicode
    white space, so the six characters are mapped to a blank first."""
    return [w for w in text.translate(_TO_SPACE).split(" ") if w]


def lower_words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text with A-Z lower-cased: ``bytes`` lower-cases and
    splits by exactly these ASCII characters."""
    return text.lower().split()


def with_row_number(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Adds an identifier per row that also tells repeated rows apart. It is
    only stable once stored, so callers write the result to a scratch table
    before they use it twice."""
    return df.withColumn(name, F.monotonically_increasing_id())


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """Write to the shared scratch folder and read back (cuts the lineage). The
    shuffle files of the write go as soon as it ends: nothing reads them again."""
    spark = df.sparkSession
    path, before = scratch_path(spark, "stored"), spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, kind: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
