"""Map the driver's TPC-H-like tables to the three raw marketplace tables.

customer → raw_hosts, orders → raw_listings, lineitem → raw_reviews. The
rules are the ones fixed in ``FIXTURES.md`` §2; the oracle SQL repeats them
in DuckDB's dialect. Each mapping is a pure projection, so it keeps the scan's
partitioning and only the referenced columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeflow.sources.raw import moon_calendar

# Fixed values of the mapping (FIXTURES.md §2).
HOST_EPOCH = "1994-01-01"
ROOM_TYPES = {
    "1-URGENT": "Entire home/apt",
    "2-HIGH": "Private room",
    "3-MEDIUM": "Shared room",
}
OTHER_ROOM_TYPE = "Hotel room"
LISTING_URL_PREFIX = "https://example.com/rooms/"
SENTIMENTS = {"A": "negative", "N": "neutral"}
OTHER_SENTIMENT = "positive"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_hosts(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    epoch = F.lit(HOST_EPOCH).cast("date")
    return customer.select(
        k.alias("id"),
        F.when(k % 50 == 0, F.lit(None)).otherwise(F.col("c_name")).alias("name"),
        F.when(k % 40 == 0, F.lit(None))
         .when(F.col("c_acctbal") >= 5000, F.lit("t")).otherwise(F.lit("f"))
         .alias("is_superhost"),
        F.date_add(epoch, (k % 1000).cast("int")).cast("timestamp_ntz").alias("created_at"),
        F.date_add(epoch, (k % 1000 + k % 30).cast("int")).cast("timestamp_ntz")
         .alias("updated_at"),
    )


def raw_listings(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    room = F.when(F.col("o_orderpriority") == "1-URGENT", ROOM_TYPES["1-URGENT"])
    for prio in ("2-HIGH", "3-MEDIUM"):
        room = room.when(F.col("o_orderpriority") == prio, ROOM_TYPES[prio])
    return orders.select(
        k.alias("id"),
        F.concat(F.lit(LISTING_URL_PREFIX), k.cast("string")).alias("listing_url"),
        F.concat(F.lit("Listing "), k.cast("string")).alias("name"),
        room.otherwise(OTHER_ROOM_TYPE).alias("room_type"),
        (k % 40).cast("bigint").alias("minimum_nights"),
        F.when(k % 97 == 0, -1 - F.col("o_custkey")).otherwise(F.col("o_custkey"))
         .alias("host_id"),
        F.concat(F.lit("$"), F.floor((cents % 50000) / 100).cast("bigint").cast("string"),
                 F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0")).alias("price"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
    )


def raw_reviews(lineitem: DataFrame) -> DataFrame:
    flag = F.col("l_returnflag")
    return lineitem.select(
        F.col("l_orderkey").alias("listing_id"),
        F.col("l_shipdate").alias("date"),
        F.concat(F.lit("Guest "), F.col("l_suppkey").cast("string")).alias("reviewer_name"),
        F.when(F.col("l_linenumber") == 7, F.lit(None))
         .otherwise(F.concat(F.col("l_linestatus"), F.lit(":"),
                             F.col("l_partkey").cast("string"))).alias("comments"),
        F.when(flag == "A", SENTIMENTS["A"]).when(flag == "N", SENTIMENTS["N"])
         .otherwise(OTHER_SENTIMENT).alias("sentiment"),
    )


def load_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All inputs of the pipeline, derived from the given tables."""
    reviews = raw_reviews(table(spark, sf_dir, "lineitem"))
    return {
        "hosts": raw_hosts(table(spark, sf_dir, "customer")),
        "listings": raw_listings(table(spark, sf_dir, "orders")),
        "reviews": reviews,
        "calendar": moon_calendar(reviews.select(F.to_date("date").alias("day"))),
        "events": table(spark, sf_dir, "events"),
    }
