"""DuckDB SQL for every registered query (the correctness oracle).

Each statement starts from the same CTE prefix, which repeats the fixture
mapping of ``sources.fixtures`` and the models of ``plans.models`` in plain
SQL over the pre-registered views (customer, orders, lineitem, events).
"""

from __future__ import annotations

from lodgeflow.plans import registry as R

NULL_TOKEN = "__null__"


def _md5_key(*exprs: str) -> str:
    parts = ", ".join(f"coalesce(cast({e} as varchar), '{NULL_TOKEN}')" for e in exprs)
    return f"md5(concat_ws('-', {parts}))"


BASE = f"""
WITH raw_hosts AS (
  SELECT c_custkey AS id,
         CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_name END AS name,
         CASE WHEN c_custkey % 40 = 0 THEN NULL WHEN c_acctbal >= 5000 THEN 't' ELSE 'f' END AS is_superhost,
         CAST(DATE '1994-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS TIMESTAMP) AS created_at,
         CAST(DATE '1994-01-01' + CAST(c_custkey % 1000 + c_custkey % 30 AS INTEGER) AS TIMESTAMP) AS updated_at
  FROM customer),
raw_listings AS (
  SELECT o_orderkey AS id,
         concat('https://example.com/rooms/', CAST(o_orderkey AS VARCHAR)) AS listing_url,
         concat('Listing ', CAST(o_orderkey AS VARCHAR)) AS name,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Entire home/apt' WHEN '2-HIGH' THEN 'Private room'
              WHEN '3-MEDIUM' THEN 'Shared room' ELSE 'Hotel room' END AS room_type,
         CAST(o_orderkey % 40 AS BIGINT) AS minimum_nights,
         CASE WHEN o_orderkey % 97 = 0 THEN -1 - o_custkey ELSE o_custkey END AS host_id,
         concat('$', CAST(CAST(floor((CAST(round(o_totalprice * 100) AS BIGINT) % 50000) / 100) AS BIGINT) AS VARCHAR),
                '.', lpad(CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0')) AS price,
         o_orderdate AS created_at, o_orderdate AS updated_at
  FROM orders),
raw_reviews AS (
  SELECT l_orderkey AS listing_id, l_shipdate AS date,
         concat('Guest ', CAST(l_suppkey AS VARCHAR)) AS reviewer_name,
         CASE WHEN l_linenumber = 7 THEN NULL
              ELSE concat(l_linestatus, ':', CAST(l_partkey AS VARCHAR)) END AS comments,
         CASE l_returnflag WHEN 'A' THEN 'negative' WHEN 'N' THEN 'neutral' ELSE 'positive' END AS sentiment
  FROM lineitem),
moon AS (
  SELECT CAST(DATE '1995-01-16' + CAST(floor(29.530588853::DOUBLE * range) AS INTEGER) AS DATE) AS full_moon_date
  FROM range(-400, 2000)),
dim_hosts AS (
  SELECT id AS host_id, coalesce(name, 'Anonymous') AS host_name,
         CASE WHEN is_superhost = 't' THEN TRUE ELSE FALSE END AS is_superhost,
         created_at, updated_at
  FROM raw_hosts),
dim_listings AS (
  SELECT id AS listing_id, name AS listing_name, room_type,
         CASE WHEN minimum_nights = 0 THEN 1 ELSE minimum_nights END AS minimum_nights,
         host_id, CAST(replace(price, '$', '') AS DECIMAL(10,2)) AS price, created_at, updated_at
  FROM raw_listings),
dim_lwh AS (
  SELECT l.listing_id, l.listing_name, l.room_type, l.minimum_nights, l.price, l.host_id,
         h.host_name, h.is_superhost AS host_is_superhost, l.created_at,
         CASE WHEN l.updated_at IS NULL OR h.updated_at IS NULL THEN NULL
              ELSE greatest(l.updated_at, h.updated_at) END AS updated_at
  FROM dim_listings l LEFT JOIN dim_hosts h ON h.host_id = l.host_id),
fct AS (
  SELECT {_md5_key('listing_id', 'date', 'reviewer_name', 'comments')} AS review_id,
         listing_id, date AS review_date, reviewer_name, comments AS review_text,
         sentiment AS review_sentiment
  FROM raw_reviews WHERE comments IS NOT NULL),
mart AS (
  SELECT f.*, (m.d IS NOT NULL) AS is_full_moon
  FROM fct f LEFT JOIN (SELECT DISTINCT full_moon_date + 1 AS d FROM moon) m
    ON CAST(f.review_date AS DATE) = m.d),
dist AS (
  SELECT *,
         CASE WHEN minimum_nights = 1 THEN '1 night' WHEN minimum_nights BETWEEN 2 AND 3 THEN '2-3 nights'
              WHEN minimum_nights BETWEEN 4 AND 7 THEN '4-7 nights' WHEN minimum_nights BETWEEN 8 AND 14 THEN '8-14 nights'
              WHEN minimum_nights BETWEEN 15 AND 30 THEN '15-30 nights' ELSE '30+ nights' END AS minimum_nights_category,
         CASE WHEN minimum_nights <= 3 THEN 'Short-term' WHEN minimum_nights <= 14 THEN 'Medium-term'
              ELSE 'Long-term' END AS stay_duration_type,
         CASE WHEN price < 50 THEN 'Budget' WHEN price BETWEEN 50 AND 150 THEN 'Mid-range'
              ELSE 'Premium' END AS price_category
  FROM dim_lwh),
series_months AS (
  SELECT CAST(date_trunc('month', CAST(created_at AS DATE)) AS DATE) AS listing_month,
         count(DISTINCT listing_id) AS new_listings
  FROM dim_listings GROUP BY 1),
new_listings AS (
  SELECT c.listing_month, coalesce(p.new_listings, 0) AS new_listings
  FROM (SELECT CAST(unnest(generate_series(CAST(min(listing_month) AS TIMESTAMP),
                                           CAST(max(listing_month) AS TIMESTAMP),
                                           INTERVAL 1 MONTH)) AS DATE) AS listing_month
        FROM series_months) c
  LEFT JOIN series_months p USING (listing_month)),
listings_v2 AS (
  SELECT id, listing_url, name, room_type, minimum_nights, host_id,
         CASE WHEN id % 10 = 0 THEN '$1.00' WHEN id % 7 = 0 THEN '$2.00' ELSE price END AS price,
         created_at,
         CASE WHEN id % 10 = 0 THEN updated_at + INTERVAL 30 DAY ELSE updated_at END AS updated_at
  FROM raw_listings WHERE id % 17 <> 0
  UNION ALL
  SELECT id + (SELECT max(id) FROM raw_listings) + 1, listing_url, name, room_type, minimum_nights,
         host_id, price, created_at, updated_at
  FROM raw_listings WHERE id % 101 = 0),
scd_v1 AS (
  SELECT *, {_md5_key('id', 'updated_at')} AS scd_id, updated_at AS scd_updated_at,
         updated_at AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to
  FROM raw_listings),
scd_hist AS (
  SELECT h.id, h.listing_url, h.name, h.room_type, h.minimum_nights, h.host_id, h.price,
         h.created_at, h.updated_at, h.scd_id, h.scd_updated_at, h.valid_from,
         CASE WHEN v.id IS NULL THEN TIMESTAMP '{R.SCD_AS_OF}'
              WHEN v.updated_at > h.valid_from THEN v.updated_at END AS valid_to
  FROM scd_v1 h LEFT JOIN listings_v2 v ON v.id = h.id
  UNION ALL
  SELECT v.*, {_md5_key('v.id', 'v.updated_at')} AS scd_id, v.updated_at AS scd_updated_at,
         v.updated_at AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to
  FROM listings_v2 v LEFT JOIN scd_v1 h ON h.id = v.id
  WHERE h.id IS NULL OR v.updated_at > h.valid_from)
"""


def _q(body: str) -> str:
    return BASE + body


def _ts(x: str) -> str:
    return f"TIMESTAMP '{x}'"


def _anomaly_sql(dims: list[str], spike: float, drop: float, flagged: bool,
                 as_of: str | None = None, delay: int = 0, source: str = "events") -> str:
    d = ", ".join(dims)
    dsel = (d + ", ") if dims else ""
    keys = f"(SELECT DISTINCT {d} FROM b)" if dims else "(SELECT 1 AS one)"
    join_dims = "".join(f" AND b.{x} IS NOT DISTINCT FROM g.{x}" for x in dims)
    gsel = "".join(f"g.{x}, " for x in dims)
    part = f"PARTITION BY {d} " if dims else ""
    cut = (f"WHERE bucket < CAST({_ts(as_of)} AS DATE) - {delay}" if as_of and delay else "")
    spike_p = "(w.row_count > w.training_avg AND (coalesce(w.training_stddev, 0) = 0 OR " \
              "(w.row_count - w.training_avg) / w.training_stddev > 3) AND " \
              f"(w.training_avg = 0 OR (w.row_count - w.training_avg) * 100.0 / w.training_avg > {spike}))"
    drop_p = "(w.row_count < w.training_avg AND (coalesce(w.training_stddev, 0) = 0 OR " \
             "(w.row_count - w.training_avg) / w.training_stddev < -3) AND " \
             f"(w.training_avg = 0 OR -(w.row_count - w.training_avg) * 100.0 / w.training_avg > {drop}))"
    sql = f"""
, b AS (SELECT CAST(ts AS DATE) AS bucket, {dsel}count(*) AS row_count FROM {source} GROUP BY ALL),
bounds AS (SELECT min(bucket) AS lo, max(bucket) AS hi FROM b),
g AS (SELECT k.*, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS bucket
      FROM {keys} k, bounds),
s AS (SELECT g.bucket, {gsel}coalesce(b.row_count, 0) AS row_count
      FROM g LEFT JOIN b ON b.bucket = g.bucket{join_dims}),
s2 AS (SELECT * FROM s {cut}),
w AS (SELECT *, avg(row_count) OVER win AS training_avg,
             stddev_samp(row_count) OVER win AS training_stddev,
             count(row_count) OVER win AS training_count
      FROM s2 WINDOW win AS ({part}ORDER BY bucket ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)),
scored AS (
  SELECT w.bucket, {''.join(f'w.{x}, ' for x in dims)}w.row_count,
         round(w.training_avg, 4) AS training_avg, round(w.training_stddev, 4) AS training_stddev,
         w.training_count,
         round(CASE WHEN w.training_stddev > 0 THEN (w.row_count - w.training_avg) / w.training_stddev END, 4) AS z_score,
         round(CASE WHEN w.training_avg <> 0 THEN (w.row_count - w.training_avg) * 100.0 / w.training_avg END, 4) AS pct_change,
         CASE WHEN {spike_p} THEN 'spike' WHEN {drop_p} THEN 'drop' END AS anomaly
  FROM w WHERE w.training_count >= 7)
SELECT * FROM scored {'WHERE anomaly IS NOT NULL' if flagged else ''}
"""
    return _q(sql)


def _profile_numeric(cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(f"""
SELECT '{c}' AS column_name, min(x) AS min, max(x) AS max, round(avg(x), 6) AS avg,
       round(stddev_samp(x), 6) AS stddev, round(var_samp(x), 2) AS variance,
       round(quantile_cont(x, 0.25), 6) AS p25, round(quantile_cont(x, 0.5), 6) AS median,
       round(quantile_cont(x, 0.75), 6) AS p75,
       (SELECT count(*) FROM (SELECT CAST({c} AS DOUBLE) AS y FROM dim_lwh) t
         WHERE abs(t.y - (SELECT avg(CAST({c} AS DOUBLE)) FROM dim_lwh))
               > 3 * (SELECT stddev_samp(CAST({c} AS DOUBLE)) FROM dim_lwh)) AS outlier_count
FROM (SELECT CAST({c} AS DOUBLE) AS x FROM dim_lwh)""")
    return _q("\n UNION ALL ".join(parts))


def _profile_string(cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(f"""
SELECT '{c}' AS column_name, min(length({c})) AS min_length, max(length({c})) AS max_length,
       round(avg(length({c})), 6) AS avg_length,
       (SELECT {c} FROM dim_lwh WHERE {c} IS NOT NULL GROUP BY {c}
        ORDER BY count(*) DESC, {c} ASC LIMIT 1) AS mode,
       CAST(sum(CASE WHEN {c} = '' THEN 1 ELSE 0 END) AS BIGINT) AS empty_count,
       CAST(sum(CASE WHEN trim({c}) = '' AND {c} <> '' THEN 1 ELSE 0 END) AS BIGINT) AS whitespace_only_count,
       CAST(sum(CASE WHEN regexp_full_match({c}, '[0-9]+') THEN 1 ELSE 0 END) AS BIGINT) AS numeric_pattern_count,
       CAST(sum(CASE WHEN regexp_full_match({c}, '[A-Za-z\\s]+') THEN 1 ELSE 0 END) AS BIGINT) AS alpha_pattern_count
FROM dim_lwh""")
    return _q("\n UNION ALL ".join(parts))


def _profile_dates(cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(f"""
SELECT '{c}' AS column_name, min({c}) AS earliest, max({c}) AS latest,
       CAST(date_diff('day', CAST(min({c}) AS DATE), CAST(max({c}) AS DATE)) AS BIGINT) AS date_range_days,
       count(DISTINCT CAST({c} AS DATE)) AS distinct_dates,
       round(count(*) / nullif(count(DISTINCT CAST({c} AS DATE)), 0), 2) AS records_per_day_avg
FROM dim_lwh""")
    return _q("\n UNION ALL ".join(parts))


def _profile_quality(cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(f"""
SELECT '{c}' AS column_name,
       CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_count,
       count(DISTINCT {c}) AS distinct_count,
       round(count({c}) * 100.0 / nullif(count(*), 0), 2)::DOUBLE AS completeness_rate,
       round(count(DISTINCT {c}) * 100.0 / nullif(count(*), 0), 2)::DOUBLE AS uniqueness_rate,
       CASE WHEN count(DISTINCT {c}) = count(*) THEN 'UNIQUE'
            WHEN count(DISTINCT {c}) = 1 THEN 'CONSTANT'
            WHEN count(DISTINCT {c}) <= 10 THEN 'LOW_CARDINALITY'
            WHEN count(DISTINCT {c}) <= 100 THEN 'MEDIUM_CARDINALITY'
            ELSE 'HIGH_CARDINALITY' END AS cardinality_category
FROM dim_lwh""")
    return _q("\n UNION ALL ".join(parts))


def _profile_wide() -> str:
    """One row over the whole review fact: totals, every column's metrics, freshness."""
    row = "concat(" + ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in FCT_COLUMNS) + ")"
    hours = f"date_diff('hour', max(review_date), {_ts(R.FRESHNESS_AS_OF)})"
    changes = ", ".join(f"count(*) - count({c}), count(DISTINCT {c})" for c in FCT_COLUMNS)
    parts = [f"""'fct_reviews' AS model_name, date_trunc('day', {_ts(R.FRESHNESS_AS_OF)}) AS profile_date,
       'dev' AS target_environment, 'spark' AS database_type, {_ts(R.FRESHNESS_AS_OF)} AS profiled_at,
       'daily' AS profile_frequency,
       'dev_fct_reviews_' || strftime(date_trunc('day', {_ts(R.FRESHNESS_AS_OF)}), '%Y%m%d%H') AS profile_run_id,
       md5(concat_ws('|', count(*), count(DISTINCT {row}), {changes})) AS profile_hash,
       NULL::DOUBLE AS sample_percentage, 'full' AS data_type,
       {len(FCT_COLUMNS)}::BIGINT AS total_columns, count(*) AS total_rows, count(DISTINCT {row}) AS distinct_rows,
       round((count(*) - count(DISTINCT {row})) * 100.0 / nullif(count(*), 0), 2)::DOUBLE AS duplicate_rate,
       min(review_date) AS review_date_earliest, max(review_date) AS review_date_latest,
       date_diff('day', CAST(min(review_date) AS DATE), CAST(max(review_date) AS DATE)) AS review_date_date_range_days,
       count(DISTINCT CAST(review_date AS DATE)) AS review_date_distinct_dates,
       round(count(*) / nullif(count(DISTINCT CAST(review_date AS DATE)), 0), 2) AS review_date_records_per_day_avg,
       {hours} AS hours_since_update, CASE WHEN {hours} > 24 THEN 'STALE' ELSE 'FRESH' END AS freshness_status,
       max(review_date) AS latest_record_date"""]
    for c in FCT_COLUMNS:
        parts.append(f"""
       CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {c}_null_count,
       count(DISTINCT {c}) AS {c}_distinct_count,
       round(count({c}) * 100.0 / nullif(count(*), 0), 2)::DOUBLE AS {c}_completeness_rate,
       round(count(DISTINCT {c}) * 100.0 / nullif(count(*), 0), 2)::DOUBLE AS {c}_uniqueness_rate,
       CASE WHEN count(DISTINCT {c}) = count(*) THEN 'UNIQUE' WHEN count(DISTINCT {c}) = 1 THEN 'CONSTANT'
            WHEN count(DISTINCT {c}) <= 10 THEN 'LOW_CARDINALITY'
            WHEN count(DISTINCT {c}) <= 100 THEN 'MEDIUM_CARDINALITY'
            ELSE 'HIGH_CARDINALITY' END AS {c}_cardinality_category""")
    for c in ("review_id", "reviewer_name", "review_text", "review_sentiment"):
        parts.append(f"""
       min(length({c})) AS {c}_min_length, max(length({c})) AS {c}_max_length, round(avg(length({c})), 6) AS {c}_avg_length,
       (SELECT {c} FROM fct WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} ASC LIMIT 1) AS {c}_mode,
       CAST(sum(CASE WHEN {c} = '' THEN 1 ELSE 0 END) AS BIGINT) AS {c}_empty_count,
       CAST(sum(CASE WHEN trim({c}) = '' AND {c} <> '' THEN 1 ELSE 0 END) AS BIGINT) AS {c}_whitespace_only_count,
       CAST(sum(CASE WHEN regexp_full_match({c}, '[0-9]+') THEN 1 ELSE 0 END) AS BIGINT) AS {c}_numeric_pattern_count,
       CAST(sum(CASE WHEN regexp_full_match({c}, '[A-Za-z\\s]+') THEN 1 ELSE 0 END) AS BIGINT) AS {c}_alpha_pattern_count""")
    x = "CAST(listing_id AS DOUBLE)"
    parts.append(f"""
       min(listing_id) AS listing_id_min, max(listing_id) AS listing_id_max, round(avg({x}), 6) AS listing_id_avg,
       round(stddev_samp({x}), 6) AS listing_id_stddev, round(var_samp({x}), 2) AS listing_id_variance,
       round(quantile_cont({x}, 0.25), 6) AS listing_id_p25, round(quantile_cont({x}, 0.5), 6) AS listing_id_median,
       round(quantile_cont({x}, 0.75), 6) AS listing_id_p75,
       (SELECT count(*) FROM fct WHERE abs({x} - (SELECT avg({x}) FROM fct)) > 3 * (SELECT stddev_samp({x}) FROM fct))
         AS listing_id_outlier_count""")
    return _q("SELECT " + ",".join(parts) + "\nFROM fct")


FCT_COLUMNS = ["review_id", "listing_id", "review_date", "reviewer_name", "review_text", "review_sentiment"]

FCT_STRINGS = ["review_id", "reviewer_name", "review_text", "review_sentiment"]


def _profile_incremental() -> str:
    """One row per column of the review fact, from all its rows."""
    month = "strftime(review_date, '%Y-%m')"
    parts = []
    for c in FCT_COLUMNS:
        text, number = c in FCT_STRINGS, c == "listing_id"
        either = lambda yes, sql, kind: f"{sql}" if yes else f"NULL::{kind}"
        parts.append(f"""
SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) - count({c}) AS null_count,
       round(count({c}) * 100.0 / nullif(count(*), 0), 2)::DOUBLE AS completeness_rate,
       CASE WHEN count(DISTINCT {c}) = count(*) THEN 'UNIQUE' WHEN count(DISTINCT {c}) = 1 THEN 'CONSTANT'
            WHEN count(DISTINCT {c}) <= 10 THEN 'LOW_CARDINALITY' WHEN count(DISTINCT {c}) <= 100 THEN 'MEDIUM_CARDINALITY'
            ELSE 'HIGH_CARDINALITY' END AS cardinality_category,
       {either(text, f"min(length({c}))", "BIGINT")} AS min_length, {either(text, f"max(length({c}))", "BIGINT")} AS max_length,
       {either(text, f"round(avg(length({c})), 6)", "DOUBLE")} AS avg_length,
       {either(number, f"round(avg({c}), 6)", "DOUBLE")} AS avg,
       {either(number, f"min({c})", "BIGINT")} AS min, {either(number, f"max({c})", "BIGINT")} AS max,
       count(DISTINCT {month}) FILTER ({month} < '{R.STORE_FIRST_RUN_END}') AS first_run_months,
       count(DISTINCT {month}) FILTER ({month} >= '{R.STORE_FIRST_RUN_END}') AS second_run_months
FROM fct""")
    return _q("\n UNION ALL ".join(parts))


def _column_modes(cols: list[str]) -> str:
    return _q("\n UNION ALL ".join(f"""
SELECT '{c}' AS column_name, mode, mode_count FROM (
  SELECT {c} AS mode, count(*) AS mode_count FROM fct WHERE {c} IS NOT NULL GROUP BY 1
  ORDER BY mode_count DESC, mode LIMIT 1)""" for c in cols))


LWH_COLUMNS = ["listing_id", "listing_name", "room_type", "minimum_nights", "price", "host_id",
               "host_name", "host_is_superhost", "created_at", "updated_at"]

_WIN_LO, _WIN_HI = R.WINDOW
_DI_LO, _DI_HI = R.DELETE_INSERT_BATCH

_DI = f"""
, t AS (SELECT * FROM fct WHERE review_date < {_ts(R.DELETE_INSERT_TARGET_END)}),
b AS (SELECT review_id, listing_id, review_date, reviewer_name, review_text,
             upper(review_sentiment) AS review_sentiment
      FROM fct WHERE review_date >= {_ts(_DI_LO)} AND review_date < {_ts(_DI_HI)})
"""

_MERGE = f"""
, t AS (SELECT CAST(review_date AS DATE) AS review_day, count(*) AS reviews,
               {_ts(R.MERGE_TARGET_LOADED)} AS loaded_at
        FROM fct WHERE review_date < {_ts(R.DELETE_INSERT_TARGET_END)} GROUP BY 1),
b AS (SELECT CAST(date AS DATE) AS review_day, count(*) AS reviews,
             {_ts(R.MERGE_BATCH_LOADED)} AS loaded_at
      FROM raw_reviews WHERE date >= {_ts(_DI_LO)} AND date < {_ts(_DI_HI)} GROUP BY 1)
"""

_IMPACT = f"""
SELECT name AS model_name, d AS direct_downstream_count, t AS total_downstream_count,
  CASE WHEN t <= 0 THEN 'leaf' WHEN t <= 1 THEN 'low_impact' WHEN t <= 3 THEN 'medium_impact'
       WHEN t <= 7 THEN 'high_impact' ELSE 'critical' END AS model_criticality,
  CAST(depth AS BIGINT) AS max_downstream_depth,
  CASE WHEN t > 10 THEN 'CRITICAL' WHEN t > 7 THEN 'VERY_HIGH' WHEN t > 3 THEN 'HIGH' WHEN t > 1 THEN 'MEDIUM'
       WHEN t > 0 THEN 'LOW' ELSE 'NONE' END AS downstream_impact_level,
  CASE WHEN t > 10 THEN 'Foundation model: ' || printf('%d downstream models over %d levels', t, depth)
                        || '; change only with full regression testing'
       WHEN t > 7 THEN 'Wide reach: ' || printf('%d downstream models over %d levels', t, depth)
                       || '; coordinate changes with all owners'
       WHEN t > 3 THEN 'Moderate reach: ' || printf('%d downstream models over %d levels', t, depth)
                       || '; plan changes carefully'
       WHEN t > 1 THEN 'Small reach: ' || printf('%d downstream models over %d levels', t, depth)
                       || '; change scope is manageable'
       WHEN t > 0 THEN 'Single dependent model'
       ELSE 'Leaf model: changes affect only itself' END AS impact_description,
  CAST(CASE WHEN t > 10 THEN 10 WHEN t > 7 THEN 8 WHEN t > 3 THEN 6 WHEN t > 1 THEN 4 WHEN t > 0 THEN 2 ELSE 0 END
       + least(depth, 3) AS BIGINT) AS change_risk_score,
  CASE WHEN t > 7 THEN 'Business Critical' WHEN t > 5 THEN 'High Business Value'
       WHEN t > 3 THEN 'Moderate Business Value' WHEN t > 1 THEN 'Supporting Role'
       WHEN t > 0 THEN 'Limited Scope' ELSE 'End Consumer' END AS business_impact_category,
  CASE WHEN d > 3 THEN 'High Fanout' WHEN d > 1 THEN 'Medium Fanout' WHEN d > 0 THEN 'Low Fanout'
       ELSE 'No Fanout' END AS fanout_pattern,
  CASE WHEN depth > 2 THEN 'Deep Chain' WHEN depth > 1 THEN 'Medium Chain' WHEN depth > 0 THEN 'Shallow Chain'
       ELSE 'No Chain' END AS chain_pattern,
  {_ts(R.LINEAGE_AS_OF)} AS analyzed_at"""

_LINEAGE = f"""
, edges AS (
  SELECT DISTINCT 'customer#' || CAST(o_custkey AS VARCHAR) AS parent,
                  'order#' || CAST(o_orderkey AS VARCHAR) AS child FROM orders
  UNION
  SELECT DISTINCT 'order#' || CAST(l_orderkey AS VARCHAR), 'part#' || CAST(l_partkey AS VARCHAR)
  FROM lineitem),
nodes AS (SELECT parent AS name FROM edges UNION SELECT child FROM edges),
reach(src, dst, depth) AS (
  SELECT parent, child, 1 FROM edges
  UNION
  SELECT r.src, e.child, r.depth + 1 FROM reach r JOIN edges e ON e.parent = r.dst),
first_visit AS (SELECT src, dst, min(depth) AS depth FROM reach GROUP BY src, dst),
tot AS (SELECT src, count(*) AS total, max(depth) AS max_depth FROM first_visit GROUP BY src),
dir AS (SELECT parent, count(*) AS direct FROM edges GROUP BY parent),
m AS (SELECT n.name, coalesce(d.direct, 0) AS d, coalesce(t.total, 0) AS t,
             coalesce(t.max_depth, 0) AS depth
      FROM nodes n LEFT JOIN dir d ON d.parent = n.name LEFT JOIN tot t ON t.src = n.name)
{_IMPACT}
FROM m
"""

# A customer and their orders reach each other, and all parts of these orders; the depth takes a cycle as one level.
_LINEAGE_CYCLES = f"""
, of_customer AS (SELECT o_custkey AS c, count(DISTINCT o_orderkey) + 1 AS members FROM orders GROUP BY 1),
parts AS (SELECT o_custkey AS c, count(DISTINCT l_partkey) AS parts FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1),
lines AS (SELECT l_orderkey AS o, count(DISTINCT l_partkey) AS own FROM lineitem GROUP BY 1),
m AS (
  SELECT 'customer#' || CAST(c AS VARCHAR) AS name, members - 1 AS d, members + coalesce(parts, 0) AS t, 1 AS depth
  FROM of_customer LEFT JOIN parts USING (c)
  UNION ALL
  SELECT DISTINCT 'order#' || CAST(o_orderkey AS VARCHAR), 1 + coalesce(own, 0), members + coalesce(parts, 0), 1
  FROM orders JOIN of_customer k ON k.c = o_custkey LEFT JOIN parts p ON p.c = o_custkey LEFT JOIN lines ON o = o_orderkey
  UNION ALL
  SELECT 'order#' || CAST(o AS VARCHAR), own, own, 1 FROM lines WHERE o NOT IN (SELECT o_orderkey FROM orders)
  UNION ALL
  SELECT DISTINCT 'part#' || CAST(l_partkey AS VARCHAR), 0, 0, 0 FROM lineitem)
{_IMPACT}
FROM m
"""

# The same measures over the small named graph, with its sorted name lists; one segment's nodes are left out.
_LINEAGE_NATIONS = f"""
, edges AS (
  SELECT 'region_' || CAST(n_regionkey AS VARCHAR) AS parent, 'nation_' || n_name AS child FROM nation
  UNION
  SELECT 'nation_' || n_name, concat_ws('_', 'segment', c_mktsegment, n_name)
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment <> 'BUILDING'),
nodes AS (SELECT parent AS name FROM edges UNION SELECT child FROM edges),
two AS (SELECT a.parent AS src, b.child AS dst FROM edges a JOIN edges b ON a.child = b.parent),
reach AS (SELECT parent AS src, child AS dst, 1 AS depth FROM edges UNION ALL SELECT src, dst, 2 FROM two),
m AS (SELECT n.name, count(dst) FILTER (depth = 1) AS d, count(dst) AS t, coalesce(max(depth), 0) AS depth,
             coalesce(string_agg(dst, ', ' ORDER BY dst) FILTER (depth = 1), '') AS direct_list,
             coalesce(string_agg(dst, ', ' ORDER BY dst), '') AS all_list
      FROM nodes n LEFT JOIN reach r ON r.src = n.name GROUP BY n.name)
{_IMPACT}, direct_list AS direct_downstream_models, all_list AS all_downstream_models
FROM m
"""


_DIM_LWH_OUT = ("listing_id, listing_name, room_type, minimum_nights, CAST(price AS DOUBLE) AS price, "
                "host_id, host_name, host_is_superhost, created_at, updated_at")

ORACLE: dict[str, str] = {
    "price_by_sentiment": _q("""
SELECT review_sentiment, count(*) AS review_count,
       round(avg(price)::DOUBLE, 2) AS avg_price, round(stddev_samp(price)::DOUBLE, 2) AS price_stddev,
       round(quantile_cont(CAST(price AS DOUBLE), 0.5), 2) AS median_price,
       CAST(min(price) AS DOUBLE) AS min_price, CAST(max(price) AS DOUBLE) AS max_price
FROM mart r JOIN dim_listings l USING (listing_id) WHERE r.is_full_moon
GROUP BY review_sentiment ORDER BY avg_price DESC NULLS FIRST"""),
    "fullmoon_sentiment": _q("""
SELECT is_full_moon, review_sentiment, count(*) AS reviews FROM mart GROUP BY ALL ORDER BY ALL"""),
    "sentiment_by_month": _q("""
SELECT CAST(month(review_date) AS BIGINT) AS review_month, review_sentiment, count(*) AS reviews_count
FROM fct GROUP BY ALL ORDER BY ALL"""),
    "new_listings_monthly": _q("SELECT * FROM new_listings ORDER BY listing_month"),
    "listing_distribution": _q(f"""
SELECT {_DIM_LWH_OUT}, minimum_nights_category, stay_duration_type, price_category FROM dist"""),
    "price_histogram": _q("""
SELECT price_category, minimum_nights_category, count(*) AS listings,
       round(avg(CAST(price AS DOUBLE)), 2) AS avg_price
FROM dist GROUP BY ALL"""),
    "superhost_ratio": _q("""
SELECT host_is_superhost, count(*) AS listings,
       round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS share_pct
FROM dim_lwh GROUP BY ALL"""),
    "dim_hosts": _q("SELECT * FROM dim_hosts"),
    "dim_listings": _q("""
SELECT listing_id, listing_name, room_type, minimum_nights, host_id, CAST(price AS DOUBLE) AS price,
       created_at, updated_at FROM dim_listings"""),
    "dim_listings_with_hosts": _q(f"SELECT {_DIM_LWH_OUT} FROM dim_lwh"),
    "fct_reviews": _q("SELECT * FROM fct"),
    "mart_fullmoon_reviews": _q("SELECT * FROM mart"),
    "increment_since_last": _q(f"""
SELECT * FROM fct WHERE review_date >
  (SELECT max(review_date) FROM fct WHERE review_date < {_ts(R.SINCE_LAST_TARGET_END)})"""),
    "increment_window": _q(f"""
SELECT * FROM fct WHERE review_date >= {_ts(_WIN_LO)} AND review_date < {_ts(_WIN_HI)}"""),
    "increment_changed_days": _q(f"""
SELECT * FROM fct WHERE review_date >= {_ts(R.SINCE_LAST_TARGET_END)} OR CAST(review_date AS DATE) IN (
  SELECT CAST(review_date AS DATE) FROM fct
  WHERE (day(review_date) = 5 AND listing_id % 37 = 0) OR (day(review_date) = 11 AND listing_id % 43 = 0)
     OR (day(review_date) = 9 AND listing_id % 41 = 0 AND review_sentiment <> upper(review_sentiment)))"""),
    "changed_days_table": _q("SELECT * FROM fct"),
    "scd2_feed": _q("""
, of_feed AS (
  SELECT *, 0 AS days, price AS p FROM raw_listings
  UNION ALL SELECT l.*, n, '$' || n || '.00' FROM raw_listings l, (VALUES (1), (2), (3)) v(n) WHERE id % 10 = 0
  UNION ALL SELECT *, 5, '$9.00' FROM raw_listings WHERE id % 5 = 0
  UNION ALL SELECT * REPLACE (id + (SELECT max(id) FROM raw_listings) + 1 AS id), 0, price FROM raw_listings WHERE id % 101 = 0
  UNION ALL SELECT * REPLACE (id + (SELECT max(id) FROM raw_listings) + 1 AS id), 1, '$7.00' FROM raw_listings WHERE id % 101 = 0),
v AS (SELECT * EXCLUDE (days, p) REPLACE (p AS price, updated_at + days * INTERVAL 1 DAY AS updated_at) FROM of_feed)
SELECT *, updated_at AS scd_updated_at, updated_at AS valid_from,
       lead(updated_at) OVER (PARTITION BY id ORDER BY updated_at) AS valid_to FROM v"""),
    "sink_full_rebuild": _q("SELECT *, strftime(review_date, '%Y-%m') AS review_month FROM fct"),
    "sink_since_last": _q("SELECT * FROM fct"),
    "sink_schema_drift": _q("""
, h AS (SELECT count(*) AS rows, count(host_name) AS names, count(is_superhost) AS superhosts,
               count(is_superhost) FILTER (host_id % 2 = 0) AS even_superhosts,
               count(host_name) FILTER (host_id % 2 = 1) AS odd_names FROM dim_hosts)
SELECT 'ignore' AS policy, rows, names, even_superhosts AS superhosts, -1::BIGINT AS lengths FROM h
UNION ALL SELECT 'append_new_columns', rows, names, even_superhosts, odd_names FROM h
UNION ALL SELECT 'sync_all_columns', rows, names, -1::BIGINT, odd_names FROM h"""),
    "sink_clustered": _q("""
SELECT 'listings' AS name, count(*) AS rows, count(DISTINCT listing_id) AS keys, CAST(sum(listing_id) AS BIGINT) AS total FROM dim_listings
UNION ALL
SELECT 'reviews', count(*), count(DISTINCT review_id), CAST(sum(listing_id) AS BIGINT) FROM fct"""),
    "sink_checks": _q("""
, f AS (
  SELECT 'one_listing_per_host' AS check_name, 'listings' AS model, 'warn' AS severity,
         (SELECT count(*) FROM (SELECT host_id FROM raw_listings WHERE host_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS failures
  UNION ALL SELECT 'positive_host', 'listings', 'error', (SELECT count(*) FROM raw_listings WHERE host_id < 1)
  UNION ALL SELECT 'long_stay', 'dim_listings', 'error', (SELECT count(*) FROM dim_listings WHERE minimum_nights > 20)
  UNION ALL SELECT 'no_stay', 'dim_listings', 'error', (SELECT count(*) FROM dim_listings WHERE minimum_nights < 1))
SELECT check_name, model, severity, failures,
       CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status,
       'run' AS invocation_id, CASE WHEN check_name IN ('one_listing_per_host', 'long_stay') THEN failures END AS stored FROM f"""),
    "sink_audit": _q("""
SELECT 'run' AS invocation_id, 'hosts' AS step, 'success' AS status, count(*) AS rows_affected, TRUE AS timed, FALSE AS failed FROM raw_hosts
UNION ALL SELECT 'run', 'again', 'error', NULL, TRUE, TRUE"""),
    "sources_declared": _q(f"""
SELECT 'hosts' AS source, count(*) AS rows, count(id) AS c0, count(name) AS c1, count(is_superhost) AS c2, count(created_at) AS c3,
       count(updated_at) AS c4, strftime(max(created_at), '%Y-%m-%d %H:%M:%S') AS greatest FROM raw_hosts
UNION ALL
SELECT 'listings', count(*), count(id), count(listing_url), count(name), count(room_type), count(minimum_nights), max(room_type) FROM raw_listings
UNION ALL
SELECT 'reviews', count(*), count(listing_id), count(date), count(reviewer_name), count(comments), count(sentiment),
       strftime(max(date), '%Y-%m-%d %H:%M:%S') FROM raw_reviews
UNION ALL
SELECT 'calendar', count(*), count(full_moon_date), NULL, NULL, NULL, NULL, strftime(max(full_moon_date), '%Y-%m-%d') FROM moon
WHERE year(full_moon_date) = {R.MOON_YEAR}"""),
    "delete_insert": _q(_DI + """
SELECT * FROM t WHERE review_id NOT IN (SELECT review_id FROM b)
UNION ALL SELECT * FROM b"""),
    "merge_upsert": _q(_MERGE + """
SELECT coalesce(b.review_day, t.review_day) AS review_day,
       CASE WHEN b.review_day IS NOT NULL THEN b.reviews ELSE t.reviews END AS reviews,
       CASE WHEN t.review_day IS NOT NULL THEN t.loaded_at ELSE b.loaded_at END AS loaded_at
FROM t FULL OUTER JOIN b ON t.review_day = b.review_day"""),
    "skip_existing": _q(_MERGE + """
SELECT * FROM b WHERE review_day NOT IN (SELECT review_day FROM t)"""),
    "scd2_history": _q("SELECT * FROM scd_hist"),
    "scd2_current": _q("SELECT * FROM scd_hist WHERE valid_to IS NULL"),
    "scd2_as_of": _q(f"""
SELECT * FROM scd_hist WHERE valid_from <= {_ts(R.SCD_VIEW_AT)}
  AND (valid_to IS NULL OR {_ts(R.SCD_VIEW_AT)} < valid_to)"""),
    "check_single_active_version": _q("""
SELECT id AS offending_id, count(*) AS active_versions FROM scd_hist WHERE valid_to IS NULL
GROUP BY id HAVING count(*) > 1"""),
    "check_unique_listing_id": _q("""
SELECT listing_id AS unique_field, count(*) AS n_records FROM dim_listings
WHERE listing_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"""),
    "check_unique_review_id": _q("""
SELECT review_id AS unique_field, count(*) AS n_records FROM fct
WHERE review_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"""),
    "check_not_null_host_name": _q("SELECT * FROM raw_hosts WHERE name IS NULL"),
    "check_accepted_room_type": _q(f"""
SELECT room_type AS value_field, count(*) AS n_records FROM dim_listings
WHERE room_type IS NOT NULL AND room_type NOT IN ({", ".join(repr(x) for x in R.ROOM_TYPES)})
GROUP BY 1"""),
    "check_accepted_sentiment": _q(f"""
SELECT sentiment AS value_field, count(*) AS n_records FROM raw_reviews
WHERE sentiment IS NOT NULL AND sentiment NOT IN ({", ".join(repr(x) for x in R.SENTIMENTS)})
GROUP BY 1"""),
    "check_relationships_listing_host": _q("""
SELECT l.* FROM raw_listings l WHERE l.host_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM raw_hosts h WHERE h.id = l.host_id)"""),
    "check_relationships_review_listing": _q("""
SELECT r.* FROM raw_reviews r WHERE r.listing_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM raw_listings l WHERE l.id = r.listing_id)"""),
    "check_positive_host_id": _q("SELECT * FROM raw_listings WHERE host_id < 1"),
    "check_null_pct_host_name": _q("""
SELECT * FROM (SELECT count(*) AS total_count,
                      CAST(sum(CASE WHEN name IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS zero_count FROM raw_hosts)
WHERE zero_count * 100 > 5 * total_count"""),
    "check_null_pct_comments": _q("""
SELECT * FROM (SELECT count(*) AS total_count,
                      CAST(sum(CASE WHEN comments IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS zero_count FROM raw_reviews)
WHERE zero_count * 100 > 5 * total_count"""),
    "check_zero_pct_min_nights": _q("""
SELECT * FROM (SELECT count(*) AS total_count,
                      CAST(sum(CASE WHEN minimum_nights = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_count FROM raw_listings)
WHERE zero_count * 100 > 5 * total_count"""),
    "check_joint_null_pct_reviews": _q("""
SELECT * FROM (SELECT count(*) AS total_count,
                      CAST(sum(CASE WHEN review_text IS NULL AND review_sentiment IS NULL THEN 1 ELSE 0 END) AS BIGINT)
                        AS zero_count FROM fct)
WHERE zero_count * 100 > 5 * total_count"""),
    "check_price_parseable": _q("""
SELECT * FROM raw_listings WHERE TRY_CAST(replace(price, '$', '') AS DOUBLE) IS NULL
   OR TRY_CAST(replace(price, '$', '') AS DOUBLE) < 0"""),
    "check_superhost_parseable": _q("""
SELECT * FROM raw_hosts WHERE is_superhost IS NOT NULL AND lower(trim(is_superhost)) NOT IN
  ('true', 't', 'yes', 'y', 'on', '1', 'false', 'f', 'no', 'n', 'off', '0')"""),
    "check_no_nulls_dim_hosts": _q("""
SELECT * FROM dim_hosts WHERE host_id IS NULL OR host_name IS NULL OR is_superhost IS NULL
   OR created_at IS NULL OR updated_at IS NULL"""),
    "check_no_nulls_dim_listings_with_hosts": _q(f"""
SELECT {_DIM_LWH_OUT} FROM dim_lwh WHERE {' OR '.join(c + ' IS NULL' for c in LWH_COLUMNS)}"""),
    "check_missing_months": _q("""
SELECT e.listing_month FROM
  (SELECT CAST(unnest(generate_series(CAST(min(m) AS TIMESTAMP), CAST(max(m) AS TIMESTAMP),
                                      INTERVAL 1 MONTH)) AS DATE) AS listing_month
   FROM (SELECT CAST(date_trunc('month', CAST(created_at AS DATE)) AS DATE) AS m FROM dim_listings)) e
WHERE e.listing_month NOT IN (SELECT listing_month FROM new_listings)"""),
    "check_created_after_review": _q("""
SELECT l.listing_id, l.listing_name, l.room_type, l.minimum_nights, l.host_id,
       CAST(l.price AS DOUBLE) AS price, l.created_at, l.updated_at,
       r.review_id, r.review_date, r.reviewer_name, r.review_text, r.review_sentiment
FROM dim_listings l JOIN fct r USING (listing_id) WHERE l.created_at >= r.review_date"""),
    "check_min_nights_sample": _q("""
SELECT listing_id, listing_name, room_type, minimum_nights, host_id, CAST(price AS DOUBLE) AS price,
       created_at, updated_at
FROM dim_listings WHERE minimum_nights < 1 ORDER BY listing_id LIMIT 10"""),
    "check_between_new_listings": _q("SELECT * FROM new_listings WHERE new_listings < 0"),
    "check_max_price": _q("""
SELECT * FROM (SELECT CAST(max(price) AS DOUBLE) AS max_value FROM dim_lwh) WHERE max_value > 5000"""),
    "check_min_min_nights": _q("""
SELECT * FROM (SELECT min(minimum_nights) AS min_value FROM raw_listings) WHERE min_value < 0"""),
    "check_p99_price": _q("""
SELECT * FROM (SELECT quantile_cont(CAST(price AS DOUBLE), 0.99) AS quantile_value FROM dim_lwh)
WHERE quantile_value < 50 OR quantile_value > 500"""),
    "check_freshness_reviews": _q(f"""
SELECT * FROM (
  SELECT max_loaded_at, hours_since_load,
         CASE WHEN max_loaded_at IS NULL THEN 'error' WHEN hours_since_load > 24 THEN 'error'
              WHEN hours_since_load > 1 THEN 'warn' ELSE 'pass' END AS status
  FROM (SELECT max(date) AS max_loaded_at,
               date_diff('second', max(date), {_ts(R.FRESHNESS_AS_OF)}) / 3600.0::DOUBLE AS hours_since_load
        FROM raw_reviews))
WHERE status <> 'pass'"""),
    "check_distinct_sentiment": _q("""
SELECT * FROM (SELECT count(DISTINCT sentiment) AS distinct_count FROM raw_reviews) WHERE distinct_count <> 3"""),
    "check_distinct_room_type": _q("""
SELECT * FROM (SELECT count(DISTINCT room_type) AS distinct_count FROM raw_listings) WHERE distinct_count <> 4"""),
    "check_distinct_superhost": _q("""
SELECT * FROM (SELECT count(DISTINCT is_superhost) AS distinct_count FROM raw_hosts) WHERE distinct_count <> 2"""),
    "check_row_count_listings": _q("""
SELECT * FROM (SELECT (SELECT count(*) FROM dim_lwh) AS row_count,
                      (SELECT count(*) FROM raw_listings) AS other_row_count)
WHERE row_count <> other_row_count"""),
    "check_regex_listing_url": _q(f"""
SELECT * FROM raw_listings WHERE listing_url IS NOT NULL
  AND NOT regexp_full_match(listing_url, '{R.LISTING_URL_REGEX}')"""),
    "check_regex_price": _q(f"""
SELECT * FROM raw_listings WHERE price IS NOT NULL AND NOT regexp_full_match(price, '{R.PRICE_REGEX}')"""),
    "violated_unique": _q("""
SELECT listing_id AS unique_field, count(*) AS n_records FROM raw_reviews
WHERE listing_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"""),
    "violated_accepted_values": _q("""
SELECT room_type AS value_field, count(*) AS n_records FROM dim_listings
WHERE room_type IS NOT NULL AND room_type <> 'Private room' GROUP BY 1"""),
    "violated_zero_pct": _q("""
SELECT * FROM (SELECT count(*) AS total_count, CAST(sum(CASE WHEN minimum_nights = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_count
               FROM raw_listings) WHERE zero_count * 100 > 1 * total_count"""),
    "violated_null_pct": _q("""
SELECT * FROM (SELECT count(*) AS total_count, CAST(sum(CASE WHEN name IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS zero_count
               FROM raw_hosts) WHERE zero_count * 100 > 1 * total_count"""),
    "violated_joint_null_pct": _q("""
SELECT * FROM (SELECT count(*) AS total_count, CAST(sum(CASE WHEN listing_id % 10 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_count
               FROM fct) WHERE zero_count * 100 > 5 * total_count"""),
    "violated_price_parses": _q("SELECT * FROM raw_listings"),
    "violated_boolean_parses": _q("SELECT * FROM raw_hosts WHERE name IS NOT NULL"),
    "violated_no_nulls": _q("SELECT * FROM raw_hosts WHERE name IS NULL OR is_superhost IS NULL"),
    "violated_missing_months": _q("""
SELECT listing_month FROM new_listings WHERE month(listing_month) = 3"""),
    "violated_sample": _q("""
SELECT listing_id, listing_name, room_type, minimum_nights, host_id, CAST(price AS DOUBLE) AS price,
       created_at, updated_at
FROM dim_listings WHERE minimum_nights < 5 ORDER BY listing_id LIMIT 10"""),
    "violated_between": _q("SELECT * FROM new_listings WHERE new_listings < 1 OR new_listings > 30"),
    "violated_max": _q("SELECT * FROM (SELECT CAST(max(price) AS DOUBLE) AS max_value FROM dim_lwh) WHERE max_value > 100"),
    "violated_min": _q("SELECT * FROM (SELECT min(minimum_nights) AS min_value FROM raw_listings) WHERE min_value < 1"),
    "violated_quantile": _q("""
SELECT * FROM (SELECT quantile_cont(CAST(price AS DOUBLE), 0.99) AS quantile_value FROM dim_lwh)
WHERE quantile_value < 50 OR quantile_value > 100"""),
    "violated_distinct_count": _q("""
SELECT * FROM (SELECT count(DISTINCT room_type) AS distinct_count FROM raw_listings) WHERE distinct_count <> 3"""),
    "violated_row_count": _q("""
SELECT * FROM (SELECT (SELECT count(*) FROM dim_lwh) AS row_count, (SELECT count(*) FROM raw_hosts) AS other_row_count)
WHERE row_count <> other_row_count"""),
    "violated_regex": _q("SELECT * FROM raw_listings WHERE NOT regexp_full_match(listing_url, '\\$[0-9][0-9.]+')"),
    "violated_relationships": _q("""
SELECT r.* FROM raw_reviews r
WHERE NOT EXISTS (SELECT 1 FROM raw_listings l WHERE l.id = r.listing_id AND l.id % 9 <> 0)"""),
    "violated_single_active": _q("""
SELECT id AS offending_id, CAST(2 AS BIGINT) AS active_versions FROM scd_hist WHERE valid_to IS NULL AND id % 13 = 0"""),
    "violated_volume_anomalies": _anomaly_sql([], 10, 5, flagged=True, as_of=R.ANOMALY_AS_OF, delay=1,
                                              source="(SELECT * FROM events WHERE day(ts) <> 20 OR event_id % 10 = 0)"),
    "price_by_sentiment_nulls": _q("""
SELECT s AS review_sentiment, count(*) AS review_count,
       round(avg(price)::DOUBLE, 2) AS avg_price, round(stddev_samp(price)::DOUBLE, 2) AS price_stddev,
       round(quantile_cont(CAST(price AS DOUBLE), 0.5), 2) AS median_price,
       CAST(min(price) AS DOUBLE) AS min_price, CAST(max(price) AS DOUBLE) AS max_price
FROM (SELECT CASE WHEN f.listing_id % 5 <> 0 THEN f.review_sentiment END AS s,
             CASE WHEN l.listing_id % 3 <> 0 THEN l.price END AS price
      FROM mart f JOIN dim_listings l USING (listing_id) WHERE f.is_full_moon)
GROUP BY 1"""),
    "scd2_snapshot_table": _q("""
, c AS (
  SELECT v1.*, v2.id IS NULL AS gone, v2.updated_at > v1.updated_at AS newer FROM raw_listings v1
  LEFT JOIN listings_v2 v2 ON v2.id = v1.id)
SELECT id, listing_url, name, room_type, minimum_nights, host_id, price, created_at, updated_at,
       updated_at AS scd_updated_at, updated_at AS valid_from,
       CASE WHEN gone THEN TIMESTAMP '2002-02-01' WHEN newer THEN updated_at + INTERVAL 30 DAY END AS valid_to
FROM c
UNION ALL  -- back in the third run with the old date: valid from where it ended
SELECT id, listing_url, name, room_type, minimum_nights, host_id, price, created_at, updated_at, updated_at,
       TIMESTAMP '2002-02-01', CAST(NULL AS TIMESTAMP) FROM c WHERE gone
UNION ALL  -- newer in the second run; the third brings an older date and changes nothing
SELECT v.*, v.updated_at, v.updated_at, CAST(NULL AS TIMESTAMP) FROM listings_v2 v JOIN c ON c.id = v.id WHERE newer
UNION ALL  -- new in the second run, missing in the third
SELECT v.*, v.updated_at, v.updated_at, TIMESTAMP '2002-03-01' FROM listings_v2 v
WHERE v.id NOT IN (SELECT id FROM raw_listings)"""),
    "late_calendar": _q("""
SELECT d.day IS NOT NULL AS is_full_moon, f.review_sentiment, count(*) AS reviews
FROM fct f LEFT JOIN (SELECT DISTINCT full_moon_date + 1 AS day FROM moon) d
  ON CAST(f.review_date + INTERVAL 20 YEAR AS DATE) = d.day
GROUP BY 1, 2"""),
    "lineage_nations": _q(_LINEAGE_NATIONS),
    "lineage_cycles": _q(_LINEAGE_CYCLES),
    "volume_anomaly_scores": _anomaly_sql([], 10, 5, flagged=False),
    "volume_anomalies": _anomaly_sql([], 10, 5, flagged=True, as_of=R.ANOMALY_AS_OF, delay=1),
    "dimension_anomaly_scores": _anomaly_sql(["event_type"], 5, 5, flagged=False),
    "dimension_anomalies": _anomaly_sql(["event_type"], 3, 3, flagged=True),
    "profile_rows": _q("""
SELECT count(*) AS total_rows,
       count(DISTINCT concat(coalesce(CAST(review_id AS VARCHAR), 'NULL'), coalesce(CAST(listing_id AS VARCHAR), 'NULL'),
                             coalesce(CAST(review_date AS VARCHAR), 'NULL'), coalesce(CAST(reviewer_name AS VARCHAR), 'NULL'),
                             coalesce(CAST(review_text AS VARCHAR), 'NULL'), coalesce(CAST(review_sentiment AS VARCHAR), 'NULL')))
         AS distinct_rows,
       round((count(*) - count(DISTINCT concat(coalesce(CAST(review_id AS VARCHAR), 'NULL'), coalesce(CAST(listing_id AS VARCHAR), 'NULL'),
                             coalesce(CAST(review_date AS VARCHAR), 'NULL'), coalesce(CAST(reviewer_name AS VARCHAR), 'NULL'),
                             coalesce(CAST(review_text AS VARCHAR), 'NULL'), coalesce(CAST(review_sentiment AS VARCHAR), 'NULL'))))
             * 100.0 / nullif(count(*), 0), 2)::DOUBLE AS duplicate_rate
FROM fct"""),
    "profile_numeric": _profile_numeric(["listing_id", "minimum_nights", "price", "host_id"]),
    "profile_string": _profile_string(["listing_name", "room_type", "host_name"]),
    "profile_dates": _profile_dates(["created_at", "updated_at"]),
    "profile_boolean": _q("""
SELECT 'host_is_superhost' AS column_name,
       CAST(sum(CASE WHEN host_is_superhost = TRUE THEN 1 ELSE 0 END) AS BIGINT) AS true_count,
       CAST(sum(CASE WHEN host_is_superhost = FALSE THEN 1 ELSE 0 END) AS BIGINT) AS false_count
FROM dim_lwh"""),
    "profile_quality": _profile_quality(LWH_COLUMNS),
    "profile_wide": _profile_wide(),
    "profile_big_integers": f"""
WITH b AS (SELECT l_orderkey * {R.BIG_FACTOR}::BIGINT + {R.BIG_BASE}::BIGINT AS big FROM lineitem),
r AS (SELECT big, row_number() OVER (ORDER BY big) - 1 AS k, count(*) OVER () AS n FROM b)
SELECT 'big' AS column_name, min(big) AS min, max(big) AS max, count(DISTINCT big) AS distinct_count,
       max(big) FILTER (k = CAST(floor(0.25::DOUBLE * (n - 1)) AS BIGINT)) AS p25_low,
       max(big) FILTER (k = CAST(floor(0.5::DOUBLE * (n - 1)) AS BIGINT)) AS median_low,
       max(big) FILTER (k = CAST(floor(0.75::DOUBLE * (n - 1)) AS BIGINT)) AS p75_low FROM r""",
    "profile_incremental": _profile_incremental(),
    "column_modes": _column_modes(FCT_STRINGS),
    "sample_hash": _q("""
SELECT * FROM raw_listings WHERE substr(md5(CAST(id AS VARCHAR)), 1, 8) < '80000000'"""),
    "lineage_impact": BASE.replace("WITH raw_hosts", "WITH RECURSIVE raw_hosts", 1) + _LINEAGE,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
