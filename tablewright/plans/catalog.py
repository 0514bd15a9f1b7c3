"""Queries by name: one per operator, over whole tables, each with its SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import numeric as num
from tablewright.functions import text as txt
from tablewright.functions.fuzzy import canonicalise
from tablewright.operators import columns as cols
from tablewright.operators import logistic, metrics, models, ranges, split, stats, svm, transforms, tune
from tablewright.operators.blocks import numeric_blocks
from tablewright.operators.deep_trees import walk_of
from tablewright.operators.dedup import drop_duplicate_rows
from tablewright.operators.impute import fill_values, fit_fill_values, impute
from tablewright.operators.knn import KNNClassifier
from tablewright.operators.ordered import fill_along
from tablewright.operators.quantiles import exact_medians
from tablewright.operators.select import assemble, select_features
from tablewright.plans.automl import AutoMLConfig, risk_run, run_automl, save_report
from tablewright.plans.cleaner import Cleaner
from tablewright.plans.prepare import ROW_KEY, prepare
from tablewright.plans.risk import FAMILY, TARGET, risk_automl, risk_prepare
from tablewright.plans.stages import RowSum, Stage
from tablewright.plans.transformer import Transformer
from tablewright.plans.views import VIEWS, table, view
from tablewright.session import materialise, scratch_path
from tablewright.sources import load_table, write_table
from tablewright.sources.reader import table_shape

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DIGITS = 6


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def with_views(*names: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in names)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), DIGITS) for c in names})


# --- fixed rules of the queries below -------------------------------------------------------------------

SEGMENTS = ["automobile", "building", "furniture", "household", "machinery"]
AGES = ["16-25", "26-39", "40-64", "65+"]
PRIORITIES = {"1-URGENT": 4, "3-MEDIUM": 2, "4-NOT SPECIFIED": 1, "5-LOW": 0}
EVENT_ORDER = ["ts", "event_id"]


# --- sources and sinks ----------------------------------------------------------------------------------

@query("csv_roundtrip", f"""{with_views("dirty_customer")}
SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, acctbal, nullif(segment, '') AS segment, age_text,
  CASE WHEN score_text <> 'n/a' THEN CAST(score_text AS BIGINT) END AS score_text
FROM dirty_customer""")
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "roundtrip") + ".csv"
    write_table(view(spark, sf, "dirty_customer"), path, "csv", sep=";")
    return load_table(spark, path, sep=";")


@query("csv_roundtrip_documents", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_roundtrip_documents(spark, sf):
    """Texts with line breaks, quotes and blanks at their ends; types by inference."""
    path = scratch_path(spark, "roundtrip") + ".csv"
    write_table(table(spark, sf, "documents"), path, "csv", rows_per_file=200)
    return load_table(spark, path)


@query("csv_roundtrip_events", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def csv_roundtrip_events(spark, sf):
    """Times to the microsecond and JSON texts, by a given schema."""
    path = scratch_path(spark, "roundtrip") + ".csv"
    events = table(spark, sf, "events")
    write_table(events, path, "csv")
    return load_table(spark, path, schema=events.schema, multiline=False)


@query("json_roundtrip", "SELECT * FROM orders")
def json_roundtrip(spark, sf):
    path = scratch_path(spark, "roundtrip") + ".json"
    orders = table(spark, sf, "orders")
    write_table(orders, path, "json")
    return load_table(spark, path, lines=True, schema=orders.schema)


def _in_many_ranges(spark, read: Callable[[], DataFrame]) -> DataFrame:
    """The table as read while Spark splits small files, too, between the cores."""
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "4096")
    try:
        return materialise(read(), "ranges")
    finally:
        spark.conf.set(name, before)


@query("csv_ranges", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_ranges(spark, sf):
    """Files with line breaks and quotes in their cells, each read in ranges by many tasks; types by inference."""
    path = scratch_path(spark, "ranges") + ".csv"
    write_table(table(spark, sf, "documents"), path, "csv")
    return _in_many_ranges(spark, lambda: load_table(spark, path, ranges_from=0))


CUSTOMER_SQL = "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer"


def _write_arrays(spark, sf, path: str, records_a_file: int) -> None:
    customers = table(spark, sf, "customer")
    block = F.floor(F.col("c_custkey") / records_a_file)
    arrays = customers.groupBy(block).agg(F.to_json(F.collect_list(F.struct(*customers.columns))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)


@query("json_arrays", CUSTOMER_SQL)
def json_arrays(spark, sf):
    """Files that hold one array of records each: a file per block of customers."""
    path = scratch_path(spark, "arrays") + ".json"
    _write_arrays(spark, sf, path, 500)
    return load_table(spark, path)


@query("json_array_ranges", CUSTOMER_SQL)
def json_array_ranges(spark, sf):
    """The same files, larger, each read in ranges by many tasks."""
    path = scratch_path(spark, "arrays") + ".json"
    _write_arrays(spark, sf, path, 5000)
    return _in_many_ranges(spark, lambda: load_table(spark, path, ranges_from=0))


@query("parquet_roundtrip", "SELECT * FROM events")
def parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "roundtrip") + ".parquet"
    write_table(table(spark, sf, "events"), path)
    return load_table(spark, path)


@query("shape_of_table", "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem")
def shape_of_table(spark, sf):
    n_rows, n_columns = table_shape(load_table(spark, f"{sf}/lineitem.parquet"))
    return spark.createDataFrame([(n_rows, n_columns)], "n_rows bigint, n_columns bigint")


# --- projections and predicates -------------------------------------------------------------------------

@query("drop_cols", "SELECT p_partkey, p_brand, p_type, p_size FROM part")
def drop_cols(spark, sf):
    return cols.drop_columns(table(spark, sf, "part"), ["p_name", "p_retailprice", "not_there"])


@query("split_features_target", f"""{with_views("risk")}
SELECT CREDIT_SCORE, ANNUAL_MILEAGE, MARRIED, CHILDREN, OUTCOME FROM risk""")
def split_features_target(spark, sf):
    kept = view(spark, sf, "risk").select("ID", "CREDIT_SCORE", "ANNUAL_MILEAGE", "MARRIED", "CHILDREN", "OUTCOME")
    features, target = cols.split_target(kept, TARGET)
    return kept.select(*features, target)


_LINEITEM_KINDS = ["l_orderkey bigint", "l_partkey bigint", "l_suppkey bigint", "l_linenumber int", "l_quantity double",
                   "l_extendedprice double", "l_discount double", "l_tax double", "l_returnflag string", "l_linestatus string",
                   "l_shipdate timestamp_ntz"]


def _kinds_sql() -> str:
    rows = []
    for name, kind in map(str.split, _LINEITEM_KINDS):
        group = "text" if kind == "string" else "other" if kind == "timestamp_ntz" else "numeric"
        rows.append(f"SELECT '{name}' AS \"column\", '{kind}' AS type, '{group}' AS kind, {kind == 'double'} AS scaled, "
                    f"count({name}) AS present FROM lineitem")
    return "\nUNION ALL ".join(rows)


@query("column_kinds", _kinds_sql())
def column_kinds(spark, sf):
    """Name, declared type and class of every column; the schema is the data here."""
    df = table(spark, sf, "lineitem")
    numeric, text = cols.numeric_columns(df), cols.text_columns(df)
    kinds = [(f.name, f.dataType.simpleString(),
              "numeric" if f.name in numeric else "text" if f.name in text else "other") for f in df.schema]
    scale = cols.numeric_columns(df, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])
    counts = df.agg(*[F.count(cols.q(n)).alias(n) for n, _, _ in kinds])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("column"), F.lit(t).alias("type"), F.lit(k).alias("kind"),
                 F.lit(n in scale).alias("scaled"), cols.q(n).alias("present")) for n, t, k in kinds])))


@query("abs_numeric", f"""{with_views("dirty_customer")}
SELECT c_custkey, c_nationkey, abs(acctbal) AS acctbal FROM dirty_customer""")
def abs_numeric(spark, sf):
    return cols.absolute(view(spark, sf, "dirty_customer").select("c_custkey", "c_nationkey", "acctbal"))


@query("coerce_numeric", f"""{with_views("dirty_customer")}
SELECT c_custkey, TRY_CAST(score_text AS DOUBLE) AS score FROM dirty_customer""")
def coerce_numeric(spark, sf):
    return view(spark, sf, "dirty_customer").select("c_custkey", num.coerce_number(F.col("score_text")).alias("score"))


SCORE_RULE = {"score_text": (0, 7)}
BALANCE_RULE = {"acctbal": (0, 9900)}


@query("range_flags", f"""{with_views("dirty_customer")}
SELECT c_custkey, acctbal, score_text,
  coalesce(TRY_CAST(score_text AS DOUBLE) < 0 OR TRY_CAST(score_text AS DOUBLE) > 7, false) AS score_text_bad,
  coalesce(acctbal < 0 OR acctbal > 9900, false) AS acctbal_bad
FROM dirty_customer""")
def range_flags(spark, sf):
    kept = view(spark, sf, "dirty_customer").select("c_custkey", "acctbal", "score_text")
    return ranges.flag_ranges(kept, {**SCORE_RULE, **BALANCE_RULE})


@query("range_drop_rows", f"""{with_views("dirty_customer")},
a AS (SELECT c_custkey, abs(acctbal) AS acctbal FROM dirty_customer),
b AS (SELECT *, coalesce(acctbal > 9900, false) AS bad FROM a),
d AS (SELECT avg(CAST(bad AS INT)) AS ratio FROM b)
SELECT c_custkey, CASE WHEN NOT bad THEN acctbal END AS acctbal FROM b CROSS JOIN d
WHERE NOT (bad AND ratio < 0.05)""")
def range_drop_rows(spark, sf):
    kept = cols.absolute(view(spark, sf, "dirty_customer").select("c_custkey", "acctbal"), ["acctbal"])
    return ranges.enforce_ranges(kept, BALANCE_RULE, 0.05)


@query("range_null_cells", f"""{with_views("dirty_customer")},
b AS (SELECT *, coalesce(TRY_CAST(score_text AS DOUBLE) > 7, false) AS bad FROM dirty_customer),
d AS (SELECT avg(CAST(bad AS INT)) AS ratio FROM b)
SELECT c_custkey, CASE WHEN NOT bad THEN score_text END AS score_text FROM b CROSS JOIN d
WHERE NOT (bad AND ratio < 0.05)""")
def range_null_cells(spark, sf):
    return ranges.enforce_ranges(view(spark, sf, "dirty_customer").select("c_custkey", "score_text"), SCORE_RULE, 0.05)


@query("row_sum_feature", f"""{with_views("risk")}
SELECT ID, MARRIED, CHILDREN, VEHICLE_OWNERSHIP,
  CAST(coalesce(MARRIED, 0) + coalesce(CHILDREN, 0) + coalesce(VEHICLE_OWNERSHIP, 0) AS DOUBLE) AS FAMILY_STABILITY
FROM risk""")
def row_sum_feature(spark, sf):
    return cols.row_sum(view(spark, sf, "risk").select("ID", *FAMILY), FAMILY, "FAMILY_STABILITY")


# --- duplicates -----------------------------------------------------------------------------------------

@query("dedup_rows", f"""{with_views("dup_orders")}
SELECT DISTINCT o_orderstatus, o_orderpriority, price_band FROM dup_orders""")
def dedup_rows(spark, sf):
    return drop_duplicate_rows(cols.drop_columns(view(spark, sf, "dup_orders"), ["o_orderkey"]))


@query("dedup_rows_keep_key", f"""{with_views("dup_orders")}
SELECT min(o_orderkey) AS o_orderkey, o_orderstatus, o_orderpriority, price_band FROM dup_orders
GROUP BY o_orderstatus, o_orderpriority, price_band""")
def dedup_rows_keep_key(spark, sf):
    return drop_duplicate_rows(view(spark, sf, "dup_orders"), row_key="o_orderkey")


@query("dedup_documents", "SELECT DISTINCT text, lang FROM documents")
def dedup_documents(spark, sf):
    return drop_duplicate_rows(table(spark, sf, "documents").select("text", "lang"))


# --- text -----------------------------------------------------------------------------------------------

_NORMALISED = r"lower(regexp_replace(segment, '^\s+|\s+$', '', 'g'))"
_TOKENS = "('nan', 'none', 'null', '')"
_GOLDEN_ROWS = ", ".join(f"({i}, '{g}')" for i, g in enumerate(SEGMENTS))

FUZZY_SQL = f"""{with_views("dirty_customer")},
norm AS (SELECT c_custkey, {_NORMALISED} AS v FROM dirty_customer),
kept AS (SELECT c_custkey, CASE WHEN v NOT IN {_TOKENS} THEN v END AS v FROM norm),
golden AS (SELECT * FROM (VALUES {_GOLDEN_ROWS}) t(i, g)),
scores AS (SELECT v, i, g, round(100.0 * (1 - levenshtein(v, g) / CAST(length(v) + length(g) AS DOUBLE))) AS score
  FROM (SELECT DISTINCT v FROM kept WHERE v IS NOT NULL) CROSS JOIN golden),
best AS (SELECT v, arg_max(g, score * 100 - i) AS g, max(score) AS score FROM scores GROUP BY v)
SELECT c_custkey, CASE WHEN best.score >= 90 THEN best.g END AS segment
FROM kept LEFT JOIN best ON kept.v = best.v"""


def _segment_text():
    return txt.null_tokens(txt.normalise_text(F.col("segment")))


@query("text_normalise", f"""{with_views("dirty_customer")}
SELECT c_custkey, {_NORMALISED} AS segment FROM dirty_customer""")
def text_normalise(spark, sf):
    return view(spark, sf, "dirty_customer").select("c_custkey", txt.normalise_text(F.col("segment")).alias("segment"))


@query("null_tokens", f"""{with_views("dirty_customer")}
SELECT c_custkey, CASE WHEN {_NORMALISED} NOT IN {_TOKENS} THEN {_NORMALISED} END AS segment FROM dirty_customer""")
def null_token_cells(spark, sf):
    return view(spark, sf, "dirty_customer").select("c_custkey", _segment_text().alias("segment"))


@query("fuzzy_canonical", FUZZY_SQL)
def fuzzy_canonical(spark, sf):
    """The weighted scorer; on these typos the plain edit score of the SQL decides alike."""
    return view(spark, sf, "dirty_customer").select("c_custkey", canonicalise(_segment_text(), SEGMENTS).alias("segment"))


@query("fuzzy_canonical_edit", FUZZY_SQL)
def fuzzy_canonical_edit(spark, sf):
    return view(spark, sf, "dirty_customer").select(
        "c_custkey", canonicalise(_segment_text(), SEGMENTS, scorer="edit").alias("segment"))


@query("first_int", r"""
SELECT p_partkey, p_brand, CAST(nullif(regexp_extract(p_brand, '\d+', 0), '') AS DOUBLE) AS brand_number FROM part""")
def first_int(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_brand",
                                           txt.first_integer(F.col("p_brand")).cast("double").alias("brand_number"))


@query("age_bucket", rf"""{with_views("dirty_customer")},
n AS (SELECT c_custkey, age_text, TRY_CAST(nullif(regexp_extract(age_text, '\d+', 0), '') AS BIGINT) AS n
  FROM (SELECT c_custkey, lower(age_text) AS age_text FROM dirty_customer))
SELECT c_custkey, CASE WHEN age_text IN ('16-25', '26-39', '40-64', '65+') THEN age_text
  WHEN n BETWEEN 16 AND 25 THEN '16-25' WHEN n BETWEEN 26 AND 39 THEN '26-39'
  WHEN n BETWEEN 40 AND 64 THEN '40-64' WHEN n >= 65 THEN '65+' END AS age
FROM n""")
def age_bucket(spark, sf):
    text = txt.null_tokens(txt.normalise_text(F.col("age_text")))
    return view(spark, sf, "dirty_customer").select("c_custkey", txt.age_bucket(text, AGES).alias("age"))


@query("membership", """
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority END AS o_orderpriority
FROM orders""")
def membership(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", txt.keep_members(F.col("o_orderpriority"), ["1-URGENT", "2-HIGH"]).alias("o_orderpriority"))


@query("category_text", f"""{with_views("dup_orders")}
SELECT o_orderkey, coalesce(CAST(CAST(price_band AS BIGINT) AS STRING), 'nan') AS price_band FROM dup_orders""")
def category_text(spark, sf):
    return view(spark, sf, "dup_orders").select(
        "o_orderkey", txt.category_text(F.col("price_band").cast("bigint")).alias("price_band"))


# --- fit statistics -------------------------------------------------------------------------------------

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


@query("fit_median", f"{with_views('dirty_customer', 'gappy_events')}\n" + _union(
    f"SELECT '{c}' AS \"column\", round(median({c}), {DIGITS}) AS value FROM {t}"
    for t, c in (("dirty_customer", "acctbal"), ("dirty_customer", "c_nationkey"), ("gappy_events", "value"))))
def fit_median(spark, sf):
    found = {**exact_medians(view(spark, sf, "dirty_customer"), ["acctbal", "c_nationkey"]),
             **exact_medians(view(spark, sf, "gappy_events"), ["value"])}
    return rounded(spark.createDataFrame(list(found.items()), "column string, value double"), "value")


@query("fit_mode", f"{with_views('dirty_customer')}\n" + _union(
    f"SELECT * FROM (SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM dirty_customer "
    f"WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY n DESC, value LIMIT 1)"
    for c in ("segment", "age_text", "score_text")))
def fit_mode(spark, sf):
    return stats.column_modes(view(spark, sf, "dirty_customer"), ["segment", "age_text", "score_text"])


_PROBS = (0.01, 0.25, 0.5, 0.75, 0.99)


@query("fit_quantiles", _union(
    f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS prob, round(quantile_cont({c}, {p}), {DIGITS}) AS value FROM lineitem"
    for c in LINE_NUMBERS for p in _PROBS))
def fit_quantiles(spark, sf):
    return rounded(stats.quantile_table(table(spark, sf, "lineitem"), {c: _PROBS for c in LINE_NUMBERS}), "value")


@query("fit_iqr", _union(
    f"SELECT '{c}' AS \"column\", round(median({c}), {DIGITS}) AS center, "
    f"round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), {DIGITS}) AS iqr FROM {t}"
    for t, c in (("events", "value"), ("documents", "n_chars"))))
def fit_iqr(spark, sf):
    rows = []
    for t, c in (("events", "value"), ("documents", "n_chars")):
        fitted = transforms.fit_scalers(table(spark, sf, t), [c], "robust")[c]
        rows.append((c, fitted["center"], fitted["scale"]))
    return rounded(spark.createDataFrame(rows, "column string, center double, iqr double"), "center", "iqr")


def _skew_sql(c: str, t: str) -> str:
    return (f"SELECT skewness({c}) * (count({c}) - 2) / sqrt(count({c}) * (count({c}) - 1.0)) FROM {t}")


@query("fit_moments", f"{with_views('gappy_events')}\n" + _union(
    f"SELECT 'value' AS \"column\", '{s}' AS stat, round(CAST(({e}) AS DOUBLE), {DIGITS}) AS value" for s, e in (
        ("count", "SELECT count(value) FROM gappy_events"),
        ("missing", "SELECT count(*) - count(value) FROM gappy_events"),
        ("min", "SELECT min(value) FROM gappy_events"), ("max", "SELECT max(value) FROM gappy_events"),
        ("mean", "SELECT avg(value) FROM gappy_events"), ("std", "SELECT stddev_pop(value) FROM gappy_events"),
        ("skew", _skew_sql("value", "gappy_events")))))
def fit_moments(spark, sf):
    return rounded(stats.describe(view(spark, sf, "gappy_events"), ["value"]), "value")


@query("fit_skew", _union(
    f"SELECT '{c}' AS \"column\", 'skew' AS stat, round(({_skew_sql(c, t)}), {DIGITS}) AS value"
    for t, c in (("lineitem", "l_quantity"), ("lineitem", "l_extendedprice"), ("documents", "n_chars"))))
def fit_skew(spark, sf):
    lines = stats.describe(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"], ["skew"])
    return rounded(lines.unionByName(stats.describe(table(spark, sf, "documents"), ["n_chars"], ["skew"])), "value")


_EDGES = [i / 5 for i in range(6)]


@query("fit_bin_edges", _union(
    f"SELECT CAST({i} AS INT) AS edge, round(quantile_cont(l_extendedprice, {p}), {DIGITS}) AS value FROM lineitem"
    for i, p in enumerate(_EDGES)))
def fit_bin_edges(spark, sf):
    edges = stats.fit_bin_edges(table(spark, sf, "lineitem"), ["l_extendedprice"])["l_extendedprice"]
    return rounded(spark.createDataFrame(list(enumerate(edges)), "edge int, value double"), "value")


@query("fit_categories", _union(
    f"SELECT DISTINCT '{c}' AS \"column\", {c} AS value FROM part" for c in ("p_type", "p_brand")))
def fit_categories(spark, sf):
    return stats.category_values(table(spark, sf, "part"), ["p_type", "p_brand"])


@query("audit_counts", f"""{with_views("dirty_customer")},
d AS (SELECT DISTINCT c_nationkey, acctbal, segment, age_text, score_text FROM dirty_customer),
b AS (SELECT *, coalesce(abs(acctbal) > 9900, false) AS bad_a,
  coalesce(TRY_CAST(score_text AS DOUBLE) > 7, false) AS bad_s FROM dirty_customer)
SELECT 'rows' AS step, CAST(NULL AS VARCHAR) AS "column", count(*) AS n FROM dirty_customer
UNION ALL SELECT 'distinct_rows', NULL, count(*) FROM d
UNION ALL SELECT 'negative', 'c_nationkey', count(*) FILTER (c_nationkey < 0) FROM b
UNION ALL SELECT 'negative', 'acctbal', count(*) FILTER (acctbal < 0) FROM b
UNION ALL SELECT 'violation', 'acctbal', count(*) FILTER (bad_a) FROM b
UNION ALL SELECT 'violation', 'score_text', count(*) FILTER (bad_s) FROM b
UNION ALL SELECT 'bad_rows', NULL, count(*) FILTER (bad_a OR bad_s) FROM b
UNION ALL SELECT 'capped', 'acctbal', count(*) FILTER (acctbal < 0 OR acctbal > 9000) FROM b""")
def audit_counts(spark, sf):
    return stats.audit(view(spark, sf, "dirty_customer"), {**BALANCE_RULE, **SCORE_RULE}, ["c_nationkey", "acctbal"],
                       {"acctbal": (0.0, 9000.0)}, drop=["c_custkey"])


# --- imputation -----------------------------------------------------------------------------------------

def _mode_sql(c: str, t: str) -> str:
    return f"(SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


def _median_sql(c: str, t: str) -> str:
    return f"(SELECT median({c}) FROM {t})"


@query("impute_auto", f"""{with_views("dirty_customer")}
SELECT c_custkey, round(coalesce(acctbal, {_median_sql("acctbal", "dirty_customer")}), {DIGITS}) AS acctbal,
  coalesce(segment, {_mode_sql("segment", "dirty_customer")}) AS segment
FROM dirty_customer""")
def impute_auto(spark, sf):
    kept = view(spark, sf, "dirty_customer").select("c_custkey", "acctbal", "segment")
    return rounded(impute(kept, *fit_fill_values(kept, ["c_custkey"])), "acctbal")


@query("fill_constant", f"""{with_views("gappy_events")}
SELECT event_id, coalesce(value, 0.0) AS value, coalesce(event_type, 'Unknown') AS event_type FROM gappy_events""")
def fill_constant(spark, sf):
    return fill_values(view(spark, sf, "gappy_events").select("event_id", "value", "event_type"),
                       {"value": 0.0}, {"event_type": "Unknown"})


def _filled_sql(function: str, frame: str, keys: str = "") -> str:
    over = f"OVER ({keys} ORDER BY ts, event_id ROWS BETWEEN {frame})"
    return ",\n  ".join(f"{function}({c} IGNORE NULLS) {over} AS {c}" for c in ("value", "event_type"))


_BACK, _AHEAD = "UNBOUNDED PRECEDING AND CURRENT ROW", "CURRENT ROW AND UNBOUNDED FOLLOWING"


def _sweep_sql(filled: str) -> str:
    return f"""{with_views("gappy_events")},
f AS (SELECT event_id, user_id, {filled} FROM gappy_events)
SELECT event_id, user_id, round(coalesce(value, {_median_sql("value", "gappy_events")}), {DIGITS}) AS value,
  coalesce(event_type, {_mode_sql("event_type", "gappy_events")}) AS event_type FROM f"""


def _impute_events(spark, sf, strategy):
    gappy = view(spark, sf, "gappy_events")
    medians, modes = exact_medians(gappy, ["value"]), stats.fit_modes(gappy, ["event_type"])
    return rounded(impute(gappy, medians, modes, strategy, EVENT_ORDER).drop("ts"), "value")


@query("impute_ffill", _sweep_sql(_filled_sql("last_value", _BACK)))
def impute_ffill(spark, sf):
    return _impute_events(spark, sf, "ffill")


@query("impute_bfill", _sweep_sql(_filled_sql("first_value", _AHEAD)))
def impute_bfill(spark, sf):
    return _impute_events(spark, sf, "bfill")


@query("ffill_by_user", f"""{with_views("gappy_events")}
SELECT event_id, user_id, {_filled_sql("last_value", _BACK, "PARTITION BY user_id")} FROM gappy_events""")
def ffill_by_user(spark, sf):
    return fill_along(view(spark, sf, "gappy_events"), EVENT_ORDER, ["user_id"]).drop("ts")


@query("bfill_by_user", f"""{with_views("gappy_events")}
SELECT event_id, user_id, {_filled_sql("first_value", _AHEAD, "PARTITION BY user_id")} FROM gappy_events""")
def bfill_by_user(spark, sf):
    return fill_along(view(spark, sf, "gappy_events"), EVENT_ORDER, ["user_id"], direction="backward").drop("ts")


# --- transforms -----------------------------------------------------------------------------------------

def _cap_sql(c: str, t: str, x: str | None = None) -> str:
    low, high = (f"(SELECT quantile_cont({c}, {p}) FROM {t})" for p in (0.01, 0.99))
    return f"CASE WHEN {x or c} IS NOT NULL THEN greatest(least({x or c}, {high}), {low}) END"


@query("cap_outliers", f"""
SELECT event_id, round({_cap_sql("value", "events")}, {DIGITS}) AS value FROM events""")
def cap_outliers(spark, sf):
    df = table(spark, sf, "events").select("event_id", "value")
    return rounded(transforms.treat_outliers(df, ["value"], {}, transforms.fit_caps(df, ["value"])), "value")


@query("log_positive", f"""
SELECT c_custkey, round(CASE WHEN c_acctbal > 0 THEN ln(1 + c_acctbal) ELSE c_acctbal END, {DIGITS}) AS c_acctbal
FROM customer""")
def log_positive(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return rounded(transforms.treat_outliers(df, ["c_acctbal"], {"c_acctbal": "log"}, {}), "c_acctbal")


@query("outlier_dispatch", f"""
SELECT round(l_quantity, {DIGITS}) AS l_quantity,
  round({_cap_sql("l_extendedprice", "lineitem")}, {DIGITS}) AS l_extendedprice,
  round(CASE WHEN l_discount > 0 THEN ln(1 + l_discount) ELSE l_discount END, {DIGITS}) AS l_discount,
  round(l_tax, {DIGITS}) AS l_tax
FROM lineitem""")
def outlier_dispatch(spark, sf):
    df = table(spark, sf, "lineitem").select(*LINE_NUMBERS)
    plan = {"l_quantity": None, "l_discount": "log", "l_tax": "none"}
    caps = transforms.fit_caps(df, ["l_extendedprice"])
    return rounded(transforms.treat_outliers(df, LINE_NUMBERS, plan, caps), *LINE_NUMBERS)


@query("bin_quantile", "SELECT event_id, CAST(" + " + ".join(
    f"CASE WHEN value >= (SELECT quantile_cont(value, {p}) FROM events) THEN 1 ELSE 0 END" for p in _EDGES[1:-1])
    + " AS DOUBLE) AS value FROM events")
def bin_quantile(spark, sf):
    df = table(spark, sf, "events").select("event_id", "value")
    return transforms.bin_columns(df, stats.fit_bin_edges(df, ["value"]))


@query("ordinal_encode", """
SELECT o_orderkey, CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '3-MEDIUM' THEN 2
  WHEN '4-NOT SPECIFIED' THEN 1 ELSE 0 END AS DOUBLE) AS o_orderpriority
FROM orders""")
def ordinal_encode(spark, sf):
    return transforms.encode_ordinal(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"),
                                     {"o_orderpriority": PRIORITIES})


@query("select_columns", "SELECT l_quantity, l_tax FROM lineitem")
def select_columns(spark, sf):
    """The projection on chosen features: only these two columns are read."""
    return table(spark, sf, "lineitem").select("l_quantity", "l_tax")


@query("pooled_folds", f"""{with_views("scored")}
SELECT fold, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives FROM scored GROUP BY fold""")
def pooled_folds(spark, sf):
    """Folds scored apart and pooled again."""
    scored = view(spark, sf, "scored")
    parts = [scored.filter(F.col("fold") == i) for i in range(3)]
    pooled = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return pooled.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("label").cast("bigint").alias("positives"))


@query("one_hot", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS o_orderstatus_F,
  CASE WHEN o_orderstatus = 'O' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS o_orderstatus_O,
  CASE WHEN o_orderstatus = 'P' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS o_orderstatus_P
FROM orders""")
def one_hot(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return transforms.encode_one_hot(df, stats.fit_categories(df, ["o_orderstatus"]))


_SCALED = ["l_quantity", "l_extendedprice", "l_discount"]


def _scale_sql(center: str, scale: str) -> str:
    cells = ",\n  ".join(
        f"round(({c} - (SELECT {center.format(c=c)} FROM lineitem)) / (SELECT {scale.format(c=c)} FROM lineitem), {DIGITS}) AS {c}"
        for c in _SCALED)
    return f"SELECT {cells}\nFROM lineitem"


def _scaled(spark, sf, strategy):
    df = table(spark, sf, "lineitem").select(*_SCALED)
    return rounded(transforms.scale_columns(df, transforms.fit_scalers(df, _SCALED, strategy)), *_SCALED)


@query("scale_minmax", _scale_sql("min({c})", "max({c}) - min({c})"))
def scale_minmax(spark, sf):
    return _scaled(spark, sf, "minmax")


@query("scale_standard", _scale_sql("avg({c})", "stddev_pop({c})"))
def scale_standard(spark, sf):
    return _scaled(spark, sf, "standard")


@query("scale_robust", _scale_sql("median({c})", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"))
def scale_robust(spark, sf):
    return _scaled(spark, sf, "robust")


@query("scale_constant", "SELECT 0.0::DOUBLE AS seven, o_orderkey FROM orders")
def scale_constant(spark, sf):
    df = table(spark, sf, "orders").select(F.lit(7.0).alias("seven"), "o_orderkey")
    return transforms.scale_columns(df, transforms.fit_scalers(df, ["seven"], "standard"))


_LAMBDA = 0.25


@query("scale_power_fixed", f"""
WITH t AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN (power(c_acctbal + 1, {_LAMBDA}) - 1) / {_LAMBDA}
  ELSE -(power(1 - c_acctbal, {2 - _LAMBDA}) - 1) / {2 - _LAMBDA} END AS x FROM customer)
SELECT c_custkey, round((x - (SELECT avg(x) FROM t)) / (SELECT stddev_pop(x) FROM t), {DIGITS}) AS c_acctbal FROM t""")
def scale_power_fixed(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    powered = {"c_acctbal": num.yeo_johnson(F.col("c_acctbal"), _LAMBDA)}
    m = stats.fit_moments(df, ["c_acctbal"], ["mean", "std"], powered)["c_acctbal"]
    scaler = {"kind": "power", "lambda": _LAMBDA, "center": m["mean"], "scale": m["std"]}
    return rounded(transforms.scale_columns(df, {"c_acctbal": scaler}), "c_acctbal")


@query("scale_power", "SELECT count(*) AS n, true AS centred, true AS unit, true AS symmetric, true AS likeliest FROM events WHERE value IS NOT NULL")
def scale_power(spark, sf):
    """Automatic choice on a skewed column: lambda of the greatest likelihood, then z-scores.

    The result proves itself: mean 0, deviation 1, skewness below a tenth, and no likelier lambda next to it.
    """
    df = table(spark, sf, "events").select("event_id", "value")
    scalers = transforms.fit_scalers(df, ["value"], "auto")
    lam = scalers["value"]["lambda"]
    scaled = transforms.scale_columns(df, scalers)
    m = scaled.agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.skewness("value").alias("skew"))

    def likelihood(x: float):
        return (-F.count("value") / 2 * F.log(F.var_pop(num.yeo_johnson(F.col("value"), x)))
                + (x - 1) * F.sum(F.signum("value") * F.log1p(F.abs("value"))))

    best = df.agg((likelihood(lam) >= F.greatest(likelihood(lam - 0.05), likelihood(lam + 0.05))).alias("likeliest"))
    return m.select("n", (F.abs("mean") < 1e-6).alias("centred"), (F.abs(F.col("std") - 1) < 1e-6).alias("unit"),
                    (F.abs("skew") < 0.1).alias("symmetric")).crossJoin(F.broadcast(best))


def _auto_sql() -> str:
    cells = []
    for c in ("quantity", "squared"):
        robust = f"({c} - (SELECT median({c}) FROM t)) / (SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM t)"
        minmax = f"({c} - (SELECT min({c}) FROM t)) / (SELECT max({c}) - min({c}) FROM t)"
        cells.append(f"round(CASE WHEN abs(({_skew_sql(c, 't')})) > 0.5 THEN {robust} ELSE {minmax} END, {DIGITS}) AS {c}")
    return ("WITH t AS (SELECT l_quantity AS quantity, l_quantity * l_quantity AS squared FROM lineitem)\n"
            f"SELECT {', '.join(cells)} FROM t")


@query("scale_auto", _auto_sql())
def scale_auto(spark, sf):
    """One column of skewness below 0.5 (min-max), one between 0.5 and 1 (robust)."""
    df = table(spark, sf, "lineitem").select(F.col("l_quantity").alias("quantity"),
                                             (F.col("l_quantity") * F.col("l_quantity")).alias("squared"))
    return rounded(transforms.scale_columns(df, transforms.fit_scalers(df, df.columns, "auto")), *df.columns)


# --- cleaner and transformer ----------------------------------------------------------------------------

def _customer_cleaner() -> Cleaner:
    return Cleaner(golden_specs={"segment": SEGMENTS, "age_text": AGES}, age_col="age_text", row_key="c_custkey",
                   range_rules={"acctbal": (0, 9900), "score_text": (0, 7)})


CLEAN_SQL = rf"""{with_views("dirty_customer")},
kept AS (SELECT *, {_NORMALISED} AS v, lower(age_text) AS a, TRY_CAST(score_text AS DOUBLE) AS s,
  TRY_CAST(nullif(regexp_extract(age_text, '\d+', 0), '') AS BIGINT) AS n FROM dirty_customer),
once AS (SELECT min(c_custkey) AS c_custkey, c_nationkey, acctbal, v, a, s, n, score_text
  FROM kept GROUP BY c_nationkey, acctbal, segment, age_text, v, a, s, n, score_text),
golden AS (SELECT * FROM (VALUES {_GOLDEN_ROWS}) t(i, g)),
scores AS (SELECT v, i, g, round(100.0 * (1 - levenshtein(v, g) / CAST(length(v) + length(g) AS DOUBLE))) AS score
  FROM (SELECT DISTINCT v FROM once WHERE v NOT IN {_TOKENS}) CROSS JOIN golden),
best AS (SELECT v, arg_max(g, score * 100 - i) AS g, max(score) AS score FROM scores GROUP BY v),
std AS (SELECT c_custkey, abs(c_nationkey) AS c_nationkey, abs(acctbal) AS acctbal, s, score_text,
  CASE WHEN best.score >= 90 THEN best.g END AS segment,
  CASE WHEN a IN ('16-25', '26-39', '40-64', '65+') THEN a WHEN n BETWEEN 16 AND 25 THEN '16-25'
    WHEN n BETWEEN 26 AND 39 THEN '26-39' WHEN n BETWEEN 40 AND 64 THEN '40-64' WHEN n >= 65 THEN '65+' END AS age_text
  FROM once LEFT JOIN best ON once.v = best.v),
flag AS (SELECT *, coalesce(acctbal > 9900, false) AS bad_a, coalesce(s > 7, false) AS bad_s FROM std),
ratio AS (SELECT avg(CAST(bad_a OR bad_s AS INT)) AS r FROM flag),
nulled AS (SELECT c_custkey, c_nationkey, CASE WHEN NOT bad_a THEN acctbal END AS acctbal, segment, age_text,
  CASE WHEN NOT bad_s THEN score_text END AS score_text
  FROM flag CROSS JOIN ratio WHERE NOT ((bad_a OR bad_s) AND r < 0.05)),
clean AS (SELECT c_custkey, c_nationkey, coalesce(acctbal, {_median_sql("acctbal", "dirty_customer")}) AS acctbal,
  coalesce(segment, {_mode_sql("segment", "dirty_customer")}) AS segment,
  coalesce(age_text, {_mode_sql("age_text", "dirty_customer")}) AS age_text,
  coalesce(score_text, {_mode_sql("score_text", "dirty_customer")}) AS score_text FROM nulled)"""


@query("clean_full", f"""{CLEAN_SQL}
SELECT c_custkey, c_nationkey, round(acctbal, {DIGITS}) AS acctbal, segment, age_text, score_text FROM clean""")
def clean_full(spark, sf):
    return rounded(_customer_cleaner().fit_transform(view(spark, sf, "dirty_customer")), "acctbal")


_AGE_CODES = {a: i for i, a in enumerate(AGES)}


@query("transform_full", f"""{CLEAN_SQL},
pre AS (SELECT c_custkey, CASE WHEN c_nationkey > 0 THEN ln(1 + c_nationkey) ELSE c_nationkey END AS c_nationkey,
  {_cap_sql("acctbal", "clean")} AS acctbal, segment,
  CAST(CASE age_text WHEN '26-39' THEN 1 WHEN '40-64' THEN 2 WHEN '65+' THEN 3 ELSE 0 END AS DOUBLE) AS age_text FROM clean)
SELECT c_custkey, """ + ",\n  ".join(
    f"round(({c} - (SELECT avg({c}) FROM pre)) / (SELECT stddev_pop({c}) FROM pre), {DIGITS}) AS {c}"
    for c in ("c_nationkey", "acctbal")) + f""",
  round((age_text - (SELECT min(age_text) FROM pre)) / (SELECT max(age_text) - min(age_text) FROM pre), {DIGITS}) AS age_text,
  """ + ",\n  ".join(f"CASE WHEN segment = '{g}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS segment_{g}" for g in SEGMENTS) + """
FROM pre""")
def transform_full(spark, sf):
    clean = materialise(_customer_cleaner().fit_transform(view(spark, sf, "dirty_customer")).drop("score_text"))
    transformer = Transformer(scaling_strategy="standard", outlier_strategies={"c_nationkey": "log"},
                              ordinal_mappings={"age_text": _AGE_CODES}, nominal_cols=["segment"],
                              ignore_cols=["c_custkey"])
    out = transformer.fit_transform(clean)
    # The mode of the raw text is no golden value and encodes to a category of its own.
    return rounded(out.drop(*[c for c in out.columns if c.startswith("segment_") and c[8:] not in SEGMENTS]),
                   "c_nationkey", "acctbal", "age_text")


# --- splits ---------------------------------------------------------------------------------------------

def _digest_sql(key: str, seed: int = 42) -> str:
    return f"md5(concat(CAST({key} AS VARCHAR), '|{seed}'))"


def holdout_sql(t: str, key: str, strata: str | None, size: float = 0.2) -> str:
    """CTEs ending in ``marked``: table ``t`` plus is_test, by largest remainder over the strata."""
    by = strata or "0"
    return f"""
ranked AS (SELECT *, {by} AS cls, row_number() OVER (PARTITION BY {by} ORDER BY {_digest_sql(key)}) AS place FROM {t}),
counts AS (SELECT cls, count(*) AS n, sum(count(*)) OVER () AS total FROM ranked GROUP BY cls),
shares AS (SELECT cls, ceil(round(total * {size}, 9)) AS wanted, ceil(round(total * {size}, 9)) * n / total AS exact FROM counts),
parts AS (SELECT cls, floor(exact) AS base, wanted - sum(floor(exact)) OVER () AS spare,
  row_number() OVER (ORDER BY exact - floor(exact) DESC, cls) AS turn FROM shares),
marked AS (SELECT ranked.*, place <= base + CASE WHEN turn <= spare THEN 1 ELSE 0 END AS is_test
  FROM ranked JOIN parts ON ranked.cls IS NOT DISTINCT FROM parts.cls)"""


@query("split_stratified", f"WITH {holdout_sql('orders', 'o_orderkey', 'o_orderstatus')}"
       "\nSELECT o_orderkey, o_orderstatus, is_test FROM marked")
def split_stratified(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.mark_holdout(df, ["o_orderkey"], 0.2, "o_orderstatus")


@query("split_random", f"WITH {holdout_sql('customer', 'c_custkey', None, 0.3)}\nSELECT c_custkey, is_test FROM marked")
def split_random(spark, sf):
    return split.mark_holdout(table(spark, sf, "customer").select("c_custkey"), ["c_custkey"], 0.3)


@query("kfold", f"""
SELECT o_orderkey, CAST(ntile(3) OVER (ORDER BY {_digest_sql("o_orderkey")}) - 1 AS INT) AS fold FROM orders""")
def kfold(spark, sf):
    return split.mark_folds(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 3)


@query("kfold_stratified", f"""
SELECT c_custkey, c_mktsegment,
  CAST(ntile(5) OVER (PARTITION BY c_mktsegment ORDER BY {_digest_sql("c_custkey")}) - 1 AS INT) AS fold
FROM customer""")
def kfold_stratified(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return split.mark_folds(df, ["c_custkey"], 5, stratify_by="c_mktsegment")


def _many_classes_sql() -> str:
    return (f"WITH {holdout_sql('orders', 'o_orderkey', 'o_custkey')},\n"
            f"folds AS (SELECT o_orderkey, CAST(ntile(3) OVER (PARTITION BY o_custkey ORDER BY {_digest_sql('o_orderkey')}) - 1 AS INT) AS fold FROM orders)\n"
            "SELECT o_orderkey, o_custkey, is_test, fold FROM marked JOIN folds USING (o_orderkey)")


@query("split_many_classes", _many_classes_sql())
def split_many_classes(spark, sf):
    """Hold-out and folds within more classes than pass through the driver."""
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    marked = split.mark_holdout(df, ["o_orderkey"], 0.2, "o_custkey")
    return split.mark_folds(marked, ["o_orderkey"], 3, stratify_by="o_custkey")


# --- metrics --------------------------------------------------------------------------------------------

_COUNTS = ("sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS tp, sum(prediction) AS pp, sum(label) AS ap, "
           "sum(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS ok, count(*) AS n")


def _metric_cells(prefix: str = "") -> str:
    cells = {"accuracy": "ok / n", "precision": "coalesce(tp / nullif(pp, 0), 0)",
             "recall": "coalesce(tp / nullif(ap, 0), 0)", "f1_score": "coalesce(2 * tp / nullif(pp + ap, 0), 0)"}
    return ", ".join(f"round(CAST({e} AS DOUBLE), {DIGITS}) AS {prefix}{m}" for m, e in cells.items())


@query("metrics_binary", f"""{with_views("scored")},
c AS (SELECT {_COUNTS} FROM scored)
SELECT {_metric_cells()} FROM c""")
def metrics_binary(spark, sf):
    return rounded(metrics.binary_metrics(view(spark, sf, "scored")), *metrics.METRICS)


@query("metrics_zero_division", f"""
WITH s AS (SELECT doc_id, 0 AS label, quality * 0 AS prediction FROM labels), c AS (SELECT {_COUNTS} FROM s)
SELECT {_metric_cells()} FROM c""")
def metrics_zero_division(spark, sf):
    scored = table(spark, sf, "labels").select("doc_id", F.lit(0).alias("label"), (F.col("quality") * 0).alias("prediction"))
    return rounded(metrics.binary_metrics(scored), *metrics.METRICS)


@query("metrics_by_fold", f"""{with_views("scored")},
c AS (SELECT fold, {_COUNTS} FROM scored GROUP BY fold)
SELECT fold, {_metric_cells()} FROM c""")
def metrics_by_fold(spark, sf):
    return rounded(metrics.fold_metrics(view(spark, sf, "scored")), *metrics.METRICS)


def _mean_cells() -> str:
    return ", ".join(f"round(avg({m}), {DIGITS}) AS mean_{m}" for m in metrics.METRICS)


def _fold_ctes(source: str, name: str) -> str:
    exact = _metric_cells().replace("round(", "(").replace(f", {DIGITS})", ")")
    return f"""c_{name} AS (SELECT fold, {_COUNTS} FROM {source} GROUP BY fold),
m_{name} AS (SELECT fold, {exact} FROM c_{name})"""


@query("metrics_mean", f"""{with_views("scored")},
{_fold_ctes("scored", "a")}
SELECT {_mean_cells()}, count(*) AS n_folds FROM m_a""")
def metrics_mean(spark, sf):
    return rounded(metrics.mean_metrics(view(spark, sf, "scored")), *[f"mean_{m}" for m in metrics.METRICS])


@query("confusion_matrix", f"""{with_views("scored")},
cells AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(label, prediction))
SELECT cells.label, cells.prediction, count(row_key) AS n FROM cells
LEFT JOIN scored ON scored.label = cells.label AND scored.prediction = cells.prediction GROUP BY ALL""")
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(view(spark, sf, "scored"))


ROC_CTES = """
g AS (SELECT CAST(score AS DOUBLE) AS score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label <> 1) AS neg
  FROM scored GROUP BY score),
r AS (SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n
  FROM g WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@query("roc_points", f"""{with_views("scored")},{ROC_CTES}
SELECT score AS threshold, round(fp / n, {DIGITS}) AS fpr, round(tp / p, {DIGITS}) AS tpr FROM r
UNION ALL SELECT CAST('infinity' AS DOUBLE), 0.0, 0.0""")
def roc_points(spark, sf):
    return rounded(metrics.roc_points(view(spark, sf, "scored")), "fpr", "tpr")


@query("auc", f"""{with_views("scored")},{ROC_CTES}
SELECT round(sum(neg * (tp - pos / 2)) / (max(p) * max(n)), {DIGITS}) AS auc FROM r""")
def auc(spark, sf):
    return rounded(metrics.auc(view(spark, sf, "scored")), "auc")


# Three threshold classifiers on the same scores stand for three models.
_CUTS = {"strict": 0.09, "middle": 0.06, "loose": 0.03}


def _board_sql(tail: str) -> str:
    parts = ",\n".join(
        f"s_{m} AS (SELECT fold, label, CASE WHEN score >= {cut} THEN 1 ELSE 0 END AS prediction FROM scored),\n"
        + _fold_ctes(f"s_{m}", m) for m, cut in _CUTS.items())
    rows = _union(f"SELECT '{m}' AS model, {_mean_cells()}, count(*) AS n_folds FROM m_{m}" for m in _CUTS)
    return f"{with_views('scored')},\n{parts},\nboard AS ({rows})\n{tail}"


def _board(spark, sf):
    scored = view(spark, sf, "scored")
    return metrics.leaderboard({
        m: rounded(metrics.mean_metrics(scored.withColumn("prediction", F.when(F.col("score") >= cut, 1).otherwise(0))),
                   *[f"mean_{x}" for x in metrics.METRICS]) for m, cut in _CUTS.items()})


@query("leaderboard", _board_sql("SELECT * FROM board ORDER BY mean_f1_score DESC, model"))
def leaderboard(spark, sf):
    return _board(spark, sf)


@query("champion", _board_sql("SELECT model, mean_f1_score AS score FROM board ORDER BY score DESC, model LIMIT 1"))
def champion(spark, sf):
    return metrics.champion(_board(spark, sf))


# --- preparation ----------------------------------------------------------------------------------------

_RISK_TEXT = {"GENDER": ["male", "female"], "EDUCATION": ["none", "high school", "university"],
              "INCOME": ["poverty", "working class", "middle class", "upper class"],
              "DRIVING_EXPERIENCE": ["0-9y", "10-19y", "20-29y", "30y+"],
              "VEHICLE_YEAR": ["before 2015", "after 2015"],
              "TYPE_OF_VEHICLE": ["sedan", "sports car", "suv", "hatchback"]}
_FLAGS = ("VEHICLE_OWNERSHIP", "MARRIED", "CHILDREN")


def _text_fix(c: str) -> str:
    golden = ", ".join(f"'{g}'" for g in _RISK_TEXT[c])
    repaired = "WHEN trim(lower({c})) = 'universit' THEN 'university' ".format(c=c) if c == "EDUCATION" else ""
    return (f"CASE WHEN trim(lower({c})) = 'none' THEN NULL {repaired}"
            f"WHEN trim(lower({c})) IN ({golden}) THEN trim(lower({c})) END AS {c}")


def _age_fix() -> str:
    n = r"TRY_CAST(nullif(regexp_extract(AGE, '\d+', 0), '') AS BIGINT)"
    return (f"CASE WHEN AGE IN ('16-25', '26-39', '40-64', '65+') THEN AGE WHEN {n} BETWEEN 16 AND 25 THEN '16-25' "
            f"WHEN {n} BETWEEN 26 AND 39 THEN '26-39' WHEN {n} BETWEEN 40 AND 64 THEN '40-64' "
            f"WHEN {n} >= 65 THEN '65+' END AS AGE")


_RISK_KEPT = ["AGE", *_RISK_TEXT, "CREDIT_SCORE", *_FLAGS, "ANNUAL_MILEAGE", "PAST_ACCIDENTS", "OUTCOME"]
_RISK_CODES = {"AGE": AGES, "DRIVING_EXPERIENCE": _RISK_TEXT["DRIVING_EXPERIENCE"], "EDUCATION": _RISK_TEXT["EDUCATION"],
               "INCOME": _RISK_TEXT["INCOME"], "VEHICLE_YEAR": _RISK_TEXT["VEHICLE_YEAR"], "GENDER": ["female", "male"]}
_RISK_LOGS = ("ANNUAL_MILEAGE", "PAST_ACCIDENTS", "FAMILY_STABILITY")


def _risk_sql() -> str:
    """The whole preparation of the risk table in SQL, up to scaled train and test rows."""
    std = [_age_fix(), *[_text_fix(c) for c in _RISK_TEXT],
           *[f"abs({c}) AS {c}" for c in ("CREDIT_SCORE", *_FLAGS, "ANNUAL_MILEAGE", "PAST_ACCIDENTS", "OUTCOME")]]
    bad = " OR ".join(["coalesce(CREDIT_SCORE > 1, false)", *[f"coalesce({c} > 1, false)" for c in _FLAGS]])
    numeric = ("CREDIT_SCORE", *_FLAGS, "ANNUAL_MILEAGE", "PAST_ACCIDENTS", "OUTCOME")
    nulled = [c if c not in ("CREDIT_SCORE", *_FLAGS) else f"CASE WHEN NOT {c} > 1 THEN {c} END AS {c}" for c in _RISK_KEPT]
    filled = [f"coalesce({c}, {_median_sql(c, 'risk') if c in numeric else _mode_sql(c, 'risk')}) AS {c}" for c in _RISK_KEPT]
    pre = ["ID", "is_test", "OUTCOME", *_FLAGS, "TYPE_OF_VEHICLE",
           "greatest(least(CREDIT_SCORE, (SELECT quantile_cont(CREDIT_SCORE, 0.99) FROM marked WHERE NOT is_test)), "
           "(SELECT quantile_cont(CREDIT_SCORE, 0.01) FROM marked WHERE NOT is_test)) AS CREDIT_SCORE",
           *[f"CASE WHEN {c} > 0 THEN ln(1 + {c}) ELSE {c} END AS {c}" for c in _RISK_LOGS],
           *["CASE " + c + " " + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(vs)) + f" ELSE 0 END AS {c}"
             for c, vs in _RISK_CODES.items()]]
    scaled = [c for c in (*_FLAGS, "CREDIT_SCORE", *_RISK_LOGS, *_RISK_CODES)]
    out = [f"round(CAST({c} - (SELECT min({c}) FROM pre WHERE NOT is_test) AS DOUBLE) / (SELECT max({c}) - min({c}) "
           f"FROM pre WHERE NOT is_test), {DIGITS}) AS {c}" for c in scaled]
    codes = [f"CASE WHEN TYPE_OF_VEHICLE = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"TYPE_OF_VEHICLE_{v}\""
             for v in sorted(_RISK_TEXT["TYPE_OF_VEHICLE"])]
    kept = ", ".join(_RISK_KEPT)
    return f"""{with_views("risk")},
once AS (SELECT min(ID) AS ID, {kept} FROM risk GROUP BY {kept}),
std AS (SELECT ID, {", ".join(std)} FROM once),
flag AS (SELECT *, {bad} AS bad FROM std),
ratio AS (SELECT avg(CAST(bad AS INT)) AS r FROM flag),
nulled AS (SELECT ID, {", ".join(nulled)} FROM flag CROSS JOIN ratio WHERE NOT (bad AND r < 0.05)),
clean AS (SELECT ID, {", ".join(filled)} FROM nulled),
engineered AS (SELECT *, MARRIED + CHILDREN + VEHICLE_OWNERSHIP AS FAMILY_STABILITY FROM clean),
{holdout_sql("engineered", "ID", "OUTCOME")},
pre AS (SELECT {", ".join(pre)} FROM marked),
final AS (SELECT ID AS row_key, is_test, CAST(OUTCOME AS INT) AS OUTCOME, {", ".join(out)}, {", ".join(codes)} FROM pre)"""


RISK_SQL = _risk_sql()


@query("prepare_risk", f"{RISK_SQL}\nSELECT * FROM final")
def prepare_risk(spark, sf):
    """The 18-column risk table from raw rows to scaled training and test rows."""
    done = prepare(view(spark, sf, "risk"), risk_prepare(keep_key=True))
    both = done.train.withColumn("is_test", F.lit(False)).unionByName(done.test.withColumn("is_test", F.lit(True)))
    numbers = [c for c in cols.numeric_columns(both) if c not in ("OUTCOME", ROW_KEY)]
    return rounded(both, *numbers).withColumnRenamed(ROW_KEY, "row_key")


@query("prepare_shapes", f"""{RISK_SQL}
SELECT is_test, count(*) AS n_rows, CAST(18 AS BIGINT) AS n_columns, round(avg(OUTCOME), {DIGITS}) AS share FROM final GROUP BY is_test""")
def prepare_shapes(spark, sf):
    done = prepare(view(spark, sf, "risk"), risk_prepare())
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"), F.avg("OUTCOME").alias("share")).select(
        F.lit(test).alias("is_test"), "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns"), "share")
        for test, df in ((False, done.train), (True, done.test))]
    return rounded(parts[0].unionByName(parts[1]), "share")


# --- nearest neighbours ---------------------------------------------------------------------------------

def _knn_sql(k: int, weights: str, p: int) -> str:
    distance = "list_distance(t.x, r.x)" if p == 2 else "list_sum([abs(z[1] - z[2]) for z in list_zip(t.x, r.x)])"
    weight = "1.0" if weights == "uniform" else (
        "CASE WHEN min(d) OVER (PARTITION BY vec_id) = 0 THEN CASE WHEN d = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 / d END")
    return f"""WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
{holdout_sql("e", "vec_id", "label")},
pairs AS (SELECT t.vec_id, r.vec_id AS train_id, r.label, round({distance}, 9) AS d
  FROM marked t CROSS JOIN marked r WHERE t.is_test AND NOT r.is_test),
near AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, train_id) <= {k}),
w AS (SELECT vec_id, label, {weight} AS w FROM near),
votes AS (SELECT vec_id, label, round(sum(w), 9) AS w FROM w GROUP BY vec_id, label)
SELECT vec_id, CAST(label AS DOUBLE) AS prediction FROM votes
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY w DESC, label) = 1"""


def _knn(spark, sf, k, weights, p):
    marked = materialise(split.mark_holdout(table(spark, sf, "embeddings"), ["vec_id"], 0.2, "label"))
    train, test = marked.filter(~F.col("is_test")), marked.filter("is_test")
    knn = KNNClassifier(k, weights, p, key_col="vec_id", featuresCol="embedding", labelCol="label")
    return knn.fit(train).transform(test).select("vec_id", "prediction")


@query("knn_uniform", _knn_sql(5, "uniform", 2))
def knn_uniform(spark, sf):
    return _knn(spark, sf, 5, "uniform", 2)


@query("knn_distance", _knn_sql(7, "distance", 2))
def knn_distance(spark, sf):
    return _knn(spark, sf, 7, "distance", 2)


@query("knn_manhattan", _knn_sql(5, "uniform", 1))
def knn_manhattan(spark, sf):
    return _knn(spark, sf, 5, "uniform", 1)


@query("knn_neighbours", _knn_sql(5, "uniform", 2).split("\nw AS")[0].rstrip(",") + """
SELECT vec_id, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY d, train_id) AS INT) AS rank, train_id,
  CAST(label AS DOUBLE) AS label, round(d, 6) AS distance FROM near""")
def knn_neighbours(spark, sf):
    """Every neighbour of the search over many cells in small blocks."""
    marked = materialise(split.mark_holdout(table(spark, sf, "embeddings"), ["vec_id"], 0.2, "label"))
    knn = KNNClassifier(5, "uniform", 2, key_col="vec_id", featuresCol="embedding", rows_per_pivot=20, block_rows=16)
    found = knn.fit(marked.filter(~F.col("is_test"))).neighbours(marked.filter("is_test"))
    return found.select(F.col("test_key").alias("vec_id"), "rank", F.col("train_key").alias("train_id"), "label",
                        F.round("distance", 6).alias("distance"))


# --- models ---------------------------------------------------------------------------------------------

# Fitted models have no SQL. These queries return what proves a fit, and the SQL says what it has to be.

_TEST_ROWS = "FROM final WHERE is_test"


def _model_tables(spark, sf):
    """Training and test vectors over all features of the prepared table."""
    done = prepare(view(spark, sf, "risk"), risk_prepare(keep_key=True))
    features, _ = cols.split_target(done.train, TARGET, drop=(ROW_KEY,))
    return tuple(materialise(assemble(df, features, TARGET, [ROW_KEY]), "model") for df in (done.train, done.test))


def _fitted(spark, sf, name, **params):
    train, test = _model_tables(spark, sf)
    model = models.train_model(models.build_model(name, train.count(), key_col=ROW_KEY, **params), train)
    output = models.predict(model, test)
    scored = output.select(F.col(ROW_KEY).alias("row_key"), "label", "prediction", metrics.score_column(output).alias("score"))
    return train, model, materialise(scored, "scored")


def _beats_majority(scored):
    """Test rows, whether scores are probabilities, and whether accuracy is above that of the larger class."""
    right = F.avg((F.col("label") == F.col("prediction")).cast("double"))
    return scored.agg(F.count(F.lit(1)).alias("n_test"), F.min(F.col("score").between(0.0, 1.0)).alias("scores_in_range"),
                      (right > F.greatest(F.avg("label"), 1 - F.avg("label"))).alias("beats_majority"))


_BEATS_SQL = f"{RISK_SQL}\nSELECT count(*) AS n_test, true AS scores_in_range, true AS beats_majority {_TEST_ROWS}"


@query("model_logistic", f"{RISK_SQL}\nSELECT count(*) AS n_train, true AS optimal FROM final WHERE NOT is_test")
def model_logistic(spark, sf):
    """The gradient of the penalised log loss at the fitted weights is below a hundredth of that at zero weights."""
    train, model, _ = _fitted(spark, sf, "logistic_regression")
    weights, n = model.coefficients.toArray(), train.count()
    x = vector_to_array("features")
    products = F.zip_with(x, F.array(*[F.lit(float(w)) for w in weights]), lambda a, w: a * w)
    margin = F.aggregate(products, F.lit(float(model.intercept)), lambda total, v: total + v)
    miss = 1 / (1 + F.exp(-margin)) - F.col("label")
    rows = train.select(x.alias("x"), miss.alias("miss"), (0.5 - F.col("label")).alias("start"))
    slopes = rows.agg(*[(F.avg(F.col("miss") * F.get("x", F.lit(i))) + float(w) / n).alias(f"g{i}") for i, w in enumerate(weights)],
                      *[F.avg(F.col("start") * F.get("x", F.lit(i))).alias(f"z{i}") for i in range(len(weights))],
                      F.avg("miss").alias("g"), F.count(F.lit(1)).alias("n_train"))
    largest = F.greatest(F.abs("g"), *[F.abs(f"g{i}") for i in range(len(weights))])
    return slopes.select("n_train", (largest <= 0.01 * F.greatest(*[F.abs(f"z{i}") for i in range(len(weights))])).alias("optimal"))


@query("model_svm", f"""{RISK_SQL}
SELECT penalty, count(*) AS n_train, true AS optimal FROM final, (VALUES ('l1'), ('l2')) p(penalty) WHERE NOT is_test GROUP BY penalty""")
def model_svm(spark, sf):
    """Optimality residual of the squared hinge for both penalties, relative to zero weights."""
    train, _ = _model_tables(spark, sf)
    rows = train.select(vector_to_array("features").alias("x"), F.col("label").alias("y"))
    found = []
    for penalty in ("l1", "l2"):
        model = models.build_model("svm", train.count(), penalty=penalty, C=0.1).fit(train)
        weights = np.append(model.coefficients.toArray(), model.intercept)
        ends = [svm.residual(w, 0.1 * svm.loss_sums(rows, w)[1], penalty) for w in (weights, 0 * weights)]
        found.append((penalty, train.count(), bool(ends[0] <= 1e-3 * ends[1])))
    return spark.createDataFrame(found, "penalty string, n_train bigint, optimal boolean")


@query("model_tree", f"{RISK_SQL}\nSELECT count(*) AS n_train, true AS splits, CAST(0 AS BIGINT) AS wrong_leaves FROM final WHERE NOT is_test")
def model_tree(spark, sf):
    """Every leaf predicts the larger class of its training rows."""
    train, model, _ = _fitted(spark, sf, "decision_tree", max_depth=5)
    leaves = model.setLeafCol("leaf").transform(train).groupBy("leaf", "prediction").agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("share"))
    wrong = ((F.col("prediction") == 1) & (F.col("share") < 0.5)) | ((F.col("prediction") == 0) & (F.col("share") > 0.5))
    return leaves.agg(F.sum("n").alias("n_train"), (F.count(F.lit(1)) > 1).alias("splits"), F.count_if(wrong).alias("wrong_leaves"))


@query("model_tree_unlimited", f"""{RISK_SQL}
SELECT count(*) AS n_train, CAST(0 AS BIGINT) AS open_leaves, CAST(0 AS BIGINT) AS wrong_leaves, true AS deeper_than_limit FROM final WHERE NOT is_test""")
def model_tree_unlimited(spark, sf):
    """Without a limit of depth every leaf is pure or holds rows that no bin tells apart; the larger class of its training rows is predicted.

    Nodes of more than 2,000 rows are split over all tasks, smaller ones in one task each.
    """
    train, model, _ = _fitted(spark, sf, "decision_tree", subtree_rows=2000)
    def bin_of(j, cuts):
        # The bin of a value is the number of cuts below it.
        return F.size(F.filter(F.lit(cuts.tolist()), lambda cut: cut < F.get(vector_to_array("features"), F.lit(j)))) if len(cuts) else F.lit(0)

    bins = F.array(*[bin_of(j, cuts) for j, cuts in enumerate(model.cuts)])
    leaves = model.leaves(model.transform(train)).select(F.get("leaf", F.lit(0)).alias("leaf"), "prediction", "label", bins.alias("bins"))
    by_leaf = leaves.groupBy("leaf", "prediction").agg(
        F.count(F.lit(1)).alias("n"), F.avg("label").alias("share"), (F.min("bins") == F.max("bins")).alias("alike"))
    wrong = ((F.col("prediction") == 1) & (F.col("share") < 0.5)) | ((F.col("prediction") == 0) & (F.col("share") > 0.5))
    depth = max(walk_of(tree, None).depth for _, trees in model.chunks() for tree in trees)
    return by_leaf.agg(F.sum("n").alias("n_train"), F.count_if((F.col("share") > 0) & (F.col("share") < 1) & ~F.col("alike")).alias("open_leaves"),
                       F.count_if(wrong).alias("wrong_leaves"), F.lit(depth > 5).alias("deeper_than_limit"))


@query("model_forest_unlimited", f"""{RISK_SQL}
SELECT tree, count(*) FILTER (WHERE NOT is_test) AS n_train, true AS as_many_copies, true AS better_than_share FROM final, range(20) t(tree) GROUP BY tree""")
def model_forest_unlimited(spark, sf):
    """Per tree of an unlimited forest: the training rows, whether its leaves were grown from as many copies as rows (to 10 %), and whether
    its leaves predict the training rows, of which it saw some 63 %, better than the larger class does."""
    train, model, _ = _fitted(spark, sf, "random_forest", n_estimators=20)
    n, found = train.count(), []
    # A large forest comes a few trees at a time.
    for first, trees in model.chunks():
        copies = F.array(*[F.lit(abs(int(t["rows"][t["left"] < 0].sum()) - n) <= 0.1 * n) for t in trees])
        sent = model.send(trees)

        @F.pandas_udf("array<double>")
        def shares(x: pd.Series) -> pd.Series:
            rows = np.stack(x.to_numpy())
            return pd.Series(list(np.stack([t.of(rows) for t in sent.value], axis=1)))

        by_tree = train.select("label", F.posexplode(shares(vector_to_array("features"))).alias("tree", "share"))
        right = F.avg(((F.col("share") > 0.5).cast("double") == F.col("label")).cast("double"))
        found += by_tree.groupBy("tree").agg(
            F.count(F.lit(1)).alias("n_train"), (right > F.greatest(F.avg("label"), 1 - F.avg("label"))).alias("better_than_share")).select(
            (F.lit(first) + F.col("tree")).cast("long").alias("tree"), "n_train", "better_than_share", F.get(copies, F.col("tree")).alias("as_many_copies")).collect()
        sent.destroy()
    return spark.createDataFrame(found, "tree long, n_train long, better_than_share boolean, as_many_copies boolean")


@query("model_forest", _BEATS_SQL)
def model_forest(spark, sf):
    return _beats_majority(_fitted(spark, sf, "random_forest", n_estimators=50, max_depth=10)[2])


@query("model_gbt", f"""{RISK_SQL}
SELECT tree, count(*) FILTER (WHERE NOT is_test) AS n_train, CAST(0 AS BIGINT) AS wrong_leaves FROM final, range(20) t(tree) GROUP BY tree""")
def model_gbt(spark, sf):
    """Per boosted tree: its training rows, and its leaves whose weight is not that of the rows that reach it, by gradient and curvature summed here."""
    rate, penalty = 0.2, 1.0
    train, model, _ = _fitted(spark, sf, "xgboost", n_estimators=20, max_depth=3, learning_rate=rate, reg_lambda=penalty)
    trees = model.trees

    @F.pandas_udf("array<int>")
    def leaves(x: pd.Series) -> pd.Series:
        rows = np.stack(x.to_numpy())
        return pd.Series(list(np.stack([t.nodes_of(rows, False) for t in trees], axis=1).astype(np.int32)))

    weights = F.array(*[F.array(*[F.lit(float(v)) for v in t.value]) for t in trees])
    reached = train.select("label", leaves(vector_to_array("features")).alias("leaf")).withColumn(
        "weight", F.transform("leaf", lambda leaf, tree: F.get(F.get(weights, tree), leaf)))
    by_tree = reached.select("label", "leaf", "weight", F.explode(F.sequence(F.lit(0), F.lit(len(trees) - 1))).alias("tree")).select(
        F.col("tree").cast("long"), F.get("leaf", F.col("tree")).alias("leaf"), F.get("weight", F.col("tree")).alias("weight"), "label",
        F.aggregate(F.slice("weight", F.lit(1), F.col("tree")), F.lit(0.0), lambda total, w: total + w).alias("margin"))
    p = 1 / (1 + F.exp(-F.col("margin")))
    sums = by_tree.groupBy("tree", "leaf", "weight").agg(F.count("*").alias("n"), F.sum(p - F.col("label")).alias("g"), F.sum(p * (1 - p)).alias("h"))
    wrong = F.abs(F.col("weight") + rate * F.col("g") / (F.col("h") + penalty)) > 1e-9
    return sums.groupBy("tree").agg(F.sum("n").alias("n_train"), F.count_if(wrong).alias("wrong_leaves"))


@query("model_knn", f"{RISK_SQL}\nSELECT count(*) AS n_test, CAST(0 AS BIGINT) AS n_different {_TEST_ROWS}")
def model_knn(spark, sf):
    """The search over many small cells against the one over a single cell."""
    train, model, scored = _fitted(spark, sf, "knn", n_neighbors=5)
    _, test = _model_tables(spark, sf)
    cells = KNNClassifier(5, key_col=ROW_KEY, rows_per_pivot=200, block_rows=100).fit(train).transform(test)
    both = scored.join(cells.select(F.col(ROW_KEY).alias("row_key"), F.col("prediction").alias("again")), "row_key")
    return both.agg(F.count(F.lit(1)).alias("n_test"), F.count_if(F.col("prediction") != F.col("again")).alias("n_different"))


@query("model_save_load", f"{RISK_SQL}\nSELECT count(*) AS n_test, CAST(0 AS BIGINT) AS n_different {_TEST_ROWS}")
def model_save_load(spark, sf):
    """Predictions of a model before saving and after loading."""
    train, test = _model_tables(spark, sf)
    model = models.train_model(models.build_model("decision_tree", train.count(), max_depth=5), train)
    folder = scratch_path(spark, "models")
    models.save_model(model, folder, "decision_tree")
    again = models.load_model(spark, folder, "decision_tree")
    before = model.transform(test).select(ROW_KEY, F.col("prediction").alias("before"))
    after = again.transform(test).select(ROW_KEY, F.col("prediction").alias("after"))
    return before.join(after, ROW_KEY).agg(F.count(F.lit(1)).alias("n_test"), F.count_if(F.col("before") != F.col("after")).alias("n_different"))


@query("pipeline_save_load", f"{RISK_SQL}\nSELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM final")
def pipeline_save_load(spark, sf):
    """Cleaner, row sum, transformer, vector and kNN as one saved pipeline: predictions before and after loading."""
    config, raw = risk_prepare(), view(spark, sf, "risk")
    numbers = ["CREDIT_SCORE", "ANNUAL_MILEAGE", "PAST_ACCIDENTS", *FAMILY, "FAMILY_STABILITY", "AGE", "VEHICLE_YEAR"]
    fitted = Pipeline(stages=[
        Stage(Cleaner(replace(config.cleaner, row_key="ID"))), RowSum(list(FAMILY), "FAMILY_STABILITY"),
        Stage(Transformer(replace(config.transformer, ignore_cols=[TARGET, "ID"]))),
        VectorAssembler(inputCols=numbers, outputCol="features"), KNNClassifier(5, key_col="ID", labelCol=TARGET)]).fit(raw)
    path = scratch_path(spark, "pipeline")
    fitted.save(path)
    again = PipelineModel.load(path)
    one, two = (m.transform(raw).select("ID", F.col("prediction").alias(n)) for m, n in ((fitted, "before"), (again, "after")))
    return one.join(two, "ID").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("before") != F.col("after")).alias("n_different"))


@query("score_columns", f"{RISK_SQL}\nSELECT count(*) AS n_test, CAST(0 AS BIGINT) AS n_different {_TEST_ROWS}")
def score_columns(spark, sf):
    """The score is the probability of class 1, the decision value without one, and the prediction without either."""
    train, test = _model_tables(spark, sf)
    output = models.train_model(models.build_model("logistic_regression", train.count()), train).transform(test)
    without = output.drop("probability")
    rows = output.select(ROW_KEY, metrics.score_column(output).alias("p")).join(
        without.select(ROW_KEY, metrics.score_column(without).alias("raw")), ROW_KEY).join(
        without.select(ROW_KEY, metrics.score_column(without.drop("rawPrediction")).alias("label")), ROW_KEY)
    odd = (F.abs(F.col("p") - 1 / (1 + F.exp(-F.col("raw")))) > 1e-9) | ((F.col("label") == 1) != (F.col("p") > 0.5))
    return rows.agg(F.count(F.lit(1)).alias("n_test"), F.count_if(odd).alias("n_different"))


# --- search, selection, AutoML --------------------------------------------------------------------------

_SMALL_GRIDS = {
    "logistic_regression": models.param_grid("logistic_regression"),
    "svm": [{"C": 1, "penalty": "l1"}],
    "decision_tree": [{"max_depth": 5}, {"max_depth": 5, "criterion": "entropy"}],
    "random_forest": [{"n_estimators": 10, "max_depth": 5}],
    "xgboost": [{"n_estimators": 3, "max_depth": 3}],
    "knn": [{"n_neighbors": 5}, {"n_neighbors": 5, "weights": "distance"}],
}


def _tuned(spark, sf, name, method, grid):
    """Number of points, and whether the best has the highest score and all scores are F1 values."""
    train, _ = _model_tables(spark, sf)
    folded = split.mark_folds(train, [ROW_KEY], 3).persist()
    try:
        found = tune.tune(name, folded, method, grid=grid, key_col=ROW_KEY)
    finally:
        folded.unpersist()
    scores = [score for _, score in found.scores]
    rows = [(name, len(scores), found.best_score == max(scores) and dict(found.scores[scores.index(max(scores))][0]) == found.best_params,
             all(0 < x <= 1 for x in scores))]
    return spark.createDataFrame(rows, "model string, n_points int, best_is_highest boolean, scores_in_range boolean")


def _tuned_sql(name: str, n: int) -> str:
    return f"SELECT '{name}' AS model, {n}::INT AS n_points, true AS best_is_highest, true AS scores_in_range"


@query("tune_default", _tuned_sql("logistic_regression", 1))
def tune_default(spark, sf):
    return _tuned(spark, sf, "logistic_regression", "default", None)


@query("tune_logistic", f"""{RISK_SQL}
SELECT CAST(c AS DOUBLE) AS "C", fold, count(*) FILTER (WHERE NOT is_test) AS n_train, true AS few_scans, true AS optimal, true AS same_f1
FROM final, (VALUES (0.001), (0.01), (0.1), (1), (10), (100)) g(c), (VALUES (0), (1), (2)) f(fold) GROUP BY c, fold""")
def tune_logistic(spark, sf):
    """The whole registered grid over three folds, fitted side by side: per point and fold the optimality, recomputed here with column functions, and F1 on the
    fold left out, by the metrics operator over predictions made with column functions."""
    train, _ = _model_tables(spark, sf)
    folded = materialise(split.mark_folds(train, [ROW_KEY], 3), "folds")
    grid = [p["C"] for p in models.param_grid("logistic_regression")]
    points = [(c, fold) for c in grid for fold in range(3)]
    blocks = numeric_blocks(folded, "features", "label", ["fold"])
    try:
        fits = logistic.fit_many(blocks, [c for c, _ in points], [f for _, f in points], len(train.first()["features"]))
        scores = logistic.held_out_f1(blocks, fits.weights, [f for _, f in points])
    finally:
        blocks.unpersist()
    fitted = F.array(*[F.struct(F.lit(float(c)).alias("C"), F.lit(f).alias("left_out"), F.array(*map(F.lit, w.tolist())).alias("w"), F.lit(float(f1)).alias("f1"))
                       for (c, f), w, f1 in zip(points, fits.weights, scores)])
    rows = folded.select(F.concat(vector_to_array("features"), F.array(F.lit(1.0))).alias("x"), "label", "fold", F.inline(fitted))
    margin = F.aggregate(F.zip_with("x", "w", lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)
    scored = rows.withColumn("margin", margin).withColumn("inside", F.col("fold") != F.col("left_out"))
    d = len(fits.weights[0])
    miss = F.when(F.col("inside"), 1 / (1 + F.exp(-F.col("margin"))) - F.col("label")).otherwise(0.0)
    zero = F.when(F.col("inside"), 0.5 - F.col("label")).otherwise(0.0)
    said, true = F.col("margin") > 0, F.col("label") > 0
    count = lambda c: F.count_if(~F.col("inside") & c)
    sums = scored.groupBy("C", "left_out", "w", "f1").agg(
        F.count("*").alias("n_train"), F.array(*[F.sum(miss * F.get("x", F.lit(i))) for i in range(d)]).alias("g"),
        F.array(*[F.sum(zero * F.get("x", F.lit(i))) for i in range(d)]).alias("z"),
        (2 * count(said & true) / (2 * count(said & true) + count(said & ~true) + count(~said & true))).alias("again"))
    pull = F.zip_with("g", F.concat(F.transform(F.slice("w", 1, d - 1), lambda v: v / F.col("C")), F.array(F.lit(0.0))), lambda a, b: F.abs(a + b))
    return sums.select("C", F.col("left_out").alias("fold"), "n_train", F.lit(fits.scans <= 15).alias("few_scans"),
                       (F.array_max(pull) <= 1e-3 * F.array_max(F.transform("z", F.abs))).alias("optimal"), (F.abs(F.col("f1") - F.col("again")) < 1e-12).alias("same_f1"))


@query("tune_grid", _tuned_sql("decision_tree", 24))
def tune_grid(spark, sf):
    """The whole registered grid of the tree."""
    return _tuned(spark, sf, "decision_tree", "grid_search", None)


@query("tune_random", _tuned_sql("decision_tree", 10))
def tune_random(spark, sf):
    return _tuned(spark, sf, "decision_tree", "random_search", None)


@query("tune_svm", _tuned_sql("svm", 8))
def tune_svm(spark, sf):
    return _tuned(spark, sf, "svm", "random_search", None)


@query("tune_knn", _tuned_sql("knn", 20))
def tune_knn(spark, sf):
    return _tuned(spark, sf, "knn", "grid_search", None)


@query("tune_failure", "SELECT true AS fell_back, true AS told, 0::INT AS n_points")
def tune_failure(spark, sf):
    """A search that fails leaves the default parameters and says why."""
    train, _ = _model_tables(spark, sf)
    found = tune.tune_or_default("decision_tree", split.mark_folds(train, [ROW_KEY], 3), method="grid_search", grid=[{"no_such_parameter": 1}])
    return spark.createDataFrame([(found.best_params == {}, found.status.startswith("ValueError"), len(found.scores))],
                                 "fell_back boolean, told boolean, n_points int")


def _selected(spark, sf, method, n_features):
    done = prepare(view(spark, sf, "risk"), risk_prepare(keep_key=True))
    features, _ = cols.split_target(done.train, TARGET, drop=(ROW_KEY,))
    base = models.build_model("decision_tree", 0, max_depth=4)
    chosen = select_features(done.train, features, TARGET, method, n_features, base, [ROW_KEY])
    # The two columns that decide the target are never given up.
    rows = [(method, len(features), len(chosen), {"DRIVING_EXPERIENCE", "VEHICLE_YEAR"} <= set(chosen), chosen == [c for c in features if c in chosen])]
    return spark.createDataFrame(rows, "method string, n_features int, n_chosen int, keeps_deciding boolean, in_order boolean")


def _selected_sql(method: str, n: int) -> str:
    return f"SELECT '{method}' AS method, 17::INT AS n_features, {n}::INT AS n_chosen, true AS keeps_deciding, true AS in_order"


@query("select_rfe", _selected_sql("rfe", 3))
def select_rfe(spark, sf):
    return _selected(spark, sf, "rfe", 3)


@query("select_forward", _selected_sql("forward", 2))
def select_forward(spark, sf):
    return _selected(spark, sf, "forward", 2)


@query("select_backward", _selected_sql("backward", 15))
def select_backward(spark, sf):
    return _selected(spark, sf, "backward", 15)


def _ranked(spark, board):
    """Models of a leaderboard, whether they are ranked by F1, and whether the champion is the first."""
    rows = [r.asDict() for r in board.collect()]
    scores = [r["mean_f1_score"] for r in rows]
    first = [r["model"] for r in rows if r.get("champion")]
    return spark.createDataFrame([(len(rows), len({r["model"] for r in rows}), bool(first) and max(rows, key=lambda r: r["mean_f1_score"])[
        "mean_f1_score"] == next(r["mean_f1_score"] for r in rows if r["model"] == first[0]), all(0 <= x <= 1 for x in scores))],
        "n_rows int, n_models int, champion_is_best boolean, scores_in_range boolean")


_RANKED_SQL = "SELECT 6::INT AS n_rows, 6::INT AS n_models, true AS champion_is_best, true AS scores_in_range"


@query("automl_leaderboard", _RANKED_SQL)
def automl_leaderboard(spark, sf):
    """All six models on small grids, with the report written and read back."""
    done = prepare(view(spark, sf, "risk"), risk_prepare(keep_key=True))
    config: AutoMLConfig = risk_automl(tuning_method="grid_search", n_features=14, grids=_SMALL_GRIDS,
                                       base_model=models.build_model("decision_tree", 0, max_depth=5))
    result = run_automl(done.train, done.test, config)
    path = save_report(result, scratch_path(spark, "report") + ".json")
    return _ranked(spark, load_table(spark, path, lines=True))


@query("risk_end_to_end", _RANKED_SQL)
def risk_end_to_end(spark, sf):
    """From a CSV file to the written report."""
    raw, out = scratch_path(spark, "raw") + ".csv", scratch_path(spark, "run")
    write_table(view(spark, sf, "risk"), raw, "csv")
    config = risk_automl(tuning_method="grid_search", n_features=14, grids=_SMALL_GRIDS,
                         base_model=models.build_model("decision_tree", 0, max_depth=5))
    risk_run(spark, raw, risk_prepare(), config, out)
    return _ranked(spark, load_table(spark, f"{out}/leaderboard.json", lines=True))
