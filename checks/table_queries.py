"""Queries of sources, profiling, validation, column operators and splits."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators import columns, frequent, profile, quality, split
from tablewright.operators.prep import Preprocessor, fit_preprocessor
from tablewright.operators.stats import regression_metrics
from tablewright.session import materialize, shared_folder
from tablewright.sources import sinks, tables

from .base import (EVENTS_WITH_GAPS_SQL, ORACLES, PART_FEATURES_SQL, events_with_gaps, part_features, query,
                   read, rounded)

# --- sources and sinks ---------------------------------------------------------------------


@query("io_csv_roundtrip", "SELECT * FROM part")
def io_csv_roundtrip(spark, d):
    part = read(spark, d, "part")
    path = sinks.write_table(part, shared_folder(spark, "csv"), "csv")
    config = {"data_source": {"type": "csv", "raw_path": path, "delimiter": ",", "header": 0}}
    return tables.load_table(spark, config, schema=part.schema)


@query("io_csv_inferred", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def io_csv_inferred(spark, d):
    path = sinks.write_table(read(spark, d, "customer"), shared_folder(spark, "csv"), "csv")
    return tables.read_delimited(spark, path).withColumn("c_custkey", F.col("c_custkey").cast("long"))


@query("io_csv_missing_cells", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS o_custkey FROM orders""")
def io_csv_missing_cells(spark, d):
    orders = read(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, "NA").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(F.col("o_orderkey") % 3 == 0, "n/a").otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"))
    table = tables.read_delimited(spark, sinks.write_table(orders, shared_folder(spark, "csv"), "csv"))
    return table.withColumns({c: F.col(c).cast("long") for c in ("o_orderkey", "o_custkey")})


@query("io_csv_bad_fields", """
SELECT 'o_custkey' AS "column", count(*) AS n FROM orders WHERE o_orderkey % 7 = 0
UNION ALL SELECT 'o_totalprice', count(*) FROM orders WHERE o_orderkey % 2 = 0""")
def io_csv_bad_fields(spark, d):
    orders = read(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, "oops").otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(F.col("o_orderkey") % 2 == 0, "1,5").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"))
    path = sinks.write_table(orders, shared_folder(spark, "csv"), "csv")
    schema = T.StructType().add("o_orderkey", "long").add("o_custkey", "long").add("o_totalprice", "double")
    return tables.count_bad_fields(tables.read_delimited(spark, path, schema=schema, bad_fields="column"))


@query("io_dataset_versions", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def io_dataset_versions(spark, d):
    root = shared_folder(spark, "datasets")
    orders = read(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    sinks.publish(orders, root, "raw_data")
    sinks.publish(columns.where_equal(orders, "o_orderstatus", "F"), root, "raw_data")
    return sinks.read_dataset(spark, root, "raw_data:latest")


@query("io_parameter_store", """
WITH s AS (SELECT avg(o_totalprice) AS a, min(o_totalprice) AS lo, max(o_totalprice) AS hi,
                  avg(o_custkey) AS ca, min(o_custkey) AS clo, max(o_custkey) AS chi FROM orders)
SELECT CAST(0 AS INTEGER) AS position, 'o_totalprice' AS "column", 'fill' AS stat, round(a, 4) AS value FROM s
UNION ALL SELECT 0, 'o_totalprice', 'offset', lo FROM s
UNION ALL SELECT 0, 'o_totalprice', 'divisor', round(hi - lo, 4) FROM s
UNION ALL SELECT 1, 'o_custkey', 'fill', round(ca, 4) FROM s
UNION ALL SELECT 1, 'o_custkey', 'offset', CAST(clo AS DOUBLE) FROM s
UNION ALL SELECT 1, 'o_custkey', 'divisor', CAST(chi - clo AS DOUBLE) FROM s
""")
def io_parameter_store(spark, d):
    fitted = fit_preprocessor(read(spark, d, "orders"), ["o_totalprice", "o_custkey"])
    path = sinks.write_table(fitted.frame(spark).coalesce(1), shared_folder(spark, "params"))
    stored = Preprocessor.from_frame(spark.read.parquet(path))
    return rounded(stored.frame(spark), 4, "value")


@query("io_metrics_document", """
WITH m AS (SELECT l_quantity AS y, l_linenumber * 7.0 AS p FROM lineitem),
a AS (SELECT count(*) AS n, avg((y-p)*(y-p)) AS mse, avg(abs(y-p)) AS mae, var_pop(y) AS vy,
             100 * avg(abs((y-p)/y)) FILTER (y <> 0) AS mape FROM m),
r AS (SELECT *, 1 - mse / vy AS r2 FROM a)
SELECT round(mse, 6) AS mse, round(sqrt(mse), 6) AS rmse, round(mae, 6) AS mae, round(r2, 8) AS r2,
       round(1 - (1 - r2) * (n - 1) / (n - 2), 8) AS adj_r2, round(mape, 6) AS mape, n FROM r""")
def io_metrics_document(spark, d):
    scored = read(spark, d, "lineitem").withColumn("p", F.col("l_linenumber") * 7.0)
    metrics = regression_metrics(scored, "l_quantity", "p", 1)
    path = sinks.write_document(metrics, shared_folder(spark, "metrics"))
    stored = spark.read.schema(metrics.schema).json(path)
    return rounded(rounded(stored, 6, "mse", "rmse", "mae", "mape"), 8, "r2", "adj_r2")


# --- profiling -----------------------------------------------------------------------------


@query("profile_shape", """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(6 AS BIGINT) AS n_cols,
       'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS columns
FROM orders""")
def profile_shape(spark, d):
    return profile.shape(read(spark, d, "orders"))


@query("duplicate_rows", """
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates FROM (
  SELECT count(*) AS n FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 10 = 3)
  GROUP BY ALL)""".replace("SELECT count(*) AS n FROM", "SELECT COLUMNS(*), count(*) AS n FROM"))
def duplicate_rows(spark, d):
    events = read(spark, d, "events")
    return profile.duplicate_rows(events.union(events.where("event_id % 10 = 3")))


@query("head_n", """
SELECT event_id, user_id, event_type, value FROM events ORDER BY event_id LIMIT 100""")
def head_n(spark, d):
    events = read(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    return profile.head(events, "event_id", 100)


@query("hash_sample", """
SELECT event_id, event_type, value FROM events
ORDER BY md5('42:' || event_id), event_id LIMIT 6""")
def hash_sample(spark, d):
    return profile.random_rows(read(spark, d, "events").select("event_id", "event_type", "value"),
                               "event_id", 6)


def _summary_sql(table: str, numeric: list[str], texts: list[str], dates: list[str]) -> str:
    parts = [f"""
SELECT '{c}' AS "column", count({c}) AS count, CAST(NULL AS BIGINT) AS "unique",
       CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq,
       round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
       CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS q25,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS q50,
       round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS q75, CAST(max({c}) AS DOUBLE) AS max,
       CAST(NULL AS VARCHAR) AS earliest, CAST(NULL AS VARCHAR) AS latest
FROM {table}""" for c in numeric]
    parts += [f"""
SELECT '{c}', sum(n)::BIGINT, count(*)::BIGINT, CAST(arg_min({c}, (-n, CAST({c} AS VARCHAR))) AS VARCHAR), max(n)::BIGINT,
       NULL, NULL, NULL, NULL, NULL, NULL, NULL, {f'CAST(min({c}) AS VARCHAR), CAST(max({c}) AS VARCHAR)' if c in dates else 'NULL, NULL'}
FROM (SELECT {c}, count(*) AS n FROM {table} WHERE {c} IS NOT NULL GROUP BY {c})""" for c in texts + dates]
    return "\nUNION ALL".join(parts)


@query("profile_summary", _summary_sql(
    "orders", ["o_orderkey", "o_custkey", "o_totalprice"], ["o_orderstatus", "o_orderpriority"], ["o_orderdate"]))
def profile_summary(spark, d):
    return rounded(profile.summary(read(spark, d, "orders")), 4, "mean", "std", "q25", "q50", "q75")


@query("profile_summary_lineitem", _summary_sql(
    "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"],
    ["l_returnflag", "l_linestatus"], ["l_shipdate"]))
def profile_summary_lineitem(spark, d):
    return rounded(profile.summary(read(spark, d, "lineitem")), 4, "mean", "std", "q25", "q50", "q75")


@query("profile_nulls", f"""
WITH {EVENTS_WITH_GAPS_SQL}
SELECT name AS "column", n_null, n_rows, round(100.0 * n_null / n_rows, 6) AS null_pct FROM (
""" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS name, count(*) FILTER ({c} IS NULL) AS n_null, count(*) AS n_rows FROM eg"
    for c in ("event_id", "user_id", "event_type", "k", "value", "score", "grade")) + ")")
def profile_nulls(spark, d):
    return rounded(profile.null_audit(events_with_gaps(spark, d)), 6, "null_pct")


@query("schema_listing", f"""
WITH {EVENTS_WITH_GAPS_SQL}
""" + "\nUNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null FROM eg"
    for i, (c, t) in enumerate((("event_id", "bigint"), ("user_id", "bigint"), ("event_type", "string"),
                                ("k", "int"), ("value", "double"), ("score", "double"),
                                ("grade", "double")))))
def schema_listing(spark, d):
    return profile.schema_listing(events_with_gaps(spark, d))


@query("drop_null_rows", f"""
WITH {EVENTS_WITH_GAPS_SQL}
SELECT * FROM eg WHERE score IS NOT NULL AND grade IS NOT NULL AND k IS NOT NULL""")
def drop_null_rows(spark, d):
    return columns.drop_null_rows(events_with_gaps(spark, d))


@query("histogram_20", "\nUNION ALL ".join(f"""
SELECT '{c}' AS "column", CAST(g.bin AS INTEGER) AS bin,
       round(lo + (hi - lo) / 20 * (g.bin - 1), 4) AS lower,
       round(CASE WHEN g.bin < 20 THEN lo + (hi - lo) / 20 * g.bin ELSE hi END, 4) AS upper,
       count(x) AS count
FROM (SELECT min({c}) AS lo, max({c}) AS hi FROM {t}) s
CROSS JOIN range(1, 21) g(bin)
LEFT JOIN (SELECT {c} AS x, least(floor(({c} - lo2) / ((hi2 - lo2) / 20)) + 1, 20) AS b
           FROM {t}, (SELECT min({c}) AS lo2, max({c}) AS hi2 FROM {t})) v ON v.b = g.bin
GROUP BY g.bin, lo, hi""" for c, t in (("l_extendedprice", "lineitem"), ("l_quantity", "lineitem"))))
def histogram_20(spark, d):
    table = profile.histogram(read(spark, d, "lineitem"), ["l_extendedprice", "l_quantity"])
    return rounded(table, 4, "lower", "upper")


_PF_NUMERIC = ("p_size", "p_retailprice", "qty", "n_lines", "disc", "tax", "price", "revenue")


def _corr_sql(select: str) -> str:
    pairs = "\nUNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM pf"
                                for a in _PF_NUMERIC for b in _PF_NUMERIC)
    return f"WITH {PART_FEATURES_SQL}, c AS ({pairs}) {select} FROM c"


@query("corr_matrix", _corr_sql("SELECT a, b, round(r, 6) AS r"))
def corr_matrix(spark, d):
    return rounded(profile.correlations(materialize(part_features(spark, d)), _PF_NUMERIC), 6, "r")


@query("corr_high", _corr_sql("SELECT a, b, CASE WHEN abs(r) > 0.35 THEN round(r, 6) END AS r"))
def corr_high(spark, d):
    pairs = profile.correlations(materialize(part_features(spark, d)), _PF_NUMERIC)
    return rounded(profile.strong_correlations(pairs), 6, "r")


_GAPPED = ("value", "score", "grade", "k")


@query("corr_pairwise_gaps", f"WITH {EVENTS_WITH_GAPS_SQL}" + "\nUNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM eg" for a in _GAPPED for b in _GAPPED))
def corr_pairwise_gaps(spark, d):
    return rounded(profile.correlations(events_with_gaps(spark, d), _GAPPED), 6, "r")


def _bracketed_names(spark, d):
    """Part names written the way multi-label text arrives: ``['red'; 'ring']``."""
    words = F.replace(F.col("p_name"), F.lit(" "), F.lit("'; '"))
    return read(spark, d, "part").withColumn("labels", F.concat(F.lit("['"), words, F.lit("']")))


@query("label_explode", """
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS label FROM part""")
def label_explode(spark, d):
    return profile.explode_labels(_bracketed_names(spark, d), "labels").select("p_partkey", "label")


@query("label_top20", """
SELECT label, count(*) AS count FROM (SELECT unnest(string_split(p_name, ' ')) AS label FROM part)
GROUP BY label ORDER BY count DESC, label LIMIT 20""")
def label_top20(spark, d):
    return profile.top_labels(_bracketed_names(spark, d), "labels", 20)


# --- validation ----------------------------------------------------------------------------

_EXPECTED = [
    quality.Expectation("event_id", "int", min=0),
    quality.Expectation("event_type", "str"),
    quality.Expectation("k", "int", min=5, max=90),
    quality.Expectation("value", "float", min=1.0, max=150.0),
    quality.Expectation("score", "float", required=False, max=100.0),
    quality.Expectation("grade", "int"),
    quality.Expectation("absent", "str"),
    quality.Expectation("absent_too", "str", required=False),
]

_REPORT_SQL = f"""
WITH {EVENTS_WITH_GAPS_SQL}, c AS (
  SELECT count(*) FILTER (k < 5) AS k_lo, count(*) FILTER (k > 90) AS k_hi,
         count(*) FILTER (k IS NULL) AS k_miss,
         count(*) FILTER (value < 1.0) AS v_lo, count(*) FILTER (value > 150.0) AS v_hi,
         count(*) FILTER (score > 100.0) AS s_hi, count(*) FILTER (score IS NULL) AS s_miss FROM eg)
SELECT * FROM (
  SELECT 'event_id' AS "column", 'present' AS status, CAST(NULL AS VARCHAR) AS dtype,
         CAST(NULL AS VARCHAR) AS dtype_expected, CAST(NULL AS BIGINT) AS missing_count,
         CAST(NULL AS BIGINT) AS rows_dropped, CAST(NULL AS BIGINT) AS below_min,
         CAST(NULL AS BIGINT) AS above_max, CAST(NULL AS VARCHAR) AS error
  UNION ALL SELECT 'event_type', 'present', NULL, NULL, NULL, NULL, NULL, NULL, NULL
  UNION ALL SELECT 'k', 'present', NULL, NULL, nullif(k_miss, 0), nullif(k_miss, 0),
                   nullif(k_lo, 0), nullif(k_hi, 0), NULL FROM c
  UNION ALL SELECT 'value', 'present', NULL, NULL, NULL, NULL, nullif(v_lo, 0), nullif(v_hi, 0), NULL FROM c
  UNION ALL SELECT 'score', 'present', NULL, NULL, nullif(s_miss, 0), nullif(s_miss, 0), NULL,
                   nullif(s_hi, 0), NULL FROM c
  UNION ALL SELECT 'grade', 'present', 'double', 'int', NULL, NULL, NULL, NULL,
                   'Column ''grade'' has dtype ''double'', expected ''int'''
  UNION ALL SELECT 'absent', 'missing', NULL, NULL, NULL, NULL, NULL, NULL, 'Missing required column: absent'
  UNION ALL SELECT 'absent_too', 'not present (optional)', NULL, NULL, NULL, NULL, NULL, NULL, NULL)
"""


@query("validate_report", _REPORT_SQL)
def validate_report(spark, d):
    return quality.validate(events_with_gaps(spark, d), _EXPECTED).table(spark)


@query("validate_report_document", _REPORT_SQL)
def validate_report_document(spark, d):
    document = quality.validate(events_with_gaps(spark, d), _EXPECTED).document(spark)
    path = sinks.write_document(document, shared_folder(spark, "report"))
    stored = spark.read.schema(document.schema).json(path)
    return (stored.select(F.explode("details").alias("column", "detail"))
            .select("column", *[F.col("detail")[k].alias(k) for k in quality.DETAIL_COLUMNS]))


@query("validate_messages", f"""
WITH {EVENTS_WITH_GAPS_SQL}
SELECT 'error' AS level, 'Column ''value'' has ' || count(*) || ' values below min (1.0)' AS message
FROM eg WHERE value < 1.0
UNION ALL SELECT 'error', 'Column ''value'' has ' || count(*) || ' values above max (150.0)' FROM eg WHERE value > 150.0
UNION ALL SELECT 'warning', 'Column ''score'' had ' || count(*) || ' missing values (optional); rows dropped.'
FROM eg WHERE score IS NULL
UNION ALL SELECT 'error', 'Missing required column: absent'""")
def validate_messages(spark, d):
    chosen = [e for e in _EXPECTED if e.name in ("value", "absent")]
    chosen.append(quality.Expectation("score", "float", required=False))
    document = quality.validate(events_with_gaps(spark, d), chosen).document(spark)
    return document.select(F.explode(F.concat(
        F.transform("errors", lambda m: F.struct(F.lit("error").alias("level"), m.alias("message"))),
        F.transform("warnings", lambda m: F.struct(F.lit("warning").alias("level"), m.alias("message"))))
    ).alias("e")).select("e.level", "e.message")


@query("quality_rules", f"""
WITH {EVENTS_WITH_GAPS_SQL}
""" + "\nUNION ALL ".join(f"""
SELECT 'max_null_percentage' AS rule, '{c}' AS "column",
       round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 6) AS value,
       CAST(8.0 AS DOUBLE) AS threshold,
       100.0 * count(*) FILTER ({c} IS NULL) / count(*) <= 8.0 AS passed FROM eg"""
    for c in ("event_id", "user_id", "event_type", "k", "value", "score", "grade")) + """
UNION ALL SELECT 'min_rows', NULL, CAST(count(*) AS DOUBLE), CAST(5000 AS DOUBLE), count(*) >= 5000 FROM eg""")
def quality_rules(spark, d):
    table = quality.rule_report(events_with_gaps(spark, d), max_null_percentage=8.0, min_rows=5000)
    return rounded(table, 6, "value")


_LINE_RULES = (
    quality.RecordRule("l_orderkey"),
    quality.RecordRule("l_quantity", 2.0, 49.0),
    quality.RecordRule("l_discount", 0.0, low_open=True),
    quality.RecordRule("l_tax", 0.0, 0.07),
    quality.RecordRule("l_extendedprice", high=100000.0),
)
_LINE_COLUMNS = "l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax"
_LINE_VIOLATIONS = """
  concat_ws(',', CASE WHEN l_orderkey IS NULL THEN 'l_orderkey' END,
    CASE WHEN l_quantity < 2.0 OR l_quantity > 49.0 THEN 'l_quantity' END,
    CASE WHEN l_discount <= 0.0 THEN 'l_discount' END,
    CASE WHEN l_tax < 0.0 OR l_tax > CAST(0.07 AS DOUBLE) THEN 'l_tax' END,
    CASE WHEN l_extendedprice > 100000.0 THEN 'l_extendedprice' END)"""


def _lines(spark, d):
    table = read(spark, d, "lineitem").select(*_LINE_COLUMNS.split(", "))
    return table.withColumns({c: F.col(c) + 0.0 for c in ("l_discount", "l_tax")})


_LINES_SQL = f"""
WITH li AS (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice,
                   l_discount + 0.0 AS l_discount, l_tax + 0.0 AS l_tax FROM lineitem),
checked AS (SELECT *, {_LINE_VIOLATIONS} AS violations FROM li)
"""


@query("records_valid", _LINES_SQL + f"SELECT {_LINE_COLUMNS} FROM checked WHERE violations = ''")
def records_valid(spark, d):
    return quality.split_records(_lines(spark, d), _LINE_RULES)[0]


@query("records_quarantine", _LINES_SQL + f"SELECT {_LINE_COLUMNS}, violations FROM checked WHERE violations <> ''")
def records_quarantine(spark, d):
    rejected = quality.split_records(_lines(spark, d), _LINE_RULES)[1]
    return rejected.withColumn("violations", F.array_join("violations", ","))


# --- projections, filters, column algebra --------------------------------------------------


@query("drop_columns", "SELECT p_partkey, p_name, p_type, p_size FROM part")
def drop_columns(spark, d):
    return columns.drop_columns(read(spark, d, "part"), ["p_brand", "not_there", "p_retailprice"])


@query("numeric_select", "SELECT p_partkey, p_size FROM part")
def numeric_select(spark, d):
    return columns.select_numeric(read(spark, d, "part"), keep=["p_partkey"], profiling=["p_retailprice"])


@query("eq_filter", "SELECT * FROM part WHERE p_name = 'red ring'")
def eq_filter(spark, d):
    return columns.where_equal(read(spark, d, "part"), "p_name", "red ring")


@query("rename_prefix", "SELECT p_partkey AS partkey, p_name AS name, p_brand AS brand, p_type AS type, "
                        "p_size AS size, p_retailprice AS retailprice FROM part")
def rename_prefix(spark, d):
    return columns.strip_prefixes(read(spark, d, "part"), ["p_", "remainder__"])


@query("rename_predictions", "SELECT o_orderkey, o_totalprice AS prediction FROM orders")
def rename_predictions(spark, d):
    orders = read(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return columns.rename_columns(orders, {"o_totalprice": "prediction", "obs_ci_lower": "lower"})


@query("project_double", "SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part")
def project_double(spark, d):
    return columns.project_as_double(read(spark, d, "part"), ["p_retailprice", "p_size"], keep=["p_partkey"])


@query("fill_missing_columns", "SELECT p_partkey, p_size, CAST(0.0 AS DOUBLE) AS energy, CAST(0.0 AS DOUBLE) AS tempo FROM part")
def fill_missing_columns(spark, d):
    table = read(spark, d, "part").select("p_partkey", "p_size")
    return columns.fill_missing_columns(table, ["energy", "p_size", "tempo"])


@query("concat_columns", "SELECT p_partkey, p_size, p_size * 2 AS doubled FROM part")
def concat_columns(spark, d):
    table = read(spark, d, "part").select("p_partkey", "p_size")
    return columns.add_columns(table, {"p_size": F.lit(-1), "doubled": F.col("p_size") * 2})


@query("intercept_column", "SELECT CAST(1.0 AS DOUBLE) AS const, p_partkey, p_size FROM part")
def intercept_column(spark, d):
    return columns.add_intercept(read(spark, d, "part").select("p_partkey", "p_size"))


@query("transpose", """
SELECT p_partkey, 'p_name' AS "column", p_name AS value FROM part
UNION ALL SELECT p_partkey, 'p_brand', p_brand FROM part
UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part""")
def transpose(spark, d):
    return columns.transpose(read(spark, d, "part"), ["p_partkey"], ["p_name", "p_brand", "p_size"])


# --- splits and alignment ------------------------------------------------------------------


@query("split_threshold", """
SELECT event_id, event_type, value FROM events
WHERE substr(md5('42:' || event_id), 1, 8) < '19999999'""")
def split_threshold(spark, d):
    events = read(spark, d, "events").select("event_id", "event_type", "value")
    return split.split_by_threshold(events, "event_id", 0.1)[1]


def _exact_sql(keep: str, seed: int, size: str, columns_: str, table: str, key: str, with_: str = "") -> str:
    return f"""
WITH {with_ + ', ' if with_ else ''} ranked AS (
  SELECT {columns_}, row_number() OVER (ORDER BY md5('{seed}:' || {key})) AS rn,
         count(*) OVER () AS n FROM {table})
SELECT {columns_} FROM ranked WHERE rn {keep} ceil(n * {size})"""


@query("split_holdout", _exact_sql("<=", 42, "0.1", "event_id, event_type, value", "events", "event_id"))
def split_holdout(spark, d):
    events = read(spark, d, "events").select("event_id", "event_type", "value")
    return split.holdout(events, "event_id", 0.1)[1]


@query("split_train", _exact_sql(">", 85, "0.2", "p_partkey, qty, n_lines", "pf", "p_partkey", PART_FEATURES_SQL))
def split_train(spark, d):
    features = part_features(spark, d).select("p_partkey", "qty", "n_lines")
    return split.train_test(features, "p_partkey", 0.2)[0]


@query("split_test", _exact_sql("<=", 85, "0.2", "p_partkey, qty, n_lines", "pf", "p_partkey", PART_FEATURES_SQL))
def split_test(spark, d):
    features = part_features(spark, d).select("p_partkey", "qty", "n_lines")
    return split.train_test(features, "p_partkey", 0.2)[1]


@query("align_inner", f"""
WITH {PART_FEATURES_SQL}
SELECT pf.p_partkey, pf.qty, p.p_size FROM pf JOIN part p USING (p_partkey) WHERE p.p_size > 10""")
def align_inner(spark, d):
    features = part_features(spark, d).select("p_partkey", "qty")
    target = read(spark, d, "part").filter("p_size > 10").select("p_partkey", "p_size")
    return columns.align_inner(features, target, "p_partkey")


@query("align_unmatched", """
SELECT c_custkey, c_mktsegment FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')""")
def align_unmatched(spark, d):
    customers = read(spark, d, "customer").select("c_custkey", "c_mktsegment")
    orders = (read(spark, d, "orders").filter("o_orderstatus = 'F'")
              .select(F.col("o_custkey").alias("c_custkey")))
    return columns.unmatched(customers, orders, "c_custkey")


@query("score_left", f"""
WITH {PART_FEATURES_SQL}
SELECT p.p_partkey, p.p_brand, x.qty * CAST(0.5 AS DOUBLE) AS prediction FROM part p
LEFT JOIN (SELECT * FROM pf WHERE n_lines > 30) x USING (p_partkey)""")
def score_left(spark, d):
    predictions = (part_features(spark, d).filter("n_lines > 30")
                   .select("p_partkey", (F.col("qty") * 0.5).alias("prediction")))
    return columns.attach_left(read(spark, d, "part").select("p_partkey", "p_brand"), predictions, "p_partkey")


# --- frequent values, allowed values, exact splits, schema checks ----------------------------


def _top_sql(table: str, name: str, n: int) -> str:
    return f"""SELECT * FROM (SELECT '{name}' AS "column", CAST({name} AS VARCHAR) AS value, count(*) AS freq FROM {table}
      WHERE {name} IS NOT NULL GROUP BY {name} ORDER BY freq DESC, value LIMIT {n})"""


@query("frequent_values", " UNION ALL ".join(_top_sql("documents", c, 2) for c in ("text", "source", "lang")))
def frequent_values(spark, d):
    """The two most frequent texts, sources and languages; texts are told apart without grouping them all where one is frequent."""
    return frequent.frequent_values(read(spark, d, "documents"), ["text", "source", "lang"], 2)


@query("label_top20_summary", ORACLES["label_top20"])
def label_top20_summary(spark, d):
    return profile.top_labels(_bracketed_names(spark, d), "labels", 20, few=False)


_ALLOWED_REPORT_SQL = """
WITH c AS (SELECT count(*) FILTER (o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) AS p, count(*) FILTER (o_custkey NOT IN (
             SELECT c_custkey FROM customer WHERE c_nationkey < 20)) AS k FROM orders)
SELECT 'o_orderpriority' AS "column", 'present' AS status, nullif(p, 0) AS not_allowed,
       'Column ''o_orderpriority'' has ' || p || ' values that are not allowed' AS message FROM c
UNION ALL SELECT 'o_custkey', 'present', nullif(k, 0), 'Column ''o_custkey'' has ' || k || ' values that are not allowed' FROM c"""


@query("validate_allowed", _ALLOWED_REPORT_SQL)
def validate_allowed(spark, d):
    """Allowed values as a list, and as a table."""
    customers = read(spark, d, "customer").where("c_nationkey < 20").select("c_custkey")
    report = quality.validate(read(spark, d, "orders"), [
        quality.Expectation("o_orderpriority", "str", allowed=["1-URGENT", "2-HIGH"]), quality.Expectation("o_custkey", "int", allowed=customers)])
    messages = spark.createDataFrame([(m.split("'")[1], m) for m in report.errors], "column string, message string")
    return report.table(spark).select("column", "status", "not_allowed").join(messages, "column")


@query("validate_cases", """
SELECT 'no columns' AS "case", 'pass' AS result, CAST(0 AS BIGINT) AS n_columns, CAST(0 AS BIGINT) AS n_errors
UNION ALL SELECT 'stops', 'Data validation failed: Column ''o_totalprice'' has ' || count(*) || ' values above max (100000)', 1, 1
FROM orders WHERE o_totalprice > 100000
UNION ALL SELECT 'goes on', 'fail', 1, 1""")
def validate_cases(spark, d):
    """Disabled (no row), without columns, stopping and going on at an error."""
    orders, rows = read(spark, d, "orders"), []
    strict = {"schema": {"columns": [{"name": "o_totalprice", "max": 100000}]}}
    for case, section in (("disabled", {**strict, "enabled": False}), ("no columns", {}), ("stops", strict), ("goes on", strict)):
        report = quality.validate_config(orders, {"data_validation": section})
        if report is None:
            continue
        result = report.result
        try:
            quality.enforce(report, "raise" if case == "stops" else "warn")
        except ValueError as error:
            result = str(error)
        rows.append((case, result, len(report.details), len(report.errors)))
    return spark.createDataFrame(rows, "case string, result string, n_columns long, n_errors long")


@query("split_repeated_key", """
WITH k AS (SELECT event_type, count(*) AS n, md5('42:' || event_type) AS h FROM events GROUP BY event_type),
w AS (SELECT *, CAST(ceil(sum(n) OVER () * CAST('0.37' AS DECIMAL(3, 2))) AS BIGINT) AS wanted, CAST(sum(n) OVER (ORDER BY h) AS BIGINT) - n AS earlier FROM k)
SELECT event_type, greatest(0, least(n, wanted - earlier)) AS n_part, n - greatest(0, least(n, wanted - earlier)) AS n_rest FROM w""")
def split_repeated_key(spark, d):
    """A split of exact size by a key that a few values make up."""
    rest, part = split.split_rows(read(spark, d, "events"), "event_type", 0.37)
    both = part.select("event_type", F.lit(1).alias("p"), F.lit(0).alias("r")).union(rest.select("event_type", F.lit(0), F.lit(1)))
    return both.groupBy("event_type").agg(F.sum("p").alias("n_part"), F.sum("r").alias("n_rest"))


_REQUIRED = ("p_partkey", "p_size", "tempo", "p_name", "energy")
_REQUIRED_SQL = "SELECT name AS feature FROM (VALUES " + ", ".join(f"('{c}')" for c in _REQUIRED) + """) t(name)
WHERE name NOT IN (SELECT column_name FROM (DESCRIBE part))"""


@query("missing_features", _REQUIRED_SQL)
def missing_features(spark, d):
    """Required features that a table lacks; asking for them stops."""
    part = read(spark, d, "part")
    try:
        columns.require_columns(part, _REQUIRED)
    except ValueError:
        return spark.createDataFrame([(c,) for c in columns.missing_columns(part, _REQUIRED)], "feature string")
    return spark.createDataFrame([], "feature string")


@query("stored_schema_check", """
SELECT 'Selected features missing from the stored feature table: [' || string_agg(chr(39) || name || chr(39), ', ' ORDER BY place) || ']' AS message
FROM (SELECT name, row_number() OVER () AS place FROM (VALUES """ + ", ".join(f"('{c}')" for c in _REQUIRED) + """) t(name))
WHERE name NOT IN (SELECT column_name FROM (DESCRIBE part))""")
def stored_schema_check(spark, d):
    """The stored feature table's footer against the features a model selected."""
    path = sinks.write_table(read(spark, d, "part"), shared_folder(spark, "features"))
    try:
        sinks.require_columns_stored(spark, path, _REQUIRED)
    except ValueError as error:
        return spark.createDataFrame([(str(error),)], "message string")
    return spark.createDataFrame([], "message string")
