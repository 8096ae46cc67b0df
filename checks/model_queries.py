"""Queries of outlier filters, transforms, features, statistics, models, clusters."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tablewright.functions.labels import EXPLORATION_PATTERNS, GENRE_PATTERNS
from tablewright.operators import clustering, features, prep, regression, scoring, stats
from tablewright.session import materialize

from .base import (CENTROIDS, CLUSTERED_SQL, EVENTS_WITH_GAPS_SQL, FIXED_FEATURES,
                   PART_FEATURES_SQL, PART_PATTERNS, PLANTED_FEATURES_SQL, events_with_gaps,
                   f_upper_sql, fixed_model, fixed_prediction_sql, fixed_preprocessor, part_features,
                   planted_features, query, read, rounded, t_quantile_sql, t_two_sided_sql)

# --- outlier filter ------------------------------------------------------------------------


def _iqr_step(name: str, source: str, column: str, k: str) -> str:
    return f"""
{name}_q AS (SELECT quantile_cont(CAST({column} AS DOUBLE), 0.25) AS q1,
                    quantile_cont(CAST({column} AS DOUBLE), 0.75) AS q3 FROM {source}),
{name} AS (SELECT s.* FROM {source} s, {name}_q
           WHERE {column} BETWEEN q1 - {k} * (q3 - q1) AND q3 + {k} * (q3 - q1))"""


@query("iqr_filter", f"""
WITH {EVENTS_WITH_GAPS_SQL}, {_iqr_step('a', 'eg', 'score', 'CAST(1.5 AS DOUBLE)')}
SELECT event_id, score FROM a""")
def iqr_filter(spark, d):
    return prep.filter_outliers(events_with_gaps(spark, d), ["score"]).select("event_id", "score")


@query("iqr_filter_sequence", f"""
WITH {PART_FEATURES_SQL}, {_iqr_step('a', 'pf', 'price', 'CAST(0.8 AS DOUBLE)')},
{_iqr_step('b', 'a', 'revenue', 'CAST(0.8 AS DOUBLE)')},
{_iqr_step('c', 'b', 'n_lines', 'CAST(0.8 AS DOUBLE)')}
SELECT p_partkey, n_lines FROM c""")
def iqr_filter_sequence(spark, d):
    kept = prep.filter_outliers(materialize(part_features(spark, d)),
                                ["price", "p_name", "revenue", "nowhere", "n_lines"], 0.8)
    return kept.select("p_partkey", "n_lines")


@query("iqr_filter_wide", f"""
WITH {EVENTS_WITH_GAPS_SQL}, {_iqr_step('a', 'eg', 'value', 'CAST(3 AS DOUBLE)')}
SELECT event_id, value FROM a""")
def iqr_filter_wide(spark, d):
    kept = prep.filter_outliers(events_with_gaps(spark, d), ["value"], 3.0, skip_zero_iqr=False)
    return kept.select("event_id", "value")


# --- imputation and scaling ----------------------------------------------------------------


def _impute(fill: str) -> str:
    return f"""
WITH {EVENTS_WITH_GAPS_SQL}
SELECT event_id, round(coalesce(score, (SELECT {fill.format('score')} FROM eg)), 6) AS score,
       round(coalesce(grade, (SELECT {fill.format('grade')} FROM eg)), 6) AS grade FROM eg"""


def _imputed(spark, d, strategy, **options):
    table = events_with_gaps(spark, d)
    fitted = prep.fit_imputer(table, ["score", "grade"], strategy, **options)
    return rounded(prep.apply_stored(table, fitted).select("event_id", "score", "grade"), 6,
                   "score", "grade")


@query("impute_mean", _impute("avg({0})"))
def impute_mean(spark, d):
    return _imputed(spark, d, "mean")


@query("impute_median", _impute("quantile_cont({0}, 0.5)"))
def impute_median(spark, d):
    return _imputed(spark, d, "median")


@query("impute_mode", f"""
WITH {EVENTS_WITH_GAPS_SQL},
s AS (SELECT score AS v, count(*) AS n FROM eg WHERE score IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 1),
g AS (SELECT grade AS v, count(*) AS n FROM eg WHERE grade IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 1)
SELECT event_id, round(coalesce(score, (SELECT v FROM s)), 6) AS score,
       round(coalesce(grade, (SELECT v FROM g)), 6) AS grade FROM eg""")
def impute_mode(spark, d):
    return _imputed(spark, d, "most_frequent")


@query("impute_constant", _impute("min(CAST(-1.0 AS DOUBLE))"))
def impute_constant(spark, d):
    return _imputed(spark, d, "constant", fill_value=-1.0)


def _orders(spark, d):
    return read(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey")


@query("scale_minmax", """
WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi,
                  min(o_custkey) AS clo, max(o_custkey) AS chi FROM orders)
SELECT round((o_totalprice - lo) / (hi - lo), 8) AS o_totalprice,
       round((o_custkey - clo) / CAST(chi - clo AS DOUBLE), 8) AS o_custkey, o_orderkey, o_orderstatus
FROM orders, s""")
def scale_minmax(spark, d):
    table = _orders(spark, d)
    fitted = prep.fit_preprocessor(table, ["o_totalprice", "o_custkey"], method="minmax")
    return rounded(prep.transform(table, fitted), 8, "o_totalprice", "o_custkey")


@query("scale_standard", """
WITH s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders)
SELECT round((o_totalprice - m) / s, 6) + 0.0 AS o_totalprice, o_orderkey, o_orderstatus, o_custkey
FROM orders, s""")
def scale_standard(spark, d):
    table = _orders(spark, d)
    fitted = prep.fit_preprocessor(table, ["o_totalprice"], method="standard")
    return rounded(prep.transform(table, fitted), 6, "o_totalprice")


@query("scale_with_gaps", f"""
WITH {EVENTS_WITH_GAPS_SQL},
m AS (SELECT quantile_cont(score, 0.5) AS med FROM eg),
f AS (SELECT event_id, coalesce(score, med) AS x FROM eg, m),
s AS (SELECT avg(x) AS mu, stddev_pop(x) AS sd FROM f)
SELECT event_id, round((x - mu) / sd, 6) + 0.0 AS score FROM f, s""")
def scale_with_gaps(spark, d):
    table = events_with_gaps(spark, d).select("event_id", "score")
    fitted = prep.fit_preprocessor(table, ["score"], strategy="median", method="standard")
    return rounded(prep.transform(table, fitted), 6, "score")


@query("scale_constant_column", "SELECT o_orderkey, CAST(0.0 AS DOUBLE) AS same FROM orders")
def scale_constant_column(spark, d):
    table = read(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") * 0 + 7).alias("same"))
    return prep.transform(table, prep.fit_preprocessor(table, ["same"]))


@query("scale_unsupported", f"""
WITH {EVENTS_WITH_GAPS_SQL}
SELECT event_id, round(coalesce(score, (SELECT avg(score) FROM eg)), 6) AS score FROM eg""")
def scale_unsupported(spark, d):
    table = events_with_gaps(spark, d).select("event_id", "score")
    return rounded(prep.transform(table, prep.fit_preprocessor(table, ["score"], method="robust")),
                   6, "score")


@query("scale_apply_new", """
WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, avg(o_totalprice) AS mu
           FROM orders WHERE o_orderstatus = 'F')
SELECT o_orderkey, o_orderstatus,
       round((coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END, mu) - lo) / (hi - lo), 8)
         AS o_totalprice
FROM orders, s WHERE o_orderstatus <> 'F'""")
def scale_apply_new(spark, d):
    table = _orders(spark, d).drop("o_custkey")
    fitted = prep.fit_preprocessor(table.filter("o_orderstatus = 'F'"), ["o_totalprice"])
    stored = prep.Preprocessor.from_frame(fitted.frame(spark))
    fresh = table.filter("o_orderstatus <> 'F'").withColumn(
        "o_totalprice", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")))
    return rounded(prep.apply_stored(fresh, stored), 8, "o_totalprice")


# --- feature engineering -------------------------------------------------------------------


def _flag_sql(text: str, patterns: dict[str, str], prefix: str) -> str:
    return ", ".join(
        f"CAST(coalesce(regexp_matches({text}, '(?i){p}'), false) AS INTEGER) AS "
        f"{prefix}{k.replace('&', 'and').replace('-', '_')}" for k, p in patterns.items())


@query("label_flags", f"SELECT p_partkey, {_flag_sql('p_name', PART_PATTERNS, 'genre_')} FROM part")
def label_flags(spark, d):
    table = read(spark, d, "part").select("p_partkey", "p_name")
    return features.add_label_flags(table, "p_name", PART_PATTERNS).drop("p_name")


_TEXT_LABELS = {"alpha": "the|and", "beta": "ou[ae]", "r&b": "ren|que", "hip-hop": "tion|ung "}


@query("label_flags_documents", f"SELECT doc_id, {_flag_sql('text', _TEXT_LABELS, 'genre_')} FROM documents")
def label_flags_documents(spark, d):
    table = read(spark, d, "documents").select("doc_id", "text")
    return features.add_label_flags(table, "text", _TEXT_LABELS).drop("text")


@query("label_flags_plain_names", f"SELECT p_partkey, {_flag_sql('p_name', PART_PATTERNS, 'is_')} FROM part")
def label_flags_plain_names(spark, d):
    table = read(spark, d, "part").select("p_partkey", "p_name")
    return features.add_label_flags(table, "p_name", PART_PATTERNS, prefix="is_").drop("p_name")


@query("label_flags_exploration", f"SELECT doc_id, {_flag_sql('text', EXPLORATION_PATTERNS, 'x_')} FROM documents")
def label_flags_exploration(spark, d):
    table = read(spark, d, "documents").select("doc_id", "text")
    return features.add_label_flags(table, "text", EXPLORATION_PATTERNS, prefix="x_").drop("text")


@query("label_flags_genres", f"SELECT doc_id, {_flag_sql('text', GENRE_PATTERNS, 'genre_')} FROM documents")
def label_flags_genres(spark, d):
    table = read(spark, d, "documents").select("doc_id", "text")
    return features.add_label_flags(table, "text", GENRE_PATTERNS).drop("text")


@query("label_flags_missing", "SELECT p_partkey, 0 AS genre_red, 0 AS genre_blue, 0 AS genre_size_small, "
                              "0 AS genre_nutandbolt, 0 AS genre_shiny FROM part")
def label_flags_missing(spark, d):
    return features.add_label_flags(read(spark, d, "part").select("p_partkey"), "p_name",
                                    PART_PATTERNS, on_missing="zeros")


def _off_ties(table, *names):
    """Scaled by an irrational number no value is a rounding tie, on which engines differ."""
    return table.withColumns({n: F.round(F.col(n) * F.sqrt(F.lit(2.0)), 12) for n in names})


_BASES = ("qty", "disc", "p_size")


@query("poly_degree2", f"""
WITH {PART_FEATURES_SQL}
SELECT p_partkey, """ + ", ".join(
    f"round(CAST({a} AS DOUBLE) * CAST({b} AS DOUBLE){' * sqrt(2), 12' if a == b == 'disc' else ', 9'}) AS audio_poly__" + (f"{a}pow2" if a == b else f"{a}_{b}")
    for i, a in enumerate(_BASES) for b in _BASES[i:]) + " FROM pf")
def poly_degree2(spark, d):
    table = part_features(spark, d).select("p_partkey", "p_name", *_BASES)
    out = features.add_polynomials(table, ["qty", "disc", "p_name", "p_size", "gone"], prefix="audio_poly__")
    out = out.drop("p_name", *_BASES)
    terms = [c for c in out.columns if c not in ("p_partkey", "audio_poly__discpow2")]
    return _off_ties(rounded(out, 9, *terms), "audio_poly__discpow2")


@query("poly_interactions3", f"""
WITH {PART_FEATURES_SQL}
SELECT p_partkey, CAST(1.0 AS DOUBLE) AS "x__1", CAST(n_lines AS DOUBLE) AS x__n_lines,
       CAST(p_size AS DOUBLE) AS x__p_size, qty AS x__qty,
       CAST(n_lines AS DOUBLE) * p_size AS x__n_lines_p_size, n_lines * qty AS x__n_lines_qty,
       p_size * qty AS x__p_size_qty, CAST(n_lines AS DOUBLE) * p_size * qty AS x__n_lines_p_size_qty FROM pf""")
def poly_interactions3(spark, d):
    table = part_features(spark, d).select("p_partkey", "n_lines", "p_size", "qty")
    return features.add_polynomials(table, ["n_lines", "p_size", "qty"], prefix="x__", degree=3,
                                    include_bias=True, interaction_only=True).drop("n_lines", "p_size", "qty")


_STAGE = {
    "target": "revenue",
    "features": {"exclude": ["p_retailprice"], "profiling_variables": ["tax"], "drop": ["p_name", "p_type"],
                 "audio_features": ["disc", "tax"], "genre_features": ["red", "blue"],
                 "polynomial": {"audio": {"degree": 2}, "genre": {"degree": 2, "interaction_only": True}}},
}


@query("feature_stage", f"""
WITH {PART_FEATURES_SQL}, fl AS (SELECT *, {_flag_sql('p_name', PART_PATTERNS, 'genre_')} FROM pf)
SELECT p_partkey, p_size, qty, n_lines, round(disc, 11) AS disc, round(price, 8) AS price,
       genre_red, genre_blue, genre_size_small, genre_nutandbolt, genre_shiny,
       round(disc * disc * sqrt(2), 12) AS audio_poly__discpow2, round(disc * tax * sqrt(2), 12) AS audio_poly__disc_tax,
       round(tax * tax * sqrt(2), 12) AS audio_poly__taxpow2,
       CAST(genre_red * genre_blue AS DOUBLE) AS genre_poly__genre_red_genre_blue FROM fl""")
def feature_stage(spark, d):
    table = features.feature_table(part_features(spark, d), _STAGE, keep=["p_partkey"],
                                   label_column="p_name", patterns=PART_PATTERNS)
    table = rounded(rounded(table, 11, "disc"), 8, "price")
    return _off_ties(table, "audio_poly__discpow2", "audio_poly__disc_tax", "audio_poly__taxpow2")


# --- statistics ----------------------------------------------------------------------------


@query("group_summary", """
SELECT l_returnflag, count(l_orderkey) AS l_orderkey_count, round(avg(l_quantity), 6) AS l_quantity_mean,
       round(avg(l_extendedprice), 4) AS l_extendedprice_mean FROM lineitem GROUP BY l_returnflag""")
def group_summary(spark, d):
    table = stats.group_summary(read(spark, d, "lineitem"), "l_returnflag", "l_orderkey",
                                ["l_quantity", "l_extendedprice"])
    return rounded(rounded(table, 6, "l_quantity_mean"), 4, "l_extendedprice_mean")


@query("group_summary_nulls", f"""
WITH {EVENTS_WITH_GAPS_SQL}
SELECT grade, true AS kept_nulls, count(event_id) AS event_id_count, round(avg(value), 6) AS value_mean FROM eg GROUP BY grade
UNION ALL SELECT grade, false, count(event_id), round(avg(value), 6) FROM eg WHERE grade IS NOT NULL GROUP BY grade""")
def group_summary_nulls(spark, d):
    table = events_with_gaps(spark, d)
    both = [stats.group_summary(table, "grade", "event_id", ["value"], null_group=keep).withColumn("kept_nulls", F.lit(keep))
            for keep in (True, False)]
    return rounded(both[0].unionByName(both[1]), 6, "value_mean")


_PROFILED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _profile_sql(spread: str) -> str:
    rows = "\nUNION ALL ".join(f"""
SELECT '{c}' AS name, avg({c}) FILTER (l_returnflag = 'A') AS a, avg({c}) FILTER (l_returnflag = 'N') AS n,
       avg({c}) FILTER (l_returnflag = 'R') AS r FROM lineitem""" for c in _PROFILED)
    return f"""
WITH m AS ({rows}), v AS (SELECT *, (a + n + r) / 3 AS mean FROM m)
SELECT name AS "column", round(a, 6) AS "A", round(n, 6) AS "N", round(r, 6) AS "R",
       round(mean, 6) AS "Average", round({spread}, 6) AS "Std.dev" FROM v"""


@query("group_profile", _profile_sql("sqrt(((a-mean)*(a-mean) + (n-mean)*(n-mean) + (r-mean)*(r-mean)) / 2)"))
def group_profile(spark, d):
    table = stats.group_profile(read(spark, d, "lineitem"), "l_returnflag", _PROFILED)
    return table.select("column", *[(F.round(F.col(f"`{c}`"), 6) + 0.0).alias(c)
                                    for c in ("A", "N", "R", "Average", "Std.dev")])


@query("group_profile_compat", _profile_sql("sqrt(((a-mean)*(a-mean) + (n-mean)*(n-mean) + (r-mean)*(r-mean)) / 3)"))
def group_profile_compat(spark, d):
    table = stats.group_profile(read(spark, d, "lineitem"), "l_returnflag", _PROFILED,
                                groups=["A", "N", "R"], compat=True)
    return table.select("column", *[(F.round(F.col(f"`{c}`"), 6) + 0.0).alias(c)
                                    for c in ("A", "N", "R", "Average", "Std.dev")])


@query("group_means_long", """
SELECT user_id, 'value' AS "column", round(avg(value), 6) AS mean FROM events GROUP BY user_id
UNION ALL SELECT user_id, 'event_id', round(avg(event_id), 6) FROM events GROUP BY user_id""")
def group_means_long(spark, d):
    return rounded(stats.group_means(read(spark, d, "events"), "user_id", ["value", "event_id"]), 6, "mean")


@query("column_means", """
SELECT 'l_quantity' AS "column", round(avg(l_quantity), 6) AS mean FROM lineitem
UNION ALL SELECT 'l_extendedprice', round(avg(l_extendedprice), 6) FROM lineitem""")
def column_means(spark, d):
    return rounded(stats.column_means(read(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"]), 6, "mean")


@query("conditional_counts", """
SELECT count(*) FILTER (l_quantity < 5) AS low, count(*) FILTER (l_quantity > 45) AS high FROM lineitem""")
def conditional_counts(spark, d):
    return stats.conditional_counts(read(spark, d, "lineitem"), {
        "low": F.col("l_quantity") < 5, "high": F.col("l_quantity") > 45})


@query("quantiles_exact", "SELECT * FROM (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {', '.join(f'round(quantile_cont(CAST({c} AS DOUBLE), {p}), 4) AS q{int(p * 1000)}' for p in (0.01, 0.25, 0.5, 0.75, 0.999))} FROM lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_orderkey")) + ")")
def quantiles_exact(spark, d):
    from tablewright.operators.quantiles import exact_quantiles
    # A low buffer limit makes the small table take the path that very large ones take.
    found = exact_quantiles(read(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_orderkey"],
                            (0.01, 0.25, 0.5, 0.75, 0.999), buffer_limit=1000)
    table = spark.createDataFrame([(c, *v) for c, v in found.items()],
                                  "column string, q10 double, q250 double, q500 double, q750 double, q999 double")
    return rounded(table, 4, "q10", "q250", "q500", "q750", "q999")


def _anova_sql(column: str, group: str, table: str) -> str:
    return f"""
SELECT '{column}' AS name, k - 1 AS d1, n - k AS d2, (sb / (k - 1)) / (sw / (n - k)) AS f, mu
FROM (SELECT count(*) AS k, sum(n) AS n, sum(n * v) AS sw, sum(n * (m - mu) * (m - mu)) AS sb, max(mu) AS mu
      FROM (SELECT {group}, count({column}) AS n, var_pop({column}) AS v, avg({column}) AS m
            FROM {table} GROUP BY {group}), (SELECT avg({column}) AS mu FROM {table}))"""


# The upper tail of F has a closed form when the first degrees of freedom are 4.
@query("anova", f"""
WITH {EVENTS_WITH_GAPS_SQL}, a AS ({_anova_sql('value', 'event_type', 'eg')} UNION ALL
{_anova_sql('user_id', 'event_type', 'eg')} UNION ALL {_anova_sql('score', 'event_type', 'eg')}),
x AS (SELECT *, d2 / (d2 + d1 * f) AS x FROM a)
SELECT name AS "column", round(f, 6) AS f_statistic,
       round(power(x, d2 / 2) * (1 + (d2 / 2) * (1 - x)), 6) AS p_value, round(mu, 6) AS column_mean FROM x""")
def anova(spark, d):
    table = stats.anova(events_with_gaps(spark, d), "event_type", ["value", "user_id", "score"])
    return rounded(table, 6, "f_statistic", "p_value", "column_mean")


@query("anova_many_groups", f"""
WITH {PART_FEATURES_SQL}, a AS ({_anova_sql('l_extendedprice', 'l_partkey', 'lineitem')} UNION ALL
{_anova_sql('l_quantity', 'l_partkey', 'lineitem')})
SELECT name AS "column", round(f, 6) AS f_statistic, round({f_upper_sql('f', 'd1', 'd2')}, 6) AS p_value,
       round(mu, 4) AS column_mean FROM a""")
def anova_many_groups(spark, d):
    table = stats.anova(read(spark, d, "lineitem"), "l_partkey", ["l_extendedprice", "l_quantity"])
    return rounded(rounded(table, 6, "f_statistic", "p_value"), 4, "column_mean")


_METRICS_SQL = """
a AS (SELECT count(*) AS n, avg((y-p)*(y-p)) AS mse, avg(abs(y-p)) AS mae, var_pop(y) AS vy,
             100 * avg(abs((y-p)/y)) FILTER (y <> 0) AS mape FROM m),
r AS (SELECT *, 1 - mse / vy AS r2 FROM a)
SELECT round(mse, {0}) AS mse, round(sqrt(mse), 4) AS rmse, round(mae, 4) AS mae, round(r2, 8) AS r2,
       round(1 - (1 - r2) * (n - 1) / (n - {1} - 1), 8) AS adj_r2, round(mape, 6) AS mape, n AS n FROM r
"""


def _shown(table, mse_digits=1):
    table = rounded(rounded(table, mse_digits, "mse"), 4, "rmse", "mae")
    return rounded(rounded(table, 8, "r2", "adj_r2"), 6, "mape")


@query("regression_metrics", "WITH m AS (SELECT l_extendedprice AS y, l_quantity * 1500 + 10000 AS p FROM lineitem),"
       + _METRICS_SQL.format(1, 1))
def regression_metrics(spark, d):
    table = read(spark, d, "lineitem").withColumn("p", F.col("l_quantity") * 1500 + 10000)
    return _shown(stats.regression_metrics(table, "l_extendedprice", "p", 1))


@query("metrics_aligned", f"""
WITH {PART_FEATURES_SQL}, m AS (SELECT pf.revenue AS y, p.p_size * 30.0 + 800 AS p
  FROM pf JOIN part p USING (p_partkey) WHERE p.p_size <> 7),""" + _METRICS_SQL.format(4, 2))
def metrics_aligned(spark, d):
    actual = part_features(spark, d).select("p_partkey", "revenue")
    predicted = (read(spark, d, "part").filter("p_size <> 7")
                 .select("p_partkey", (F.col("p_size") * 30.0 + 800).alias("p")))
    return _shown(stats.aligned_metrics(actual, predicted, "p_partkey", "revenue", "p", 2), 4)


@query("metrics_rounded", """
WITH m AS (SELECT l_quantity AS y, l_linenumber * 7.0 AS p FROM lineitem),
a AS (SELECT count(*) AS n, avg((y-p)*(y-p)) AS mse, avg(abs(y-p)) AS mae, var_pop(y) AS vy,
             100 * avg(abs((y-p)/y)) FILTER (y <> 0) AS mape FROM m),
r AS (SELECT *, 1 - mse / vy AS r2 FROM a)
SELECT round(mse, 4) AS mse, round(sqrt(mse), 4) AS rmse, round(mae, 4) AS mae, round(r2, 4) AS r2,
       round(1 - (1 - r2) * (n - 1) / (n - 2), 4) AS adj_r2, round(mape, 4) AS mape, n FROM r""")
def metrics_rounded(spark, d):
    table = read(spark, d, "lineitem").withColumn("p", F.col("l_linenumber") * 7.0)
    return stats.round_metrics(stats.regression_metrics(table, "l_quantity", "p", 1))


@query("fit_line", f"""
WITH {PART_FEATURES_SQL}
SELECT round(regr_slope(revenue, qty), 6) AS slope, round(regr_intercept(revenue, qty), 6) AS intercept FROM pf""")
def fit_line(spark, d):
    return rounded(stats.fit_line(part_features(spark, d), "qty", "revenue"), 6, "slope", "intercept")


# --- regression ----------------------------------------------------------------------------


_OLS2_SQL = f"""
WITH {PART_FEATURES_SQL},
s AS (SELECT count(*) AS n, avg(qty) AS m1, avg(disc) AS m2, avg(revenue) AS my,
             var_pop(qty) * count(*) AS s11, var_pop(disc) * count(*) AS s22, covar_pop(qty, disc) * count(*) AS s12,
             covar_pop(qty, revenue) * count(*) AS s1y, covar_pop(disc, revenue) * count(*) AS s2y,
             var_pop(revenue) * count(*) AS syy FROM pf),
b AS (SELECT *, s11 * s22 - s12 * s12 AS det, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
             (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM s),
c AS (SELECT *, my - b1 * m1 - b2 * m2 AS b0, (syy - b1 * s1y - b2 * s2y) / (n - 3) AS v FROM b),
e AS (SELECT *, sqrt(v * (1.0 / n + (m1 * m1 * s22 - 2 * m1 * m2 * s12 + m2 * m2 * s11) / det)) AS e0,
             sqrt(v * s22 / det) AS e1, sqrt(v * s11 / det) AS e2 FROM c)
"""


_COEFFICIENTS_SQL = "\nUNION ALL ".join(
    f"SELECT '{name}' AS feature, round(b{i}, 4) AS coefficient, round(e{i}, 4) AS std_err, round(b{i} / e{i}, 4) AS t, "
    f"round({t_two_sided_sql(f'(b{i} / e{i})', '(n - 3)')}, 8) AS p FROM e" for i, name in enumerate(("const", "qty", "disc")))


def _rounded_coefficients(table):
    return rounded(rounded(table, 4, "coefficient", "std_err", "t"), 8, "p")


@query("ols_two_var", _OLS2_SQL + _COEFFICIENTS_SQL)
def ols_two_var(spark, d):
    found = regression.moments(part_features(spark, d), ["qty", "disc", "revenue"])
    return _rounded_coefficients(regression.coefficient_table(spark, regression.fit(found, "revenue", ["qty", "disc"])))


@query("moments_wide", f"""
WITH {PART_FEATURES_SQL}
""" + "\nUNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(covar_samp({a}, {b}), 4) AS covariance FROM pf"
    for a in ("p_size", "p_retailprice", "qty", "n_lines", "disc", "tax", "price", "revenue")
    for b in ("p_size", "p_retailprice", "qty", "n_lines", "disc", "tax", "price", "revenue")))
def moments_wide(spark, d):
    names = ["p_size", "p_retailprice", "qty", "n_lines", "disc", "tax", "price", "revenue"]
    found = regression.moments(materialize(part_features(spark, d)), names)
    rows = [(a, b, float(found.comoment[i, j] / (found.n - 1))) for i, a in enumerate(names) for j, b in enumerate(names)]
    return rounded(spark.createDataFrame(rows, "a string, b string, covariance double"), 4, "covariance")


_CANDIDATES = ("qty", "disc", "p_size", "tax")


def _selected_model(spark, d):
    """Selection from four columns, two of which make up the target."""
    table = materialize(planted_features(spark, d))
    return regression.train(regression.moments(table, [*_CANDIDATES, "revenue"]), "revenue", _CANDIDATES), table


_PLANTED_OLS2_SQL = _OLS2_SQL.replace(PART_FEATURES_SQL, PLANTED_FEATURES_SQL)


# A p-value under 0.05 is a |t| over the 97.5 % point, one over 0.1 a |t| under the 95 % point.
@query("stepwise_two_candidates", _OLS2_SQL.rstrip() + f""",
r AS (SELECT *, abs(s1y / sqrt(s11 * syy)) AS r1, abs(s2y / sqrt(s22 * syy)) AS r2,
             abs(b1 / e1) AS t1, abs(b2 / e2) AS t2 FROM e),
q AS (SELECT *, r1 * sqrt((n - 2) / (1 - r1 * r1)) AS u1, r2 * sqrt((n - 2) / (1 - r2 * r2)) AS u2,
             {t_quantile_sql('(n - 2)')} AS single_in, {t_quantile_sql('(n - 3)')} AS pair_in,
             {t_quantile_sql('(n - 3)', 1.6448536269514722)} AS pair_out FROM r),
f AS (SELECT *, greatest(u1, u2) > single_in AS any_in, u1 >= u2 AS qty_first,
             CASE WHEN u1 >= u2 THEN t2 ELSE t1 END > pair_in AS both_in,
             CASE WHEN u1 >= u2 THEN t1 ELSE t2 END < pair_out AS first_out FROM q)
SELECT 'qty' AS feature FROM f WHERE any_in AND (CASE WHEN qty_first THEN NOT (both_in AND first_out) ELSE both_in END)
UNION ALL
SELECT 'disc' FROM f WHERE any_in AND (CASE WHEN qty_first THEN both_in ELSE NOT (both_in AND first_out) END)""")
def stepwise_two_candidates(spark, d):
    found = regression.moments(part_features(spark, d), ["qty", "disc", "revenue"])
    picked = regression.stepwise(found, "revenue", ["qty", "disc"])
    return spark.createDataFrame([(p,) for p in picked], "feature string")


@query("stepwise_planted", _PLANTED_OLS2_SQL + _COEFFICIENTS_SQL)
def stepwise_planted(spark, d):
    model, _ = _selected_model(spark, d)
    return _rounded_coefficients(regression.coefficient_table(spark, model))


@query("stepwise_planted_metrics", _PLANTED_OLS2_SQL.rstrip() + ", m AS (SELECT revenue AS y, b0 + b1 * qty + b2 * disc AS p FROM pf, e),"
       + _METRICS_SQL.format(6, 2).replace(" FROM r\n", ", 'train' AS split FROM r\n"))
def stepwise_planted_metrics(spark, d):
    model, table = _selected_model(spark, d)
    return _shown(stats.evaluate(table, model, split_label="train"), 6)


@query("stepwise_initial", _PLANTED_OLS2_SQL + _COEFFICIENTS_SQL)
def stepwise_initial(spark, d):
    """A starting set of which nothing stays but what makes up the target."""
    found = regression.moments(materialize(planted_features(spark, d)), [*_CANDIDATES, "revenue"])
    picked = regression.stepwise(found, "revenue", _CANDIDATES, initial=["p_size", "tax", "disc"])
    return _rounded_coefficients(regression.coefficient_table(spark, regression.fit(found, "revenue", sorted(picked, key=_CANDIDATES.index))))


ALL_CANDIDATES = ("p_size", "p_retailprice", "qty", "n_lines", "disc", "tax", "price")


def selected_from_all(spark, d):
    """Selection from seven columns and all their products, for the real target; tests hold it against row-level fits."""
    table = features.add_polynomials(materialize(part_features(spark, d)), ALL_CANDIDATES, prefix="poly__")
    names = [*ALL_CANDIDATES, *[c for c in table.columns if c.startswith("poly__")]]
    return regression.train(regression.moments(table, [*names, "revenue"]), "revenue", names), table


@query("stepwise")
def stepwise(spark, d):
    return regression.coefficient_table(spark, selected_from_all(spark, d)[0])


@query("stepwise_metrics")
def stepwise_metrics(spark, d):
    model, table = selected_from_all(spark, d)
    return stats.evaluate(table, model, split_label="train")


_CROSSED = ("p_size", "p_retailprice", "qty", "n_lines", "disc", "tax", "price", "revenue")
_CROSSED_TERMS = [(a,) for a in _CROSSED] + [(a, b) for i, a in enumerate(_CROSSED) for b in _CROSSED[i:]]


@query("moments_crossed", f"""
WITH {PART_FEATURES_SQL},
wide AS (SELECT p_partkey, """ + ", ".join(
    f"{' * '.join(f'CAST({x} AS DOUBLE)' for x in t)} AS {t[0] if len(t) == 1 else 'poly__' + features.term_name(t)}" for t in _CROSSED_TERMS) + """ FROM pf),
long AS (UNPIVOT wide ON COLUMNS(* EXCLUDE p_partkey) INTO NAME name VALUE v)
SELECT x.name AS a, y.name AS b, round(corr(x.v, y.v), 6) AS r FROM long x JOIN long y USING (p_partkey) GROUP BY x.name, y.name""")
def moments_crossed(spark, d):
    """Correlations of a crossed feature set, from cross moments in tiles of 16 columns."""
    table = features.add_polynomials(materialize(part_features(spark, d).select("p_partkey", *[F.col(c).cast("double") for c in _CROSSED])),
                                     _CROSSED, prefix="poly__")
    names = [c for c in table.columns if c != "p_partkey"]
    found = regression.moments(table, names, tile=16)
    scale = np.sqrt(np.diag(found.comoment))
    matrix = found.comoment / np.outer(scale, scale)
    rows = [(a, b, float(matrix[i, j])) for i, a in enumerate(names) for j, b in enumerate(names)]
    return rounded(spark.createDataFrame(rows, "a string, b string, r double"), 6, "r")


_WIDE = 24
_WIDE_WEIGHTS = [((i * 7) % 11 - 5) / 10.0 for i in range(_WIDE)]
_WIDE_KERNEL = [0.0005] + [(i % 5 + 1) / 1000.0 for i in range(_WIDE)]


@query("prediction_interval_wide", f"""
WITH x AS (SELECT vec_id, CAST(embedding AS DOUBLE[])[1:{_WIDE}] AS e FROM embeddings),
s AS (SELECT vec_id, 1.5 + list_sum(list_transform(list_zip(e, {_WIDE_WEIGHTS}::DOUBLE[]), lambda z: z[1] * z[2])) AS y,
             CAST({_WIDE_KERNEL[0]} AS DOUBLE) + list_sum(list_transform(list_zip(e, {_WIDE_KERNEL[1:]}::DOUBLE[]), lambda z: (z[1] - CAST(0.1 AS DOUBLE)) * (z[1] - CAST(0.1 AS DOUBLE)) * z[2])) AS g FROM x),
h AS (SELECT vec_id, y, {t_quantile_sql('1975')} * sqrt(CAST({250.0 / 1975!r} AS DOUBLE) * (1 + g)) AS h FROM s)
SELECT vec_id, round(y, 6) AS prediction, round(y - h, 6) AS prediction_pi_lower, round(y + h, 6) AS prediction_pi_upper FROM h""")
def prediction_interval_wide(spark, d):
    """Interval of a model of more than 20 features, which is a matrix product instead of one expression."""
    names = [f"e{i}" for i in range(_WIDE)]
    model = regression.LinearModel(tuple(names), "y", 2000, _WIDE + 1, 250.0, 1.5, np.array(_WIDE_WEIGHTS), np.full(_WIDE, 0.1), np.diag(_WIDE_KERNEL))
    table = read(spark, d, "embeddings").select("vec_id", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])
    kept = ("prediction", "prediction_pi_lower", "prediction_pi_upper")
    return rounded(regression.predict(table, model).select("vec_id", *kept), 6, *kept)


_FEW_CENTRES = [[-0.1, 0.0, 0.1, 0.05], [0.1, 0.1, -0.05, 0.0], [0.0, -0.1, 0.0, 0.1]]


@query("nearest_centroid_columns", """
WITH x AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
n AS (SELECT vec_id, """ + ", ".join(" + ".join(f"(e[{i + 1}] - CAST({v} AS DOUBLE)) * (e[{i + 1}] - CAST({v} AS DOUBLE))" for i, v in enumerate(c)) + f" AS d{j}"
                                    for j, c in enumerate(_FEW_CENTRES)) + """ FROM x)
SELECT vec_id, CAST(CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS INTEGER) AS cluster FROM n""")
def nearest_centroid_columns(spark, d):
    """Centres over separate columns, which is one expression."""
    names = [f"e{i}" for i in range(4)]
    table = read(spark, d, "embeddings").select("vec_id", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])
    return clustering.assign_nearest(table, names, _FEW_CENTRES).select("vec_id", "cluster")


@query("predict_fixed", f"""
WITH {PART_FEATURES_SQL}
SELECT p_partkey, round({fixed_prediction_sql()[0]}, 6) AS prediction FROM pf""")
def predict_fixed(spark, d):
    scored = regression.predict(part_features(spark, d), fixed_model(), interval=False)
    return rounded(scored.select("p_partkey", "prediction"), 6, "prediction")


@query("prediction_interval", f"""
WITH {PART_FEATURES_SQL},
s AS (SELECT count(*) AS n, avg(qty) AS m, avg(revenue) AS my, var_pop(qty) * count(*) AS sxx,
             covar_pop(qty, revenue) * count(*) AS sxy, var_pop(revenue) * count(*) AS syy FROM pf),
b AS (SELECT *, sxy / sxx AS b1, my - sxy / sxx * m AS b0, (syy - sxy * sxy / sxx) / (n - 2) AS v FROM s),
p AS (SELECT p_partkey, b0 + b1 * qty AS y,
             {t_quantile_sql('(n - 2)')} * sqrt(v * (1 + 1.0 / n + (qty - m) * (qty - m) / sxx)) AS h FROM pf, b)
SELECT p_partkey, round(y, 4) AS prediction, round(y - h, 4) AS prediction_pi_lower,
       round(y + h, 4) AS prediction_pi_upper FROM p""")
def prediction_interval(spark, d):
    table = part_features(spark, d)
    model = regression.fit(regression.moments(table, ["qty", "revenue"]), "revenue", ["qty"])
    names = ("prediction", "prediction_pi_lower", "prediction_pi_upper")
    return rounded(regression.predict(table, model).select("p_partkey", *names), 4, *names)


@query("evaluate_fixed", f"""
WITH {PART_FEATURES_SQL}, m AS (SELECT revenue AS y, {fixed_prediction_sql()[0]} AS p FROM pf),"""
       + _METRICS_SQL.format(4, 3))
def evaluate_fixed(spark, d):
    return _shown(stats.evaluate(part_features(spark, d), fixed_model()), 4)


# --- clustering ----------------------------------------------------------------------------


def _clustered(spark, d):
    return clustering.assign_nearest(read(spark, d, "embeddings"), ["embedding"], CENTROIDS)


@query("nearest_centroid", f"WITH {CLUSTERED_SQL} SELECT vec_id, label, cluster FROM clustered")
def nearest_centroid(spark, d):
    return _clustered(spark, d).select("vec_id", "label", "cluster")


@query("inertia", f"""
WITH {CLUSTERED_SQL},
x AS (SELECT cluster, unnest(e) AS v, generate_subscripts(e, 1) AS i FROM clustered),
w AS (SELECT cluster, i, var_pop(v) * count(*) AS ss FROM x GROUP BY cluster, i)
SELECT round(sum(ss), 4) AS inertia FROM w""")
def inertia(spark, d):
    return rounded(clustering.inertia(_clustered(spark, d), ["embedding"]), 4, "inertia")


def _silhouette_sql(distance: str) -> str:
    return f"""
WITH {CLUSTERED_SQL},
s AS (SELECT cluster, count(*) AS n FROM clustered GROUP BY cluster),
pairs AS (SELECT a.vec_id, a.cluster AS mine, b.cluster AS other, sum({distance}) AS total
          FROM clustered a, clustered b GROUP BY 1, 2, 3),
m AS (SELECT vec_id, mine, max(total / (s.n - 1)) FILTER (mine = other) AS own,
             min(total / s.n) FILTER (mine <> other) AS rest, max(s.n) FILTER (mine = other) AS size
      FROM pairs JOIN s ON s.cluster = other GROUP BY 1, 2)
SELECT round(avg(CASE WHEN size = 1 THEN 0 ELSE (rest - own) / greatest(own, rest) END), 6) AS silhouette FROM m"""


@query("silhouette", _silhouette_sql(
    "list_sum(list_transform(list_zip(a.e, b.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"))
def silhouette(spark, d):
    value = clustering.silhouette(_clustered(spark, d), ["embedding"])
    return rounded(spark.createDataFrame([(value,)], "silhouette double"), 6, "silhouette")


@query("silhouette_euclidean", _silhouette_sql(
    "sqrt(list_sum(list_transform(list_zip(a.e, b.e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))))"))
def silhouette_euclidean(spark, d):
    return rounded(clustering.silhouette_euclidean(_clustered(spark, d), "vec_id", ["embedding"]),
                   6, "silhouette")


_GAP = "list_sum(list_transform(list_zip(e, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


def _lloyd_sql(k: int, updates: int = 2) -> str:
    """CTEs of k-means from the given centres: v<n> has the assignment after n updates (k as suffix)."""
    parts = [f"c0_{k}(j, c) AS (VALUES " + ", ".join(f"({j}, {CENTROIDS[j]}::DOUBLE[])" for j in range(k)) + ")"]
    for n in range(updates + 1):
        parts.append(f"""d{n}_{k} AS (SELECT vec_id, e, j, {_GAP} AS d FROM xs, c{n}_{k}),
v{n}_{k} AS (SELECT vec_id, e, j, d FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, j) AS place FROM d{n}_{k}) WHERE place = 1)""")
        if n < updates:
            parts.append(f"""c{n + 1}_{k} AS (
  SELECT j, list(m ORDER BY i) AS c FROM (
    SELECT j, i, avg(v) AS m FROM (SELECT j, unnest(e) AS v, generate_subscripts(e, 1) AS i FROM v{n}_{k}) GROUP BY j, i) GROUP BY j
  UNION ALL SELECT j, c FROM c{n}_{k} WHERE j NOT IN (SELECT j FROM v{n}_{k}))""")
    return ",\n".join(parts)


_XS_SQL = "WITH xs AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), "


@query("kmeans_assign")
def kmeans_assign(spark, d):
    """Three clusters by the default fit: ten drawn starts, updates until rest; tests hold it against plain steps."""
    return clustering.kmeans_fit(read(spark, d, "embeddings"), ["embedding"], 3).table.select("vec_id", "cluster")


@query("kmeans_elbow")
def kmeans_elbow(spark, d):
    """One to ten clusters, ten starts each."""
    return clustering.kmeans_sweep(read(spark, d, "embeddings"), ["embedding"])


@query("kmeans_assign_two_updates", f"{_XS_SQL}{_lloyd_sql(3)} SELECT vec_id, j AS cluster FROM v2_3")
def kmeans_assign_two_updates(spark, d):
    fitted = clustering.kmeans_fit(read(spark, d, "embeddings"), ["embedding"], 3, start=CENTROIDS, max_iter=2, tolerance=0.0)
    return fitted.table.select("vec_id", "cluster")


@query("kmeans_elbow_two_updates", _XS_SQL + ",\n".join(_lloyd_sql(k) for k in (1, 2, 3)) + " " + " UNION ALL ".join(
    f"SELECT {k} AS k, round(sum(d), 4) AS inertia FROM v2_{k}" for k in (1, 2, 3)))
def kmeans_elbow_two_updates(spark, d):
    found = clustering.kmeans_sweep(read(spark, d, "embeddings"), ["embedding"], (1, 2, 3), max_iter=2, tolerance=0.0,
                                    starts={k: CENTROIDS[:k] for k in (1, 2, 3)})
    return rounded(found.select("k", "inertia"), 4, "inertia")


@query("kmeans_one_cluster", """
WITH x AS (SELECT unnest(CAST(embedding AS DOUBLE[])) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
w AS (SELECT i, var_pop(v) * count(*) AS ss FROM x GROUP BY i)
SELECT 1 AS k, round(sum(ss), 4) AS inertia FROM w""")
def kmeans_one_cluster(spark, d):
    found = clustering.kmeans_sweep(read(spark, d, "embeddings"), ["embedding"], [1])
    return rounded(found.select("k", "inertia"), 4, "inertia")


@query("cluster_sizes", f"WITH {CLUSTERED_SQL} SELECT cluster, count(*) AS size FROM clustered GROUP BY cluster")
def cluster_sizes(spark, d):
    return clustering.cluster_sizes(_clustered(spark, d))


# --- scoring -------------------------------------------------------------------------------

_BUCKETS = """CASE WHEN success <= 20 THEN 'bust' WHEN success <= 40 THEN 'not successful'
  WHEN success <= 60 THEN 'maybe' WHEN success <= 80 THEN 'great chance' ELSE 'hit' END"""
_MESSAGES = """CASE WHEN success <= 20 THEN 'will be a bust!' WHEN success <= 40 THEN 'will not be successful!'
  WHEN success <= 60 THEN 'will maybe be a hit!' WHEN success <= 80 THEN 'has a great chance!'
  ELSE 'will be an absolute HIT!' END"""


@query("response_buckets", f"""
WITH s AS (SELECT o_orderkey, round(o_totalprice / CAST(5000 AS DOUBLE), 1) AS success FROM orders)
SELECT o_orderkey, success, {_BUCKETS} AS bucket,
       '''' || o_orderkey || ''' ' || {_MESSAGES} || ' It has an expected success of ' || success || '%!' AS message
FROM s""")
def response_buckets(spark, d):
    table = read(spark, d, "orders").select(
        "o_orderkey", (F.col("o_totalprice") / 5000.0).alias("prediction"))
    return scoring.with_response(table, title="o_orderkey").drop("prediction")


SCORE_CONFIG = {
    "preprocessing": {"drop_columns": ["p_type"]},
    "features": {"drop": ["p_name"], "audio_features": ["disc", "p_retailprice"], "genre_features": ["red", "blue"],
                 "polynomial": {"audio": {"degree": 2}}},
}
SCORE_FEATURES = ("qty", "audio_poly__disc_p_retailprice", "genre_red")


def part_scorer() -> scoring.Scorer:
    return scoring.Scorer(fixed_model(SCORE_FEATURES), fixed_preprocessor(), SCORE_CONFIG,
                          label_column="p_name", patterns=PART_PATTERNS)


_point, _half = fixed_prediction_sql(("x.qty", "x.cross_term", "x.red"))
SCORED_SQL = f"""
x AS (SELECT p_partkey, (qty - 300) / 900 AS qty, disc * ((p_retailprice - 950) / 75) AS cross_term,
             CAST(regexp_matches(p_name, '(?i)red|scarlet') AS INTEGER) AS red FROM pf)"""


@query("batch_score", f"""
WITH {PART_FEATURES_SQL}, {SCORED_SQL}
SELECT pf.p_partkey, pf.p_name, pf.p_type, pf.p_retailprice, pf.qty, round({_point}, 6) AS prediction,
       round({_point} - {_half}, 6) AS prediction_pi_lower, round({_point} + {_half}, 6) AS prediction_pi_upper
FROM pf JOIN x USING (p_partkey)""")
def batch_score(spark, d):
    table = part_features(spark, d).select("p_partkey", "p_name", "p_type", "p_retailprice", "qty", "disc")
    return rounded(part_scorer().score(table).drop("disc"), 6,
                   "prediction", "prediction_pi_lower", "prediction_pi_upper")


@query("batch_score_fixed_interval", f"""
WITH {PART_FEATURES_SQL}
SELECT p_partkey, round({fixed_prediction_sql()[0]} - {fixed_prediction_sql()[1]}, 6) AS prediction_pi_lower,
       round({fixed_prediction_sql()[0]} + {fixed_prediction_sql()[1]}, 6) AS prediction_pi_upper FROM pf""")
def batch_score_fixed_interval(spark, d):
    scored = scoring.Scorer(fixed_model(FIXED_FEATURES)).score(part_features(spark, d))
    names = ("prediction_pi_lower", "prediction_pi_upper")
    return rounded(scored.select("p_partkey", *names), 6, *names)


_RECORD_RULES = (scoring.RecordRule("p_name"), scoring.RecordRule("p_size", 5, 45),
                 scoring.RecordRule("disc", 0.0, 0.06), scoring.RecordRule("qty", 0.0, low_open=True))


@query("score_records", f"""
WITH {PART_FEATURES_SQL}, {SCORED_SQL},
s AS (SELECT pf.p_name, pf.p_size, {_point} AS prediction, round({_point}, 1) + 0.0 AS success
      FROM pf JOIN x USING (p_partkey) WHERE pf.p_size BETWEEN 5 AND 45 AND pf.disc BETWEEN 0 AND CAST(0.06 AS DOUBLE))
SELECT p_name, p_size, round(prediction, 6) AS prediction, success, {_BUCKETS} AS bucket,
       '''' || p_name || ''' ' || {_MESSAGES} || ' It has an expected success of ' || success || '%!' AS message FROM s""")
def score_records(spark, d):
    out = scoring.score_records(part_features(spark, d), part_scorer(), _RECORD_RULES,
                                title="p_name", metadata=("p_name", "p_size"))
    return rounded(out, 6, "prediction")
