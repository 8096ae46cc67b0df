"""Registry, shared derived tables and fixed parameters of the check queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators.prep import ColumnTransform, Preprocessor
from tablewright.operators.regression import LinearModel

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL where one can be written."""
    def register(make: Query) -> Query:
        QUERIES[name] = make
        if sql is not None:
            ORACLES[name] = sql.strip()
        return make
    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def hundredths(name: str) -> Column:
    """Two-decimal amount as a whole number, so that sums do not depend on row order."""
    return F.round(F.col(name) * 100).cast("long")


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Round for comparison; adding zero turns -0.0 into 0.0."""
    return df.withColumns({n: F.round(F.col(n), digits) + F.lit(0.0) for n in names})


def part_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table of the parts: sales measures from lineitem joined to part."""
    sales = read(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("n_lines"),
        F.sum(hundredths("l_discount")).cast("double").alias("disc_sum"),
        F.sum(hundredths("l_tax")).cast("double").alias("tax_sum"),
        F.sum(hundredths("l_extendedprice")).cast("double").alias("price_sum"),
        F.sum(hundredths("l_extendedprice") * (100 - hundredths("l_discount"))).cast("double")
        .alias("net_sum"))
    per_line = {name: F.col(total) / F.col("n_lines") / 100.0 for name, total in (
        ("disc", "disc_sum"), ("tax", "tax_sum"), ("price", "price_sum"))}
    return (read(spark, sf_dir, "part").join(sales, "p_partkey").select(
        "p_partkey", "p_name", "p_type", "p_size", "p_retailprice", "qty", "n_lines",
        *[c.alias(n) for n, c in per_line.items()],
        (F.col("net_sum") / 10000.0 / 1000.0).alias("revenue")))


PART_FEATURES_SQL = """
sales AS (
  SELECT l_partkey, sum(l_quantity) AS qty, count(*) AS n_lines,
         CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS DOUBLE) AS disc_sum,
         CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS DOUBLE) AS tax_sum,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) AS price_sum,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)
                  * (100 - CAST(round(l_discount * 100) AS BIGINT))) AS DOUBLE) AS net_sum
  FROM lineitem GROUP BY l_partkey),
pf AS (
  SELECT p_partkey, p_name, p_type, p_size, p_retailprice, qty, n_lines,
         disc_sum / n_lines / CAST(100 AS DOUBLE) AS disc,
         tax_sum / n_lines / CAST(100 AS DOUBLE) AS tax,
         price_sum / n_lines / CAST(100 AS DOUBLE) AS price,
         net_sum / CAST(10000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS revenue
  FROM part JOIN sales ON p_partkey = l_partkey)
"""


def planted_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part features whose target is made of two columns and a remainder from the key."""
    remainder = (F.col("p_partkey") * 7919) % 1000
    return part_features(spark, sf_dir).withColumn(
        "revenue", F.col("qty") * F.lit(0.05) + F.col("disc") * F.lit(120.0) + remainder.cast("double") / F.lit(500.0))


PLANTED_FEATURES_SQL = PART_FEATURES_SQL.replace("pf AS (", "pf0 AS (") + """,
pf AS (SELECT * REPLACE (qty * CAST(0.05 AS DOUBLE) + disc * CAST(120 AS DOUBLE)
                         + CAST((p_partkey * 7919) % 1000 AS DOUBLE) / CAST(500 AS DOUBLE) AS revenue) FROM pf0)
"""


def events_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a parsed number and two columns that miss values by rule."""
    k = F.regexp_extract("props", r'"k": (\d+)', 1).try_cast("int")
    return (read(spark, sf_dir, "events").withColumn("k", k)
            .withColumn("score", F.when(F.col("k") >= 10, F.col("value")))
            .withColumn("grade", F.when(F.col("k") % 7 != 0, F.col("k") % 5).cast("double"))
            .select("event_id", "user_id", "event_type", "k", "value", "score", "grade"))


EVENTS_WITH_GAPS_SQL = r"""
eg AS (
  SELECT event_id, user_id, event_type, k, value,
         CASE WHEN k >= 10 THEN value END AS score,
         CAST(CASE WHEN k % 7 <> 0 THEN k % 5 END AS DOUBLE) AS grade
  FROM (SELECT *, TRY_CAST(regexp_extract(props, '"k": (\d+)', 1) AS INTEGER) AS k FROM events))
"""

# Patterns suited to the words of the given tables.
PART_PATTERNS = {"red": "red|scarlet", "blue": "blue", "size-small": "small|tiny",
                 "nut&bolt": "nut|bolt|screw", "shiny": "SHINY|steel"}

# A model with given parameters, so that its predictions can be written as SQL.
FIXED_FEATURES = ("qty", "disc", "p_size")
FIXED_WEIGHTS = (0.05, 120.0, 0.3)
FIXED_INTERCEPT = 1.5
FIXED_CENTRE = (700.0, 0.05, 25.0)
FIXED_KERNEL = ((0.0005, 0.0, 0.0, 0.0), (0.0, 2e-8, 1e-7, 0.0),
                (0.0, 1e-7, 0.02, 1e-6), (0.0, 0.0, 1e-6, 3e-6))


def fixed_model(features: Sequence[str] = FIXED_FEATURES) -> LinearModel:
    return LinearModel(tuple(features), "revenue", 2000, 4, 250000.0, FIXED_INTERCEPT,
                       np.array(FIXED_WEIGHTS), np.array(FIXED_CENTRE), np.array(FIXED_KERNEL))


def fixed_preprocessor() -> Preprocessor:
    return Preprocessor((ColumnTransform("qty", 650.0, 300.0, 900.0),
                         ColumnTransform("p_retailprice", 1000.0, 950.0, 75.0)))


def t_quantile_sql(df: str, z: float = 1.959963984540054) -> str:
    """Upper point of the t distribution by its expansion in 1/df (many degrees of freedom).

    ``z`` is the matching point of the normal distribution; the default is for 97.5 %.
    """
    terms = [z, (z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96,
             (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
             (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160]
    return "(" + " + ".join(f"CAST({t!r} AS DOUBLE) / power({df}, {i})"
                            for i, t in enumerate(terms)) + ")"


def t_two_sided_sql(t: str, df: str) -> str:
    """P(|T| > |t|) by its finite sum, which differs for odd and even degrees of freedom."""
    square = f"(1 / (1 + ({t}) * ({t}) / ({df})))"
    angle = f"atan(abs({t}) / sqrt({df}))"
    odd = (f"1 - 2 / pi() * ({angle} + sin({angle}) * list_sum(list_transform(range(0, CAST(({df} - 1) / 2 AS BIGINT)), "
           f"lambda i: exp(lgamma(i + 1) + lgamma(1.5) - lgamma(i + 1.5)) * power({square}, i + 0.5))))")
    even = (f"1 - sin({angle}) * list_sum(list_transform(range(0, CAST(({df}) / 2 AS BIGINT)), "
            f"lambda i: exp(lgamma(i + 0.5) - lgamma(0.5) - lgamma(i + 1)) * power({square}, i)))")
    return f"(CASE WHEN CAST({df} AS BIGINT) % 2 = 1 THEN {odd} ELSE {even} END)"


def f_upper_sql(f: str, df1: str, df2: str) -> str:
    """P(F > f) by its finite sum; one of the degrees of freedom must be even."""
    def tail(a: str, b: str, y: str) -> str:
        return (f"list_sum(list_transform(range(0, CAST(({b}) / 2 AS BIGINT)), lambda i: exp(({a}) / 2.0 * ln(1 - {y}) "
                f"+ lgamma(({a}) / 2.0 + i) - lgamma(({a}) / 2.0) - lgamma(i + 1) + i * ln({y}))))")

    high, low = f"({df1}) * ({f}) / (({df2}) + ({df1}) * ({f}))", f"({df2}) / (({df2}) + ({df1}) * ({f}))"
    return (f"(CASE WHEN CAST({df1} AS BIGINT) % 2 = 0 THEN {tail(df2, df1, f'({high})')} "
            f"WHEN CAST({df2} AS BIGINT) % 2 = 0 THEN 1 - {tail(df1, df2, f'({low})')} END)")


def fixed_prediction_sql(features: Sequence[str] = FIXED_FEATURES) -> tuple[str, str]:
    """SQL of the fixed model's prediction and half interval width."""
    point = f"CAST({FIXED_INTERCEPT} AS DOUBLE)" + "".join(
        f" + {x} * CAST({w} AS DOUBLE)" for x, w in zip(features, FIXED_WEIGHTS))
    z = ["CAST(1 AS DOUBLE)", *(f"({x} - CAST({m} AS DOUBLE))" for x, m in zip(features, FIXED_CENTRE))]
    spread = " + ".join(f"{z[i]} * {z[j]} * CAST({FIXED_KERNEL[i][j]!r} AS DOUBLE)"
                        for i in range(4) for j in range(4) if FIXED_KERNEL[i][j])
    variance = f"CAST({250000.0 / 1996!r} AS DOUBLE)"
    return point, f"{t_quantile_sql('1996')} * sqrt({variance} * (1 + {spread}))"


def centroid(j: int, width: int = 64) -> list[float]:
    """Given cluster centres in the embedding space, made by rule."""
    return [((i * (j + 3) + 5 * j) % 11 - 5) / 40.0 for i in range(width)]


CENTROIDS = [centroid(j) for j in range(3)]

CLUSTERED_SQL = """
dist AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
near AS (
  SELECT *, """ + ", ".join(
    f"list_sum(list_transform(list_zip(e, {c}::DOUBLE[]), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d{j}"
    for j, c in enumerate(CENTROIDS)) + """ FROM dist),
clustered AS (
  SELECT vec_id, label, e, CAST(CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0
                                     WHEN d1 <= d2 THEN 1 ELSE 2 END AS INTEGER) AS cluster
  FROM near)
"""
