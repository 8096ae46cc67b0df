"""Data quality: expectations checked in one aggregation, and row-level rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import is_numeric, matches_type, number, quoted
from .membership import count_not_in

DETAIL_COLUMNS = ("status", "dtype", "dtype_expected", "missing_count", "rows_dropped",
                  "below_min", "above_max", "error")
_DETAIL_TYPES = ("status string, dtype string, dtype_expected string, missing_count long,"
                 " rows_dropped long, below_min long, above_max long, error string")


@dataclass(frozen=True)
class Expectation:
    """What one column should look like; bounds are inclusive.

    ``allowed`` are the values it may have: a list, or the first column of a table of any size.
    """

    name: str
    dtype: str | None = None
    required: bool = True
    min: float | None = None
    max: float | None = None
    allowed: Sequence[Any] | DataFrame | None = None

    @classmethod
    def from_config(cls, entry: Mapping[str, Any], spark: SparkSession | None = None) -> Expectation:
        """``allowed_values`` lists values, or names a Parquet table whose first column holds them."""
        known = {k: entry[k] for k in ("dtype", "required", "min", "max") if k in entry}
        allowed = entry.get("allowed_values")
        if isinstance(allowed, str):
            allowed = (spark or SparkSession.active()).read.parquet(allowed)
        return cls(entry["name"], **known, allowed=allowed)


@dataclass
class QualityReport:
    """Outcome of a validation: overall result, messages, and details per column."""

    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    details: dict[str, dict[str, Any]] = field(default_factory=dict)
    #: Whether a column was checked against allowed values; the tables then have ``not_allowed``.
    membership: bool = False

    @property
    def _columns(self) -> tuple[str, ...]:
        return DETAIL_COLUMNS + (("not_allowed",) if self.membership else ())

    @property
    def _types(self) -> str:
        return _DETAIL_TYPES + (", not_allowed long" if self.membership else "")

    @property
    def result(self) -> str:
        return "fail" if self.errors else "pass"

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per expected column; keys that do not apply are NULL."""
        rows = [(c, *(d.get(k) for k in self._columns)) for c, d in self.details.items()]
        return spark.createDataFrame(rows, "column string, " + self._types)

    def document(self, spark: SparkSession) -> DataFrame:
        """One row ``result, errors, warnings, details`` for the report sink."""
        details = {c: tuple(d.get(k) for k in self._columns) for c, d in self.details.items()}
        return spark.createDataFrame(
            [(self.result, self.errors, self.warnings, details)],
            "result string, errors array<string>, warnings array<string>,"
            f" details map<string, struct<{self._types.replace(' ', ': ').replace(',: ', ', ')}>>")


Check = tuple[Expectation, str, Column]


def planned(df: DataFrame, expectations: Sequence[Expectation]) -> tuple[QualityReport, list[Check]]:
    """What the schema alone tells (presence and type), and the conditions whose rows are to be counted."""
    report = QualityReport()
    checks: list[Check] = []
    for e in expectations:
        detail: dict[str, Any] = {}
        report.details[e.name] = detail
        report.membership |= e.allowed is not None
        if e.name not in df.columns:
            if e.required:
                detail |= {"status": "missing", "error": f"Missing required column: {e.name}"}
                report.errors.append(detail["error"])
            else:
                detail["status"] = "not present (optional)"
            continue
        detail["status"] = "present"
        actual = df.schema[e.name].dataType
        if e.dtype and not matches_type(actual, e.dtype):
            found = actual.simpleString()
            message = f"Column '{e.name}' has dtype '{found}', expected '{e.dtype}'"
            detail |= {"dtype": found, "dtype_expected": e.dtype, "error": message}
            report.errors.append(message)
            continue
        value = number(df, e.name) if is_numeric(df, e.name) else quoted(e.name)
        checks.append((e, "missing_count", value.isNull()))
        if e.min is not None:
            checks.append((e, "below_min", value < F.lit(e.min)))
        if e.max is not None:
            checks.append((e, "above_max", value > F.lit(e.max)))
        if e.allowed is not None and not isinstance(e.allowed, DataFrame):
            checks.append((e, "not_allowed", ~value.isin(list(e.allowed))))
    return report, checks


def counts_of(checks: Sequence[Check]) -> list[Column]:
    """The aggregates of the checks, one row for all of them."""
    return [F.count_if(condition).alias(f"n{i}") for i, (_, _, condition) in enumerate(checks)]


def validate(df: DataFrame, expectations: Sequence[Expectation]) -> QualityReport:
    """Check presence and type on the schema, then all counts in a single aggregation.

    Columns whose allowed values are a table take a job each, see ``membership``.
    """
    report, checks = planned(df, expectations)
    row = df.agg(*counts_of(checks)).first() if checks else ()
    known = {(e.name, kind): n for (e, kind, _), n in zip(checks, row)}
    # Columns that stand in the table with the type they should have.
    sound = {e.name for e, kind, _ in checks if kind == "missing_count"}
    known |= {(e.name, "not_allowed"): count_not_in(df, e.name, e.allowed) for e in expectations
              if e.name in sound and isinstance(e.allowed, DataFrame)}
    return reported(report, expectations, known)


def reported(report: QualityReport, expectations: Sequence[Expectation], known: Mapping[tuple[str, str], int]) -> QualityReport:
    """The report with the counts per column and kind that are not 0."""
    for e in expectations:
        for kind in ("missing_count", "below_min", "above_max", "not_allowed"):
            if known.get((e.name, kind)):
                _record(report, e, kind, known[e.name, kind])
    return report


# The wording of the messages, which reports are compared by.
def _record(report: QualityReport, e: Expectation, kind: str, n: int) -> None:
    detail = report.details[e.name]
    detail[kind] = n
    if kind == "missing_count":
        detail["rows_dropped"] = n
        level = "required" if e.required else "optional"
        (report.errors if e.required else report.warnings).append(
            f"Column '{e.name}' had {n} missing values ({level}); rows dropped.")
    elif kind == "not_allowed":
        report.errors.append(f"Column '{e.name}' has {n} values that are not allowed")
    else:
        side, bound = ("below min", e.min) if kind == "below_min" else ("above max", e.max)
        report.errors.append(f"Column '{e.name}' has {n} values {side} ({bound})")


def validate_config(df: DataFrame, config: Mapping[str, Any]) -> QualityReport | None:
    """Validate against a configuration's ``data_validation`` section; None when disabled."""
    section = config.get("data_validation", {})
    if not section.get("enabled", True):
        return None
    columns = section.get("schema", {}).get("columns", [])
    return validate(df, [Expectation.from_config(c, df.sparkSession) for c in columns])


def enforce(report: QualityReport, action: str = "raise") -> None:
    """Act on a failed report: ``raise`` stops, anything else lets the job go on."""
    if report.errors and action.lower() == "raise":
        raise ValueError("Data validation failed: " + "; ".join(report.errors))


def rule_report(df: DataFrame, *, max_null_percentage: float | None = None,
                min_rows: int | None = None) -> DataFrame:
    """Table-wide rules: ``rule, column, value, threshold, passed``; one aggregation."""
    names = df.columns if max_null_percentage is not None else []
    missing = [(number(df, c) if is_numeric(df, c) else quoted(c)).isNull() for c in names]
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 *[F.count_if(m).alias(f"m{i}") for i, m in enumerate(missing)]).first()
    rows = []
    for i, c in enumerate(names):
        share = 100.0 * row[f"m{i}"] / row["n"] if row["n"] else 0.0
        rows.append(("max_null_percentage", c, share, float(max_null_percentage),
                     share <= max_null_percentage))
    if min_rows is not None:
        rows.append(("min_rows", None, float(row["n"]), float(min_rows), row["n"] >= min_rows))
    return df.sparkSession.createDataFrame(
        rows, "rule string, column string, value double, threshold double, passed boolean")


# --- row-level rules -----------------------------------------------------------------------

@dataclass(frozen=True)
class RecordRule:
    """Range of one field of a record; every field with a rule must also be present."""

    name: str
    low: float | None = None
    high: float | None = None
    low_open: bool = False


# The accepted ranges of a scoring record.
RECORD_RULES: tuple[RecordRule, ...] = (
    RecordRule("track_name"),
    RecordRule("year", 1900, 2030),
    RecordRule("artist_popularity", 0.0, 100.0),
    RecordRule("genre"),
    RecordRule("danceability", 0.0, 1.0),
    RecordRule("energy", 0.0, 1.0),
    RecordRule("liveness", 0.0, 1.0),
    RecordRule("loudness"),
    RecordRule("speechiness", 0.0, 1.0),
    RecordRule("tempo", 0.0, low_open=True),
    RecordRule("valence", 0.0, 1.0),
    RecordRule("duration_ms", 0.0, low_open=True),
    RecordRule("acousticness", 0.0, 1.0),
    RecordRule("key", 0.0, 11.0),
)


def with_violations(df: DataFrame, rules: Sequence[RecordRule] = RECORD_RULES,
                    name: str = "violations") -> DataFrame:
    """Add the names of the fields of each row that are missing or out of range."""
    checks = [F.when(~_holds(df, r), F.lit(r.name)) for r in rules]
    return df.withColumn(name, F.array_compact(F.array(*checks)) if checks
                         else F.array().cast("array<string>"))


def _holds(df: DataFrame, rule: RecordRule) -> Column:
    """True or false, never NULL; made of plain comparisons that a scan can apply."""
    if rule.name not in df.columns:
        return F.lit(False)
    value = quoted(rule.name)
    holds = value.isNotNull()
    if isinstance(df.schema[rule.name].dataType, (T.FloatType, T.DoubleType)):
        holds &= ~F.isnan(value)
    if rule.low is not None:
        holds &= value > F.lit(rule.low) if rule.low_open else value >= F.lit(rule.low)
    if rule.high is not None:
        holds &= value <= F.lit(rule.high)
    return holds


def split_records(df: DataFrame, rules: Sequence[RecordRule] = RECORD_RULES,
                  ) -> tuple[DataFrame, DataFrame]:
    """Valid rows with the input's columns, and rejected rows with their violations."""
    valid = df.filter(reduce(lambda a, b: a & b, [_holds(df, r) for r in rules], F.lit(True)))
    return valid, with_violations(df, rules).filter(F.size("violations") > 0)
