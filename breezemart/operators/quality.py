"""Null-rate profile and quality gate, one aggregate for all columns."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F


class DataQualityError(Exception):
    """A table broke a quality rule; the message names every broken rule."""


@dataclass(frozen=True)
class Rules:
    """What a table must keep to.

    `measured` are the columns held to the null threshold. Derived columns are left out on
    purpose: wind chill and heat index exclude each other, so one of them is always mostly null.
    """

    table: str
    measured: list[str]
    required: list[str] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    threshold: float = 10.0


def _counts(columns: list[str]) -> list[Column]:
    return [F.count(F.lit(1)).alias("n_rows"),
            *[F.count_if(F.col(f"`{name}`").isNull()).alias(f"nulls_{i}")
              for i, name in enumerate(columns)]]


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: rows, nulls, null %, and the mean null % over the columns.

    An empty table has no percentages (null).
    """
    columns = columns or df.columns
    counts = df.agg(*_counts(columns))
    hundred, rows = F.lit(100.0), F.col("n_rows").cast("double")
    total = sum((F.col(f"nulls_{i}") for i in range(len(columns))), F.lit(0))
    lines = F.array(*[F.struct(F.lit(name).alias("column_name"),
                               F.col(f"nulls_{i}").alias("null_count"))
                      for i, name in enumerate(columns)])
    return (counts
            .withColumn("mean_null_pct",
                        F.try_divide(total.cast("double") * hundred, rows * F.lit(len(columns))))
            .select("n_rows", "mean_null_pct", F.inline(lines))
            .select("column_name", "n_rows", "null_count",
                    F.try_divide(F.col("null_count").cast("double") * hundred, rows)
                    .alias("null_pct"), "mean_null_pct"))


def gate_report(df: DataFrame, threshold: float = 10.0, columns: list[str] | None = None) -> DataFrame:
    """The profile with a verdict per column."""
    return profile(df, columns).withColumn("passed", F.col("null_pct") <= F.lit(float(threshold)))


def observed(df: DataFrame, rules: Rules) -> tuple[DataFrame, Observation]:
    """`df` with its null counts taken along by whatever action writes it: no pass of its own."""
    observation = Observation()
    return df.observe(observation, *_counts(_checked(df, rules))), observation


def check(df: DataFrame, rules: Rules) -> dict[str, float]:
    """Run the gate with one aggregate, and one more where `unique` columns may hold no value twice;
    returns null % per column or raises."""
    _require(df, rules)
    if rules.unique and not df.groupBy(*rules.unique).count().where("count > 1").isEmpty():
        raise DataQualityError(f"{rules.table}: {', '.join(rules.unique)} repeats")
    return judge(df.agg(*_counts(_checked(df, rules))).first(), df, rules)


def judge(counts: Row | dict, df: DataFrame, rules: Rules) -> dict[str, float]:
    """The verdict on counts from `check` or from an observation."""
    _require(df, rules)
    counts = counts.asDict() if isinstance(counts, Row) else counts
    rows = counts["n_rows"]
    if rows == 0:
        raise DataQualityError(f"no data in {rules.table}")
    names = _checked(df, rules)
    share = {name: 100.0 * counts[f"nulls_{i}"] / rows for i, name in enumerate(names)}
    broken = [f"{name} is null in {share[name]:.2f}% (limit {rules.threshold}%)"
              for name in rules.measured if share[name] > rules.threshold]
    broken += [f"{name} must not be null" for name in rules.not_null if share[name] > 0]
    if broken:
        raise DataQualityError(f"{rules.table}: " + "; ".join(broken))
    return share


def _checked(df: DataFrame, rules: Rules) -> list[str]:
    wanted = dict.fromkeys([*rules.measured, *rules.not_null])
    return [name for name in wanted if name in df.columns]


def _require(df: DataFrame, rules: Rules) -> None:
    needed = dict.fromkeys([*rules.required, *rules.measured, *rules.not_null, *rules.unique])
    missing = [name for name in needed if name not in df.columns]
    if missing:
        raise DataQualityError(f"{rules.table}: missing columns {missing}")
