"""Rows that break a rule go to a table of their own, with the rule's name; the others are stored.

The rows that keep the rules are written in one pass, and that pass counts the others by rule. Only
where there are any does a second pass read the input again, for them alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from breezemart.operators.quality import DataQualityError

SCHEMA = "table string, rule string, row string, batch_id string"


def not_null(columns: list[str]) -> dict[str, Column]:
    return {f"{name} must not be null": F.col(f"`{name}`").isNotNull() for name in columns}


def broken_rule(rules: dict[str, Column]) -> Column:
    """The name of the first rule a row breaks, null if it keeps all; an unknown outcome is broken."""
    broken = F.lit(None).cast("string")
    for name, kept in reversed(rules.items()):
        broken = F.when(~F.coalesce(kept, F.lit(False)), F.lit(name)).otherwise(broken)
    return broken


def split(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame, Observation]:
    """(rows that keep all rules, the others with their `rule`, counts).

    The counts are there once the first frame has been written; `counted` reads them.
    """
    names, observation = list(rules), Observation()
    marked = df.withColumn("_rule", broken_rule(rules))
    watched = marked.observe(
        observation, F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col("_rule") == name).alias(f"broken_{i}") for i, name in enumerate(names)])
    return (watched.where("_rule is null").drop("_rule"),
            marked.where("_rule is not null").withColumnRenamed("_rule", "rule"), observation)


def counted(observation: Observation, rules: dict[str, Column]) -> tuple[int, dict[str, int]]:
    """All rows, and rows by broken rule (those rules only that some row breaks)."""
    counts = observation.get
    broken = {name: counts[f"broken_{i}"] for i, name in enumerate(rules)}
    return counts["n_rows"], {name: n for name, n in broken.items() if n}


def quarantined(bad: DataFrame, table: str, batch_id: str) -> DataFrame:
    """Broken rows in the layout of the quarantine table: the whole row as JSON."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in bad.columns if c != "rule"]), {"ignoreNullFields": "false"})
    return bad.select(F.lit(table).alias("table"), "rule", row.alias("row"), F.lit(batch_id).alias("batch_id"))


def store(df: DataFrame, rules: dict[str, Column], write: Callable[[DataFrame], object], path: str, table: str,
          batch_id: str, most_pct: float) -> dict[str, int]:
    """Write the rows that keep `rules` by `write` and append the others to the quarantine at `path`.

    The quarantine has a folder for every table, so tables can be written side by side. Fails where
    more than `most_pct` % of all rows break a rule, where all of them do, and where there are none.
    Returns the number of rows by broken rule.
    """
    good, bad, observation = split(df, rules)
    write(good)
    rows, broken = counted(observation, rules)
    if not rows:
        raise DataQualityError(f"no data in {table}")
    if broken:
        quarantined(bad, table, batch_id).drop("table").write.mode("append").parquet(f"{path}/table={table}")
    judge_share(table, rows, broken, most_pct)
    return broken


def judge_share(table: str, rows: int, broken: dict[str, int], most_pct: float) -> None:
    held = sum(broken.values())
    if held and (held == rows or 100.0 * held / rows > most_pct):
        listed = "; ".join(f"{name} in {n}" for name, n in broken.items())
        raise DataQualityError(f"{table}: {held} of {rows} rows broke a rule (limit {most_pct}%): {listed}")
