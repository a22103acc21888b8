"""Quality rules and row counts of loads."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from operator import eq, ge, gt, le, lt, ne

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TESTS: dict[str, Callable] = {">": gt, ">=": ge, "=": eq, "!=": ne, "<": lt, "<=": le}


@dataclass(frozen=True)
class Rule:
    """`ColumnCount` or `RowCount` against a number."""

    measure: str
    op: str
    bound: int

    def __str__(self) -> str:
        return f"{self.measure} {self.op} {self.bound}"


#: The rule every load is checked with.
DEFAULT_RULES = [Rule("ColumnCount", ">", 0)]


def evaluate(df: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """rule, value, passed: one row per rule, one pass over the data and none if no rule needs it."""
    spark = df.sparkSession
    listed = spark.createDataFrame(
        [(i, str(r), r.measure) for i, r in enumerate(rules)], "position int, rule string, measure string"
    )
    if any(r.measure == "RowCount" for r in rules):
        measured = listed.crossJoin(F.broadcast(df.agg(F.count("*").alias("rows"))))
    else:
        measured = listed.withColumn("rows", F.lit(None).cast("bigint"))
    value = F.when(F.col("measure") == "ColumnCount", F.lit(len(df.columns)).cast("bigint")).otherwise(F.col("rows"))
    passed = F.lit(None).cast("boolean")
    for i, r in enumerate(rules):
        passed = F.when(F.col("position") == i, _TESTS[r.op](F.col("value"), F.lit(r.bound))).otherwise(passed)
    return measured.withColumn("value", value).select("rule", "value", passed.alias("passed"))


def audit(operator: str, **frames: DataFrame) -> DataFrame:
    """operator, step, n_rows: the row count of each frame, e.g. audit("upsert", base=..., slice=..., result=...)."""
    out = None
    for step, df in frames.items():
        counted = df.agg(F.count("*").alias("n_rows")).select(
            F.lit(operator).alias("operator"), F.lit(step).alias("step"), "n_rows"
        )
        out = counted if out is None else out.unionByName(counted)
    if out is None:
        raise ValueError("nothing to count")
    return out
