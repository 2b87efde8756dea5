"""Data-quality checks. Every check returns rows ``(name, passed, details)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.operators.relational import orphans, outside, union_by_name

RESULT = "name string, passed boolean, details string"


@dataclass(frozen=True)
class TableRules:
    """What one table has to satisfy."""

    dataset: str
    required: Sequence[str] = ()
    non_null: Sequence[str] = ()
    unique: Sequence[str] = ()


@dataclass(frozen=True)
class References:
    """Child column whose values must occur in a parent column."""

    child: str
    column: str
    parent: str
    parent_column: str
    name: str = field(default="")


def check_table(df: DataFrame, rules: TableRules) -> DataFrame:
    """All checks of one table from one pass over the columns they name."""
    frames = []
    if rules.required:
        frames.append(_required(df, rules))
    nulls = [c for c in rules.non_null if c in df.columns]
    absent = [c for c in rules.unique if c not in df.columns]
    unique = [c for c in rules.unique if c in df.columns]
    if rules.non_null or unique:
        counts = [F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in nulls]
        counts += [_duplicates(c).alias(f"d_{c}") for c in unique]
        results = []
        if rules.non_null:
            results.append(_null_result(rules.dataset, nulls))
        results += [_unique_result(rules.dataset, c, F.col(f"d_{c}")) for c in unique]
        one_row = df.agg(*counts) if counts else df.agg(F.lit(0).alias("n"))
        frames.append(one_row.select(F.inline(F.array(*results))))
    if absent:
        rows = [(f"{rules.dataset}_{c}_unique", False, "duplicate_count=-1") for c in absent]
        frames.append(df.sparkSession.createDataFrame(rows, RESULT))
    return union_by_name(frames)


def _required(df: DataFrame, rules: TableRules) -> DataFrame:
    missing = [c for c in rules.required if c not in df.columns]
    details = "missing=" + ",".join(missing) if missing else "all required columns present"
    row = (f"{rules.dataset}_required_columns", not missing, details)
    return df.sparkSession.createDataFrame([row], RESULT)


def column_report(df: DataFrame, rules: TableRules) -> DataFrame:
    """For each required column: whether the table has it, its nulls and the table's rows, in one pass."""
    present = [c for c in rules.required if c in df.columns]
    counts = [F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in present]
    one_row = df.agg(F.count(F.lit(1)).alias("rows"), *counts)
    report = [
        F.struct(
            F.lit(rules.dataset).alias("dataset"), F.lit(c).alias("column_name"), F.lit(c in present).alias("present"),
            (F.col(f"n_{c}") if c in present else F.col("rows")).alias("nulls"), F.col("rows").alias("rows"),
        )
        for c in rules.required
    ]
    return one_row.select(F.inline(F.array(*report)))


def _duplicates(column: str) -> Column:
    """Rows beyond the first per value; nulls count as one value."""
    value = F.col(column)
    has_null = F.coalesce(F.max(value.isNull().cast("bigint")), F.lit(0))
    return F.count(F.lit(1)) - F.count_distinct(value) - has_null


def _result(name: Column | str, passed: Column, details: Column) -> Column:
    name = F.lit(name) if isinstance(name, str) else name
    return F.struct(name.alias("name"), passed.alias("passed"), details.alias("details"))


def _null_result(dataset: str, columns: Sequence[str]) -> Column:
    found = F.array_compact(
        F.array(
            *(
                F.when(F.col(f"n_{c}") > 0, F.concat(F.lit(f"'{c}': "), F.col(f"n_{c}").cast("string")))
                for c in columns
            )
        )
    ) if columns else F.array().cast("array<string>")
    details = F.when(F.size(found) == 0, F.lit("no nulls in required columns")).otherwise(
        F.concat(F.lit("{"), F.array_join(found, ", "), F.lit("}"))
    )
    return _result(f"{dataset}_non_null", F.size(found) == 0, details)


def _unique_result(dataset: str, column: str, duplicates: Column) -> Column:
    details = F.concat(F.lit("duplicate_count="), duplicates.cast("string"))
    return _result(f"{dataset}_{column}_unique", duplicates == 0, details)


def _count_check(name: str, failures: DataFrame) -> DataFrame:
    """One result from a one-row frame with a ``failures`` column."""
    n = F.col("failures")
    return failures.select(
        F.lit(name).alias("name"),
        (n == 0).alias("passed"),
        F.concat(F.lit("failures="), n.cast("string")).alias("details"),
    )


def check_references(tables: Mapping[str, DataFrame], rules: Sequence[References]) -> DataFrame:
    """Referential checks; ``failures`` counts child rows without a parent."""
    frames = []
    for r in rules:
        missing = orphans(tables[r.child], r.column, tables[r.parent], r.parent_column)
        total = missing.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("failures"))
        frames.append(_count_check(r.name or f"{r.child}_{r.column}_in_{r.parent}", total))
    return union_by_name(frames)


def check_accepted_values(df: DataFrame, name: str, column: str, values: Sequence[str]) -> DataFrame:
    bad = df.agg(F.count_if(~F.col(column).isin(*values)).alias("failures"))
    return _count_check(name, bad)


def check_range(
    df: DataFrame, name: str, columns: Sequence[str], low: float = float("-inf"), high: float = float("inf")
) -> DataFrame:
    """Rows in which any of the columns lies outside ``low .. high``."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.coalesce(outside(F.col(c), low, high), F.lit(False))
    return _count_check(name, df.agg(F.count_if(bad).alias("failures")))


def gate(results: DataFrame) -> list[dict[str, Any]]:
    """The check results, a handful of rows, for the run's record; one error that names every failed check if any has."""
    rows = [r.asDict() for r in results.select("name", "passed", "details").orderBy("name").collect()]
    if failed := [r for r in rows if not r["passed"]]:
        text = "; ".join(f"{r['name']}: {r['details']}" for r in failed)
        raise ValueError(f"Data quality checks failed: {text}")
    return rows
