"""Small helpers shared by the column functions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def first_match(cases: Iterable[tuple[Column, object]], default: object = None) -> Column:
    """CASE over (condition, value) pairs, in order."""
    result: Column | None = None
    for condition, value in cases:
        result = F.when(condition, value) if result is None else result.when(condition, value)
    return F.lit(default) if result is None else result.otherwise(F.lit(default))


def ordering(*columns: str) -> Column:
    """A struct that sorts like the columns do, ascending with nulls last."""
    return F.expr("struct(" + ", ".join(f"isnull({c}) AS no_{c}, {c}" for c in columns) + ")")


def _cents(money: str) -> str:
    return f"CAST(rint(CAST({money} AS DOUBLE) * 100) AS BIGINT)"


def cents(money: str) -> Column:
    """An amount as whole cents. Sums of these are exact and do not depend on row order.

    By way of double, which is quicker than decimal arithmetic and close enough
    to round every amount below 90 trillion back to its cents.
    """
    return F.expr(_cents(money))


def dollars(whole_cents: Column) -> Column:
    """Whole cents back to an amount."""
    return whole_cents / F.lit(100.0)


def total(money: str) -> Column:
    """Exact sum of amounts, 0 for none."""
    return F.expr(f"coalesce(sum({_cents(money)}), 0) / 100.0D")


def small_table(spark: SparkSession, names: Sequence[str], rows: Iterable[Sequence]) -> DataFrame:
    """A table of configured rows, held in the plan itself; whole numbers are bigint."""
    columns = list(zip(*rows))
    return spark.createDataFrame(pa.table({name: list(values) for name, values in zip(names, columns)}))
