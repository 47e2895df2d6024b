"""Running totals over keys of any size, in two levels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_offset(df: DataFrame, key: list[str], chunk: str, order: list[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows of the key before this
    one, in the order of ``chunk`` and then ``order``.

    A key's rows never meet in one task: totals run within a chunk, and over
    the chunks' sums, of which a key has as many as ``chunk`` has values.
    """
    inner = Window.partitionBy(*key, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*key).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*key, chunk).agg(F.sum(value).alias("_sum"))
    starts = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(outer), F.lit(0))).drop("_sum")
    return (
        df.join(starts, [*key, chunk])
        .withColumn(out, F.col("_start") + F.coalesce(F.sum(value).over(inner), F.lit(0)))
        .drop("_start")
    )
