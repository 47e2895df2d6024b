"""Ordered sequences per key, safe for keys of any size.

A plain window sorts all rows of one key in one task.  Here rows are sorted
over the whole cluster by key and order and cut into blocks of about equal
size, wherever the cuts fall: a key with a third of all rows lies in a third
of the blocks.  Windows run within (key, block), and one summary row per
(key, block) goes through a window over the key, of which no key has more than
there are blocks.  Every key takes this way, whatever its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def in_blocks(df: DataFrame, keys: list[str], order: list[str], blocks: int | None = None) -> DataFrame:
    """``df`` with ``_block``, the number of the row's block in the order of
    ``keys`` and ``order``, which together tell rows apart.

    ``blocks`` is the most there are, Spark's number of shuffle partitions if
    None.  Written to the checkpoint folder: cuts come from a sample, and a
    block must hold the same rows however often it is read.
    """
    columns = [*keys, *order]
    ranged = df.repartitionByRange(blocks, *columns) if blocks else df.repartitionByRange(*columns)
    return cut(ranged.withColumn("_block", F.spark_partition_id()))


def of_several_blocks(summaries: DataFrame, keys: list[str], carried: dict[str, Column]) -> DataFrame:
    """The summaries (one per key and block) of keys that lie in several
    blocks, with the columns ``carried``.

    A cut divides one key at most, so these are no more than two rows per
    block: a bound that allows to broadcast them.
    """
    number = F.count("*").over(Window.partitionBy(*keys))
    return F.broadcast(summaries.withColumns(carried).withColumn("_blocks", number).where("_blocks > 1").select(*keys, "_block", *carried))


def neighbours(blocked: DataFrame, keys: list[str], order: list[str], values: dict[str, tuple[Column, int]]) -> DataFrame:
    """Add columns to the result of ``in_blocks``: name to (value, step), the
    value of the row before (-1) or after (1) in its key; null without one."""
    near, far = Window.partitionBy(*keys, "_block").orderBy(*order), Window.partitionBy(*keys).orderBy("_block")
    take = {-1: F.lag, 1: F.lead}
    edge = {-1: F.max_by, 1: F.min_by}
    boxed = blocked.withColumns({f"_v{n}": F.struct(v.alias("v")) for n, (v, _) in values.items()})
    ends = boxed.groupBy(*keys, "_block").agg(*[edge[step](f"_v{n}", F.struct(*order)).alias(f"_e{n}") for n, (_, step) in values.items()])
    beyond = of_several_blocks(ends, keys, {f"_far{n}": take[step](f"_e{n}").over(far) for n, (_, step) in values.items()})
    return (
        boxed.withColumns({f"_near{n}": take[step](f"_v{n}").over(near) for n, (_, step) in values.items()})
        .join(beyond, [*keys, "_block"], "left")
        .select(*[c for c in blocked.columns if c != "_block"], *[F.coalesce(f"_near{n}", f"_far{n}")["v"].alias(n) for n in values])
    )
