"""Full history of changing attributes with validity periods (problem 4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import in_blocks, of_several_blocks


def attribute_history(
    events: DataFrame,
    keys: list[str],
    attributes: list[str],
    instant_us: Column,
    ends: Column,
    keep_attributes: bool = False,
    blocks: int | None = None,
) -> DataFrame:
    """Periods in which each entity kept one combination of attributes.

    ``instant_us`` is an event's time in microseconds, ``ends`` is true for
    events that end the entity; any other event states the attributes from its
    instant on, and stating those in force starts nothing.  Returns the keys,
    valid_from_us, valid_to_us (end excluded, -1 if open) and, on request, the
    attributes.

    Blank and null attributes are the same, as are keys apart from blanks
    around them.  Events without an instant are left out.  Of different states
    at one instant an ending comes first, the rest in order of their hash; only
    the last holds, as the others last no time.  Repeated and late rows change
    nothing; a history without its beginning starts at its first event.  Empty
    tables give no rows; further columns are not looked at.

    Plan: gaps and islands in one pass.  Events are reduced to one per entity
    and instant with map-side combine and sorted over the cluster into blocks
    (see ``ordered``; ``blocks`` is their number).  Within (entity, block)
    ``lag`` compares attribute hashes, a running sum numbers the islands, and
    each island's minimum and the next island's start give the period.  An
    entity cut by a block's end gets the last hash, the number of islands and
    the next start from the blocks' summaries, of which it has one per block.
    """
    clean = lambda c: F.coalesce(F.regexp_replace(F.col(c).cast("string"), r"(?U)^\s+|\s+$", ""), F.lit(""))
    by = [f"_k{i}" for i in range(len(keys))]
    state = F.when(F.coalesce(ends, F.lit(False)), F.lit(None)).otherwise(F.xxhash64(*[clean(a) for a in attributes], F.lit(0)))
    kept = [F.col(f"_s.a{i}").alias(a) for i, a in enumerate(attributes) if keep_attributes]
    rows = events.select(
        *[clean(k).alias(b) for k, b in zip(keys, by, strict=True)],
        instant_us.alias("_us"),
        F.struct(
            F.coalesce(state, F.lit(-(2**63))).alias("hash"),
            state.isNotNull().alias("on"),
            *[clean(a).alias(f"a{i}") for i, a in enumerate(attributes) if keep_attributes],
        ).alias("_s"),
    ).where("_us is not null")
    placed = in_blocks(rows.groupBy(*by, "_us").agg(F.max("_s").alias("_s")), by, ["_us"], blocks)
    within = Window.partitionBy(*by, "_block").orderBy("_us")
    compared = placed.withColumn("_before", F.lag("_s.hash").over(within)).withColumn("_changed", (F.col("_before") != F.col("_s.hash")).cast("int"))
    summed = compared.withColumn("_islands", F.coalesce(F.sum("_changed").over(within.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))

    over = Window.partitionBy(*by).orderBy("_block")
    ends_of_block = summed.groupBy(*by, "_block").agg(
        F.min_by("_s.hash", "_us").alias("_first"),
        F.max_by("_s.hash", "_us").alias("_last"),
        F.min("_us").alias("_first_us"),
        F.min(F.when(F.col("_changed") == 1, F.col("_us"))).alias("_change_us"),
        F.max("_islands").alias("_inner"),
    )
    ends_of_block = ends_of_block.withColumn("_opens", F.coalesce(F.lag("_last").over(over) != F.col("_first"), F.lit(True)).cast("int")).withColumn(
        "_start", F.when(F.col("_opens") == 1, F.col("_first_us")).otherwise(F.col("_change_us"))
    )
    carried = of_several_blocks(
        ends_of_block,
        by,
        {
            "_opening": F.col("_opens"),
            "_offset": F.coalesce(F.sum(F.col("_inner") + F.col("_opens")).over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            # the nearest start in a later block
            "_further": F.last("_start", ignorenulls=True).over(Window.partitionBy(*by).orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)),
        },
    )
    opening = F.coalesce("_opening", F.lit(1))
    numbered = summed.join(carried, [*by, "_block"], "left").select(
        *by, "_block", "_us", "_s", "_further",
        (F.coalesce("_offset", F.lit(0)) + opening + F.col("_islands")).alias("_island"),
        F.coalesce("_changed", opening).alias("_starts"),
    )
    islands = numbered.groupBy(*by, "_block", "_island").agg(F.min("_us").alias("_from"), F.min("_s").alias("_s"), F.max("_starts").alias("_starts"), F.max("_further").alias("_further"))
    # what goes on from the block before has its minimum there
    starts = islands.where("_starts = 1")
    spans = starts.withColumn("_to", F.lead("_from").over(Window.partitionBy(*by, "_block").orderBy("_island")))
    return spans.where("_s.on").select(
        *[F.col(b).alias(k) for k, b in zip(keys, by, strict=True)], F.col("_from").alias("valid_from_us"), F.coalesce("_to", "_further", F.lit(-1)).alias("valid_to_us"), *kept
    )
