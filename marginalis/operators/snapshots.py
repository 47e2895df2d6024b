"""What changed between consecutive full snapshots of a table (problem 1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut, digest
from .ordered import in_blocks, neighbours


def same_id(col: Column) -> Column:
    """Ids are the same apart from letter case, blanks around and - for _."""
    return F.upper(F.regexp_replace(F.translate(col, "-", "_"), r"(?U)^\s+|\s+$", ""))


def snapshot_order(versions: DataFrame, series: str, snapshot: str, time: Column) -> DataFrame:
    """One row per snapshot: its key, the key of the next one, and whether one
    came before.

    Copies of a snapshot row, however spelled, collapse to one (smallest
    spelling, earliest time).  Snapshots without an id, series or readable
    time have no place in the order and are left out.
    """
    rows = versions.select(
        F.col(series).alias("series"),
        F.col(snapshot).alias("snapshot"),
        digest(same_id(F.col(snapshot))).alias("skey"),
        F.unix_micros(time).alias("us"),
    ).where("series is not null and us is not null and trim(snapshot) <> ''")
    one = rows.groupBy("skey").agg(
        F.min(F.struct("us", "snapshot", "series")).alias("m")
    ).select("skey", "m.us", "m.snapshot", "m.series")
    placed = in_blocks(one, ["series"], ["us", "skey"])
    return cut(neighbours(placed, ["series"], ["us", "skey"], {"next": (F.col("skey"), 1), "has_before": (F.lit(True), -1)}))


def except_all_both_ways(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """EXCEPT ALL of side +1 minus side -1 and the reverse in one aggregation.

    Counts each (keys, value) with the sign of its side; what is left above
    zero is the residue of one difference, below zero that of the other.
    """
    return rows.groupBy(*keys, value).agg(F.sum("side").alias("n")).where("n <> 0")


def snapshot_changes(
    versions: DataFrame,
    entries: DataFrame,
    series: str = "drive_file_id",
    snapshot: str = "version_id",
    entry: str = "entry_id",
    signature: str = "entry_signature",
    active: str = "active",
    recency: str = "last_seen",
    time: str = "modified_time",
) -> DataFrame:
    """Records added, removed or changed by each snapshot against the one
    before it in its series.

    Returns (series, snapshot as spelled in ``versions``, entry id without
    blanks around it, change_type NEW / REMOVED / UPDATED).

    Of several rows for one record in one snapshot the latest ``recency``
    counts; at a tie an active row beats an inactive one, then the larger
    signature.  A null ``active`` counts as inactive, a null or unreadable
    ``recency`` as oldest, a null signature as ''.  Rows without an entry id
    or of a snapshot that isn't in ``versions`` are in no snapshot.  A
    snapshot without rows is empty: everything before it was REMOVED.  Empty
    tables give no rows; further columns are not looked at.

    Plan: each row goes once to its own snapshot (side +1) and once to the
    next one (side -1), hashed by (snapshot, entry), so neither a large
    snapshot nor a large series meets in one task; the latest-row step has
    map-side combine; EXCEPT ALL and the full join reuse that partitioning.
    """
    order = snapshot_order(versions, series, snapshot, F.try_to_timestamp(F.col(time)))
    rows = entries.select(
        digest(same_id(F.col(snapshot))).alias("skey"),
        F.regexp_replace(F.col(entry), r"(?U)^\s+|\s+$", "").alias("entry"),
        F.struct(
            F.coalesce(F.unix_micros(F.try_to_timestamp(F.col(recency))), F.lit(-(2**62))).alias("seen"),
            F.coalesce(F.col(active), F.lit(False)).alias("active"),
            digest(same_id(F.col(signature))).alias("sig"),
        ).alias("state"),
    ).where("entry <> ''")
    sides = (
        rows.join(order.select("skey", "next", "has_before"), "skey")
        .select(
            F.explode(
                F.filter(
                    F.array(
                        F.struct(F.when(F.col("has_before"), F.col("skey")).alias("skey"), F.lit(1).alias("side")),
                        F.struct(F.col("next").alias("skey"), F.lit(-1).alias("side")),
                    ),
                    lambda x: x["skey"].isNotNull(),
                )
            ).alias("to"),
            "entry",
            "state",
        )
        .select("to.*", "entry", "state")
    )
    latest = (
        sides.groupBy("skey", "entry")
        .agg(
            F.max(F.when(F.col("side") == 1, F.col("state"))).alias("now"),
            F.max(F.when(F.col("side") == -1, F.col("state"))).alias("before"),
        )
        .select(
            "skey",
            "entry",
            F.explode(
                F.filter(
                    F.array(
                        F.struct(F.col("now.active").alias("active"), F.col("now.sig").alias("sig"), F.lit(1).alias("side")),
                        F.struct(F.col("before.active").alias("active"), F.col("before.sig").alias("sig"), F.lit(-1).alias("side")),
                    ),
                    lambda x: x["active"],
                )
            ).alias("s"),
        )
        .select("skey", "entry", "s.sig", "s.side")
    )
    residue = except_all_both_ways(latest, ["skey", "entry"], "sig")
    added = residue.where("n > 0").select("skey", "entry", F.lit(True).alias("is_now"))
    gone = residue.where("n < 0").select("skey", "entry", F.lit(True).alias("was_before"))
    changes = added.join(gone, ["skey", "entry"], "full_outer").select(
        "skey",
        "entry",
        F.when(F.col("was_before").isNull(), "NEW").when(F.col("is_now").isNull(), "REMOVED").otherwise("UPDATED").alias("change_type"),
    )
    return changes.join(order.select("skey", "series", "snapshot"), "skey").select(
        F.col("series").alias(series), F.col("snapshot").alias(snapshot), F.col("entry").alias(entry), "change_type"
    )
