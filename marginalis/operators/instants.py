"""Normalising timestamp columns of a table to instants (problem 2)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.instants import CANONICAL, PARTS, components, present, with_instant


def zone_ids(spark: SparkSession) -> list[str]:
    """The zone names the JVM's rules cover (a fixed list of some hundred)."""
    return sorted(str(x) for x in spark.sparkContext._jvm.java.time.ZoneId.getAvailableZoneIds())


def normalised_instants(
    rows: DataFrame,
    fields: list[str],
    key: str,
    desks: DataFrame,
    abbreviations: DataFrame,
    table_name: str,
    desk: str = "desk_id",
) -> DataFrame:
    """(table_name, record_key, field, utc_us) for each value of ``fields``
    that states an instant and isn't already in the canonical form.

    ``desks`` gives each desk's zone_name and date_order, ``abbreviations``
    minutes east of UTC; both are small tables, which Spark broadcasts by
    their measured size.  Null, blank and impossible values, values with an
    unknown zone and zone-less values of an unknown desk give no row; a null
    key gives a null record_key; repeated rows give one.  Times that occur
    twice mean the earlier instant, skipped ones use the offset before the
    change.  Further columns are not looked at.
    """
    zones = zone_ids(rows.sparkSession)
    d = desks.select(F.col(desk).alias("_desk"), F.col("zone_name").alias("_zone"), F.upper("date_order").alias("_order")).dropDuplicates(["_desk"])
    a = abbreviations.select(F.upper("abbreviation").alias("_ab"), F.col("offset_minutes").alias("_minutes")).dropDuplicates(["_ab"])
    values = rows.select(
        F.col(key).cast("string").alias("record_key"),
        F.col(desk).alias("_desk"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("x"),
    ).select("record_key", "_desk", "x.*")
    said = (
        present(values.where(F.col("value").isNotNull() & ~F.col("value").rlike(CANONICAL)).distinct(), "_parts", components(F.col("value")))
        .withColumn("_ab", F.upper(F.get("_parts", F.lit(PARTS.index("ab")))))
        .join(d, "_desk", "left")
        .join(a, "_ab", "left")
    )
    found = with_instant(said, "utc_us", "_parts", "_zone", "_order", "_minutes", zones)
    return found.select(F.lit(table_name).alias("table_name"), "record_key", "field", "utc_us").distinct()


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
