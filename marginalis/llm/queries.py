"""Queries of the text problems and, where SQL can express them, their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalis.session import table

from . import encoding, mixing, names, packing, textforms
from .tokens import token_counts


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return textforms.look_alikes(table(spark, d, "annotations"), "source_sha256", "entry_id", ["comment", "selected_text"])


def _links(spark: SparkSession, d: str) -> DataFrame:
    annotations, entries = table(spark, d, "annotations"), table(spark, d, "entries")
    return names.link_names(names.distinct_names([annotations.select("raw_author"), annotations.select("reviewer"), entries.select("canonical_author")]))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return names.linked_pairs(_links(spark, d))


def p6_entities(spark: SparkSession, d: str) -> DataFrame:
    return _links(spark, d)


def _sized(spark: SparkSession, d: str) -> DataFrame:
    return token_counts(table(spark, d, "documents").select("doc_id", "text", "source"), "text").drop("text")


def p7_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.harmonic_packing(_sized(spark, d), table(spark, d, "containers"))


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(p7_packing(spark, d), table(spark, d, "containers"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_sources(_sized(spark, d), table(spark, d, "mix_targets"))[0]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_sources(_sized(spark, d), table(spark, d, "mix_targets"))[1]


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents").select("doc_id", "text", "source", "lang")
    return encoding.restore(documents).where("garbled").select("doc_id").distinct()


def p9_restored(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents").select("doc_id", "text", "source", "lang")
    return encoding.restore(documents).where("garbled").select("doc_id", "restored", "chains", "whole")


# What SQL can check of operators that it can't express: whole results reduced to what must hold of them.


def p6_names(spark: SparkSession, d: str) -> DataFrame:
    """Every name that stands for somebody, as often as it has an entity."""
    return _links(spark, d).groupBy("name").agg(F.count("entity").alias("entities"))


def p7_items(spark: SparkSession, d: str) -> DataFrame:
    """Per kind of container: items, bins that hold too much, and items that
    fit whole but were split."""
    containers = table(spark, d, "containers").select("container_id", "capacity_tokens")
    packed = p7_packing(spark, d).join(F.broadcast(containers), "container_id")
    items = packed.groupBy("container_id", "item").agg(F.count("*").alias("parts"), F.sum("size").alias("size"), F.first("capacity_tokens").alias("room"))
    bins = packed.groupBy("container_id", "bin").agg(F.sum("size").alias("size"), F.first("capacity_tokens").alias("room"))
    over = bins.groupBy("container_id").agg(F.count_if(F.col("size") > F.col("room")).alias("over_full"))
    return items.groupBy("container_id").agg(F.count("*").alias("items"), F.count_if((F.col("parts") > 1) & (F.col("size") <= F.col("room"))).alias("needless_splits")).join(over, "container_id")


def p8_uses(spark: SparkSession, d: str) -> DataFrame:
    """Per target: whether its documents are used no more often than allowed,
    counting whole documents and passes over their source."""
    pieces, shares = mixing.mix_sources(_sized(spark, d), table(spark, d, "mix_targets"))
    uses = pieces.groupBy("mix_name", "source", "doc_id", "block").agg(F.count("*").alias("uses")).groupBy("mix_name", "source").agg(F.max("uses").alias("uses"))
    return shares.join(uses, ["mix_name", "source"], "left").select(
        "mix_name", "source", ((F.col("most_turns") <= F.col("max_repeats")) & (F.coalesce("uses", F.lit(0)) <= F.col("max_repeats"))).alias("within_repeats")
    )


def p9_lost(spark: SparkSession, d: str) -> DataFrame:
    """The texts with characters that were lost when they were read: all are found."""
    documents = table(spark, d, "documents").select("doc_id", "text", "source", "lang")
    return encoding.restore(documents).where(F.col("garbled") & F.col("text").contains("\ufffd")).select("doc_id").distinct()


QUERIES = {f.__name__: f for f in (p3_found, p6_found, p6_entities, p6_names, p7_packing, p7_fill, p7_items, p8_mix, p8_shares, p8_uses, p9_found, p9_restored, p9_lost)}

# The oracle of p3 repeats the form's SQL in the oracle's engine; pairing and grouping are its own.
_FORMS = textforms.canonical_sql(
    """(select source_sha256, entry_id, 'comment' as field, comment as text from annotations
        union all select source_sha256, entry_id, 'selected_text', selected_text from annotations)"""
)
ORACLES = {
    "p3_found": f"""with f as ({_FORMS}), r as (select distinct source_sha256, entry_id, field, text, form from f where form <> '' and entry_id is not null)
select distinct a.field, a.entry_id as entry_id_a, b.entry_id as entry_id_b
from r a join r b on a.source_sha256 is not distinct from b.source_sha256 and a.field = b.field and a.form = b.form
where a.text <> b.text and a.entry_id < b.entry_id""",
    "p6_names": """with n as (select raw_author as name from annotations union select reviewer from annotations union select canonical_author from entries)
select name, 1::bigint as entities from n where regexp_matches(name, '\\p{L}') and strip_accents(lower(trim(name))) not in ('user', 'reviewer', 'author', 'admin', 'unknown', 'anonymous')""",
    "p7_items": "select container_id, count(distinct doc_id) as items, 0::bigint as needless_splits, 0::bigint as over_full from containers, documents where capacity_tokens > 0 group by 1",
    "p8_uses": "select distinct mix_name, source, true as within_repeats from mix_targets where target_share > 0 and max_repeats > 0",
    "p9_lost": "select distinct doc_id from documents where contains(text, chr(65533))",
}
