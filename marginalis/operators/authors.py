"""Author resolution by scoped, prioritised rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S

# Scopes of rules, and their priority.
PRIORITY = {"ENTRY": 500, "THREAD": 400, "VERSION": 300, "DOCUMENT_RAW": 200, "GLOBAL_ALIAS": 100}

RULE = "rule_id string, scope string, document_key string, version_id string, root_entry_id string, entry_id string, raw_author string, canonical_author string, status string, rule_ord long"


def alias_rules(spark: SparkSession, aliases: dict[str, str]) -> DataFrame:
    """Rules of scope GLOBAL_ALIAS from a map; generic and blank names give none."""
    if not isinstance(aliases, dict):
        raise TypeError("reviewer aliases must be a map")
    kept = [(a, c) for a, c in aliases.items() if a and " ".join(a.split()).lower() not in S.GENERIC_AUTHORS and c and c.strip()]
    rows = [(f"ALIAS::{' '.join(a.split()).lower()}", "GLOBAL_ALIAS", None, None, None, None, a, c.strip(), "APPROVED", i) for i, (a, c) in enumerate(kept)]
    return spark.createDataFrame(rows, RULE)


def effective_rules(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both rule tables; at a tie the first one's rules win, each in its order."""
    return first.withColumn("rule_source", F.lit(0)).unionByName(second.withColumn("rule_source", F.lit(1)))


def clean_rules(rules: DataFrame) -> DataFrame:
    """Rules with an id and an author, scope and status in upper case.  A null
    status, as in tables without that column, means APPROVED, a blank one not."""
    return rules.where((S.strip(F.col("rule_id")) != "") & (S.strip(F.col("canonical_author")) != "")).withColumns(
        {"scope": F.upper(S.strip(F.col("scope"))), "status": F.upper(S.strip(F.coalesce("status", F.lit("APPROVED")))), "canonical_author": S.strip(F.col("canonical_author"))}
    )


def _raw_key(col: Column) -> Column:
    """Equal where raw authors match: generic names to the letter, others in any case."""
    return F.when(S.is_generic(col), F.concat(F.lit("="), S.collapse(col))).otherwise(F.concat(F.lit("~"), S.raw_author(col)))


def resolve_authors(entries: DataFrame, rules: DataFrame, historical: DataFrame | None = None) -> DataFrame:
    """Replace canonical_author, author_status, author_resolution_method and
    author_rule_id of entries by what the rules say.

    A historical author of the entry id goes before all rules.  Else the rule
    with the highest scope wins, at a tie the first in order.  VERSION and
    DOCUMENT_RAW rules match their raw author, a blank one blank authors only;
    THREAD and ENTRY rules with a blank raw author match any.  Aliases of
    generic names are ignored.  Unmatched entries stay unresolved.

    Plan: one equi join per scope, not one join on five alternatives.  Rules
    are reduced to one per key first, so no join multiplies rows, and the best
    of the up to five matches is a struct comparison within the row: no shuffle
    of the entries beyond the joins', which broadcast while rules are small.
    """
    rules = clean_rules(rules).where("status = 'APPROVED'")
    if "rule_source" not in rules.columns:
        rules = rules.withColumn("rule_source", F.lit(0))
    k = lambda c: S.strip(F.col(c))
    any_raw = F.lit("*")
    raw = _raw_key(F.col("raw_author"))
    keys = {
        "ENTRY": ([k("document_key"), k("entry_id")], True),
        "THREAD": ([k("document_key"), k("root_entry_id")], True),
        "VERSION": ([k("version_id")], False),
        "DOCUMENT_RAW": ([k("document_key")], False),
        "GLOBAL_ALIAS": ([], False),
    }
    out = entries.withColumn("_raw", raw)
    options = []
    for scope, (parts, blank_is_any) in keys.items():
        named = S.strip(F.col("raw_author")) != ""
        rule_raw = F.when(named, raw).otherwise(any_raw) if blank_is_any else raw
        own = rules.where(F.col("scope") == scope)
        if scope == "GLOBAL_ALIAS":
            own = own.where(~S.is_generic(F.col("raw_author")))
        for p in parts:
            own = own.where(p != "")
        key = F.concat_ws("\x1f", *parts, rule_raw)
        best = own.groupBy(key.alias(f"_{scope}")).agg(F.min(F.struct("rule_source", "rule_ord", "rule_id", "canonical_author")).alias(f"_r{scope}"))
        for variant in (("_raw", "any") if blank_is_any else ("_raw",)):
            name = f"_m{scope}{variant}"
            mine = F.concat_ws("\x1f", *parts, F.col("_raw") if variant == "_raw" else any_raw)
            out = out.withColumn("_k", mine).join(best.select(F.col(f"_{scope}").alias("_k"), F.col(f"_r{scope}").alias(name)), "_k", "left").drop("_k")
            options.append(F.when(F.col(name).isNotNull(), F.struct(F.lit(-PRIORITY[scope]).alias("p"), F.col(f"{name}.rule_source").alias("s"), F.col(f"{name}.rule_ord").alias("o"), F.col(f"{name}.rule_id").alias("rule_id"), F.col(f"{name}.canonical_author").alias("author"), F.lit(scope).alias("scope"))))
    out = out.withColumn("_best", F.array_min(F.array_compact(F.array(*options))))
    if historical is not None:
        past = historical.groupBy(S.strip(F.col("entry_id")).alias("_hid")).agg(F.min(S.blank_null(F.col("canonical_author"))).alias("_past"))
        out = out.join(past, S.strip(out["entry_id"]) == F.col("_hid"), "left").drop("_hid")
    else:
        out = out.withColumn("_past", F.lit(None).cast("string"))
    found = F.coalesce("_past", F.col("_best.author"))
    result = out.withColumns(
        {
            "canonical_author": F.coalesce(found, F.lit("")),
            "author_status": F.when(found.isNotNull(), "RESOLVED").otherwise("UNRESOLVED"),
            "author_resolution_method": F.when(F.col("_past").isNotNull(), "HISTORICAL_NATIVE_ID")
            .when(F.col("_best").isNotNull(), F.col("_best.scope"))
            .when(S.is_generic(F.col("raw_author")), "GENERIC_RAW_UNRESOLVED")
            .otherwise("DISTINCTIVE_RAW_UNMAPPED"),
            "author_rule_id": F.when(F.col("_past").isNull(), F.coalesce(F.col("_best.rule_id"), F.lit(""))).otherwise(F.lit("")),
        }
    )
    return result.drop(*[c for c in result.columns if c.startswith("_")])


def author_summary(entries: DataFrame, by: list[str]) -> DataFrame:
    """Per group: entries, resolved and unresolved ones, canonical authors
    without blanks and unresolved raw authors with them, each sorted."""
    resolved = F.coalesce(F.col("author_status"), F.lit("")) == "RESOLVED"
    order = lambda c: F.array_join(F.transform(F.array_sort(F.transform(c, lambda x: F.struct(F.lower(x).alias("l"), x.alias("v")))), lambda s: s["v"]), "; ")
    return entries.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if(resolved).alias("resolved"),
        F.count_if(~resolved).alias("unresolved"),
        order(F.collect_set(F.when(resolved, S.blank_null(F.col("canonical_author"))))).alias("canonical_authors"),
        order(F.collect_set(F.when(~resolved, S.strip(F.col("raw_author"))))).alias("unresolved_raw_authors"),
    )
