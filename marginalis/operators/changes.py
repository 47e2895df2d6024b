"""Change plans of entries against stored state, and the writes that follow."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

AUTHOR_FIELDS = ("canonical_author", "author_status", "author_resolution_method", "author_rule_id")
CHANGES = ("NEW", "UPDATED", "AUTHOR_UPDATED", "UNCHANGED", "REMOVED")


def change_plan(current: DataFrame, previous: DataFrame, keys: tuple[str, ...] = ("document_key", "entry_id"), author_fields: tuple[str, ...] = AUTHOR_FIELDS) -> DataFrame:
    """(keys, change_type, current, previous): how each entry changes.

    Both sides have the keys and entry_signature, previous also active; both
    are unique by key (see ``checks``).  NEW without a previous row; UPDATED if
    that was inactive or the signature differs; AUTHOR_UPDATED if only author
    fields do; else UNCHANGED; REMOVED if active and gone.  Inactive and gone
    is no change.  One full outer join on the keys.
    """
    c = current.select(*[F.col(k).alias(f"c_{k}") for k in keys], F.struct(*current.columns).alias("current"))
    p = previous.select(*[F.col(k).alias(f"p_{k}") for k in keys], F.struct(*previous.columns).alias("previous"))
    on = [F.col(f"c_{k}") == F.col(f"p_{k}") for k in keys]
    joined = c.join(p, on, "full_outer")
    was_active = S.is_active(F.col("previous.active"))
    differs = F.lit(False)
    for f in author_fields:
        if f in current.columns and f in previous.columns:
            differs = differs | (S.strip(F.col(f"current.{f}")) != S.strip(F.col(f"previous.{f}")))
    change = (
        F.when(F.col("previous").isNull(), "NEW")
        .when(F.col("current").isNull(), F.when(was_active, "REMOVED"))
        .when(~was_active, "UPDATED")
        .when(S.strip(F.col("current.entry_signature")) != S.strip(F.col("previous.entry_signature")), "UPDATED")
        .when(differs, "AUTHOR_UPDATED")
        .otherwise("UNCHANGED")
    )
    return joined.select(*[F.coalesce(f"c_{k}", f"p_{k}").alias(k) for k in keys], change.alias("change_type"), "current", "previous").where("change_type is not null")


def change_counts(plan: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One column per kind of change, kinds without changes as 0."""
    return plan.groupBy(*(by or [])).agg(*[F.count_if(F.col("change_type") == c).alias(c.lower()) for c in CHANGES])


@dataclass(frozen=True)
class Mutations:
    inserts: DataFrame
    updates: DataFrame
    deactivations: DataFrame
    history: DataFrame


def mutations(plan: DataFrame, recorded_at: str, columns: list[str]) -> Mutations:
    """The writes of a plan: rows to insert, update and deactivate, with the
    ``columns`` that both sides have, and the audit rows.

    ``recorded_at`` is a parameter, so that a plan gives the same rows however
    often it runs.  Updates keep a stored first_seen; removals are copies of
    the stored row, inactive and HISTORICAL; UNCHANGED writes nothing.
    """
    now = F.lit(recorded_at)
    side = lambda s: [F.col(f"{s}.{c}").alias(c) for c in columns]
    new, removed = plan.where("change_type = 'NEW'"), plan.where("change_type = 'REMOVED'")
    updated = plan.where("change_type in ('UPDATED', 'AUTHOR_UPDATED')")
    live = {"active": F.lit(True), "source_state": F.lit("CURRENT"), "last_seen": now}
    inserts = new.select(*side("current")).withColumns(live | {"first_seen": now})
    updates = updated.select(*side("current"), F.coalesce(S.blank_null(F.col("previous.first_seen")), now).alias("first_seen")).withColumns(live)
    gone = removed.select(*side("previous"), F.coalesce(S.blank_null(F.col("previous.first_seen")), now).alias("first_seen")).withColumns({"active": F.lit(False), "source_state": F.lit("HISTORICAL"), "last_seen": now})
    return Mutations(inserts, updates, gone, history_rows(plan, recorded_at, columns))


def history_rows(plan: DataFrame, recorded_at: str, columns: list[str]) -> DataFrame:
    """One audit row per change but UNCHANGED: the current values, of removals
    the previous ones, and the signature before."""
    value = lambda c: F.when(F.col("current").isNotNull(), F.col(f"current.{c}")).otherwise(F.col(f"previous.{c}"))
    rest = [c for c in columns if c not in ("document_key", "entry_id", "entry_signature")]
    return plan.where("change_type <> 'UNCHANGED'").select(
        F.concat_ws("::", "document_key", "entry_id", S.text(value("version_id")) if "version_id" in columns else F.lit(""), "change_type").alias("history_key"),
        "document_key", "entry_id", "change_type",
        S.text(value("entry_signature")).alias("entry_signature"),
        S.text(F.col("previous.entry_signature")).alias("previous_signature"),
        *[value(c).alias(c) for c in rest],
        (F.col("change_type") != "REMOVED").alias("active"),
        F.when(F.col("change_type") == "REMOVED", "HISTORICAL").otherwise("CURRENT").alias("source_state"),
        F.lit(recorded_at).alias("recorded_at"),
    )


def apply_mutations(stored: DataFrame, m: Mutations, keys: tuple[str, ...] = ("document_key", "entry_id")) -> DataFrame:
    """The stored table after the writes: untouched rows and the written ones."""
    names = stored.columns
    touched = m.updates.select(*keys).unionByName(m.deactivations.select(*keys))
    kept = stored.join(touched, list(keys), "left_anti").select(*names)
    full = lambda df: df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in names])
    return kept.unionByName(full(m.updates)).unionByName(full(m.deactivations)).unionByName(full(m.inserts))


def ledger_upsert(rows: DataFrame, ledger: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, action, fields): a ledger's merge by key: inserted, updated (a
    field differs, null being a value), unchanged or kept (only in the ledger)."""
    new = rows.select(F.col(key).alias("_n"), F.struct(*fields).alias("new"))
    old = ledger.select(F.col(key).alias("_o"), F.struct(*fields).alias("old"))
    differs = F.lit(False)
    for f in fields:
        differs = differs | ~F.col(f"new.{f}").eqNullSafe(F.col(f"old.{f}"))
    j = new.join(old, F.col("_n") == F.col("_o"), "full_outer")
    action = F.when(F.col("_o").isNull(), "inserted").when(F.col("_n").isNull(), "kept").when(differs, "updated").otherwise("unchanged")
    return j.select(F.coalesce("_n", "_o").alias(key), action.alias("action"), *[F.when(F.col("_n").isNotNull(), F.col(f"new.{f}")).otherwise(F.col(f"old.{f}")).alias(f) for f in fields])
