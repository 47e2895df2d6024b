"""Every query with an oracle gives the same rows as DuckDB on the same tables."""

import pytest

import __spark_entry__ as entry
from conftest import SMALL, compare_with_oracle
from marginalis.plans import backend_queries, change_queries, reference_queries

CORE = [change_queries, reference_queries, backend_queries]
NAMED = [(n, m) for m in CORE for n in m.QUERIES]


@pytest.mark.parametrize("name,module", [(n, m) for n, m in NAMED if n in m.ORACLES], ids=[n for n, m in NAMED if n in m.ORACLES])
def test_same_rows(spark, name, module):
    compare_with_oracle(spark, name, module.QUERIES[name], module.ORACLES[name])


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {n for n, _ in NAMED} <= set(entry.queries())


def test_normalize_text_by_brute_force(spark):
    import re
    import unicodedata

    rows = change_queries.table(spark, SMALL, "documents").select("doc_id", "text").collect()
    got = dict((r[0], r[1]) for r in reference_queries.q04_normalize_text(spark, SMALL).collect())
    for doc, text in rows:
        made = unicodedata.normalize("NFKC", text or "").translate({0x200A: " ", 0x200E: " ", 0x200F: " "})
        assert got[doc] == re.sub(r"[ \t-\r\x85\xa0  -     　]+", " ", made).strip(" ")


def test_merged_rows_of_every_match(spark):
    merged = entry.queries()["q19_merged_rows"](spark, SMALL)
    counted = {r["match"]: r["n"] for r in entry.queries()["q18_output_upsert"](spark, SMALL).collect()}
    assert {r["match"]: r["count"] for r in merged.groupBy("match").count().collect()} == counted and len(counted) > 1
    assert merged.select("author", "comment_id").distinct().count() == merged.count()


def test_output_rows_of_every_match(spark):
    rows = entry.queries()["q18_output_rows"](spark, SMALL).collect()
    assert len({(r.reviewer, r.comment_id) for r in rows}) == len(rows) and {r["match"] for r in rows} > {"ID"}
    assert all((r.stored_id is None) == (r["match"] in ("NONE", "AMBIGUOUS")) for r in rows)
