"""A run over a folder, and the router, with an extractor that reads JSON lines."""

import json

import pytest
from pyspark.sql import functions as F

from marginalis.operators import database, output, pages, summaries
from marginalis.plans.folder import process_folder, synchronize
from marginalis.sources import records
from marginalis.sources.store import Store
from test_pipeline import rows, version


def lines(*items):
    return "\n".join(json.dumps(x) for x in items).encode()


def test_folder(spark, tmp_path, monkeypatch):
    def reader(content, name):
        import json as j

        if content.startswith(b"broken"):
            raise ValueError("unreadable")
        for i, line in enumerate(content.decode().splitlines()):
            yield {"ord": i, "rect_x0": 1.0, "rect_y0": 2.0, "rect_x1": 3.0, "rect_y1": 4.0, "footer_candidates": []} | j.loads(line)

    folder, store = tmp_path / "in", Store(spark, str(tmp_path / "store"))
    folder.mkdir()
    first = {"annotation_id": "n1", "comment": "Check this", "raw_author": "user", "annotation_type": "Highlight", "xref": 5, "parent_xref": 0, "pdf_page": 1, "page_text": "Known  page", "created": "D:20250213063711Z00'00'"}
    reply = {"annotation_id": "n2", "comment": "Done", "raw_author": "ann", "annotation_type": "Text", "xref": 6, "parent_xref": 5, "relation_raw": "/R", "pdf_page": 2, "page_label": "iv", "footer_candidates": ["7"]}
    empty = {"comment": "", "raw_author": "Bea Cole", "annotation_type": "Ink", "xref": 7, "parent_xref": 0, "pdf_page": 3, "footer_candidates": ["9"]}
    (folder / "BOOK_Sara Khalil.pdf").write_bytes(lines(first, reply, empty))
    (folder / "bad.pdf").write_bytes(b"broken")
    (folder / "note.txt").write_bytes(b"no")
    master = pages.master_index(spark.createDataFrame([("Known page", 12, "12")], "text string, pdf_page int, book_page string"), "text", "pdf_page", "book_page")
    config = records.load_config(None) | {"document_key": "book", "reviewer_aliases": {"ann": "Ann Lee"}, "empty_annotation_rules": {"ink": "skip", "default": "keep"}, "recipients": {"ADMIN": ["a@x.invalid"]}}
    go = lambda **k: process_folder(store, str(folder), reader, config, master, "2026-01-01T00:00:00Z", **k)
    dry = go(dry_run=True)
    assert dry.files_seen == 2 and {r["action"] for r in dry.results} == {"DRY_RUN", "ERROR"} and store.state() == {}
    sent = []
    monkeypatch.setenv("NOTIFICATIONS_ENABLED", "yes")
    run = go(send=sent.append)
    done = {r["file"]: r for r in run.results}
    assert done["bad.pdf"]["action"] == "ERROR" and "unreadable" in done["bad.pdf"]["error"] and done["BOOK_Sara Khalil.pdf"]["new"] == 3
    e = {r.entry_id: r for r in store.read("entries").collect()}
    fallback = next(k for k in e if k.startswith("fallback:"))
    assert (e["n1"].book_page, e["n1"].created_date, e["n2"].book_page, e[fallback].book_page) == ("12", "2025-02-13T06:37:11+00:00", "iv", "")
    assert (e["n2"].parent_entry_id, e["n2"].root_entry_id, e["n2"].reply_depth, e["n2"].canonical_author) == ("n1", "n1", 1, "Ann Lee")
    codes = {(r.file, r.code) for r in run.alerts.collect()}
    assert ("bad.pdf", "PDF_PROCESSING_ERROR") in codes and {c for f, c in codes if f != "bad.pdf"} == {"PDF_PROCESSED", "PAGE_MAPPING_UNRESOLVED", "NEEDS_REVIEW"}
    assert run.delivered == len(sent) == len(codes)
    # nothing has changed since: nothing is read
    again = process_folder(store, str(folder), lambda *_: pytest.fail("read"), config, master, "2026-01-02T00:00:00Z")
    assert [r["action"] for r in again.results] == ["SKIP_UNCHANGED"] * 2
    assert process_folder(store, str(tmp_path / "in"), reader, config, master, "x", pattern="*.none").files_seen == 0


def annotation(spark, items):
    return rows(spark, [(i, "x y", c, None) for i, c, *_ in items]).withColumns(
        {"identity_key": F.concat(F.lit("k-"), "entry_id"), "annotation_id": F.col("entry_id"), "reviewer": F.lit("Ann Lee"), "annotation_type": F.lit("Text")}
    )


def test_flat_table_upsert(spark):
    a = annotation(spark, [("A", "one"), ("B", "two"), ("C", "three"), ("A", "again"), ("D", "no page"), ("E", "skipped")]).withColumns({"book_page": F.when(F.col("entry_id") == "D", "").otherwise("1"), "import_candidate": F.col("entry_id") != "E"})
    empty = database.database_rows(a.limit(0), F.lit("f"), F.lit("l"), F.lit("t0"))
    first = database.upsert_database(a, empty, F.lit("f"), F.lit("l"), "t1")
    assert first.stats.first().asDict() == {"inserted": 4, "updated": 0, "unchanged": 1, "skipped": 1, "needs_review": 1}
    stored = spark.createDataFrame(first.table.collect(), first.table.schema)
    b = annotation(spark, [("A", "one"), ("B", "changed"), ("N", "new")])
    second = database.upsert_database(b, stored, F.lit("f"), F.lit("l"), "t2")
    assert {r.annotation_key: r.action for r in second.actions.collect()} == {"k-A": "unchanged", "k-B": "updated", "k-N": "inserted", "k-C": "kept", "k-D": "kept"}
    seen = {r.annotation_key: (r.comment, r.first_seen, r.last_seen) for r in second.table.collect()}
    assert seen["k-A"] == ("one", "t1", "t1") and seen["k-B"] == ("changed", "t1", "t2") and seen["k-N"] == ("new", "t2", "t2")
    assert database.upsert_database(b.limit(0), empty, F.lit("f"), F.lit("l"), "t").stats.first().asDict() == dict.fromkeys(("inserted", "updated", "unchanged", "skipped", "needs_review"), 0)


STORED = "tab string, row_no string, " + ", ".join(f"{c} string" for c in output.VISIBLE)


def test_reconcile_by_tables(spark):
    flat = database.database_rows(annotation(spark, [("A", "one"), ("B", "two")]), F.lit("f"), F.lit("l"), F.lit("t"))
    other = flat.withColumns({"reviewer": F.lit("Bea"), "annotation_key": F.concat("annotation_key", F.lit("2"))})
    both = flat.unionByName(other).unionByName(flat.where("annotation_id = 'A'").withColumn("active", F.lit("FALSE")))
    visible = {r.comment_id: r for r in database.eligible_database(flat).collect()}
    same = ("Ann's", "r1", *[visible["A"][c] for c in output.VISIBLE])
    # the same comment in another's table is none of hers
    stored = spark.createDataFrame([same, ("Bea", "r2", "", "", "1", "two", "Own", "", "", "", "Yes", "re", "", "Note")], STORED)
    made, stats = database.reconcile(both, stored, {"Ann Lee": "Ann's"})
    got = {(r.tab, r.comment_id): (r.write, r.category, r.resolved) for r in made.collect()}
    assert got == {("Ann's", "A"): ("UNCHANGED", "", ""), ("Ann's", "B"): ("INSERT", "", ""), ("Bea", "A"): ("INSERT", "", ""), ("Bea", "B"): ("UPDATE", "Own", "Yes")}
    assert {r.tab: (r.reviewer, r.eligible, r.inserted, r.updated, r.unchanged) for r in stats.collect()} == {"Ann's": ("Ann Lee", 2, 1, 0, 1), "Bea": ("Bea", 2, 1, 1, 0)}
    totals = database.reconcile_totals(both, stats).first()
    assert (totals.database_records, totals.eligible_records, totals.skipped_records, totals.reviewers) == (5, 4, 1, 2)
    with pytest.raises(ValueError, match="no name"):
        database.reconcile(both, stored, {"Bea": " "})
    with pytest.raises(ValueError, match="several"):
        database.reconcile(both, stored.unionByName(stored.where("row_no = 'r2'").withColumn("row_no", F.lit("r3"))), {})
    assert set(output.VISIBLE) - set(database.public_view(made).columns) == set(database.HIDDEN)


def test_router(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    a = rows(spark, [("A", "user", "1", None)])
    done = synchronize(store, version("a"), a, True)
    assert (done.mode, done.duplicate, done.stats["inserted"], done.stats["needs_review"], done.stats["output_inserted"]) == ("V2", False, 1, 1, 0)
    known = synchronize(store, version("a"), a, True)
    assert known.duplicate and known.stats["unchanged"] == 1 and known.stats["inserted"] == 0
    assert sorted((r.status, r.message_error) for r in store.read("files").collect()) == [("DUPLICATE", "Known v2 document version"), ("PROCESSED", "")]
    with pytest.raises(ValueError, match="needs"):
        synchronize(store, version("b"), a, False)
    b = annotation(spark, [("A", "one")])
    flat = database.database_rows(b.limit(0), F.lit(""), F.lit(""), F.lit(""))
    old = synchronize(store, version("b"), b, False, flat, spark.createDataFrame([], STORED))
    assert (old.mode, old.stats["inserted"], old.stats["output_inserted"], old.duplicate) == ("LEGACY", 1, 1, False)


def test_summaries(spark):
    r = rows(spark, [("A", "b", "1", None), ("B", "A", "2", "A"), ("C", "c", "", None)]).withColumns({"book_page": F.when(F.col("entry_id") == "A", "10").when(F.col("entry_id") == "B", "9"), "entry_type": F.lit("COMMENT"), "import_candidate": F.col("comment") != "", "skip_reason": F.when(F.col("comment") == "", "empty_ink").otherwise("")})
    s = summaries.file_summary(r, ["source_file"]).first()
    assert (s.book_pages, s.raw_authors, s.skipped, s.pages_unresolved, s.comments_found) == (["9", "10"], ["A", "b", "c"], 1, [1], 3)
    pages_ = summaries.file_summary(r.withColumn("book_page", F.element_at(F.array(F.lit("x"), F.lit("010"), F.lit("iv")), F.col("ord") + 1)), ["source_file"]).first().book_pages
    assert pages_ == ["010", "iv", "x"]
    assert summaries.skipped_by_reason(r, ["source_file"]).first().skipped == {"empty_ink": 1}
    index = spark.createDataFrame([("f", "1", 30), ("g", "2", 12)], "fingerprint string, book_page string, master_pdf_page int")
    meta = summaries.master_metadata(index, F.lit("abcdef0123456789"))
    assert tuple(meta.select("version", "expected_pages", "fingerprint_count").first()) == ("sha256:abcdef012345", 30, 2)
    assert summaries.master_metadata(index.limit(0), F.lit("ab")).first().expected_pages == 0
    files = spark.createDataFrame([("a", 40, 40), ("b", 40, 31), ("c", 0, 0), ("d", None, None)], "file string, pages int, pages_mapped int")
    got = {x.file: (x.mapping_coverage, x.pages_beyond_master, x.master_mismatch_suspected) for x in summaries.master_compatibility(files, meta).collect()}
    assert got == {"a": (1.0, 10, False), "b": (0.775, 10, True), "c": (0.0, 0, False), "d": (0.0, 0, False)}


def test_command_line(spark, tmp_path, capsys):
    from marginalis.__main__ import main

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.pdf").write_bytes(b"no document")
    (tmp_path / "m.json").write_text(json.dumps({"f": {"book_page": "1", "master_pdf_page": 1}}))
    (tmp_path / "c.json").write_text(json.dumps({"document_key": "book"}))
    store = str(tmp_path / "store")
    assert main(["folder", str(tmp_path / "in"), "--store", store, "--config", str(tmp_path / "c.json"), "--master", str(tmp_path / "m.json")]) == 1
    said = json.loads(capsys.readouterr().out)
    assert said["files_seen"] == 1 and said["results"][0]["action"] == "ERROR"
    assert main(["tables", "--store", store]) == 0 and json.loads(capsys.readouterr().out)["files"] == 1
