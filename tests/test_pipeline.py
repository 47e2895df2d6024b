"""The whole run on tiny versions: ingest, duplicate, approval, removal, failure, stream."""

import json

import pytest
from pyspark.sql import functions as F

from marginalis.operators import checks
from marginalis.plans.pipeline import Version, execute, process_versions, reconcile_output
from marginalis.schemas import ANNOTATION
from marginalis.sources import files, records
from marginalis.sources.store import Store


def rows(spark, items, sha="a" * 64):
    base = dict.fromkeys(ANNOTATION.fieldNames())
    made = []
    for i, (entry, author, comment, parent) in enumerate(items):
        made.append(tuple((base | {"ord": i, "source_sha256": sha, "entry_id": entry, "raw_author": author, "comment": comment, "relation_type": "REPLY" if parent else "ROOT", "parent_entry_id": parent, "root_entry_id": parent or entry, "xref": 10 + i, "pdf_page": 1, "book_page": "1", "import_candidate": True, "source_file": "f.pdf"}).values()))
    return spark.createDataFrame(made, ANNOTATION)


def version(sha, when="t1"):
    return Version("BOOK", sha * 64, "file", "f.pdf", "link", f"2024-01-01T00:00:0{when[1]}Z", 10, 3, f"2024-02-01T00:00:0{when[1]}Z")


def test_life_of_a_document(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    assert store.read("entries").count() == 0
    first = [("A", "user", "hello", None), ("B", "alias", "reply", "A")]
    r = execute(store, version("a"), rows(spark, first), {"alias": "Full Name"})
    assert r.action == "PROCESSED" and r.counts["new"] == 2
    assert {x.entry_id: x.canonical_author for x in store.read("entries").collect()} == {"A": "", "B": "Full Name"}
    assert store.read("review").count() == 1 and store.read("history").count() == 2 and store.read("documents").first().status == "NEEDS_AUTHOR_REVIEW"
    # the same version again writes nothing
    before = store.state()
    assert execute(store, version("a"), rows(spark, first), {"alias": "Full Name"}).action == "DUPLICATE_VERSION" and store.state() == before
    # a known version with other content fails before any write
    with pytest.raises(checks.CheckFailed):
        execute(store, version("a"), rows(spark, [("A", "user", "changed", None)]), {"alias": "Full Name"})
    assert store.state() == before
    # an approval becomes a rule and resolves the author of the known version
    decided = store.read("review").withColumns({"decision": F.lit("APPROVE"), "canonical_author": F.lit("Ann Lee")})
    store.commit(replace={"review": decided}, document="BOOK")
    r = execute(store, version("a"), rows(spark, first), {"alias": "Full Name"})
    assert (r.action, r.promoted_rules, r.counts["author_updated"]) == ("PROCESSED", 1, 1)
    assert store.read("documents").first().status == "PROCESSED" and store.read("versions").count() == 1
    assert execute(store, version("a"), rows(spark, first), {"alias": "Full Name"}).promoted_rules == 0
    # the next version changes one entry, drops one, adds one
    second = [("A", "user", "hello again", None), ("C", "alias", "new", None)]
    r = execute(store, version("b", "t2"), rows(spark, second, "b" * 64), {"alias": "Full Name"})
    assert (r.counts["new"], r.counts["updated"], r.counts["removed"]) == (1, 1, 1)
    state = {x.entry_id: (x.active, x.first_seen, x.source_state) for x in store.read("entries").collect()}
    assert state["B"] == (False, "2024-02-01T00:00:01Z", "HISTORICAL") and state["A"][:2] == (True, "2024-02-01T00:00:01Z") and state["C"][1] == "2024-02-01T00:00:02Z"
    assert store.read("versions").count() == 2 and store.read("history").count() == 2 + 1 + 3


def test_batch_order_failure_and_dry_run(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    good, broken = rows(spark, [("A", "x y", "1", None)]), rows(spark, [("A", "x", "1", None), ("A", "x", "2", None)], "c" * 64)
    assert process_versions(store, [(version("a"), good)], dry_run=True) == [{"file": "f.pdf", "action": "DRY_RUN", "import_candidates": 1}] and store.state() == {}
    done = process_versions(store, [(version("c", "t2"), broken), (version("a"), good)])
    assert [d["action"] for d in done] == ["PROCESSED", "ERROR"]
    assert sorted(r.status for r in store.read("files").collect()) == ["ERROR", "PROCESSED"]


def test_stream_takes_a_batch_once(spark, tmp_path):
    from marginalis.streaming.incremental import start

    store = Store(spark, str(tmp_path / "store"))
    folder = str(tmp_path / "in")
    rows(spark, [("A", "x", "1", None)]).write.mode("append").parquet(folder)
    for _ in range(2):
        q = start(spark, folder, str(tmp_path / "cp"), store, "BOOK", "2024-02-01T00:00:00Z")
        q.awaitTermination(120)
        assert q.exception() is None
    assert store.read("entries").count() == 1 and store.read("history").count() == 1


def test_reconcile(spark):
    from marginalis.operators.output import VISIBLE

    a = rows(spark, [("A", "x", "1", None), ("B", "x", "2", None)]).withColumns({"reviewer": F.lit("R"), "annotation_id": F.col("entry_id")})
    stored = spark.createDataFrame([("r1", "A", "1", "1", "K", "Yes", "r", "T")], "row_no string, comment_id string, page string, comment string, category string, resolved string, replies string, annotation_type string")
    out = {r.comment_id: r for r in reconcile_output(a, stored).collect()}
    assert out["A"].stored_id == "r1" and out["A"].category == "K" and out["B"].stored_id is None and set(VISIBLE) <= set(out["A"].asDict())


def test_files_and_extraction(spark, tmp_path):
    for name, data in (("a.pdf", b"one"), ("b.pdf", b"bad"), ("c.txt", b"no")):
        (tmp_path / name).write_bytes(data)
    listed = files.list_files(spark, str(tmp_path))
    assert sorted(r.name for r in listed.collect()) == ["a.pdf", "b.pdf"]

    def reader(content, name):
        if content == b"bad":
            raise ValueError("unreadable")
        yield {"source_file": name, "comment": content.decode()}

    got = {r.path.rsplit("/", 1)[1]: r for r in files.extract(files.with_contents(spark, listed, str(tmp_path)), reader, ANNOTATION).collect()}
    assert got["a.pdf"].comment == "one" and got["a.pdf"].error is None and len(got["a.pdf"].sha256) == 64 and got["b.pdf"].error == "ValueError: unreadable"


def test_records(spark, tmp_path):
    table = records.records_of(spark, [["A", "", "B"], ["1"], ["", None], [None, "x", 2]])
    assert [tuple(r) for r in table.collect()] == [("1", ""), ("", "2")] and table.columns == ["A", "B"]
    assert records.records_of(spark, []).columns == []
    for name, data in (("list", [{"k": "a", "v": "1"}]), ("map", {"a": {"v": "1"}, "b": {"v": "2"}})):
        (tmp_path / f"{name}.json").write_text(json.dumps(data))
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("k string, v string")
    assert [tuple(r) for r in records.keyed_json(spark, str(tmp_path / "list.json"), schema, "k").collect()] == [("a", "1")]
    assert sorted(tuple(r) for r in records.keyed_json(spark, str(tmp_path / "map.json"), schema, "k").collect()) == [("a", "1"), ("b", "2")]
    (tmp_path / "h.json").write_text(json.dumps({"schema_version": 1, "entry_id_to_author": {" x ": "Ann"}}))
    assert [tuple(r) for r in records.historical_authors(spark, str(tmp_path / "h.json")).collect()] == [("x", "Ann")]
    (tmp_path / "h.json").write_text(json.dumps({"x": " "}))
    with pytest.raises(ValueError):
        records.historical_authors(spark, str(tmp_path / "h.json"))
    assert records.load_config(None)["empty_annotation_rules"] == {"default": "keep"}
    assert records.document_key({"document_key": "a-b c"}, {}) == "A_B_C" == records.document_key({"document_key": "z"}, {"DOCUMENT_KEY": "a-b c"})
    with pytest.raises(ValueError):
        records.document_key({}, {})
    records.write_outputs(spark.createDataFrame([("1", "2")], "a string, b string"), str(tmp_path / "out"), ["b"])
    assert spark.read.option("header", "true").csv(str(tmp_path / "out/annotations_csv")).columns == ["b"]


def test_rows_without_a_hash_are_logged(spark, tmp_path):
    from marginalis.streaming.incremental import ingest

    store = Store(spark, str(tmp_path / "store"))
    lost = rows(spark, [("B", "x", "1", None)], None).unionByName(rows(spark, [("C", "x", "1", None)], "").withColumn("source_file", F.lit("g.pdf")))
    batch = rows(spark, [("A", "x", "1", None)]).unionByName(lost)
    done = ingest(batch, store, "BOOK", "2024-02-01T00:00:00Z")
    assert sorted((d["file"], d["action"]) for d in done) == [("f.pdf", "ERROR"), ("f.pdf", "PROCESSED"), ("g.pdf", "ERROR")]
    assert sorted(r.status for r in store.read("files").collect()) == ["ERROR", "ERROR", "PROCESSED"]
    assert [r.entry_id for r in store.read("entries").collect()] == ["A"]
