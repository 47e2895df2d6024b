"""Cases of the review-annotation operators, on tiny tables."""

import pytest
from pyspark.sql import functions as F

from marginalis.functions import scalars as S
from marginalis.operators import alerts, authors, changes, checks, output, pages, registry, review

PREVIOUS = "document_key string, entry_id string, entry_signature string, active string, canonical_author string, author_status string, first_seen string"
CURRENT = "document_key string, entry_id string, entry_signature string, canonical_author string, author_status string"


def plan(spark, current, previous):
    c = spark.createDataFrame([("B", e, s, a, "RESOLVED") for e, s, a in current], CURRENT)
    p = spark.createDataFrame([("B", e, s, f, a, "RESOLVED", "T0") for e, s, f, a in previous], PREVIOUS)
    return changes.change_plan(c, p)


def kinds(p):
    return {r.entry_id: r.change_type for r in p.select("entry_id", "change_type").collect()}


def test_mixed_diff_and_mutations(spark):
    p = plan(spark, [("A", "same", "x"), ("B", "new", "x"), ("D", "brand", "x")], [("A", "same", "true", "x"), ("B", "old", "true", "x"), ("C", "gone", "true", "x")])
    assert kinds(p) == {"A": "UNCHANGED", "B": "UPDATED", "C": "REMOVED", "D": "NEW"}
    assert changes.change_counts(p).first().asDict() == {"new": 1, "updated": 1, "author_updated": 0, "unchanged": 1, "removed": 1}
    m = changes.mutations(p, "NOW", ["document_key", "entry_id", "entry_signature"])
    assert (m.inserts.count(), m.updates.count(), m.deactivations.count(), m.history.count()) == (1, 1, 1, 3)
    assert m.updates.first().first_seen == "T0" and m.updates.first().last_seen == "NOW"
    gone = m.deactivations.first()
    assert not gone.active and gone.source_state == "HISTORICAL" and gone.last_seen == "NOW"
    stored = spark.createDataFrame([("B", e, s, True, "CURRENT", "T0", "T0") for e, s in (("A", "same"), ("B", "old"), ("C", "gone"))], "document_key string, entry_id string, entry_signature string, active boolean, source_state string, first_seen string, last_seen string")
    after = {r.entry_id: (r.entry_signature, r.active) for r in changes.apply_mutations(stored, m).collect()}
    assert after == {"A": ("same", True), "B": ("new", True), "C": ("gone", False), "D": ("brand", True)}


def test_reappearing_gone_and_author_only(spark):
    assert kinds(plan(spark, [("A", "s", "x")], [("A", "s", "false", "x")])) == {"A": "UPDATED"}
    assert kinds(plan(spark, [], [("A", "s", "no", "x")])) == {} == kinds(plan(spark, [], [("A", "s", None, "x")]))
    assert kinds(plan(spark, [("A", "s", "y")], [("A", "s", "yes", "x")])) == {"A": "AUTHOR_UPDATED"}
    assert kinds(plan(spark, [], [])) == {}


def resolve(spark, entries, rules, historical=None):
    e = spark.createDataFrame(entries, "document_key string, version_id string, root_entry_id string, entry_id string, raw_author string")
    r = spark.createDataFrame([(*x, i) for i, x in enumerate(rules)], authors.RULE)
    h = None if historical is None else spark.createDataFrame(historical, "entry_id string, canonical_author string")
    return {x.entry_id: (x.canonical_author, x.author_status, x.author_resolution_method, x.author_rule_id) for x in authors.resolve_authors(e, r, h).collect()}


def rule(i, scope, author, raw="", doc="", version="", root="", entry="", status="APPROVED"):
    return (i, scope, doc, version, root, entry, raw, author, status)


def test_author_rules(spark):
    entries = [("D", "V", "t", str(i), raw) for i, raw in enumerate(["User", "user", "ALIASX", "", None, "other", "Ms  Y"])]
    rules = [
        rule("r1", "VERSION", "Ann", "User", version="V"), rule("r2", "GLOBAL_ALIAS", "Bob", "aliasx"), rule("r3", "GLOBAL_ALIAS", "Generic", "user"), rule("r4", "DOCUMENT_RAW", "Cy", "ms y", doc="D"),
        rule("r5", "DOCUMENT_RAW", "Later", "ms y", doc="D"), rule("r6", "ENTRY", "Eve", doc="D", entry="5"), rule("r7", "DOCUMENT_RAW", "Dee", "other", doc="D"), rule("r8", "ENTRY", "Off", doc="D", entry="3", status=""), rule("", "ENTRY", "No id", doc="D", entry="3"),
    ]
    got = resolve(spark, entries, rules)
    assert got["0"] == ("Ann", "RESOLVED", "VERSION", "r1") and got["1"] == ("", "UNRESOLVED", "GENERIC_RAW_UNRESOLVED", "")
    assert got["2"][:3] == ("Bob", "RESOLVED", "GLOBAL_ALIAS") and got["3"][1:3] == ("UNRESOLVED", "GENERIC_RAW_UNRESOLVED") == got["4"][1:3]
    assert got["5"] == ("Eve", "RESOLVED", "ENTRY", "r6") and got["6"] == ("Cy", "RESOLVED", "DOCUMENT_RAW", "r4")
    assert resolve(spark, entries, rules, [("5", "Old"), ("9", "X")])["5"] == ("Old", "RESOLVED", "HISTORICAL_NATIVE_ID", "")
    assert resolve(spark, [("D", "V", "t", "1", "zed")], [])["1"] == ("", "UNRESOLVED", "DISTINCTIVE_RAW_UNMAPPED", "")
    assert resolve(spark, [("D", "V", "t", "1", "zed")], [rule("t", "THREAD", "Tom", doc="D", root="t")])["1"][2] == "THREAD"
    aliases = authors.alias_rules(spark, {"one": "A B", "User": "C", "user": "D", "": "E", "two": " "})
    assert [r.raw_author for r in aliases.collect()] == ["one"]
    with pytest.raises(TypeError):
        authors.alias_rules(spark, ["x"])


def test_review_queue_promotion_and_human_columns(spark):
    e = spark.createDataFrame(
        [("B", "V", f"e{i}", "user" if i < 9 else "User", "UNRESOLVED", str(i % 3), "same text" if i % 2 else f"text {i}", i, i) for i in range(11)] + [("B", "V", "done", "x", "RESOLVED", "1", "t", 0, 0)],
        "document_key string, version_id string, entry_id string, raw_author string, author_status string, book_page string, content string, pdf_page int, xref int",
    )
    rows = {r.raw_author: r for r in review.review_queue(e, ["pdf_page", "xref"]).collect()}
    assert set(rows) == {"user", "User"} and rows["user"].entry_count == 9
    assert rows["user"].sample_entry_ids == "e0, e1, e2, e3, e4" and rows["user"].sample_pages == "0, 1, 2" and rows["user"].sample_content == "text 0 | same text | text 2"
    # without a book page the file's page, without a content the comment
    bare = e.where("entry_id in ('e3', 'e9')").withColumns({"book_page": F.lit(""), "comment": F.lit("said"), "content": F.when(F.col("entry_id") == "e9", F.col("content"))})
    assert {r.raw_author: (r.sample_pages, r.sample_content) for r in review.review_queue(bare, ["pdf_page"]).collect()} == {"user": ("3", "said"), "User": ("9", "same text")}
    stored = review.review_queue(e, ["pdf_page", "xref"]).where("raw_author = 'user'").withColumns({"entry_count": F.lit(1).cast("long"), "decision": F.lit(" approve "), "canonical_author": F.lit("Ann"), "rule_scope": F.lit("")})
    merged = {r.raw_author: r for r in review.review_upsert(review.review_queue(e, ["pdf_page", "xref"]), stored, ["decision", "canonical_author", "rule_scope"]).collect()}
    assert merged["user"].entry_count == 9 and merged["user"].canonical_author == "Ann" and merged["User"].write == "INSERT"
    none = spark.createDataFrame([], "rule_id string, scope string, document_key string, version_id string, root_entry_id string, entry_id string, raw_author string, canonical_author string, status string")
    fresh = review.promote_rules(stored, none)
    assert [(r.rule_id, r.scope, r.canonical_author) for r in fresh.collect()] == [("PM::B::V::user", "VERSION", "Ann")]
    assert review.promote_rules(stored, fresh).count() == 0
    with pytest.raises(Exception, match="stored rule differs"):
        review.promote_rules(stored, fresh.withColumn("canonical_author", F.lit("Bea"))).collect()
    with pytest.raises(Exception, match="must be VERSION"):
        review.promote_rules(stored.withColumn("rule_scope", F.lit("ENTRY")), none).collect()


def one(spark, *cols):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())


def test_scalars(spark):
    t = lambda x: F.lit(x).cast("string")
    assert one(spark, S.pdf_date(t("D:20240102030405+01'30'")), S.pdf_date(t("D:20240102030405Z")), S.pdf_date(t("D:20240102030405")), S.pdf_date(t(" odd ")), S.pdf_date(t(None))) == ("2024-01-02T03:04:05+01:30", "2024-01-02T03:04:05+00:00", "2024-01-02T03:04:05", "odd", "")
    assert one(spark, S.document_key(t(" igcse-arabic 2p ")), S.version_id(t("igcse arabic"), t("1" * 64)), S.version_id(t("x"), t("12"))) == ("IGCSE_ARABIC_2P", "IGCSE_ARABIC@" + "1" * 64, None)
    assert one(spark, *[S.footer_status(t(p), F.array(t(c))) for p, c in (("210", "210"), ("210", "211"), ("viii", "8"), ("٢١٠", "210"), (None, "1"), ("1", None))]) == ("footer_verified", "footer_mismatch", "", "footer_verified", "", "")
    assert one(spark, *[S.relation_type(t(p), t(r)) for p, r in ((None, None), ("0", "/Group"), ("5", "/Group"), ("5", "/R"), ("x", ""))]) == ("ROOT", "ROOT", "GROUP", "REPLY", "ROOT")
    assert one(spark, *[S.truthy(t(x)) for x in ("TRUE", "y", "no", None)], *[S.is_active(t(x)) for x in ("x", "Inactive", "", None, "0")]) == (True, True, False, False, True, False, False, False, False)
    keep, reason = S.should_import(t("Highlight"), t(" "), {"highlight": "skip", "default": "keep"})
    assert one(spark, keep, reason) == (False, "empty_highlight")
    aliases = {"aliasx": "Full Name"}
    assert one(spark, *[S.reviewer_name(t(r), t(f), aliases) for r, f in (("AliasX", ""), ("First Last", ""), ("user", "BOOK_aliasx.pdf"), ("user", "BOOK_aliasxy.pdf"), ("Name 12", ""))]) == ("Full Name", "First Last", "Full Name", "", "")
    # a full name in the file's own name, without numbers and common words; an explicit one goes first
    files = [("user", "IGCSE_ARABIC_2P_First Last.pdf"), ("user", "IGCSE_ARABIC_2P_Sara Khalil (final) 12.pdf"), ("user", "IGCSE_ARABIC_2P.pdf"), ("user", "One Two Three Four Five.pdf"), ("user", "Reviewer Ann.pdf")]
    assert one(spark, *[S.reviewer_name(t(r), t(f), aliases) for r, f in files]) == ("First Last", "Sara Khalil", "", "", "")
    assert one(spark, S.reviewer_name(t("aliasx"), t(""), aliases, t("Ann  Lee")), S.reviewer_name(t("aliasx"), t(""), aliases, t("Ann"))) == ("Ann Lee", "Full Name")
    same = S.entry_signature(t("a"), t(None))
    assert one(spark, same)[0] == one(spark, S.entry_signature(t("a"), t("")))[0] != one(spark, S.entry_signature(t(""), t("a")))[0]
    assert one(spark, S.raw_authors_match(t("User"), t("user")), S.raw_authors_match(t("Ann  B"), t("ann b"))) == (False, True)
    assert one(spark, S.normalize_text(t("ｘ  ﬁ‎\n٣")))[0] == "x fi ٣"


def test_registry_log(spark):
    schema = "file_log_id long, drive_file_id string, modified_time string, size_bytes long, pdf_sha256 string, status string"
    log = spark.createDataFrame([(1, "f", "t1", 5, "aa", "PROCESSED"), (2, "f", "t2", 6, "bb", "ERROR"), (2, "f", "t2", 6, "bb", "ERROR"), (3, "g", "t1", 5, "aa", "DUPLICATE"), (4, None, "t", 1, "cc", "PROCESSED")], schema)
    files = spark.createDataFrame([("f", "t2", 6, "zz"), ("f", "t1", 5, "AA"), ("h", "t", 1, None), ("g", "t1", 5, "aa")], "drive_file_id string, modified_time string, size_bytes long, pdf_sha256 string")
    assert sorted((r.drive_file_id, r.modified_time, r.action) for r in registry.precheck(files, log).collect()) == [("f", "t1", "PROCESS"), ("f", "t2", "SKIP_UNCHANGED"), ("g", "t1", "SKIP_UNCHANGED"), ("h", "t", "PROCESS")]
    assert sorted((r.drive_file_id, r.modified_time) for r in registry.files_to_process(files, log).collect()) == [("f", "t1"), ("h", "t")]
    assert sorted((r.drive_file_id, r.modified_time, r.action) for r in registry.hash_precheck(files, log).collect()) == [("f", "t1", "SKIP_DUPLICATE_FILE"), ("f", "t2", "PROCESS"), ("g", "t1", "PROCESS"), ("h", "t", "PROCESS")]
    known = spark.createDataFrame([("K-A", "AB")], "document_key string, pdf_sha256 string")
    new = spark.createDataFrame([("k_a", "ab "), ("k_a", "cd"), ("x", "ab")], "document_key string, pdf_sha256 string")
    assert sorted(r.decision for r in registry.classify_versions(new, known).collect()) == ["DUPLICATE", "NEW_VERSION", "NEW_VERSION"]


def test_alerts_and_notices(spark):
    schema = "file string, status string, error string, reviewers string, inserted int, updated int, pages_unresolved int, footer_mismatches int, master_suspect boolean, coverage double, pages_beyond_master int, needs_review int, unchanged int, master_index_version string"
    rows = [("bad", "ERROR", "broken", "", 0, 0, 9, 9, True, 0.1, 9, 9, 0, ""), ("good", "PROCESSED", None, "A; B", 1, 2, 0, 0, False, 1.0, 0, 0, 7, "v"), ("odd", "PROCESSED", None, None, 1, 2, 3, 1, True, 0.5, 2, 4, 0, "v")]
    got = alerts.classify_results(spark.createDataFrame(rows, schema))
    codes = {}
    for r in got.collect():
        codes.setdefault(r.file, []).append(r.code)
    assert codes["bad"] == ["PDF_PROCESSING_ERROR"] and codes["good"] == ["PDF_PROCESSED"] and codes["odd"] == list(alerts.ALERTS)[1:]
    said = {(r.file, r.code): r.message for r in got.collect()}
    assert said["good", "PDF_PROCESSED"] == "good processed successfully; reviewer=A; B; new=1; updated=2; unchanged=7."
    assert said["odd", "MASTER_INDEX_MISMATCH"] == "Possible master-index mismatch detected; coverage=50.0%; master=v."
    made, taken = alerts.notices(got, {"ADMIN": ["a@x.invalid"]}), []

    def send(notice):
        if notice["file"] == "bad":
            raise OSError("refused")
        taken.append(notice["code"])

    assert alerts.deliver(made, send, False) == 0 and alerts.deliver(made, send, True) == len(taken) == 8
    assert alerts.switched_on("X", environment={"X": " On "}) and not alerts.switched_on("X", environment={"X": "0"}) and not alerts.switched_on("X", environment={})
    sent = alerts.notices(got, {"ADMIN": ["a@x.invalid", "b@x.invalid"], "PM": ["b@x.invalid"]}).where("file = 'bad'").first()
    assert sent.recipients == ["a@x.invalid", "b@x.invalid"] and "PDF_PROCESSING_ERROR" in sent.subject and "Manual action required: Yes" in sent.body


def visible(i, page, comment, category="", kind=""):
    return ("R", i, "f", "l", page, comment, category, "R", "c", "m", "", "", f"id{i}", kind)


def test_output_match_and_merge(spark):
    names = ("reviewer", "ord", *output.VISIBLE)
    desired = spark.createDataFrame([visible(1, "1", "a"), visible(2, "2", "b  c"), visible(3, "2", "b c"), visible(4, "9", "new", "Own", "T"), visible(5, "3", "twice")], list(names))
    stored = spark.createDataFrame(
        [("r1", "id1", "7", "z", "Content", "Yes", "hi", "Text"), ("r2", "", "2", "b c", "K", "Yes", "yo", "Note"), ("r3", "", "3", "twice", "", "", "", ""), ("r4", "", "3", "twice", "", "", "", ""), ("r5", "id1x", "1", "a", "", "", "", "")],
        "row_no string, comment_id string, page string, comment string, category string, resolved string, replies string, annotation_type string",
    )
    m = output.match_output(desired, stored)
    assert {r.comment_id: (r.match, r.stored_id) for r in m.collect()} == {"id1": ("ID", "r1"), "id2": ("KEY", "r2"), "id3": ("NONE", None), "id4": ("NONE", None), "id5": ("AMBIGUOUS", None)}
    merged = {r.comment_id: r for r in output.merge_fields(m, stored).collect()}
    assert (merged["id1"].category, merged["id1"].resolved, merged["id1"].replies, merged["id1"].annotation_type, merged["id1"].comment) == ("Content", "Yes", "hi", "Text", "a")
    assert (merged["id4"].category, merged["id4"].resolved, merged["id4"].annotation_type) == ("Own", "", "T")


def test_layouts(spark):
    H = output.HEADER
    layouts = {
        "CANONICAL": H, "MIGRATED_ANNOTATION_TYPE_E": (*H[:4], "Annotation Type", *H[5:11]), "MIGRATED_CATEGORY_TYPE_HEADER": (*H[:4], "Type", *H[5:11]),
        "MIGRATED_CATEGORY_BLANK_HEADER": (*H[:4], "", *H[5:11]), "MIGRATED_ELEVEN_COLUMNS": (*H[:4], *H[5:11], "Type"), "MIGRATED_TYPE_HEADER": (*H[:4], None, *H[5:11], "Type"),
    }
    assert {n: output.layout_of(h)[0] for n, h in layouts.items()} == {n: n for n in layouts}
    rows = spark.createDataFrame([([f"c{i}" for i in range(11)],), (["p"],)], "cells array<string>")
    moved = output.migrate_layout(rows, layouts["MIGRATED_ANNOTATION_TYPE_E"]).collect()
    assert (moved[0].category, moved[0].author, moved[0].comment_id, moved[0].annotation_type) == ("", "c5", "c10", "c4") and tuple(moved[1]) == ("p", *[""] * 11)
    older = output.migrate_layout(rows, layouts["MIGRATED_ELEVEN_COLUMNS"]).first()
    assert (older.category, older.author, older.comment_id, older.annotation_type) == ("", "c4", "c9", "c10")
    kept = output.migrate_layout(rows, layouts["MIGRATED_CATEGORY_BLANK_HEADER"]).first()
    assert (kept.category, kept.author, kept.comment_id, kept.annotation_type) == ("c4", "c5", "c10", "")
    for unknown in (("x",), (*H[:4], "Other", *H[5:]), H[:5]):
        with pytest.raises(ValueError, match="unknown table layout"):
            output.migrate_layout(rows, unknown)

def test_pages_and_marked_text(spark):
    p = spark.createDataFrame([(1, " one  page", 1, "i"), (2, "blank", 2, "ii"), (3, "blank", 3, "iii"), (4, None, 4, "")], "doc int, text string, page int, label string")
    master = pages.master_index(p, "text", "page", "label")
    assert {r.book_page: r.master_pdf_page for r in master.collect()} == {"i": 1, "iii": 3}
    seen = spark.createDataFrame([("one page", "", ["7"]), ("other", "12", ["13"]), ("none", "", ["", "5"]), ("none", None, [])], "text string, label string, found array<string>")
    got = [(r.mapped_page, r.mapping_method, r.mapping_confidence) for r in pages.map_pages(seen, master, "text", "label", "found").orderBy("text", F.desc("label")).collect()]
    assert sorted(got) == sorted([("i", "master_text_fingerprint", 1.0), ("12", "pdf_page_label+footer_mismatch", 0.6), ("5", "footer_only_unverified", 0.25), ("", "unresolved", 0.0)])
    marks = spark.createDataFrame([("p", "m", 0, 0.0, 0.0, 100.0, 10.0), ("p", "m", 1, 0.0, 20.0, 100.0, 30.0)], "page string, mark string, quad int, x0 double, y0 double, x1 double, y1 double")
    words = spark.createDataFrame([("p", 0, "third", 5.0, 21.0, 20.0, 29.0), ("p", 1, "first", 5.0, 1.0, 60.0, 9.0), ("p", 2, "second", 61.0, 1.0, 130.0, 9.0), ("p", 3, "out", 5.0, 9.0, 20.0, 19.0), ("p", 4, "flat", 5.0, 5.0, 5.0, 5.0)], "page string, no int, w string, x0 double, y0 double, x1 double, y1 double")
    assert [tuple(r) for r in pages.marked_text(marks, words, ["page"], ("x0", "y0", "x1", "y1"), "mark", "quad", "no", "w").collect()] == [("p", "m", "first second third")]


def test_checks_fail_before_writing(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    with pytest.raises(checks.CheckFailed):
        checks.require_keys(df, ["k"])
    checks.require_keys(df.where("v = 1"), ["k"])
    with pytest.raises(checks.CheckFailed):
        checks.require(df, F.col("v") < 3, "small")
    with pytest.raises(checks.CheckFailed):
        checks.require_targets(df, df.where("v = 9"), ["k"])


def test_ledger(spark):
    new = spark.createDataFrame([("a", "x"), ("b", None), ("c", "y")], "k string, f string")
    old = spark.createDataFrame([("a", "x"), ("b", "z"), ("d", "w")], "k string, f string")
    assert {r.k: (r.action, r.f) for r in changes.ledger_upsert(new, old, "k", ["f"]).collect()} == {"a": ("unchanged", "x"), "b": ("updated", None), "c": ("inserted", "y"), "d": ("kept", "w")}
