from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marginalis.operators import ordered
from marginalis.operators.snapshots import snapshot_changes

V = "version_id string, drive_file_id string, modified_time string, entry_id string"
E = "version_id string, entry_id string, entry_signature string, active boolean, last_seen string, drive_file_id string"
T = "2024-01-0{}T00:00:00.000Z"


def changes(spark, versions, entries):
    v = spark.createDataFrame([(a, b, c, "clash") for a, b, c in versions], V)
    e = spark.createDataFrame([(*r, "clash") for r in entries], E)
    return Counter(tuple(r) for r in snapshot_changes(v, e).collect())


def test_added_removed_changed_with_uneven_spelling(spark):
    versions = [("K_A@1", "f", T.format(1)), ("K_A@2", "f", T.format(2)), ("K_A@2", "f", T.format(2)), ("K_A@3", "f", T.format(3))]
    entries = [
        ("k-a@1 ", "x", "S1", True, T.format(1)), ("K_A@1", "y", "s2", True, T.format(1)), ("K_A@1", "z", "s3", True, T.format(1)),
        ("K_A@2", " x", " s1", True, T.format(2)), ("K_A@2", "y", "changed", True, T.format(2)), ("K_A@2", "n", "s4", True, T.format(2)), ("K_A@2", "n", "s4", True, T.format(2)),
        # superseded rows: the latest last_seen counts, active or not
        ("K_A@2", "z", "s3", True, T.format(1)), ("K_A@2", "z", "s3", False, T.format(2)),
    ]
    assert changes(spark, versions, entries) == Counter(
        [
            ("f", "K_A@2", "y", "UPDATED"), ("f", "K_A@2", "n", "NEW"), ("f", "K_A@2", "z", "REMOVED"),
            # the third snapshot is empty
            ("f", "K_A@3", "x", "REMOVED"), ("f", "K_A@3", "y", "REMOVED"), ("f", "K_A@3", "n", "REMOVED"),
        ]
    )


def test_nulls_empty_tables_and_strangers(spark):
    assert not changes(spark, [], [])
    assert not changes(spark, [], [("v", "e", "s", True, T.format(1))])
    versions = [("a", "f", T.format(1)), (None, "f", T.format(2)), ("b", None, T.format(2)), ("c", "f", None), ("d", "f", T.format(3))]
    entries = [("a", "x", None, True, None), ("d", "x", "", True, None), ("a", None, "s", True, T.format(1)), ("a", "", "s", True, T.format(1)), ("d", "y", "s", None, T.format(1)), (None, "x", "s", True, T.format(1)), ("zz", "x", "s", True, T.format(1))]
    # a null signature is the same as an empty one; inactive, nameless and unplaced rows are in no snapshot
    assert not changes(spark, versions, entries)


def test_tie_on_last_seen(spark):
    versions = [("a", "f", T.format(1)), ("b", "f", T.format(2))]
    entries = [("b", "x", "s1", True, T.format(2)), ("b", "x", "s9", False, T.format(2))]
    assert changes(spark, versions, entries) == Counter([("f", "b", "x", "NEW")])


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("klm"), st.integers(0, 40), st.integers(0, 9)), max_size=60, unique_by=lambda r: r[:2]), st.integers(1, 9))
def test_blocks_give_the_neighbours_a_window_gives(spark, rows, blocks):
    df = spark.createDataFrame(rows, "key string, at long, v int")
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    w = Window.partitionBy("key").orderBy("at")
    plain = df.select("*", F.lag("v").over(w).alias("b"), F.lead("at").over(w).alias("n"))
    blocked = ordered.neighbours(ordered.in_blocks(df, ["key"], ["at"], blocks), ["key"], ["at"], {"b": (F.col("v"), -1), "n": (F.col("at"), 1)})
    assert blocked.columns == plain.columns
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, blocked.collect()))


def test_a_hot_series_lies_in_many_blocks(spark):
    df = spark.createDataFrame([("hot" if i % 3 else f"k{i}", i) for i in range(3000)], "key string, at long")
    blocks = [r["_block"] for r in ordered.in_blocks(df, ["key"], ["at"], 12).where("key = 'hot'").select("_block").distinct().collect()]
    assert len(blocks) >= 6
