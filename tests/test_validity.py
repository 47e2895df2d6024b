import random

from pyspark.sql import functions as F

from marginalis.operators.validity import attribute_history


def periods(spark, events, **options):
    df = spark.createDataFrame([(*e, 1, 2) for e in events], "k string, a string, b string, us long, kind string, valid_from_us int, _key int")
    out = attribute_history(df, ["k"], ["a", "b"], F.col("us"), F.col("kind") == "REMOVED", True, **options)
    return sorted(tuple(r) for r in out.collect())


def test_islands(spark):
    events = [
        ("x", "1", "p", 10, "NEW"), ("x", "1", "p", 20, "UNCHANGED"), ("x", "2", "p", 30, "UPDATED"), ("x", "2", "p", 30, "UPDATED"), ("x", "1", "p", 40, "UPDATED"),
        ("x", "1", "p", 50, "REMOVED"), ("x", "1", "p", 55, "REMOVED"), ("x", "1", "p", 60, "NEW"), (" y ", None, "", 5, "UPDATED"), ("y", "", None, 9, "NEW"),
    ]
    random.Random(1).shuffle(events)
    assert periods(spark, events) == [("x", 10, 30, "1", "p"), ("x", 30, 40, "2", "p"), ("x", 40, 50, "1", "p"), ("x", 60, -1, "1", "p"), ("y", 5, -1, "", "")]


def test_nulls_ties_and_empty(spark):
    assert periods(spark, []) == []
    assert periods(spark, [("x", "1", "p", None, "NEW"), ("x", "1", "p", 5, None)]) == [("x", 5, -1, "1", "p")]
    # at one instant an ending comes first, so the statement holds
    assert periods(spark, [("x", "1", "p", 5, "REMOVED"), ("x", "1", "p", 5, "NEW")]) == [("x", 5, -1, "1", "p")]
    assert len(periods(spark, [("x", "1", "p", 5, "NEW"), ("x", "2", "p", 5, "NEW")])) == 1
    assert periods(spark, [("x", "1", "p", 5, "REMOVED")]) == []


def naive(events):
    """Periods by the definition, one event after the other."""
    states = {}
    for k, a, b, us, kind in events:
        if us is not None:
            states.setdefault(k, {}).setdefault(us, set()).add(None if kind == "REMOVED" else (a, b))
    out = []
    for k, at in states.items():
        begun, current = None, None
        for us in sorted(at):
            (state,) = at[us]
            if state != current:
                if current is not None:
                    out.append((k, begun, us, *current))
                begun, current = us, state
        if current is not None:
            out.append((k, begun, -1, *current))
    return sorted(out)


def test_any_entity_over_any_blocks(spark):
    r = random.Random(7)
    # one entity with two thirds of all events, long runs of one state, and many of a single event
    at = {}
    for i in range(900):
        k, us = ("hot" if i % 3 else f"k{i % 40}"), r.randint(0, 2000)
        at.setdefault((k, us), ("1" if us < 900 and r.random() < 0.97 else str(r.randint(0, 2)), r.choice(["NEW", "UPDATED", "UPDATED", "REMOVED"] if us > 700 else ["UPDATED"])))
    events = [(k, a, "p", us, kind) for (k, us), (a, kind) in at.items()]
    expected = naive(events)
    assert any(t - f > 200 for k, f, t, *_ in expected if k == "hot")
    for blocks in (1, 2, 7, 40, None):
        assert periods(spark, events, blocks=blocks) == expected, blocks


def test_plan_sums_islands_and_reads_events_once(spark):
    df = spark.createDataFrame([("hot" if i % 3 else f"k{i}", str(i % 2), i) for i in range(300)], "k string, a string, us long")
    out = attribute_history(df, ["k"], ["a"], F.col("us"), F.lit(False))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "lag(" in plan and "sum(_changed" in plan and "_island" in plan and "lead(" in plan
