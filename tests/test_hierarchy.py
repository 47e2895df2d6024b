import random

import pytest
from pyspark.sql import functions as F

from marginalis.operators.hierarchy import descendants, resolve_threads


def threads(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], "source_sha256 string, entry_id string, parent_entry_id string, kind string, root string")
    return resolve_threads(df, is_child=F.col("kind") == "REPLY")


def walk(nodes, scope, node):
    depth, path, seen = 0, [], set()
    while True:
        if (scope, node) not in nodes:
            return ("orphan", "", depth, path[::-1])
        if node in seen:
            return ("cycle", "", -1, [])
        seen.add(node)
        path.append(node)
        if nodes[scope, node] is None:
            return ("ok", node, depth, path[::-1])
        node, depth = nodes[scope, node], depth + 1


def check(spark, rows):
    nodes = {(s or "", e.strip()): (p or "").strip() or None if k == "REPLY" else None for s, e, p, k in rows if (e or "").strip()}
    got = {(r.scope, r.node): (r.status, r.root, r.depth, r.path) for r in threads(spark, rows).collect()}
    assert got == {k: walk(nodes, *k) for k in nodes}


def test_nested_group_orphan_cycle_blank(spark):
    check(
        spark,
        [
            ("s", "10", None, "ROOT"), ("s", "11", " 10", "REPLY"), ("s", "12", "11 ", "REPLY"), ("s", "20", "10", "GROUP"), ("s", "21", "20", "REPLY"),
            ("s", "30", "nowhere", "REPLY"), ("s", "31", "30", "REPLY"), ("s", "40", "41", "REPLY"), ("s", "41", "40", "REPLY"), ("s", "42", "41", "REPLY"), ("s", "43", "43", "REPLY"),
            ("s", "50", "", "REPLY"), ("s", "51", None, "REPLY"), ("t", "11", "10", "REPLY"), ("s", "11", "10", "REPLY"), (None, "a", None, None), (None, "b", "a", "REPLY"), ("s", None, "10", "REPLY"), ("s", " ", "10", "REPLY"),
        ],
    )


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9, 33])
def test_chain_and_loop_of_any_length(spark, n):
    chain = [("c", f"n{i}", f"n{i - 1}" if i else None, "REPLY" if i else "ROOT") for i in range(n + 1)]
    loop = [("l", f"n{i}", f"n{(i + 1) % n}", "REPLY") for i in range(n)] + [("l", "below", "n0", "REPLY")]
    check(spark, chain + loop)


def test_random_forest(spark):
    r = random.Random(3)
    rows = [("s" if i % 3 else f"t{i % 7}", f"n{i}", f"n{r.randint(max(0, i - 30), i + 2)}", r.choice(["REPLY"] * 9 + ["ROOT"])) for i in range(400)]
    check(spark, rows)


def test_empty_and_descendants(spark):
    assert threads(spark, []).count() == 0
    rows = [("s", "a", None, "ROOT"), ("s", "b", "a", "REPLY"), ("s", "c", "b", "REPLY")]
    got = sorted(tuple(x) for x in descendants(threads(spark, rows)).collect())
    assert got == [("s", "a", "b", 1), ("s", "a", "c", 2), ("s", "b", "c", 1)]


def test_running_totals_in_two_levels(spark):
    from marginalis.operators.running import with_offset

    rows = [("k" if i % 3 else "l", i % 5, i, i % 4) for i in range(60)]
    got = with_offset(spark.createDataFrame(rows, "key string, chunk int, at int, n long"), ["key"], "chunk", ["at"], "n", "before").collect()
    for key in "kl":
        total = 0
        for row in sorted((g for g in got if g.key == key), key=lambda g: (g.chunk, g.at)):
            assert row.before == total
            total += row.n
