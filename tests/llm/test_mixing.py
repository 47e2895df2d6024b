import numpy as np
import pytest

from marginalis.llm import mixing

TARGETS = "mix_name string, source string, target_share double, max_repeats int"


def mixed(spark, docs, targets, **k):
    d = spark.createDataFrame([(*x, "clash") for x in docs], "doc_id long, source string, tokens long, block string")
    pieces, shares = mixing.mix_sources(d, spark.createDataFrame(targets, TARGETS), **k)
    return pieces.collect(), {(r.mix_name, r.source): r for r in shares.collect()}


def test_shares_repeats_and_absent_sources(spark):
    docs = [(i, "big", 300) for i in range(200)] + [(1000 + i, "small", 150) for i in range(30)] + [(2000, None, 900), (2001, "unused", 900), (2002, "small", 0), (2003, "small", None)]
    targets = [("m", "big", 0.6, 1), ("m", "small", 0.3, 3), ("m", "gone", 0.1, 2), ("m", "small", 0.3, 3), ("one", "small", 1.0, 2), ("none", "gone", 1.0, 1), ("bad", "big", 0.0, 1), ("bad", "small", None, 1)]
    pieces, shares = mixed(spark, docs, targets, block=50)
    assert set(shares) == {("m", "big"), ("m", "small"), ("m", "gone"), ("one", "small"), ("none", "gone")}
    assert shares["m", "gone"].tokens == 0 and shares["m", "gone"].wanted_share == 0 and shares["none", "gone"].tokens == 0
    assert shares["m", "big"].actual_share == pytest.approx(2 / 3, abs=0.03) and shares["m", "small"].actual_share == pytest.approx(1 / 3, abs=0.03)
    # scarce sources are used up, as far as the margin for the draws allows
    assert shares["m", "small"].tokens > 0.8 * 3 * 30 * 150 and shares["one", "small"].tokens == 2 * 30 * 150
    limit = {("m", "big"): 1, ("m", "small"): 3, ("one", "small"): 2}
    used = {}
    for p in pieces:
        assert 0 <= p.first < p.last
        for token in range(p.first, p.last):
            key = (p.mix_name, p.source, p.doc_id, token)
            used[key] = used.get(key, 0) + 1
    assert all(n <= limit[k[:2]] for k, n in used.items())
    assert {p.source for p in pieces} == {"big", "small"}
    # each slot of each shard is filled once
    slots = {}
    for p in pieces:
        slots.setdefault((p.mix_name, p.shard, p.slot), set()).add((p.source, p.block, p.turn))
    assert all(len(v) == 1 for v in slots.values())


def test_empty(spark):
    assert mixed(spark, [], [("m", "a", 1.0, 1)])[0] == [] and mixed(spark, [(1, "a", 5)], [])[1] == {}


@pytest.mark.parametrize("size", [1, 2, 3, 5, 16, 17, 1000])
def test_permutation(size):
    index = np.arange(size)
    out = mixing.permute(index, np.full(size, size), np.full(size, 12345, dtype=np.uint64))
    assert sorted(out) == list(index)
    if size > 16:
        assert list(out) != list(mixing.permute(index, np.full(size, size), np.full(size, 99, dtype=np.uint64)))


def test_shard_counts_keep_the_shares():
    rng = np.random.default_rng(1)
    shares = np.array([0.5, 0.3, 0.2])
    for slots in (1, 7, 512):
        counts = mixing.shard_counts(slots, shares, rng)
        assert counts.sum() == slots and np.all(np.abs(counts - slots * shares) < 3)


def test_a_tiny_source_gives_what_it_has(spark):
    docs = [(i, "big", 256) for i in range(400)] + [(1000 + i, "mid", 256) for i in range(200)] + [(2000, "tiny", 200)]
    pieces, shares = mixed(spark, docs, [("m", "big", 0.6, 1), ("m", "mid", 0.39, 1), ("m", "tiny", 0.01, 3), ("n", "tiny", 0.9, 1), ("n", "big", 0.1, 1)])
    # three uses of one block are a hundredth of 300 slots; one use is nine tenths of one
    assert shares["m", "tiny"].tokens == 3 * 200 and shares["m", "tiny"].most_turns == 3
    assert shares["m", "big"].tokens == 180 * 256 and shares["m", "mid"].tokens == 117 * 256
    assert shares["n", "tiny"].tokens == 200 and shares["n", "big"].tokens == 0


def test_shards_add_up_to_the_counts():
    rng = np.random.default_rng(3)
    for sources in (1, 3, 40):
        shares = rng.dirichlet(np.full(sources, 0.5))
        room = rng.integers(1, 5000, sources).astype(float)
        slots = mixing.slots_possible(shares, room)
        counts = mixing.shard_counts(slots, shares, rng)
        assert counts.sum() == slots and np.all(counts <= room) and np.all(np.abs(counts - slots * shares) <= 1)
        draws = mixing.Draws(counts, [1, 2])
        got = [draws.of(i) for i in range(draws.size)]
        assert [int(h.sum()) for _, h in got] == [min(mixing.SHARD, slots - i * mixing.SHARD) for i in range(draws.size)]
        total = np.zeros_like(counts)
        for before, here in got:
            assert np.array_equal(before, total) and np.all(here >= 0)
            total = total + here
        assert draws.size == 0 or np.array_equal(total, counts)
        # any shard is found alone
        assert all(np.array_equal(mixing.Draws(counts, [1, 2]).of(i)[1], got[i][1]) for i in range(0, draws.size, 3))


def test_counts_of_shards_are_multinomial():
    # 4000 shards of two equal sources: mean 256, variance 128 of the binomial
    draws = mixing.Draws(np.array([512 * 2000, 512 * 2000]), [7])
    first = np.array([draws.of(i)[1][0] for i in range(4000)])
    assert first.mean() == 256 and abs(first.var() / 128 - 1) < 0.12


def test_huge_mixes_are_drawn_one_shard_at_a_time():
    counts = np.array([3_000_000_000, 1_500_000_000, 620_000_003, 5], dtype=np.int64)
    draws = mixing.Draws(counts, [3])
    assert draws.size >= 10_000_000
    previous = None
    for i in (0, 1, 4_999_999, draws.size - 2, draws.size - 1):
        before, here = draws.of(i)
        assert before.sum() == i * mixing.SHARD and np.all(here >= 0) and np.all(before + here <= counts)
        assert np.all(np.abs(before - float(i) * mixing.SHARD * (counts / counts.sum())) < 1e6)
        previous = before + here
    assert np.array_equal(previous, counts)


def test_no_slot_is_left_out(spark):
    docs = [(i, f"s{i % 13}", 256) for i in range(2600)]
    targets = [("m", f"s{i}", 1 / 13, 2) for i in range(13)]
    for seed in range(3):
        pieces, shares = mixed(spark, docs, targets, seed=seed)
        slots = {(p.shard, p.slot) for p in pieces}
        assert slots == {(j // mixing.SHARD, j % mixing.SHARD) for j in range(2 * 2600)}
        assert all(r.tokens == 2 * 200 * 256 for r in shares.values())


def test_two_targets_of_one_source(spark):
    docs = [(i, "a", 256) for i in range(90)] + [(1000 + i, "b", 256) for i in range(200)]
    pieces, shares = mixed(spark, docs, [("m", "a", 0.3, 1), ("m", "a", 0.3, 2), ("m", "b", 0.4, 1)])
    uses = {}
    for p in pieces:
        uses[p.source, p.doc_id] = uses.get((p.source, p.doc_id), 0) + 1
    assert len(pieces) == len({(p.shard, p.slot) for p in pieces}) == 150
    assert set(uses.values()) == {1} and sum(k[0] == "a" for k in uses) == 90 and sum(k[0] == "b" for k in uses) == 60
