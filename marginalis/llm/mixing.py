"""Mixing sources to target weights (problem 8)."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalis.operators.running import with_offset
from marginalis.session import cut

#: Tokens in a block, slots in an output shard, documents in a chunk of running totals, shards in a task.
BLOCK, SHARD, CHUNK, SHARDS = 256, 512, 1 << 14, 1 << 11


def blocks_of(documents: DataFrame, doc: str, source: str, tokens: str, block: int = BLOCK) -> DataFrame:
    """(source, block, doc, first, last): which tokens of which documents make
    up each block of a source.

    A source's documents follow each other in a pseudorandom order, cut every
    ``block`` tokens, so a document may go on in the next block and the last
    block of a source may be short.  Documents without tokens or a source are
    in no block.
    """
    rows = documents.select(F.col(source).alias("source"), F.col(doc).alias("doc"), F.col(tokens).alias("n"), F.xxhash64(doc).alias("h")).where("n > 0 and trim(source) <> ''")
    # the running totals read the rows twice, and sizes take long to count
    rows = cut(rows)
    chunks = rows.count() // CHUNK + 1
    placed = with_offset(rows.withColumn("chunk", F.pmod(F.xxhash64("doc", F.lit(1)), F.lit(chunks))), ["source"], "chunk", ["h", "doc", "n"], "n", "at")
    return placed.select(
        "source", "doc", "at", "n", F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("n") - 1) / block))).alias("block")
    ).select(
        "source", "block", "doc",
        F.greatest(F.col("block") * block - F.col("at"), F.lit(0)).alias("first"),
        F.least((F.col("block") + 1) * block - F.col("at"), F.col("n")).alias("last"),
    )


def permute(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Pseudorandom permutation of range(size), per row its own size and key:
    a four-round Feistel network over the next power of four, walked again from
    where it leaves the range."""
    bits = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2).astype(np.float64))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.ones(len(index), dtype=bool)
    limit = size.astype(np.uint64)
    while todo.any():
        left, right = out[todo] >> bits[todo], out[todo] & mask[todo]
        for r in range(4):
            x = (right + key[todo] + np.uint64(r * 0x632BE59B)) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
            x *= np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> np.uint64(32)
            left, right = right, left ^ (x & mask[todo])
        out[todo] = (left << bits[todo]) | right
        todo[todo] = out[todo] >= limit[todo]
    return out.astype(np.int64)


def slots_possible(shares: np.ndarray, room: np.ndarray) -> int:
    """Most slots for which no source passes its room: room is whole, so a share
    of the slots that is rounded up still fits."""
    slots = int(np.floor(min(room / shares) + 1e-9))
    while np.any(np.ceil(slots * shares - 1e-9) > room):
        slots -= 1
    return slots


def shard_counts(slots: int, shares: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Slots by source: the whole parts of the expected counts, and one more
    for the largest remainders, drawn where they are equal."""
    whole = np.floor(slots * shares + 1e-9).astype(np.int64)
    rest = slots - int(whole.sum())
    if rest > 0:
        part = np.round(slots * shares - whole, 9)
        whole[np.lexsort((rng.random(len(shares)), -part))[:rest]] += 1
    return whole


#: numpy draws from the hypergeometric distribution up to this size.
EXACT = 1_000_000_000


def draw_left(counts: np.ndarray, left: int, rng: np.random.Generator) -> np.ndarray:
    """How many of each source's slots are among ``left`` slots drawn from all
    of ``counts`` without replacement: a multinomial draw given its totals.
    Beyond numpy's size each source's draw takes the normal limit, within what
    the totals leave possible."""
    if counts.sum() < EXACT:
        return rng.multivariate_hypergeometric(counts, left, method="marginals")
    out, rest = np.zeros_like(counts), int(counts.sum())
    for i, c in enumerate(counts.tolist()):
        share = c / rest if rest else 0.0
        spread_ = np.sqrt(max(0.0, left * share * (1 - share) * (rest - left) / max(1, rest - 1)))
        out[i] = min(max(round(rng.normal(left * share, spread_)), left - (rest - c), 0), c, left)
        left, rest = left - int(out[i]), rest - c
    return out


class Draws:
    """Slots of each source in each shard of a mix: multinomial counts, drawn
    so that over all shards they add up to ``counts``.

    The shards are halved again and again, and each half's counts drawn from
    those of the whole with a seed of its own, so any shard finds its counts,
    and those before it, in a number of draws logarithmic in the shards.
    """

    def __init__(self, counts: np.ndarray, key: list[int]):
        self.counts, self.key, self.size = counts, key, -(-int(counts.sum()) // SHARD)
        self._memo: dict[tuple[int, int], np.ndarray] = {}

    def of(self, shard: int) -> tuple[np.ndarray, np.ndarray]:
        """(counts of all shards before, counts of this one)."""
        low, high, before, here = 0, self.size, np.zeros_like(self.counts), self.counts
        while high - low > 1:
            middle = (low + high) // 2
            left = self._memo.get((low, high))
            if left is None:
                if len(self._memo) > 10_000:
                    self._memo.clear()
                left = self._memo[low, high] = draw_left(here, (middle - low) * SHARD, np.random.default_rng([*self.key, low, high]))
            if shard < middle:
                here, high = left, middle
            else:
                before, here, low = before + left, here - left, middle
        return before, here


def shard_plan(mixes: list[tuple], seed: int) -> tuple[np.ndarray, list[Draws]]:
    """(number of the first shard of each mix, and of all, draws of each mix)."""
    draws = [Draws(np.asarray(counts, dtype=np.int64), [seed, zlib.crc32(mix.encode())]) for mix, _, counts, _ in mixes]
    return np.cumsum([0, *(d.size for d in draws)]), draws


def mix_sources(documents: DataFrame, targets: DataFrame, doc: str = "doc_id", source: str = "source", tokens: str = "tokens", block: int = BLOCK, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(pieces, shares) of the mixes in ``targets``.

    pieces: (mix_name, shard, slot, source, block, turn, doc, first, last), the
    token ranges of each slot of each output shard; no slot is left out; turn
    counts the uses of the block before.  shares: (mix_name, source, target_share, wanted_share,
    tokens, actual_share, most_turns, max_repeats), one row per target.

    ``targets`` has mix_name, source, target_share, max_repeats.  A mix is as
    large as its scarcest source allows; sources that are absent get nothing,
    and the others' shares are scaled up to wanted_share.  Sources without a
    target, or null, aren't used; targets without a positive share or repeats
    ask for nothing.  Repeated target rows count once; different ones of one
    source ask for their sum, within the smallest max_repeats.  No document is used
    more than max_repeats times: a block comes once in each of that many
    passes over its source, each in an order of its own.

    Plan: running totals in two levels cut sources into blocks; a mix's counts
    are fixed once, and each shard draws its own and those before it by itself;
    shards are a range, so no task holds all of a mix;
    a slot's number within its source goes through the source's permutation
    to a block; one join by (source, block) brings the pieces.  The driver sees
    targets and one count per target source.
    """
    spark = documents.sparkSession
    pieces = cut(blocks_of(documents, doc, source, tokens, block))
    wanted = targets.where("target_share > 0 and max_repeats > 0 and mix_name is not null and source is not null").select("mix_name", "source", "target_share", "max_repeats").distinct()
    sizes = pieces.groupBy("source").agg((F.max("block") + 1).alias("blocks"))
    plan = wanted.join(sizes, "source", "left").limit(10_001).toPandas()
    if len(plan) > 10_000:
        raise ValueError("more than 10000 targets")
    rows = []
    named = plan.dropna(subset=["blocks"]).groupby(["mix_name", "source"], as_index=False).agg({"target_share": "sum", "max_repeats": "min", "blocks": "first"})
    for mix, group in named.groupby("mix_name"):
        shares = group["target_share"].to_numpy(float) / group["target_share"].sum()
        room = (group["blocks"] * group["max_repeats"]).to_numpy(float)
        slots = slots_possible(shares, room)
        counts = shard_counts(slots, shares, np.random.default_rng([seed, zlib.crc32(mix.encode())]))
        if slots:
            rows.append((mix, [str(s) for s in group["source"]], [int(c) for c in counts], [int(b) for b in group["blocks"]]))
    first_shard = shard_plan(rows, seed)[0]
    total = int(first_shard[-1])
    tasks = max(1, min(total, max(spark.sparkContext.defaultParallelism, total // SHARDS)))
    shards = spark.range(0, total, 1, tasks)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts, draws = shard_plan(rows, seed)
        for batch in batches:
            out = []
            for number in batch["id"]:
                m = int(np.searchsorted(starts, number, side="right")) - 1
                shard = int(number - starts[m])
                before, here = draws[m].of(shard)
                mix, names, _, blocks = rows[m]
                first = 0
                for s, c, n, b in zip(names, here.tolist(), before.tolist(), blocks, strict=True):
                    if c:
                        out.append((mix, shard, s, c, n, first, b))
                    first += c
            yield pd.DataFrame(out, columns=["mix_name", "shard", "source", "count", "before", "first_slot", "blocks"])

    drawn = shards.mapInPandas(draw, "mix_name string, shard long, source string, count long, before long, first_slot long, blocks long")
    slots = drawn.select(
        "mix_name", "shard", "source", "blocks", "before", "first_slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)).alias("i")
    ).select("mix_name", "shard", (F.col("first_slot") + F.col("i")).alias("slot"), "source", "blocks", (F.col("before") + F.col("i")).alias("j"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            turn = batch["j"] // batch["blocks"]
            names = batch["mix_name"] + "\x1f" + batch["source"]
            codes, distinct = pd.factorize(names)
            base = np.array([zlib.crc32(f"{seed}\x1f{n}".encode()) for n in distinct], dtype=np.uint64)
            key = (base[codes] << np.uint64(20)) + turn.to_numpy().astype(np.uint64) if len(batch) else np.zeros(0, np.uint64)
            at = permute((batch["j"] % batch["blocks"]).to_numpy(), batch["blocks"].to_numpy(), key)
            yield batch.assign(turn=turn, block=at)[["mix_name", "shard", "slot", "source", "block", "turn"]]

    placed = slots.mapInPandas(place, "mix_name string, shard long, slot long, source string, block long, turn long")
    mixed = placed.join(pieces, ["source", "block"]).select("mix_name", "shard", "slot", "source", "block", "turn", F.col("doc").alias(doc), "first", "last")
    got = mixed.groupBy("mix_name", "source").agg(F.sum(F.col("last") - F.col("first")).alias("tokens"), (F.max("turn") + 1).alias("most_turns"))
    total = got.groupBy("mix_name").agg(F.sum("tokens").alias("_all"))
    present = wanted.join(sizes, "source").groupBy("mix_name").agg(F.sum("target_share").alias("_present"))
    shares = (
        wanted.join(got, ["mix_name", "source"], "left").join(total, "mix_name", "left").join(present, "mix_name", "left").join(sizes, "source", "left")
        .select(
            "mix_name", "source", "target_share", F.when(F.col("blocks").isNotNull(), F.col("target_share") / F.col("_present")).otherwise(0.0).alias("wanted_share"),
            F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce(F.col("tokens") / F.col("_all"), F.lit(0.0)).alias("actual_share"),
            F.coalesce("most_turns", F.lit(0)).alias("most_turns"), "max_repeats",
        )
    )
    return mixed, shares
