"""Filling fixed-capacity containers with items by harmonic packing (problem 7)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Items that a worker packs together; bounds its memory, not the input.
AT_ONCE = 1 << 18


class Shelf:
    """Items by size; finds the largest one that fits in constant time."""

    def __init__(self, capacity: int):
        self.capacity, self.mask = capacity, 0
        self.by_size: dict[int, list] = {}

    def put(self, size: int, item: object) -> None:
        self.by_size.setdefault(size, []).append(item)
        self.mask |= 1 << size

    def take(self, at_most: int, at_least: int = 0) -> tuple[int, object] | None:
        fitting = self.mask & ((1 << (at_most + 1)) - 1)
        size = fitting.bit_length() - 1
        if size < max(at_least, 0):
            return None
        stack = self.by_size[size]
        item = stack.pop()
        if not stack:
            self.mask &= ~(1 << size)
        return size, item


def pack(sizes: list[int], items: list, capacity: int, top_up: bool = True) -> Iterator[list[tuple[int, object]]]:
    """Bins of (size, item) for sizes from 0 to the capacity.

    Class k holds the sizes above capacity/(k+1) up to capacity/k, so that k of
    them always fit.  Bins are opened class by class from the largest items,
    each with its class's fixed count of k items; the room that is left takes
    the largest items of further classes that fit, till none does.  Without
    ``top_up`` it stays empty, and a class's bins depend on that class alone.
    """
    shelf = Shelf(capacity)
    for size, item in zip(sizes, items, strict=True):
        shelf.put(size, item)
    while (first := shelf.take(capacity)) is not None:
        size, _ = first
        chosen, room = [first], capacity - size
        k = capacity // size if size else 0
        for _ in range(k - 1):
            more = shelf.take(min(room, size), capacity // (k + 1) + 1)
            if more is None:
                break
            chosen.append(more)
            room -= more[0]
        while top_up and (more := shelf.take(room)) is not None:
            chosen.append(more)
            room -= more[0]
        yield chosen


_ROW = "container_id int, bin string, item long, part int, size long"


def harmonic_packing(items: DataFrame, containers: DataFrame, item: str = "doc_id", size: str = "tokens", capacity: str = "capacity_tokens", top_up: bool = True) -> DataFrame:
    """(container_id, bin, item, part, size): where each item goes, for each
    kind of container.

    Items are put whole, part 0; one larger than the capacity is split into
    full parts, each a bin of its own, and a rest that is packed like an item.
    A null or negative size counts as 0; items of size 0 go into any bin, or
    one of their own if there is no other.  A null id is an item like others;
    repeated rows are items of their own.  Kinds of container without a
    positive capacity take nothing.  Empty tables give no rows.

    Plan: no shuffle.  Each task packs its own items, AT_ONCE at a time; a
    kind's bins left partly empty at the end of a batch are few against those
    filled, whatever the number of tasks.  ``containers`` is collected: one
    number per kind of container, a fixed list of at most 1000.
    """
    kinds = [(r[0], r[1]) for r in containers.select("container_id", capacity).distinct().limit(1001).collect() if r[0] is not None and r[1] and r[1] > 0]
    if len(kinds) > 1000:
        raise ValueError("more than 1000 kinds of containers")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        held: list[pd.DataFrame] = []
        number = 0

        def flush() -> Iterator[pd.DataFrame]:
            nonlocal number
            ids = [i for b in held for i in b["item"]]
            lengths = [int(s) for b in held for s in b["size"]]
            for kind, room in kinds:
                sizes, named, rows = [], [], []
                for i, n in zip(ids, lengths, strict=True):
                    full, rest = divmod(n, room)
                    if full and not rest:
                        full, rest = full - 1, room
                    for p in range(full):
                        rows.append((kind, f"{task}-{number}", i, p, room))
                        number += 1
                    sizes.append(rest)
                    named.append((i, full))
                for chosen in pack(sizes, named, room, top_up):
                    rows += [(kind, f"{task}-{number}", i, p, s) for s, (i, p) in chosen]
                    number += 1
                yield pd.DataFrame({"container_id": pd.Series([r[0] for r in rows], dtype="int32"), "bin": [r[1] for r in rows], "item": pd.array([r[2] for r in rows], dtype="Int64"), "part": pd.Series([r[3] for r in rows], dtype="int32"), "size": pd.Series([r[4] for r in rows], dtype="int64")})
            held.clear()

        for batch in batches:
            held.append(batch.astype({"item": "Int64"}))
            if sum(map(len, held)) >= AT_ONCE:
                yield from flush()
        if held:
            yield from flush()

    lean = items.select(F.col(item).cast("long").alias("item"), F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)).alias("size"))
    return lean.mapInPandas(run, _ROW)


def fill_report(packed: DataFrame, containers: DataFrame, capacity: str = "capacity_tokens") -> DataFrame:
    """Per kind of container: bins, tokens, and the share of room that is used."""
    sums = packed.groupBy("container_id").agg(F.countDistinct("bin").alias("bins"), F.sum("size").alias("tokens"), F.countDistinct("item").alias("items"))
    return sums.join(F.broadcast(containers.select("container_id", capacity)), "container_id").withColumn("used_share", F.col("tokens") / (F.col("bins") * F.col(capacity)))
