import random

from marginalis.llm.packing import fill_report, harmonic_packing, pack


def packed(spark, items, containers):
    i = spark.createDataFrame([(*x, "clash") for x in items], "doc_id long, tokens long, bin string")
    c = spark.createDataFrame(containers, "container_id int, container_name string, capacity_tokens int")
    return harmonic_packing(i, c), c


def test_whole_items_within_capacity(spark):
    r = random.Random(1)
    items = [(i, r.choice([0, 1, 5, 40, 90, 130, 256, 257, 600, 5000])) for i in range(700)]
    out, containers = packed(spark, items, [(1, "s", 256), (2, "m", 1000)])
    rows = out.collect()
    for kind, room in ((1, 256), (2, 1000)):
        own = [x for x in rows if x.container_id == kind]
        bins, parts = {}, {}
        for x in own:
            bins[x.bin] = bins.get(x.bin, 0) + x.size
            parts.setdefault(x.item, []).append(x.size)
        assert max(bins.values()) <= room
        for i, n in items:
            # only what exceeds the capacity is split: full parts and one rest
            assert sum(parts[i]) == n and len(parts[i]) == max(1, -(-n // room)) and sorted(parts[i])[1:] == [room] * (len(parts[i]) - 1)
        assert sum(n for _, n in items) / (len(bins) * room) > 0.9
    assert all(0.9 < x.used_share <= 1 for x in fill_report(out, containers).collect())


def test_nulls_repeats_and_empty(spark):
    out, _ = packed(spark, [(1, None), (1, 5), (1, 5), (None, 3), (2, -4)], [(1, "s", 10), (2, "none", None), (3, "zero", 0), (None, "x", 5)])
    rows = out.collect()
    assert {x.container_id for x in rows} == {1} and sorted(x.size for x in rows) == [0, 0, 3, 5, 5]
    assert packed(spark, [], [(1, "s", 10)])[0].count() == 0 and packed(spark, [(1, 1)], [])[0].count() == 0


def test_fixed_count_by_class():
    # items of class 3 (a quarter to a third of 12) go three to a bin
    bins = list(pack([4] * 9, list(range(9)), 12))
    assert [len(b) for b in bins] == [3, 3, 3]
    assert [sorted(s for s, _ in b) for b in pack([7, 3, 2, 6, 6], list("abcde"), 12)] == [[2, 3, 7], [6, 6]]
    # without topping up a class keeps to itself
    assert sorted([sorted(s for s, _ in b) for b in pack([7, 3, 2, 6, 6, 3, 3], list("abcdefg"), 12, False)]) == [[2], [3, 3, 3], [6, 6], [7]]
    assert list(pack([0, 0], ["a", "b"], 5)) == [[(0, "b"), (0, "a")]]


def test_tokens_of_whole_texts(spark):
    from tokenizers import Tokenizer

    from marginalis.llm.tokens import TOKENIZER, token_counts

    JSON = TOKENIZER.replace(".tiktoken", ".json")
    made = Tokenizer.from_file(JSON)
    texts = ["", None, "A short note.", "слово " * 5000, "<|endoftext|>", "end" + " \n" * 400_000 + " x" + "\t" * 3000]
    df = spark.createDataFrame([(i, t, -1) for i, t in enumerate(texts)], "i int, text string, tokens int")
    got = {r.i: r.tokens for r in token_counts(df, "text").collect()}
    # another library with the same vocabulary counts alike
    assert {r.i: r.tokens for r in token_counts(df, "text", tokenizer=JSON).collect()} == got
    assert got[0] == got[1] == 0 and got[2] == len(made.encode(texts[2], add_special_tokens=False)) and got[3] == len(made.encode(texts[3], add_special_tokens=False))
    assert got[4] > 1  # a special token's name is ordinary text
