import pytest

from marginalis.llm import queries, textforms

ALIKE = [
    ("ｆｕｌｌ　ｗｉｄｔｈ，", "full width,"), ("café", "café"), ("no​br­eak", "nobreak"), ("a b c", "a b c"), ("ﬁnd aﬀair", "find affair"), ("x‑y", "x-y"),
    ("Аеос", "Aeoc"), ("Αο", "Ao"), ("ё", "ë"), ("а́", "á"), ("تﻻحظ", "تلاحظ"), ("أ", "أ"),
    ("یرجى أی", "يرجى أى"), ("5 ℃", "5 °C"), ("  a  b ", "a b"), ("가", "가"),
]
DIFFERENT = [("a", "A"), ("e", "é"), ("x2", "x²"), ("'", "’"), ("-", "–"), ("–", "—"), ("ا", "أ"), ("a b", "ab"), ("...", "…"), ("ss", "ß")]


def forms(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.form for r in textforms.canonical_texts(df, "text").orderBy("i").collect()]


def test_what_looks_alike_and_what_does_not(spark):
    got = forms(spark, [t for p in ALIKE + DIFFERENT for t in p])
    for i, pair in enumerate(ALIKE + DIFFERENT):
        a, b = got[2 * i : 2 * i + 2]
        assert (a == b) == (pair in ALIKE), (pair, a, b)


def test_null_empty_invisible_and_long(spark):
    long = "ａ" * 300_000
    assert forms(spark, [None, "", " ", "​", long]) == [None, "", "", "", "a" * 300_000]
    again = forms(spark, [a for a, _ in ALIKE])
    assert forms(spark, again) == again


def pairs(spark, rows):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "source_sha256 string, entry_id string, comment string, selected_text string, form string, g string")
    return sorted(tuple(r) for r in textforms.look_alikes(df, "source_sha256", "entry_id", ["comment", "selected_text"]).collect())


def test_pairs(spark):
    rows = [("s", "a", "x-y", None), ("s", "b", "x‑y", "x-y"), ("s", "c", "x-y", ""), ("t", "d", "x‐y", None), ("s", "c", "x-y", ""), ("s", None, "x‐y", None), (None, "e", "q ", "q"), (None, "f", "q", " ")]
    assert pairs(spark, rows) == [("comment", "a", "b"), ("comment", "b", "c"), ("comment", "e", "f")]
    assert pairs(spark, []) == []


def test_hot_text_costs_no_pairs(spark):
    rows = [("s", f"{i:04d}", "OK", None) for i in range(1500)] + [("s", "zz", "ＯＫ", None)]
    assert len(pairs(spark, rows)) == 1500


def test_oracle(spark):
    from conftest import compare_with_oracle

    for name, sql in queries.ORACLES.items():
        compare_with_oracle(spark, name, queries.QUERIES[name], sql)


@pytest.mark.parametrize("table", textforms.LOOKALIKES)
def test_tables_are_letters_one_to_one(table):
    assert len(table[0]) == len(table[1]) and all(c.isalpha() for c in "".join(table))


def test_clashing_columns_and_order(spark):
    df = spark.createDataFrame([(i, f"ａ{i}", "old", "x", True, f"T{i}") for i in range(500)], "i int, text string, form string, t string, odd boolean, `T2` string")
    rows = textforms.canonical_texts(df, "text").collect()
    assert all(r.form == f"a{r.i}" and r.text == f"ａ{r.i}" and r.t == "x" and r.odd and r.T2 == f"T{r.i}" for r in rows)
    assert textforms.canonical_texts(df, "text", "text").where("text like 'a%'").count() == 500
