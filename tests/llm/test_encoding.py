import random

from marginalis.llm import encoding

SENTENCES = {
    "fr": ["L’été, la température près de la crémaillère baissa", "Où est passée la réponse modèle déjà citée", "Les élèves relèvent cinq mesures à côté du château", "Ça ne suffit pas, répéta la maîtresse énervée"],
    "ru": ["Почему рисунок расположен на полях", "Сколько раз упомянута лестница в тексте", "Дед привёз из города корзины с яблоками", "Осенью стало холоднее, и класс удивился"],
    "ar": ["انظر إلى العنوان الرئيسي ماذا تلاحظ", "يسجل الطلاب قراءة ثم يكملون الفقرة الأولى", "سافر الجد إلى قرية بعيدة ومعه سلة", "تدور المضخة مرة قبل أن تتوقف عند السطر"],
    "en": ["Check x² and 3 × 5 at 20 °C, then stop", "A vowel chart lists Â, Ã, Ä and Å side by side", "“Salt” costs £5 — no more", "The café’s résumé was naïve"],
}
DAMAGE = {"fr": [("latin-1", "utf-8"), ("cp1252", "utf-8"), ("cp437", "utf-8")], "ru": [("mac-roman", "cp1251"), ("cp1252", "utf-8")], "ar": [("latin-1", "cp1256"), ("mac-roman", "utf-8")], "en": [("cp1252", "utf-8"), ("cp1256", "utf-8")]}


def harm(text, wrong, real):
    raw = text.encode(real, "ignore")
    return "".join(encoding.letters_of(wrong)[b] for b in raw)


def corpus(n=900, share=0.08):
    r = random.Random(5)
    rows = []
    for i in range(n):
        lang = r.choice(list(SENTENCES))
        clean = " ".join(r.choice(SENTENCES[lang]) for _ in range(3))
        text = clean
        if r.random() < share:
            text = harm(clean, *r.choice(DAMAGE[lang]))
        rows.append((i, text, f"src{i % 3}", lang, clean))
    return rows


def test_found_and_restored(spark):
    rows = corpus()
    df = spark.createDataFrame([(*x[:4], "clash", 7) for x in rows], "doc_id long, text string, source string, lang string, word string, garbled int")
    got = {r.doc_id: r for r in encoding.restore(df).collect()}
    assert len(got) == len(rows) and got[0].word == "clash"
    damaged = {x[0] for x in rows if x[1] != x[4]}
    found = {i for i, r in got.items() if r.garbled}
    assert len(found & damaged) >= 0.97 * len(damaged) and len(found - damaged) <= 2
    assert sum(got[x[0]].restored == x[4] for x in rows if x[0] in damaged) >= 0.9 * len(damaged)
    # the English texts name single accented letters, which nothing around them tells apart
    for lang, share in (("fr", 0.9), ("ru", 0.9), ("ar", 0.9), ("en", 0.7)):
        own = [x for x in rows if x[0] in damaged and x[3] == lang]
        assert sum(got[x[0]].restored == x[4] for x in own) >= share * len(own), lang
    assert all(got[i].restored == rows[i][1] for i in got if i not in found)


def test_sources_of_any_number_keep_their_frequencies(spark):
    # of 3000 sources some read Arabic by the wrong table, and some list those very letters
    def text(i):
        return ("ÊÏæÑ ÇáãÖÎÉ ãÑÉ", "ar") if i % 50 == 1 else ("تدور المضخة مرة قبل أن تتوقف", "ar") if i % 2 else ("Â Ã Ä Å", "en")

    rows = [(i, text(i)[0], f"s{i}", text(i)[1]) for i in range(3000)]
    got = {r.doc_id: r.garbled for r in encoding.restore(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")).collect()}
    assert [i for i in got if got[i] != (i % 50 == 1)] == []


def test_arrays_score_as_pairs_do():
    texts = ["où", "", "x" * 70, "١٢٣ 45", "\x02\x03"]
    pair, first, sizes = encoding.pair_codes(texts)
    assert list(zip(pair.tolist(), first.tolist(), strict=True)) == [p for t in texts for p in encoding.pairs_of(t)] and sizes.tolist() == [len(t) + 1 for t in texts]


def test_nulls_ascii_lost_and_empty(spark):
    schema = "doc_id long, text string, source string, lang string"
    long = "plain text " * 50_000
    rows = [(1, None, None, None), (2, "", "s", "en"), (3, long, "s", "en"), (4, "caf� au lait", None, None), (4, "caf� au lait", None, None), (5, "é " * 20_000, "s", None)]
    got = [(r.doc_id, r.garbled, r.restored) for r in encoding.restore(spark.createDataFrame(rows, schema)).collect()]
    assert sorted(got, key=lambda x: x[0])[:3] == [(1, False, None), (2, False, ""), (3, False, long)]
    assert [g[1] for g in got if g[0] == 4] == [True, True] and [g[1] for g in got if g[0] == 5] == [False]
    assert encoding.restore(spark.createDataFrame([], schema)).count() == 0


def test_chains_undo_what_they_do():
    for chain in encoding.CHAINS[1 : encoding.LOST]:
        text = {"cp1251": "слово", "cp1256": "كتاب", "koi8-r": "слово", "cp866": "слово", "cp1253": "λόγος"}.get(chain[-1], "dé")
        made = text
        for wrong, real in list(zip(chain[::2], chain[1::2], strict=True))[::-1]:
            made = harm(made, wrong, real)
        assert encoding.undo(made, chain) == text, chain
    assert encoding.readings("Ù�ÙŠ") == [(encoding.LOST, "في")]


def lossy(text):
    return "".join("�" if b in encoding.UNDEFINED else encoding.letters_of("cp1252")[b] for b in text.encode())


def test_lost_bytes_have_every_filling():
    assert {t for _, t in encoding.readings(lossy("Нужна"))} == {"Ёужна", "Ѝужна", "Џужна", "Аужна", "Нужна"}
    assert len(encoding.readings(lossy("соляная"))) == 125 and len(encoding.readings(lossy("salt”"))) == 5
    assert encoding.readings("caf�") == [(encoding.LOST, "caf�")]


def test_lost_bytes_are_filled_by_the_model(spark):
    texts = ["Соляная кислота, моховая тропа", "класс удивился, сколько яблок", "“salt” and “lens” are said", "я с ним"]
    rows = [(i, texts[i % 4], "s", "en" if i % 4 == 2 else "ru") for i in range(200)]
    # a long run of letters has too many fillings to list them
    broken = ["моховая", "удивился,", "“salt”", "Соляная", "с", "удивился" * 12]
    rows += [(1000 + i, lossy(t), "s", "en" if i == 2 else "ru") for i, t in enumerate(broken)]
    got = {r.doc_id: r for r in encoding.restore(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")).collect()}
    assert all("�" in rows[200 + i][1] and got[1000 + i].garbled for i in range(6))
    assert [got[1000 + i].restored for i in range(4)] == broken[:4] and all(got[1000 + i].whole for i in range(4))
    # "я" and "с" are both words: nothing tells which one was meant
    assert not got[1004].whole
    assert "�" not in got[1005].restored and len(got[1005].restored) == 96
