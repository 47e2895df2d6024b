"""Visually identical text in different characters to one form (problem 3).

The mapping runs as SQL of an embedded DuckDB on the Arrow batches of each
partition.  Its tables come from rules over the Unicode character database;
only what the database doesn't hold (which letters of other scripts look like
Latin ones) is stated here.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginalis.session import cut, digest

# Letters of Cyrillic, Greek, Armenian and others with the shape of the Latin letter below them.
LOOKALIKES = (
    ("АВЕЅІЈКМНОРСТҮХԚԜҺԌаеѕіјорсухһԁԛԝ", "ABESIJKMHOPCTYXQWHGaesijopcyxhdqw"),
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονϲϹ", "ABEZHIKMNOPTYXovcC"),
    ("ՕՍՏօսոհցᎪᏴᏟᎬᏦᏞᎷᏢᏒᏚᎢᏙᏃ", "OUSounhgABCEKLMPRSTVZ"),
    ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFNLSRVHWXYAEIOU"),
    ("Ӏӏ", "Il"),
    ("ЁЇЀёїѐΆΈΊΌΎΪΫόӒӐӓӑӖӗӦӧ", "ËÏÈëïèÁÉÍÓÝÏŸóÄĂäăĔĕÖö"),
)

# Compatibility decompositions that keep the printed shape.
SAME_SHAPE_TAGS = ("<wide>", "<narrow>", "<isolated>", "<initial>", "<medial>", "<final>", "<noBreak>", "<compat>")

# Fixed values: <compat> characters that do look different from their decomposition.
DIFFERENT_SHAPE = "ſﬅŉ…‥‴‷⁗″‶‼⁇⁈⁉"

#: Letters that have one shape at the start and inside of a word and another at its end.
FARSI_YEH, YEH, ALEF_MAKSURA = "ی", "ي", "ى"
FARSI_KAF, KAF = "ک", "ك"


@cache
def mappings() -> tuple[dict[str, str], dict[str, str], str]:
    """(one character to one, one to several, invisible characters)."""
    single, several, invisible = {}, {}, []
    for code in range(0xA0, sys.maxunicode + 1):
        ch = chr(code)
        kind = unicodedata.category(ch)
        if kind == "Cf" or 0xFE00 <= code <= 0xFE0F or code in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0) or 0xE0100 <= code <= 0xE01EF:
            if not 0x0600 <= code <= 0x0605 and code not in (0x06DD, 0x070F, 0x08E2):  # signs that print
                invisible.append(ch)
            continue
        if kind == "Zs":
            single[ch] = " "
            continue
        parts = unicodedata.decomposition(ch).split()
        if parts and parts[0] in SAME_SHAPE_TAGS and ch not in DIFFERENT_SHAPE:
            # fully, but step by step, so that no raised or circled form is resolved on the way
            made = _resolve("".join(chr(int(x, 16)) for x in parts[1:]))
            if not made.startswith(" "):  # accents that stand alone
                (single if len(made) == 1 else several)[ch] = made
    for seen, meant in LOOKALIKES:
        single |= {a: b for a, b in zip(seen, meant, strict=True) if a != b}
    single |= {"‐": "-", "ʼ": "’", "‑": "-", "µ": "μ", "Ω": "Ω", "K": "K", "Å": "Å"}
    return single, several, "".join(invisible)


def _resolve(text: str) -> str:
    out = []
    for ch in text:
        parts = unicodedata.decomposition(ch).split()
        if parts and parts[0] in SAME_SHAPE_TAGS and ch not in DIFFERENT_SHAPE:
            out.append(_resolve("".join(chr(int(x, 16)) for x in parts[1:])))
        else:
            out.append(" " if unicodedata.category(ch) == "Zs" else ch)
    return "".join(out)


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _class(chars: str) -> str:
    """Regular-expression class, neighbouring characters as ranges."""
    runs: list[list[int]] = []
    for code in sorted(map(ord, set(chars))):
        if runs and code == runs[-1][1] + 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs) + "]"


@cache
def touched() -> str:
    """Class of all characters that the mapping or NFC may change."""
    single, several, invisible = mappings()
    moved = [chr(c) for c in range(0xA0, sys.maxunicode + 1) if unicodedata.combining(chr(c)) or (not 0xAC00 <= c < 0xD7A4 and unicodedata.normalize("NFC", chr(c)) != chr(c))]
    # Hangul vowels and finals compose, too
    return _class("".join(sorted({*single, *several, *invisible, *moved, *map(chr, range(0x1161, 0x11C3)), FARSI_YEH, FARSI_KAF})))


def canonical_sql(relation: str, text: str = "text", out: str = "form") -> str:
    """SELECT of all columns of ``relation`` and the one form of ``text``.

    The steps in order: invisible characters go; compatibility forms that
    print alike become what they stand for; letters of one shape become the
    Latin ones, before and after accents are composed, as a composed letter
    may be a look-alike; Farsi yeh and kaf become the Arabic letters they look
    like at their place in the word; white space collapses.  Each text takes
    only the steps that its characters call for: a scan for the characters a
    step changes costs a small part of the step.
    """
    single, several, invisible = mappings()
    table = f"{_quote(''.join(single))}, {_quote(''.join(single.values()))}"
    keys = "[" + ", ".join(map(_quote, several)) + "]"
    values = "[" + ", ".join(map(_quote, several.values())) + "]"
    forms = f"map({keys}, {values})"
    letter = r"[\x{0620}-\x{064a}\x{066e}-\x{06d3}]"
    mark = r"[\x{0640}\x{064b}-\x{065f}\x{0670}]*"
    has = lambda chars: f"regexp_matches(t, {_quote(_class(chars))})"
    steps = [
        f"CASE WHEN odd THEN regexp_replace(t, {_quote(_class(invisible))}, '', 'g') ELSE t END",
        f"CASE WHEN odd AND {has(''.join(several))} THEN "
        f"list_aggregate(list_transform(string_split(t, ''), lambda c: coalesce(map_extract({forms}, c)[1], c)), 'string_agg', '') ELSE t END",
        f"CASE WHEN odd AND {has(''.join(single))} THEN translate(t, {table}) ELSE t END",
        "CASE WHEN odd THEN nfc_normalize(t) ELSE t END",
        f"CASE WHEN odd AND {has(''.join(single))} THEN nfc_normalize(translate(t, {table})) ELSE t END",
        f"CASE WHEN odd AND (contains(t, '{FARSI_YEH}') OR contains(t, '{FARSI_KAF}')) THEN "
        f"replace(replace(regexp_replace(regexp_replace(t, '{FARSI_YEH}({mark}{letter})', '{YEH}\\1', 'g'), '{FARSI_YEH}({mark}{letter})', '{YEH}\\1', 'g'), "
        f"'{FARSI_YEH}', '{ALEF_MAKSURA}'), '{FARSI_KAF}', '{KAF}') ELSE t END",
        r"trim(CASE WHEN regexp_matches(t, '[\t-\r]|  ') THEN regexp_replace(t, '\s+', ' ', 'g') ELSE t END)",
    ]
    sql = f"SELECT *, {text} AS t, strlen({text}) > length({text}) AND regexp_matches({text}, {_quote(touched())}) AS odd FROM {relation}"
    for step in steps:
        sql = f"SELECT * REPLACE ({step} AS t) FROM ({sql})"
    return f"SELECT * EXCLUDE (odd) RENAME (t AS {out}) FROM ({sql})"


def canonical_texts(df: DataFrame, text: str, out: str = "form") -> DataFrame:
    """Add ``out``: ``text`` in its one form.

    Two texts get the same form if they look alike in print: width of letters
    and spaces, invisible characters, the way accents, ligatures and hyphens
    are stored and the script of a same-shaped letter are evened out; case,
    accents, raised digits, punctuation and lengths of dashes stay.  Null stays
    null; empty and blank texts, or invisible ones, become ''.  Texts may be of
    any length.  A column named ``out`` is replaced.
    """
    sql = canonical_sql("batch", "text", "form")
    if out != text:
        df = df.drop(out)
    kept = [f for f in df.schema.fields if f.name != out]
    schema = T.StructType([*kept, T.StructField(out, T.StringType())])
    names, at = schema.fieldNames(), df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        # one thread keeps the order of rows; the text alone goes in, so no column's name can clash
        con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        for item in batches:
            con.register("batch", pa.table({"text": item.column(at)}))
            made = con.sql(sql).to_arrow_table().column("form").cast(pa.string()).combine_chunks()
            con.unregister("batch")
            others = [c for c, n in zip(item.columns, item.schema.names, strict=True) if n != out]
            yield pa.RecordBatch.from_arrays([*others, made.combine_chunks() if isinstance(made, pa.ChunkedArray) else made], names=names)

    return df.mapInArrow(run, schema)


def look_alikes(df: DataFrame, scope: str, key: str, fields: list[str]) -> DataFrame:
    """(field, key_a, key_b): pairs within one scope whose values of a field
    look alike but aren't the same code points; a < b by code point.

    Blank values take no part, nor do rows without a key; null scopes are one
    scope.  Repeated rows count once.  Empty tables give no rows.

    Plan: one pass over the texts writes hashes of form and spelling.  Groups
    of (scope, field, form) are reduced to their least and largest spelling
    with map-side combine; only groups of two and more spellings go on, are
    written, spellings are paired, and the pairs meet the rows of either.
    So a text that a third of the rows share costs nothing unless spelled in
    several ways, and then as much as it has pairs.
    """
    values = (
        df.select(scope, key, F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields])).alias("x"))
        .select(F.col(scope).alias("scope"), F.col(key).alias("key"), "x.*")
        .where("text is not null and key is not null")
    )
    # written once: forms take long, and hashes are short
    rows = cut(canonical_texts(values, "text").where("form <> ''").select("field", "key", digest("scope", "field", "form").alias("g"), F.unhex(F.md5("text")).alias("s")))
    mixed = rows.groupBy("g").agg(F.min("s").alias("lo"), F.max("s").alias("hi")).where("lo <> hi").select("g")
    kept = cut(rows.join(mixed, "g", "left_semi").distinct())
    spellings = kept.select("g", "s").distinct()
    pairs = spellings.withColumnRenamed("s", "s_a").join(spellings.withColumnRenamed("s", "s_b"), "g").where("s_a <> s_b")
    a = kept.select("g", F.col("s").alias("s_a"), "field", F.col("key").alias(f"{key}_a"))
    b = kept.select("g", F.col("s").alias("s_b"), F.col("key").alias(f"{key}_b"))
    return pairs.join(a, ["g", "s_a"]).join(b, ["g", "s_b"]).where(F.col(f"{key}_a") < F.col(f"{key}_b")).select("field", f"{key}_a", f"{key}_b").distinct()
