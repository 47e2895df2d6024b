"""Scalar operators as column expressions.

Null and '' mean the same at every comparison; results are '' where the input
says nothing, unless stated otherwise.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The ten digits of the Arabic and the Persian script.
EASTERN_DIGITS = "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹"

# Raw author names that identify nobody.
GENERIC_AUTHORS = ("", "user", "reviewer", "author", "unknown", "anonymous", "admin")

# Texts of a flag that mean true, and those that mean inactive.
TRUE_TEXTS = ("1", "true", "yes", "y")
INACTIVE_TEXTS = ("", "false", "0", "no", "inactive")


def blank_null(col: Column) -> Column:
    """The text, null if it is null or blank."""
    return F.nullif(strip(col), F.lit(""))


def text(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def strip(col: Column) -> Column:
    """White space of any kind off both ends (``trim`` takes blanks only)."""
    return F.regexp_replace(text(col), r"(?U)^\s+|\s+$", "")


def collapse(col: Column) -> Column:
    """Runs of white space to one blank, none at the ends."""
    return F.trim(F.regexp_replace(text(col), r"(?U)\s+", " "))


def _compose(values: pd.Series) -> pd.Series:
    return values.map(lambda v: v if v is None or v.isascii() else unicodedata.normalize("NFKC", v))


def normalize_text(col: Column) -> Column:
    """NFKC, directional marks and hair spaces to blanks, white space collapsed.

    Compatibility forms aren't among Spark's functions; only values beyond
    ASCII take the vectorised detour.
    """
    return collapse(F.translate(F.pandas_udf(_compose, "string")(text(col)), " ‎‏", "   "))


def fold_digits(col: Column) -> Column:
    return F.translate(text(col), EASTERN_DIGITS, "0123456789" * 2)


def fingerprint(*cols: Column) -> Column:
    """SHA-256 of the texts joined by '|'."""
    return F.sha2(F.concat_ws("|", *[text(c) for c in cols]), 256)


def rounded(col: Column, digits: int = 1) -> Column:
    """A coordinate as text with a fixed number of decimals, ties to even."""
    return F.format_string(f"%.{digits}f", F.bround(F.coalesce(col.cast("double"), F.lit(0.0)), digits))


def entry_id(annotation_id: Column, fallback: Column) -> Column:
    """The native id, or 'fallback:' and the fingerprint."""
    return F.coalesce(blank_null(annotation_id), F.concat(F.lit("fallback:"), text(fallback)))


def identity_key(reviewer: Column, book_page: Column, annotation_id: Column, fallback: Column) -> Column:
    """Key of an annotation that depends on its reviewer and page."""
    native = blank_null(annotation_id)
    return F.when(native.isNotNull(), fingerprint(F.lit("native"), reviewer, book_page, native)).otherwise(fingerprint(F.lit("fallback"), fallback))


def pdf_date(col: Column) -> Column:
    """PDF date D:YYYYMMDDHHMMSS[Z|+hh'mm'] to ISO text; other texts as they are."""
    pattern = r"^D:(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})(?:(Z).*|([+-]\d{2})'?(\d{2})'?)?$"
    t = strip(col)
    zoned = F.regexp_replace(t, pattern, "$1-$2-$3T$4:$5:$6$7$8:$9")
    # without an offset the template leaves a colon at the end
    plain = F.regexp_replace(F.regexp_replace(zoned, ":$", ""), "Z$", "+00:00")
    return F.when(t.rlike(pattern), plain).otherwise(t)


def relation_type(parent_xref: Column, relation_raw: Column) -> Column:
    """ROOT without a parent number, GROUP if so marked, else REPLY."""
    parent = F.coalesce(parent_xref.try_cast("int"), F.lit(0))
    return F.when(parent == 0, "ROOT").when(F.lower(F.ltrim(strip(relation_raw), F.lit("/"))) == "group", "GROUP").otherwise("REPLY")


def should_import(annotation_type: Column, comment: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """(keep, reason): a comment keeps; an empty one goes by the rule of its
    type, then the default rule, then is kept."""
    rule = F.lit(rules.get("default", "keep"))
    kind = F.lower(strip(annotation_type))
    for name, action in rules.items():
        if name != "default":
            rule = F.when(kind == name.lower(), F.lit(action)).otherwise(rule)
    keep = (strip(comment) != "") | (rule == "keep")
    return keep, F.when(keep, "").otherwise(F.concat(F.lit("empty_"), kind))


def raw_author(col: Column) -> Column:
    """Raw author for comparing: white space collapsed, lower case."""
    return F.lower(collapse(col))


def is_generic(col: Column) -> Column:
    return raw_author(col).isin(*GENERIC_AUTHORS)


def raw_authors_match(expected: Column, actual: Column) -> Column:
    """Generic names match to the letter, others in any case."""
    exact = collapse(expected) == collapse(actual)
    return F.when(is_generic(expected) | is_generic(actual), exact).otherwise(raw_author(expected) == raw_author(actual))


def document_key(col: Column) -> Column:
    return F.regexp_replace(F.replace(F.upper(strip(col)), F.lit("-"), F.lit("_")), r"(?U)\s+", "_")


def version_id(document: Column, sha256: Column) -> Column:
    """KEY@sha; null for a blank key or a hash that hasn't 64 characters."""
    key, sha = document_key(document), F.lower(strip(sha256))
    return F.when((key != "") & (F.length(sha) == 64), F.concat(key, F.lit("@"), sha))


def truthy(col: Column) -> Column:
    return F.lower(strip(col)).isin(*TRUE_TEXTS)


def is_active(col: Column) -> Column:
    """Whether a stored flag means active; null and blank don't."""
    return ~F.lower(strip(col)).isin(*INACTIVE_TEXTS)


def entry_signature(*cols: Column) -> Column:
    """Equal if and only if all fields are equal as text; null is ''."""
    return F.sha2(F.to_json(F.struct(*[text(c).alias(f"f{i:02d}") for i, c in enumerate(cols)])), 256)


def coordinates(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.concat_ws(",", *[text(c) for c in (x0, y0, x1, y1)])


def overlap_area(a: list[Column], b: list[Column]) -> Column:
    """Area common to two boxes (x0, y0, x1, y1); 0 if they don't meet."""
    width = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    height = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.when((width > 0) & (height > 0), width * height).otherwise(F.lit(0.0))


def footer_status(book_page: Column, candidates: Column) -> Column:
    """footer_verified or footer_mismatch for a page number in digits against
    an array of candidates; '' if either says nothing."""
    page = fold_digits(strip(book_page))
    numbers = F.filter(F.transform(candidates, lambda c: F.translate(c, EASTERN_DIGITS, "0123456789" * 2).try_cast("int")), lambda c: c.isNotNull())
    return (
        F.when(~page.rlike(r"^\d{1,9}$") | (F.coalesce(F.size(numbers), F.lit(0)) <= 0), "")
        .when(F.array_contains(numbers, page.try_cast("int")), "footer_verified")
        .otherwise("footer_mismatch")
    )


def looks_like_full_name(col: Column, generic: tuple[str, ...] = GENERIC_AUTHORS) -> Column:
    """Two and more words, a letter in each of the first four, not generic."""
    parts = F.split(collapse(col), " ")
    return (F.size(parts) >= 2) & F.forall(F.slice(parts, 1, 4), lambda p: p.rlike(r"\p{L}")) & ~raw_author(col).isin(*generic)


# Words of file names that belong to no name.
FILE_WORDS = (
    "igcse", "arabic", "cie", "cambridge", "book", "pdf", "review", "reviewed", "comment", "comments", "final", "copy", "version", "part", "workbook", "student", "teacher", "2p", "v2", "v3",
)


def file_reviewer(filename: Column, aliases: dict[str, str], generic: tuple[str, ...] = GENERIC_AUTHORS) -> Column:
    """Reviewer by the name of a file: the first alias that stands in it as
    words, else what is left without numbers and common words, if that is a
    full name of up to four words; else ''."""
    stem = collapse(F.regexp_replace(F.regexp_replace(text(filename), r"\.[^.]*$", ""), r"[_.()\\-]+", " "))
    words = F.concat(F.lit(" "), F.lower(stem), F.lit(" "))
    named = F.lit(None).cast("string")
    if aliases:
        known = F.array(*[F.struct(F.lit(f" {' '.join(a.split()).lower()} ").alias("alias"), F.lit(" ".join(n.split())).alias("name")) for a, n in aliases.items() if a.strip()])
        named = F.get(F.filter(known, lambda k: F.contains(words, k["alias"])), F.lit(0))["name"]
    kept = F.filter(F.split(stem, " "), lambda t: ~F.lower(t).isin(*FILE_WORDS, *generic) & ~t.rlike(r"^\d*$"))
    left = F.array_join(kept, " ")
    return F.coalesce(named, F.when(looks_like_full_name(left, generic) & (F.size(kept) <= 4), left), F.lit(""))


def reviewer_name(raw: Column, filename: Column, aliases: dict[str, str], explicit: Column | None = None, generic: tuple[str, ...] = GENERIC_AUTHORS) -> Column:
    """The explicit reviewer if that is a full name, else by alias of the raw
    author, the raw author if it is a full name, or by the file's name; else ''."""
    by_alias = F.lit(None).cast("string")
    if aliases:
        names = {" ".join(a.split()).lower(): " ".join(n.split()) for a, n in aliases.items()}
        by_alias = F.nullif(F.try_element_at(F.create_map(*[F.lit(x) for item in names.items() for x in item]), raw_author(raw)), F.lit(""))
    first = F.when(looks_like_full_name(explicit, generic), collapse(explicit)) if explicit is not None else F.lit(None).cast("string")
    return F.coalesce(first, by_alias, F.when(looks_like_full_name(raw, generic), collapse(raw)), file_reviewer(filename, aliases, generic))
