"""Timestamps in many spellings to one instant in microseconds (problem 2).

All spellings are one regular expression, an alternation of formats with named
groups.  One ``regexp_replace`` turns a value into its components, which
``split`` makes an array; from there everything is integer arithmetic on
columns, so the whole conversion stays in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# English month names, by their first three letters.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

# How the names of months and weekdays go on after three letters.
MONTH_NAMES = "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
DAY_NAMES = "mon(?:day)?|tue(?:s(?:day)?)?|wed(?:nesday)?|thu(?:rs?(?:day)?)?|fri(?:day)?|sat(?:urday)?|sun(?:day)?"

#: The one form that needs no normalising.
CANONICAL = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}Z$"

#: Digits other than ASCII ones that values are written in.
DIGITS = ("٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹０１２３４５６７８９", "0123456789" * 3)

#: Order of the components in the array.
PARTS = ("y", "mo", "d", "h", "mi", "s", "f", "ap", "sg", "oh", "om", "zn", "ab", "p1", "p2", "p3", "ep")


class _Format:
    """A format under construction: each use of a component is a new group."""

    groups: dict[str, list[str]] = {p: [] for p in PARTS}

    @classmethod
    def g(cls, part: str, pattern: str) -> str:
        name = f"{part}x{len(cls.groups[part])}"
        cls.groups[part].append(name)
        return f"(?<{name}>{pattern})"


def _build() -> tuple[str, str]:
    g = _Format.g
    frac = lambda: rf"(?:[.,]{g('f', r'\d{1,12}')})?"
    # Z, +hh, +hh:mm, +hhmm, +hh'mm', Z00'00' (PDF), each optional
    offset = lambda: rf"(?:\s*{g('sg', '[+-]')}{g('oh', r'\d\d')}(?:[:']?{g('om', r'\d\d')}'?)?|\s*{g('sg', '[Zz]')}(?:00'?(?:00'?)?)?)?"
    region = r"[A-Za-z]+(?:/[A-Za-z0-9_+\-]+)+|UTC"
    zone = lambda: rf"(?:\s*\[?{g('zn', region)}\]?)?"
    ampm = lambda: rf"\s*{g('ap', r'[AaPp]\.?[Mm]\.?(?![A-Za-z])')}"
    clock = lambda: rf"{g('h', r'\d{1,2}')}:{g('mi', r'\d\d')}(?::{g('s', r'\d\d')}{frac()})?(?:{ampm()})?"
    month = lambda: g("mo", MONTH_NAMES)
    day_name = rf"(?:(?:{DAY_NAMES})\.?,?\s+)?"
    abbr = lambda: rf"(?:{offset()}|\s*{g('ab', '[A-Z]{1,5}')})"
    # date and time with separators, year first; also the basic form without them
    iso = rf"{g('y', r'\d{4}')}-{g('mo', r'\d\d')}-{g('d', r'\d\d')}(?:[Tt\s]\s*{clock()}{offset()}{zone()})?"
    iso_abbr = rf"{g('y', r'\d{4}')}-{g('mo', r'\d\d')}-{g('d', r'\d\d')}[Tt\s]\s*{clock()}\s*{g('ab', '[A-Z]{2,5}')}"
    basic = rf"{g('y', r'\d{4}')}{g('mo', r'\d\d')}{g('d', r'\d\d')}[Tt]{g('h', r'\d\d')}{g('mi', r'\d\d')}(?:{g('s', r'\d\d')}{frac()})?{offset()}"
    basic_day = rf"{g('y', r'\d{4}')}{g('mo', r'\d\d')}{g('d', r'\d\d')}"
    pdf = (
        rf"[Dd]:{g('y', r'\d{4}')}(?:{g('mo', r'\d\d')}(?:{g('d', r'\d\d')}(?:{g('h', r'\d\d')}"
        rf"(?:{g('mi', r'\d\d')}(?:{g('s', r'\d\d')})?)?)?)?)?{offset()}"
    )
    # all digits, order of the parts by desk
    digits = rf"{g('p1', r'\d{1,4}')}[/.]{g('p2', r'\d{1,2}')}[/.]{g('p3', r'\d{1,4}')}(?:,?\s+{clock()}{abbr()}{zone()})?"
    # [Day,] 19 Apr 2025 10:35:01 +0545 or EEST
    day_first = rf"{day_name}{g('d', r'\d{1,2}')}[\s-]{month()}\.?,?[\s-]{g('y', r'\d{4}')}(?:,?\s+{clock()}{abbr()}{zone()})?"
    month_first = rf"{day_name}{month()}\.?\s+{g('d', r'\d{1,2}')},?\s+{g('y', r'\d{4}')}(?:,?\s+{clock()}{abbr()}{zone()})?"
    epoch = rf"{g('ep', r'\d{9,10}|\d{12,13}|\d{15,16}|\d{18,19}')}"
    pattern = r"^\s*(?i:" + "|".join((iso, iso_abbr, basic, basic_day, pdf, digits, day_first, month_first, epoch)) + r")\s*$"
    made = "\x01" + "\x1f".join("".join("${" + n + "}" for n in _Format.groups[p]) for p in PARTS)
    return pattern, made


PATTERN, TEMPLATE = _build()


def present(df: DataFrame, out: str, value: Column, keep: list[str] | None = None) -> DataFrame:
    """Add ``out`` and drop the rows where it is null.

    A filter would be pushed below and compute ``value`` a second time there;
    a generator computes it once.
    """
    return df.select(*(keep or df.columns), F.explode(F.array_compact(F.array(value))).alias(out))


def components(value: Column) -> Column:
    """Array of the text components in the order of PARTS; null if no format fits."""
    folded = F.regexp_replace(F.translate(value, *DIGITS), r"[\u00a0\u2007\u202f\u2009\u200e\u200f]", " ")
    made = F.regexp_replace(folded, F.lit(PATTERN), F.lit(TEMPLATE))
    return F.when(made.startswith("\x01"), F.split(F.substr(made, F.lit(2)), "\x1f", -1))


def epoch_day(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970-01-01 of a proleptic Gregorian date, in integers.

    The year is counted from March, so that the leap day is its last one.
    """
    shifted = y - F.when(m <= 2, 1).otherwise(0)
    since_march = F.pmod(m + 9, F.lit(12))
    floor = lambda a, n: F.floor(a / n)  # noqa: E731  (exact below 2^53)
    return shifted * 365 + floor(shifted, 4) - floor(shifted, 100) + floor(shifted, 400) + floor(since_march * 153 + 2, 5) + d - 719469


def month_days(y: Column, m: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    return F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)


def with_instant(df: DataFrame, out: str, parts: str, zone: str, date_order: str, minutes: str, zones: list[str]) -> DataFrame:
    """Add ``out``: microseconds since 1970-01-01 UTC of an array of components.

    The arguments name columns: the array, the zone of wall times, the order
    (DMY, MDY, YMD) of all-digit dates, and the offset of the value's zone
    abbreviation or null; ``zones`` are the zone ids the JVM knows.  Rows
    whose value names no possible date and time, an unknown zone or
    abbreviation, or wall time without a zone are dropped.

    Each step is a projection of its own: one is used several times by the
    next, so Catalyst keeps them apart and the generated code stays small.
    """
    at = {p: F.get(F.col(parts), F.lit(i)) for i, p in enumerate(PARTS)}
    order = F.col(date_order)
    text = df.withColumns(
        {f"_{p}": at[p] for p in ("ap", "sg", "zn", "ab", "ep")}
        | {f"_{p}": at[p].try_cast("long") for p in ("h", "mi", "s", "oh", "om", "p1", "p2", "p3")}
        | {
            "_y": at["y"].try_cast("long"),
            "_mo": F.when(at["mo"] == "", F.lit(1)).otherwise(
                F.coalesce(
                    F.nullif(F.array_position(F.array(*[F.lit(x) for x in MONTHS]), F.lower(F.substring(at["mo"], 1, 3))), F.lit(0).cast("long")),
                    at["mo"].try_cast("long"),
                )
            ),
            "_d": F.when(at["d"] == "", F.lit(1).cast("long")).otherwise(at["d"].try_cast("long")),
            "_f": F.substring(F.rpad(at["f"], 6, "0"), 1, 6).try_cast("long"),
            "_lead": F.when((F.length(at["p1"]) == 4) & (F.length(at["p3"]) <= 2), "Y").when((F.length(at["p3"]) == 4) & (F.length(at["p1"]) <= 2), order),
            "_digits": at["p1"] != "",
        }
    )
    p1, p2, p3, lead = F.col("_p1"), F.col("_p2"), F.col("_p3"), F.col("_lead")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    civil = text.withColumns(
        {
            "_y": F.when(F.col("_digits"), F.when(lead == "Y", p1).otherwise(p3)).otherwise(F.col("_y")),
            "_mo": F.when(F.col("_digits"), F.when(lead == "MDY", p1).when(lead.isNotNull(), p2)).otherwise(F.col("_mo")),
            "_d": F.when(F.col("_digits"), F.when(lead == "Y", p3).when(lead == "MDY", p2).when(lead.isNotNull(), p1)).otherwise(F.col("_d")),
            "_h": F.when(
                F.col("_ap") != "",
                F.when(zero("_h").between(1, 12), zero("_h") % 12 + F.when(F.lower(F.substring("_ap", 1, 1)) == "p", 12).otherwise(0)),
            ).otherwise(zero("_h")),
            "_clock": zero("_mi") * 60 + zero("_s"),
            "_clock_ok": (zero("_mi") <= 59) & (zero("_s") <= 59) & (zero("_oh") <= 18) & (zero("_om") <= 59),
            "_east": (zero("_oh") * 60 + zero("_om")) * F.when(F.col("_sg") == "-", -1).otherwise(1),
        }
    )
    y, mo, d = F.col("_y"), F.col("_mo"), F.col("_d")
    local = civil.withColumn(
        "_local",
        F.when(
            y.between(1, 9999) & mo.between(1, 12) & d.between(1, 31) & (d <= month_days(y, mo)) & (F.col("_h") <= 23) & F.col("_clock_ok"),
            ((epoch_day(y, mo, d) * 24 + F.col("_h")) * 3600 + F.col("_clock")) * 1_000_000 + F.col("_f"),
        ),
    ).withColumn("_zone_id", F.when(F.col("_zn") != "", F.col("_zn")).otherwise(F.col(zone)))
    known = F.col("_zone_id").isin(zones)
    ticks, size = F.col("_ep").try_cast("decimal(20,0)"), F.length("_ep")
    return present(
        local,
        out,
        F.when(
            F.col("_ep") != "",
            F.when(size <= 10, ticks * 1_000_000).when(size <= 13, ticks * 1000).when(size <= 16, ticks).otherwise(F.floor(ticks / 1000)).cast("long"),
        )
        .when(F.col("_sg") != "", F.col("_local") - F.col("_east") * 60_000_000)
        .when(F.col("_ab") != "", F.col("_local") - F.col(minutes).cast("long") * 60_000_000)
        .when(known, F.unix_micros(F.to_utc_timestamp(F.timestamp_micros("_local"), F.when(known, F.col("_zone_id"))))),
        df.columns,
    )
