import pytest

from marginalis.operators.instants import normalised_instants

DESKS = [("BEY", "Asia/Beirut", "DMY"), ("NYC", "America/New_York", "MDY"), ("KTM", "Asia/Kathmandu", "YMD"), ("LHI", "Australia/Lord_Howe", "DMY"), ("ODD", "No/Where", "DMY")]
ABBREVIATIONS = [("EST", -300), ("NPT", 345)]


def us(text):
    import datetime as dt

    return int((dt.datetime.fromisoformat(text) - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)).total_seconds()) * 1_000_000


def read(spark, cases):
    rows = spark.createDataFrame([(str(i), d, v, "clash") for i, (d, v) in enumerate(cases)], "id string, desk_id string, t string, zone_name string")
    desks = spark.createDataFrame(DESKS, "desk_id string, zone_name string, date_order string")
    abbreviations = spark.createDataFrame(ABBREVIATIONS, "abbreviation string, offset_minutes int")
    out = normalised_instants(rows, ["t"], "id", desks, abbreviations, "x")
    return {int(r.record_key): r.utc_us for r in out.collect()}


CASES = [
    ("BEY", "2024-07-01T12:00:00+03:00", us("2024-07-01T09:00:00+00:00")),
    ("BEY", "2024-07-01 12:00", us("2024-07-01T09:00:00+00:00")),
    ("BEY", "2024-01-01T12:00:00", us("2024-01-01T10:00:00+00:00")),
    ("BEY", "05/06/2024 08:20", us("2024-06-05T05:20:00+00:00")),
    ("NYC", "05/06/2024 8:20:01 PM", us("2024-05-07T00:20:01+00:00")),
    ("KTM", "2024/05/06 12:05:00 AM", us("2024-05-05T18:20:00+00:00")),
    ("BEY", "٢٠٢٥-٠٨-٢٩ ٢٣:٤١", us("2025-08-29T20:41:00+00:00")),
    ("BEY", "D:20251104214441+01'00'", us("2025-11-04T20:44:41+00:00")),
    ("BEY", "D:20250213063711Z00'00'", us("2025-02-13T06:37:11+00:00")),
    ("BEY", "D:2025", us("2024-12-31T22:00:00+00:00")),
    ("BEY", "20250430T134339+0100", us("2025-04-30T12:43:39+00:00")),
    ("BEY", "Sat, 19 Apr 2025 10:35:01 +0545", us("2025-04-19T04:50:01+00:00")),
    ("BEY", "2 Nov 2025 23:43:44 EST", us("2025-11-03T04:43:44+00:00")),
    ("NYC", "Nov 11, 2024 1:01 AM", us("2024-11-11T06:01:00+00:00")),
    ("BEY", "2025-09-09 08:51:07 America/Chicago", us("2025-09-09T13:51:07+00:00")),
    ("BEY", "2025-03-15T02:26:16-04:00[America/New_York]", us("2025-03-15T06:26:16+00:00")),
    ("BEY", "1730693883", 1_730_693_883_000_000),
    ("BEY", "1730128837328", 1_730_128_837_328_000),
    ("BEY", "2025-08-16T23:14:56.900853449Z", us("2025-08-16T23:14:56+00:00") + 900_853),
    ("BEY", "1969-12-31T23:59:59Z", -1_000_000),
    ("BEY", "2000-02-29", us("2000-02-28T22:00:00+00:00")),
    # wall time that occurs twice means the earlier instant, skipped one the offset before
    ("NYC", "2024-11-03T01:30:00", us("2024-11-03T05:30:00+00:00")),
    ("NYC", "2024-03-10T02:30:00", us("2024-03-10T07:30:00+00:00")),
    ("LHI", "2024-10-06 02:10", us("2024-10-05T15:40:00+00:00")),
    ("LHI", "2024-04-07 01:45", us("2024-04-06T14:45:00+00:00")),
    ("BEY", "Saturday, 19 April 2025 10:35:01 +0545", us("2025-04-19T04:50:01+00:00")), ("NYC", "Sept 3, 2024 1:01 AM", us("2024-09-03T05:01:00+00:00")),
    # parts of any length are read whole
    ("BEY", "2024-07-01 12:00:00" + " " * 5000 + "+03:00", us("2024-07-01T09:00:00+00:00")), ("BEY", "2024-07-01 12:00:00 " + "A" * 5000 + "/B", None),
    # no case
    ("BEY", "Mayhem 3, 2024 10:00 AM", None), ("BEY", "3 Marzipan 2024 10:00", None), ("BEY", "Nonday, 3 May 2024 10:00", None), ("BEY", "2025-08-16T23:14:56.900853Z", None), ("BEY", "2025-13-02T08:00:00Z", None), ("BEY", "0000-00-00 00:00", None), ("BEY", "D:20241345996100", None), ("BEY", "D:", None),
    ("BEY", "2023-02-29", None), ("BEY", "1900-02-29", None), ("BEY", "2024-01-01T24:00:00", None), ("BEY", "13/13/2024 08:00", None), ("NYC", "01/01/2024 13:00:00 PM", None), ("BEY", "2024-01-01 10:00:00 XYZ", None),
    ("BEY", "2024-01-01 10:00:00 No/Where", None), ("ODD", "2024-01-01 10:00", None), (None, "2024-01-01 10:00", None), ("BEY", None, None), ("BEY", "", None), ("BEY", "  ", None), ("BEY", "today", None), ("BEY", "x" * 100_000, None),
]


def test_each_spelling(spark):
    got = read(spark, [c[:2] for c in CASES])
    for i, (desk, value, expected) in enumerate(CASES):
        assert got.get(i) == expected, (desk, value)


def test_repeated_rows_and_empty_tables(spark):
    rows = spark.createDataFrame([("k", "BEY", "1730693883")] * 3, "id string, desk_id string, t string")
    desks = spark.createDataFrame(DESKS, "desk_id string, zone_name string, date_order string")
    none = spark.createDataFrame([], "abbreviation string, offset_minutes int")
    assert normalised_instants(rows, ["t"], "id", desks, none, "x").count() == 1
    assert normalised_instants(rows.limit(0), ["t"], "id", desks.limit(0), none, "x").count() == 0


@pytest.mark.parametrize("day", [-719162, -1, 0, 59, 11016, 19782, 2932896])
def test_day_arithmetic(spark, day):
    import datetime as dt

    from pyspark.sql import functions as F

    from marginalis.functions.instants import epoch_day

    date = dt.date(1970, 1, 1) + dt.timedelta(days=day)
    got = spark.range(1).select(epoch_day(F.lit(date.year).cast("long"), F.lit(date.month).cast("long"), F.lit(date.day).cast("long")).alias("d")).first()[0]
    assert int(got) == day
