"""Event-time expressions: the reference's own cases, plus zone independence."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import timeexpr as tx

PHX = "America/Phoenix"


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_parse_local_text_to_epoch(spark):
    parsed = tx.parse_local_text(F.lit("2025-03-18 05:26:55"), PHX)
    assert one(spark, tx.epoch_seconds(parsed)) == 1742300815


def test_epoch_to_local_text(spark):
    assert one(spark, tx.local_text(tx.from_epoch(F.lit(1745790930)), PHX)) == "2025-04-27 14:55:30"
    assert one(spark, tx.local_text(tx.from_epoch(F.lit(1742297215)), PHX)) == "2025-03-18 04:26:55"


def test_round_trip_and_naive_relabel(spark):
    text = "2025-04-29 07:44:25"
    back = tx.local_text(tx.local_to_utc(tx.ntz(dt.datetime(2025, 4, 29, 7, 44, 25)), PHX), PHX)
    assert one(spark, back) == text
    assert one(spark, tx.local_text(tx.parse_local_text(F.lit(text), PHX), PHX)) == text


def test_bad_format_is_invalid(spark):
    for bad in ["2025-03-18T05:26:55Z", "2025-13-18 05:26:55", "", None, "2025-03-18"]:
        lit = F.lit(bad).cast("string")
        assert one(spark, tx.is_valid_text(lit)) in (False, None)
        assert one(spark, tx.parse_local_text(lit, PHX)) is None


def test_ordering_and_comparison(spark):
    a, b = tx.ntz("2025-03-18 05:26:55"), tx.ntz("2025-03-18 05:26:56")
    row = spark.range(1).select((a < b).alias("lt"), (b > a).alias("gt"), (a <= a).alias("le"),
                                (tx.epoch_seconds(b) - tx.epoch_seconds(a)).alias("d")).first()
    assert row["lt"] and row["gt"] and row["le"] and row["d"] == 1


def test_seconds_are_truncated(spark):
    t = tx.ntz("2024-01-01 00:00:59.900")
    assert one(spark, tx.format_text(t)) == "2024-01-01 00:00:59"
    assert one(spark, tx.seconds_between(tx.ntz("2024-01-01 00:00:00.600"), tx.ntz("2024-01-01 00:01:00.100"))) == 60


def test_zone_free_under_dst_session(spark):
    """A wall time that does not exist in the session zone must not move."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        t = tx.ntz("2024-03-10 02:30:00.700")
        row = spark.range(1).select(tx.epoch_seconds(t).alias("e"), tx.format_text(t).alias("s"),
                                    tx.seconds_between(tx.ntz("2024-03-10 01:30:00"), t).alias("d")).first()
        assert row["e"] == 1710037800
        assert row["s"] == "2024-03-10 02:30:00"
        assert row["d"] == 3600
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_report_time_format(spark):
    # 2024-01-20 00:45:30 UTC is 1/19/24 5:45 PM in Phoenix; midnight/noon use 12
    assert one(spark, tx.report_time(tx.ntz("2024-01-20 00:45:30"), PHX)) == "1/19/24 5:45 PM"
    assert one(spark, tx.report_time(tx.ntz("2024-01-20 07:05:00"), PHX)) == "1/20/24 12:05 AM"
    assert one(spark, tx.report_time(tx.ntz("2024-01-20 19:00:00"), PHX)) == "1/20/24 12:00 PM"
