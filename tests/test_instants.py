from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from presslake.functions.instants import mask_of, to_micros, tokens_of, zone_table
from presslake.operators.timestamps import normalise_timestamps


def read(text, zone=None, order=None, calendar="gregorian"):
    micros, ok = to_micros([text], [zone], [order], [calendar])
    return datetime.fromtimestamp(micros[0] / 1e6, timezone.utc).replace(tzinfo=None).isoformat() if ok[0] else None


@pytest.mark.parametrize(
    "text, zone, order, want",
    [
        ("2026-05-25 06:16:11 Europe/London", None, None, "2026-05-25T05:16:11"),
        ("Thu, 18 Jun 2026 12:06:45 +0930", None, None, "2026-06-18T02:36:45"),
        ("Sun, 21 Sep 2025 08:19:04 -0500 (CDT)", None, None, "2025-09-21T13:19:04"),
        ("2024-10-27T02:13:22+01:00[Europe/Paris]", None, None, "2024-10-27T01:13:22"),
        ("2025-01-14T08:48:59.909868513-04", None, None, "2025-01-14T12:48:59.909868"),
        ("20240421T203948+0700", None, None, "2024-04-21T13:39:48"),
        ("1762316346961", None, None, "2025-11-05T04:19:06.961000"),
        ("1775109060179444", None, None, "2026-04-02T05:51:00.179444"),
        ("1754872928.212", None, None, "2025-08-11T00:42:08.212000"),
        ("2026-06-01 23:43 CST", "Asia/Shanghai", "ymd", "2026-06-01T15:43:00"),
        ("2026-06-01 23:43 CST", "America/Chicago", "mdy", "2026-06-02T05:43:00"),
        ("January 11, 2026 6:21 AM SGT", "Asia/Singapore", "dmy", "2026-01-10T22:21:00"),
        ("April 27, 2026 12:15 am IST", "Asia/Kolkata", "dmy", "2026-04-26T18:45:00"),
        ("9/28/2026", "America/New_York", "mdy", "2026-09-28T04:00:00"),
        ("08-APR-26", "Europe/Paris", "dmy", "2026-04-07T22:00:00"),
        ("05/09/24", "Asia/Shanghai", "ymd", "2005-09-23T16:00:00"),
        ("发布时间：2025年11月8日 下午6:36", "Asia/Shanghai", "ymd", "2025-11-08T10:36:00"),
        ("2024.2.22 上午12:06", "Asia/Shanghai", "ymd", "2024-02-21T16:06:00"),
        ("２０２５年７月１７日", "Asia/Shanghai", "ymd", "2025-07-16T16:00:00"),
        ("Ngày 7 tháng 12 năm 2024, 18:22", "Asia/Ho_Chi_Minh", "dmy", "2024-12-07T11:22:00"),
        ("27 tháng 12, 2025", "Asia/Ho_Chi_Minh", "dmy", "2025-12-26T17:00:00"),
        ("Publié le 1er octobre 2026", "Europe/Paris", "dmy", "2026-09-30T22:00:00"),
        ("2024-04-26 19:36:16 UTC+9:30", None, None, "2024-04-26T10:06:16"),
        ("2026-07-06 24:00:00", "Europe/London", "dmy", "2026-07-06T23:00:00"),
        ("6 juillet 2026 à 14h30", "Europe/Paris", "dmy", "2026-07-06T12:30:00"),
        ("12:30 06/07/2026", "Europe/Paris", "dmy", "2026-07-06T10:30:00"),
        ("6 July 2026, 9.30am", "Europe/London", "dmy", "2026-07-06T08:30:00"),
        ("6 July 2026 9 pm", "Europe/London", "dmy", "2026-07-06T20:00:00"),
        ("2026-W28-1", "Europe/London", "dmy", "2026-07-05T23:00:00"),
        ("2026W281T10:00Z", None, None, "2026-07-06T10:00:00"),
        ("12 April 1899", "Europe/London", "dmy", "1899-04-12T00:00:00"),
        ("2150-07-06 12:00", "Europe/Paris", "dmy", "2150-07-06T10:00:00"),
        ("2150-01-06 12:00", "America/New_York", "mdy", "2150-01-06T17:00:00"),
        ("word " * 60 + "2026-05-05 10:00Z", None, None, "2026-05-05T10:00:00"),
        # twice: the first; skipped: moved by the gap
        ("2025-11-02 01:30", "America/New_York", "mdy", "2025-11-02T05:30:00"),
        ("2025-03-09 02:30", "America/New_York", "mdy", "2025-03-09T07:30:00"),
        ("2024-03-31T01:30:00", "Europe/London", "dmy", "2024-03-31T01:30:00"),
    ],
)
def test_notations(text, zone, order, want):
    assert read(text, zone, order) == want


def test_buddhist_years():
    assert read("17 July 2568", "Asia/Bangkok", "dmy", "buddhist") == "2025-07-16T17:00:00"
    assert read("17 July 2568", "Asia/Bangkok", "dmy") == "2568-07-16T17:00:00"


@pytest.mark.parametrize("text", [None, "", "  ", "2026年", "2026", "Undated", "2026-02-30", "31/11/2025", "99:99", "0000-00-00T00:00:00Z", "20 Smarch 2025", "2025-13-05 08:00", "2026-W54-1", "2026-W10-8", "2026-07-06 24:01", "n/a", "x" * 5000])
def test_no_timestamp(text):
    assert read(text, "Europe/London", "dmy") is None


def test_needs_a_source_without_zone():
    assert read("2026-05-05 10:00") is None and read("2026-05-05 10:00Z") == "2026-05-05T10:00:00"


@settings(max_examples=150, deadline=None)
@given(st.datetimes(datetime(1990, 1, 1), datetime(2060, 1, 1)), st.sampled_from(["Europe/Paris", "America/New_York", "Australia/Sydney", "Asia/Shanghai", "Asia/Kolkata"]))
def test_zone_table_agrees_with_the_library(wall, zone):
    first = wall.replace(tzinfo=ZoneInfo(zone), fold=0)
    want = int(first.utcoffset().total_seconds())
    import numpy as np

    seconds = int(wall.replace(tzinfo=timezone.utc).timestamp())
    assert zone_table(zone).offset_at(np.array([seconds]))[0] == want


def test_masks_are_few():
    assert mask_of(tokens_of("3 May 2025 10:00")) == mask_of(tokens_of("7 Ogos 2026 23:59"))


def test_operator(spark):
    rows = spark.createDataFrame([(1, "2026-05-05 10:00Z", None, "x"), (2, "5/6/2026", "s", "y"), (3, None, "s", None), (None, "2026-05-05 10:00Z", "s", "z"), (2, "5/6/2026", "s", "y")], "rec_id bigint, published string, source_name string, time_zone string")
    registry = spark.createDataFrame([("s", "Asia/Singapore", "dmy", "gregorian")], "source_name string, time_zone string, date_order string, calendar string")
    got = normalise_timestamps({"scripts": (rows, "published", "source_name")}, registry).collect()
    assert sorted((r.rec_id, r.utc_micros // 1_000_000) for r in got) == [(1, 1777975200), (2, 1780588800), (2, 1780588800)]
    assert normalise_timestamps({"scripts": (rows.limit(0), "published", "source_name")}, registry).count() == 0


def test_rows_without_source_name_keep_their_own_zone(spark, tmp_path):
    from presslake.plans.queries import QUERIES

    one = "rec_id bigint, {} string, source_name string, source_id string"
    for name, column in (("scripts", "published"), ("site_adapters", "publish_date")):
        spark.createDataFrame([], one.format(column)).write.parquet(f"{tmp_path}/{name}.parquet")
    rows = [(1, "2026-05-05 10:00Z", None, "a"), (2, "2026-05-05T18:00:00+08:00", None, "a"), (3, "1777975200", None, "a"), (4, "2026-05-05 10:00", None, "a"), (5, "2026-05-05 18:00", "s", "a")]
    spark.createDataFrame(rows, one.format("published_date")).write.parquet(f"{tmp_path}/parsers.parquet")
    registry = [("s", "a", "Asia/Singapore", "dmy", "gregorian")]
    spark.createDataFrame(registry, "source_name string, source_id string, time_zone string, date_order string, calendar string").write.parquet(f"{tmp_path}/source_registry.parquet")
    got = QUERIES["p1_found"](spark, str(tmp_path)).collect()
    assert sorted((r.rec_id, r.utc_micros) for r in got) == [(i, 1_777_975_200_000_000) for i in (1, 2, 3, 5)]
