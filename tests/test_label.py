from __future__ import annotations

import datetime as dt
import random

from conftest import rows

from tidemark.operators.keyed import (
    count_over,
    first_seen,
    keep_first,
    later_counts,
    later_flags,
    repeat_rows,
    top_levels,
)
from tidemark.plans.label import response_label
from pyspark.sql import functions as F


def market(spark, splits, listings, seen):
    return (
        spark.createDataFrame(splits, "listing_id long, ticket_splits_option int, date_accessed string"),
        spark.createDataFrame(
            listings,
            "listing_id long, event_id long, date_accessed string, is_ga boolean, section_name string, zone_name string",
        ),
        spark.createDataFrame(seen, "event_id long, date_accessed string"),
    )


DAYS = ["2018_09_08", "2018_09_09", "2018_09_10", "2018_09_11"]


def plain(listing, day, event=1, ga=False, section="A", zone="Z"):
    return (listing, event, day, ga, section, zone)


def test_later_means_any_later_day(spark):
    tables = market(
        spark,
        [(1, 2, DAYS[0]), (1, 2, DAYS[2])],
        [plain(1, DAYS[0]), plain(1, DAYS[2])],
        [(1, d) for d in DAYS],
    )
    label = response_label(*tables)
    assert rows(label, "date_accessed", "indicator") == [(DAYS[0], 0), (DAYS[2], 1)]
    assert label.columns == ["listing_id", "ticket_splits_option", "date_accessed", "date", "indicator"]
    assert dict(label.dtypes)["date"] == "date"


def test_rows_without_a_next_day_are_dropped(spark):
    tables = market(spark, [(1, 2, DAYS[3])], [plain(1, DAYS[3])], [(1, d) for d in DAYS])
    assert response_label(*tables).count() == 0


def test_each_split_option_is_its_own_key(spark):
    tables = market(
        spark,
        [(1, 2, DAYS[0]), (1, 4, DAYS[0]), (1, 4, DAYS[1])],
        [plain(1, DAYS[0]), plain(1, DAYS[1])],
        [(1, d) for d in DAYS],
    )
    got = rows(response_label(*tables), "ticket_splits_option", "date_accessed", "indicator")
    assert got == [(2, DAYS[0], 1), (4, DAYS[0], 0), (4, DAYS[1], 1)]


def test_same_day_twice_gives_zero_and_one(spark):
    tables = market(spark, [(1, 2, DAYS[0])] * 2, [plain(1, DAYS[0])], [(1, d) for d in DAYS])
    assert rows(response_label(*tables), "indicator") == [(0,), (1,)]


def test_general_admission_and_unknown_places_are_dropped(spark):
    kinds = [
        plain(1, DAYS[0]),
        plain(2, DAYS[0], ga=True),
        plain(3, DAYS[0], section="PARKING PASS"),
        plain(4, DAYS[0], zone="Pit GA"),
        plain(5, DAYS[0], section=None),
        plain(6, DAYS[0], zone=None),
        plain(7, DAYS[0], ga=None),
    ]
    tables = market(spark, [(i, 1, DAYS[0]) for i in range(1, 8)], kinds, [(1, DAYS[1])])
    assert rows(response_label(*tables), "listing_id") == [(1,)]


def test_repeated_summary_rows_fan_out(spark):
    tables = market(spark, [(1, 2, DAYS[0])], [plain(1, DAYS[0])], [(1, DAYS[1]), (1, DAYS[1])])
    assert response_label(*tables).count() == 2


def test_folder_column_and_text_give_the_same_label(spark):
    tables = market(
        spark, [(1, 2, DAYS[0]), (1, 2, DAYS[1])], [plain(1, d) for d in DAYS], [(1, d) for d in DAYS]
    )
    dated = [t.withColumn("snapshot_date", F.to_date("date_accessed", "yyyy_MM_dd")) for t in tables]
    assert rows(response_label(*tables)) == rows(response_label(*dated))


def test_flags_match_a_row_by_row_walk(spark):
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(30)}", dt.date(2018, 9, rng.randrange(1, 9))) for _ in range(900)]
    data += [(None, dt.date(2018, 9, 1)), (None, dt.date(2018, 9, 1))]
    seen = {}
    for key, day in data:
        seen.setdefault(key, []).append(day)
    want = []
    for key, days in seen.items():
        days.sort()
        want += [(key, day, int(i == len(days) - 1)) for i, day in enumerate(days)]
    df = spark.createDataFrame(data, "k string, day date")
    got = [tuple(r) for r in later_flags(df, ["k"], "day", "gone").select("k", "day", "gone").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_a_key_is_counted_per_day_before_the_window(spark):
    df = spark.createDataFrame([("a", 1)] * 500 + [("a", 2)] * 3, "k string, d int")
    assert rows(later_counts(df, ["k"], "d")) == [("a", 1, 500, 0), ("a", 2, 3, 1)]


def test_repeat_rows_beyond_one_chunk(spark):
    df = spark.createDataFrame([("a", 70000), ("b", 1), ("c", 0)], "k string, n int")
    assert rows(repeat_rows(df, "n").groupBy("k").count()) == [("a", 70000), ("b", 1)]


def test_first_seen_keeps_copies_of_the_first_batch(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 1, "x"), ("a", 2, "y"), ("b", 2, "z"), (None, 1, "n"), (None, 2, "n")],
        "k string, day int, v string",
    )
    assert rows(first_seen(df, ["k"], "day")) == [
        ("a", 1, "x"), ("a", 1, "x"), ("b", 2, "z"), (None, 1, "n"), (None, 2, "n"),
    ]
    # A NULL equals nothing: such rows are new in every batch.
    gaps = spark.createDataFrame([("a", 1), (None, 1), (None, 2), ("a", 2)], "k string, day int")
    assert rows(first_seen(gaps, ["k"], "day")) == [("a", 1), (None, 1), (None, 2)]


def test_keep_first_takes_the_lowest(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2)], "k string, t int")
    first = keep_first(df, ["k"], ["t"])
    assert rows(first) == [("a", 1), ("b", 2)]
    assert "WindowGroupLimit" in first._jdf.queryExecution().toString()


def test_count_over_counts_non_null_values_and_keeps_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 5)], "k string, v int")
    got = count_over(df, ["k"], {"n": "v", "own": "k"})
    assert rows(got, "k", "v", "n", "own") == [("a", 1, 1, 2), ("a", None, 1, 2), (None, 5, 1, 0)]


def test_ties_at_the_border_go_to_the_smallest_key(spark):
    df = spark.createDataFrame([("c",), ("a",), ("b",), ("a",)], "k string")
    assert [r["k"] for r in top_levels(df, "k", F.count("k"), 2).collect()] == ["a", "b"]
