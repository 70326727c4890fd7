from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions.dates import snapshot_date
from tidemark.plans import label_state
from tidemark.plans.label import response_label

FIRST = dt.date(2018, 9, 8)


def text(i):
    return (FIRST + dt.timedelta(days=i)).strftime("%Y_%m_%d")


def tables(spark, seed, days=7):
    """Splits that repeat, pause and end, listings that repeat or lack an event's next day, NULL keys."""
    draw = random.Random(seed)
    splits, listings, seen = [], [], []
    for day in range(days):
        for event in range(4):
            if draw.random() < 0.8:
                seen += [(event, text(day))] * draw.choice([1, 1, 2])
        for listing in range(12):
            if draw.random() < 0.6:
                copies = draw.choice([1, 1, 1, 2])
                zone = draw.choice(["Z", "Z", "Z", "GA", None])
                listings += [(listing, listing % 4, text(day), False, "A", zone)] * copies
                for option in (1, 2, None):
                    splits += [(listing, option, text(day))] * draw.choice([0, 1, 1, 3])
        splits.append((None, 1, text(day)))
    made = (
        spark.createDataFrame(splits, "listing_id long, ticket_splits_option int, date_accessed string"),
        spark.createDataFrame(listings, "listing_id long, event_id long, date_accessed string, is_ga boolean, section_name string, zone_name string"),
        spark.createDataFrame(seen, "event_id long, date_accessed string"),
    )
    return [df.withColumn("snapshot_date", snapshot_date(F.col("date_accessed"))) for df in made]


def upto(frames, day):
    return [df.filter(F.col("snapshot_date") <= F.lit(day)) for df in frames]


def test_after_each_day_the_rows_of_all_days_at_once(spark, tmp_path):
    frames = [df.cache() for df in tables(spark, 1)]
    root = f"{tmp_path}/label"
    for i in range(7):
        day = FIRST + dt.timedelta(days=i)
        label_state.advance(spark, root, *frames, day)
        if i in (2, 6):
            got = label_state.current_labels(spark, root)
            want = response_label(*upto(frames, day))
            assert got.dtypes == want.dtypes and rows(got) == rows(want) != []


def test_a_repeated_or_broken_day_changes_nothing(spark, tmp_path):
    frames = tables(spark, 3, 5)
    days = [FIRST + dt.timedelta(days=i) for i in range(5)]
    for day in days:
        label_state.advance(spark, f"{tmp_path}/once", *frames, day)
        label_state.advance(spark, f"{tmp_path}/twice", *frames, day)
        label_state.advance(spark, f"{tmp_path}/twice", *frames, day)
    assert rows(label_state.current_labels(spark, f"{tmp_path}/once")) == rows(label_state.current_labels(spark, f"{tmp_path}/twice"))
    # Broken off between the two writes: its closed rows count only with its state.
    label_state.advance(spark, f"{tmp_path}/broken", *frames, days[0])
    label_state.advance(spark, f"{tmp_path}/broken", *frames, days[1])
    before = rows(label_state.current_labels(spark, f"{tmp_path}/broken"))
    state = spark.read.schema(label_state.OPEN).parquet(f"{tmp_path}/broken/open/as_of={days[1]}")
    eve, of_day = (label_state._of_day(frames[1], days[1]), [label_state._of_day(df, days[2]) for df in frames])
    closed, _ = label_state.close_day(state, of_day[0], eve, of_day[2], days[2])
    closed.write.parquet(f"{tmp_path}/broken/closed/closed_on={days[2]}")
    assert rows(label_state.current_labels(spark, f"{tmp_path}/broken")) == before


def test_a_missing_day_tells_nothing(spark, tmp_path):
    frames = tables(spark, 4, 6)
    gap = FIRST + dt.timedelta(days=2)
    frames = [df.filter(F.col("snapshot_date") != F.lit(gap)) for df in frames]
    for i in (0, 1, 3, 4, 5):
        label_state.advance(spark, f"{tmp_path}/gap", *frames, FIRST + dt.timedelta(days=i))
    assert rows(label_state.current_labels(spark, f"{tmp_path}/gap")) == rows(response_label(*frames))


def test_a_new_day_reads_the_state_and_two_days(spark, tmp_path):
    """Every scan is of one folder: the state as of the day before, or one day of a table."""
    names = ["splits", "listings", "summary"]
    for name, df in zip(names, tables(spark, 5, 6)):
        df.write.partitionBy("snapshot_date").parquet(f"{tmp_path}/{name}")
    frames = [spark.read.parquet(f"{tmp_path}/{name}") for name in names]
    day = FIRST + dt.timedelta(days=4)
    label_state.advance(spark, f"{tmp_path}/label", *frames, FIRST + dt.timedelta(days=3))
    state = spark.read.schema(label_state.OPEN).parquet(f"{tmp_path}/label/open/as_of={day - dt.timedelta(days=1)}")
    eve = label_state._of_day(frames[1], day - dt.timedelta(days=1))
    for frame in label_state.close_day(state, label_state._of_day(frames[0], day), eve, label_state._of_day(frames[2], day), day):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        scans = re.findall(r"FileScan parquet.*?(?=\n)", plan)
        dated = [s for s in scans if "PartitionFilters: [isnotnull(snapshot_date" in s]
        # One other scan: the state, from the folder of its day.
        assert len(scans) - len(dated) == 1 == sum("copies#" in s for s in scans)
        assert all(re.search(r"\(snapshot_date#\d+ = 2018-09-1[12]\)", s) for s in dated)
    with pytest.raises(ValueError):
        label_state.current_labels(spark, f"{tmp_path}/nothing")
