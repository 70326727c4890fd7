from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.functions.binning import edge_bin, edge_label, equal_width_bin
from tidemark.functions.dates import day_of_week, days_until, local_date
from tidemark.plans import explore, features


def test_right_closed_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in (-1, 0, 0.5, 1, 1.5, 2, 75, 76)], "v double")
    edges = explore.PERFORMER_EDGES
    got = [r[0] for r in df.select(edge_bin(F.col("v"), edges)).collect()]
    want = pd.cut([-1, 0, 0.5, 1, 1.5, 2, 75, 76], bins=edges, labels=False)
    assert [None if np.isnan(w) else int(w) + 1 for w in want] == got
    assert df.filter("v = 2").select(edge_label(edge_bin(F.col("v"), edges), edges)).first()[0] == "(1, 2]"


@pytest.mark.parametrize("values,bins", [
    ([0.0, 1.0, 2.0, 3.0, 4.0, 5.0], 5),
    ([0.1 * i for i in range(31)], 10),
    ([3.0, 3.0, 3.0], 5),
    ([0.0, 0.0], 3),
    ([-7.3, -2.2, 0.0, 11.9, 4.4], 7),
])
def test_equal_width_bins_match_pandas(spark, values, bins):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    low, high = explore.column_range(df, "v")
    got = [r[0] for r in df.select(equal_width_bin(F.col("v"), low, high, bins)).collect()]
    assert got == [int(w) + 1 for w in pd.cut(pd.Series(values), bins=bins, labels=False)]


def test_null_has_no_bin(spark):
    df = spark.createDataFrame([(None,), (1.0,), (2.0,)], "v double")
    assert rows(explore.with_equal_bins(df, "v", 2)) == [(1.0, 1), (2.0, 2), (None, None)]


def test_text_columns(spark):
    df = spark.createDataFrame([(" Rock / Pop  ",), ("",), (" - ",), (None,)], "t string")
    assert [r[0] for r in df.select(text.clean_level(F.col("t"))).collect()] == ["Rock__Pop", "", "-", None]
    assert [r[0] for r in df.select(text.wordless_to(F.col("t"))).collect()] == [" Rock / Pop  ", "None", "None", "None"]
    assert [r[0] for r in df.select(text.empty_to(F.col("t"), "False")).collect()][1] == "False"
    assert [r[0] for r in df.select(text.contains_ignoring_case(F.col("t"), "ROCK")).collect()] == [True, False, False, False]


def test_calendar(spark):
    df = spark.createDataFrame([("2018-09-09T20:00:00-0400", dt.date(2018, 9, 1))], "t string, d date")
    row = df.select(local_date(F.col("t")), day_of_week(F.col("d")), days_until(local_date(F.col("t")), F.col("d"))).first()
    assert tuple(row) == (dt.date(2018, 9, 9), 6, 8)


def lumped(spark, values, **options):
    df = spark.createDataFrame(list(enumerate(values)), "i int, z string")
    out = features.lump_rare(df, "z", F.count("z"), **options)
    return [r["z_simp"] for r in out.orderBy("i").collect()]


def test_lumping_is_strict_and_takes_the_top_before_the_threshold(spark):
    values = ["a"] * 3 + ["b"] * 3 + ["c"] * 2 + ["", "", "", "", None]
    assert lumped(spark, values, min_count=2) == ["a"] * 3 + ["b"] * 3 + ["0"] * 7
    # '' is the largest level, then 'a' by the tie rule; '' itself still becomes '0'.
    assert lumped(spark, values, max_levels=2) == ["a"] * 3 + ["0"] * 10
    assert lumped(spark, values, max_levels=3, min_count=3) == ["0"] * 13


def perf(spark):
    pairs = [(1, 10), (2, 10), (3, 10), (1, 11), (2, 11), (1, 12), (1, 12)]
    return spark.createDataFrame(pairs, "event_id int, performer_id long")


def test_performers_with_exactly_the_minimum_are_kept(spark):
    got = rows(features.performer_levels(perf(spark), None, 2).distinct(), "event_id", "event_perf_count", "level")
    assert got == [(1, 4, "10"), (1, 4, "11"), (1, 4, "12"), (2, 2, "10"), (2, 2, "11"), (3, 1, "10")]
    assert {r[2] for r in rows(features.performer_levels(perf(spark), None, 3), "event_id", "event_perf_count", "level")} == {"10", "0"}


def test_multihot_matches_wide_dummies(spark):
    sets, slots = features.performer_multihot(perf(spark), max_perf=2, min_events=1)
    assert slots == ["10", "11"]
    vectors = features.multihot_vector(sets, "performer_levels", slots, "v")
    got = rows(vectors, "event_id", "event_perf_count", vector_to_array("v"))
    # Performer 12 is outside the top two and becomes the baseline level '0'.
    assert got == [(1, 4, [1.0, 1.0]), (2, 2, [1.0, 1.0]), (3, 1, [1.0, 0.0])]
    again, same = features.performer_multihot(perf(spark), max_perf=2, min_events=1)
    assert same == slots and rows(again.select("event_id")) == rows(sets.select("event_id"))


def test_one_hot_drops_the_first_level_and_zeroes_null(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), (None, "x"), ("c", "x")], "z string, constant string")
    fit = features.one_hot(df, ["z", "constant"])
    assert fit.names == ["z_b", "z_c"] and fit.columns == ["z_vec"]
    got = fit.model.transform(df).select("z", vector_to_array("z_vec"))
    assert rows(got) == [("a", [0.0, 0.0]), ("b", [1.0, 0.0]), ("c", [0.0, 1.0]), (None, [0.0, 0.0])]


def main_rows(spark):
    days = [dt.date(2018, 9, 8), dt.date(2018, 9, 9)]
    data = []
    for i in range(12):
        event = i % 3
        data.append((
            i, 1 + i % 2, days[i // 10], i % 2, 5, 6, i % 4, f"City {event} ", event, "Rock / Pop", event == 1,
            event % 2, ["", "True"][i % 2], 10.0 + i, 2, ["", "Floor", None][i % 3], 1.5, 7, float(i), 10.0, i % 2 == 1,
        ))
    data[11] = data[11][:13 - 6] + ("Only Late",) + data[11][8:]
    return spark.createDataFrame(
        data,
        "listing_id long, ticket_splits_option int, date date, indicator int, days_until_show int, dow_listing_avail int, "
        "dow_show int, geos string, event_id long, category string, event_parking boolean, venue_id long, "
        "dirty_ticket_ind string, price_curr double, quantity int, zone_name string, popularity double, "
        "totallistings int, price_over_min double, minprice double, full_listing boolean",
    )


def reference_matrix(spark):
    """The same matrix by pandas dummies."""
    df = main_rows(spark).toPandas()
    for column in ("dow_show", "venue_id"):
        df[column] = df[column].astype(str)
    df["geos"] = df.geos.str.strip().str.replace(" ", "_").str.replace("/", "")
    df["category"] = df.category.str.strip().str.replace(" ", "_").str.replace("/", "")
    df["dirty_ticket_ind"] = df.dirty_ticket_ind.replace("", "False")
    df["zone_name_simp"] = df.zone_name.where(df.zone_name == "Floor", "0")
    holdout = df.date == df.date.max()
    df = df.drop(columns=["event_id", "venue_id", "date", "zone_name", "dow_listing_avail", "listing_id", "indicator"])
    return pd.get_dummies(df, drop_first=True).astype(float), holdout


def test_feature_matrix_matches_pandas(spark):
    matrix = features.feature_matrix(main_rows(spark), None, venues=False, events=False, zones_min_listings=3)
    want, holdout = reference_matrix(spark)
    assert matrix.names == list(want.columns)
    for part, mask in ((matrix.train, ~holdout), (matrix.holdout, holdout)):
        got = part.orderBy("listing_id").select(vector_to_array("features")).collect()
        np.testing.assert_allclose([r[0] for r in got], want[mask].to_numpy())
    assert matrix.train.columns == ["listing_id", "ticket_splits_option", "date", "label", "features"]


def test_levels_seen_only_in_the_holdout(spark):
    everything = features.feature_matrix(main_rows(spark), None, venues=False, events=False, zones=False)
    train_only = features.feature_matrix(main_rows(spark), None, venues=False, events=False, zones=False, levels_from="train")
    assert "geos_Only_Late" in everything.names and "geos_Only_Late" not in train_only.names
    slot = everything.names.index("geos_Only_Late")
    total = everything.train.select(F.sum(vector_to_array("features")[slot])).first()[0]
    assert total == 0.0


def test_matrix_with_performers_and_all_lumps(spark):
    performers = perf(spark).withColumn("event_id", F.col("event_id").cast("long"))
    matrix = features.feature_matrix(
        main_rows(spark), performers, perf_min_events=1, venues_min_events=0, events_min_listings=3, zones_min_listings=3,
        keep_dow=True,
    )
    assert "event_perf_count" in matrix.names and "performer_id_11" in matrix.names
    slot = matrix.names.index("event_perf_count")
    both = matrix.train.unionByName(matrix.holdout)
    # Event 0 has no performers and counts as 0.
    assert {r[0] for r in both.select(vector_to_array("features")[slot]).collect()} == {0.0, 4.0, 2.0}


def test_exploration_helpers(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 0.0), (2, None, 1.0)], "k int, s string, indicator double")
    assert rows(explore.count_mean(df, "k")) == [(1, 2, 0.5), (2, 1, 1.0)]
    assert rows(explore.value_counts(df, "s", share=True)) == [("a", 2, 1.0)]
    assert rows(explore.column_sums(df)) == [(4, 2.0)]
    assert rows(explore.shape(df)) == [(3, 3)]
    profile = rows(explore.range_profile(df, ["k", "indicator"]))
    assert profile == [("indicator", 0.0, 1.0, True), ("k", 1.0, 2.0, False)]


def test_decimals_are_summed_and_any_script_has_words(spark):
    from tidemark.functions.text import wordless_to

    df = spark.sql("SELECT CAST(1.25 AS DECIMAL(12,2)) AS d, 2 AS i, 'x' AS t, true AS b")
    assert explore.column_sums(df).columns == ["d", "i"] and float(explore.column_sums(df).first()[0]) == 1.25
    roles = spark.createDataFrame([("актёр",), ("--",), (None,)], "role string")
    assert [r[0] for r in roles.select(wordless_to(F.col("role"))).collect()] == ["актёр", "None", "None"]


def test_rows_without_a_day_stay_in_training(spark):
    df = spark.createDataFrame([(1, 5), (2, 7), (3, None), (4, 7)], "id int, date int")
    train, holdout = features.temporal_holdout(df)
    assert rows(train, "id") == [(1,), (3,)] and rows(holdout, "id") == [(2,), (4,)]
    nothing = spark.createDataFrame([(1, None)], "id int, date int")
    assert [part.count() for part in features.temporal_holdout(nothing)] == [1, 0]
