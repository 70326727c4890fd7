"""Feature tables: calendar features, base table, level lumping, encodings, matrix."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel,
    OneHotEncoder,
    StringIndexer,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import day_of_week, days_until, local_date, snapshot_day, snapshot_text
from tidemark.functions.text import clean_level, empty_to, level_text
from tidemark.operators.keyed import top_levels
from tidemark.plans.explore import performer_counts, with_listing
from tidemark.session import stage_table

OTHER = "0"


def date_features(events: DataFrame, listings: DataFrame) -> DataFrame:
    """Days to the show and the weekdays, per event and snapshot day.

    Listings shrink to their event days before the join, so an event with many
    listings costs no more than one with few.
    """
    seen = listings.select("event_id", snapshot_day(listings).alias("date")).distinct()
    snapshot = F.col("date")
    show = local_date(F.col("eventdatelocal"))
    return (
        seen.join(events.select("event_id", "eventdatelocal").distinct(), "event_id")
        .select(
            "event_id",
            snapshot_text(snapshot).alias("date_accessed"),
            days_until(show, snapshot).alias("days_until_show"),
            day_of_week(snapshot).alias("dow_listing_avail"),
            day_of_week(show).alias("dow_show"),
        )
        .distinct()
    )


def main_table(
    labels: DataFrame, listings: DataFrame, summary: DataFrame, dates: DataFrame, events: DataFrame
) -> DataFrame:
    """The 21-column base table: label, calendar, event, listing and market columns.

    The three event-level tables join each other first; the label rows then meet
    one narrow table instead of three.
    """
    market = (
        summary.select("event_id", "date_accessed", "popularity", "totallistings", "minprice")
        .join(dates, ["event_id", "date_accessed"])
        .join(events.select("event_id", "geos", "category", "event_parking", "venue_id"), "event_id")
    )
    rows = with_listing(
        labels, listings, "event_id", "dirty_ticket_ind", "price_curr", "quantity", "zone_name"
    )
    return rows.join(market, ["event_id", "date_accessed"]).select(
        "listing_id",
        "ticket_splits_option",
        "date",
        "indicator",
        "days_until_show",
        "dow_listing_avail",
        "dow_show",
        "geos",
        "event_id",
        "category",
        "event_parking",
        "venue_id",
        "dirty_ticket_ind",
        "price_curr",
        "quantity",
        "zone_name",
        "popularity",
        "totallistings",
        (F.col("price_curr") - F.col("minprice")).alias("price_over_min"),
        "minprice",
        (F.col("ticket_splits_option") == F.col("quantity")).alias("full_listing"),
    )


def kept_levels(
    df: DataFrame, column: str, measure: Column, max_levels: int | None, min_count: int
) -> DataFrame:
    """Levels among the ``max_levels`` largest whose measure is above ``min_count``."""
    return top_levels(df, column, measure, max_levels).filter(F.col("measure") > min_count).select(column)


def lump_rare(
    df: DataFrame,
    column: str,
    measure: Column,
    max_levels: int | None = None,
    min_count: int = 0,
    name: str | None = None,
    other: str = OTHER,
) -> DataFrame:
    """``df`` with ``name``: the level as text, or ``other`` where the level is rare.

    NULL and '' count as rare.  The level table is joined, never collected.
    """
    name = name or f"{column}_simp"
    levels = kept_levels(df, column, measure, max_levels, min_count).filter(level_text(F.col(column)) != "")
    levels = levels.select(F.col(column).alias("_level"), level_text(F.col(column)).alias(name))
    joined = df.join(levels, df[column] == F.col("_level"), "left").drop("_level")
    return joined.withColumn(name, F.coalesce(name, F.lit(other)))


def performer_levels(performers: DataFrame, max_perf: int | None = None, min_events: int = 10) -> DataFrame:
    """``event_id, event_perf_count, level`` rows; small performers become ``OTHER``.

    A performer with exactly ``min_events`` rows is kept.
    """
    counted = performer_counts(performers)
    level = F.when(F.col("perf_events") < min_events, F.lit(OTHER))
    if max_perf is not None:
        best = top_levels(performers, "performer_id", F.countDistinct("event_id"), max_perf)
        best = best.select(F.col("performer_id").alias("_best"))
        counted = counted.join(best, F.col("performer_id") == F.col("_best"), "left")
        level = level.when(F.col("_best").isNull(), F.lit(OTHER))
    return counted.select(
        "event_id", "event_perf_count", level.otherwise(level_text(F.col("performer_id"))).alias("level")
    )


def performer_multihot(
    performers: DataFrame, max_perf: int | None = None, min_events: int = 10
) -> tuple[DataFrame, list[str]]:
    """One row per event with the set ``performer_levels``, and the levels that get a slot.

    The text-first level is the baseline and has no slot.  Distinct levels are
    taken per event before they are gathered, so an event holds at most as many
    entries as there are levels.
    """
    rows = stage_table(performer_levels(performers, max_perf, min_events).distinct(), "performer_levels")
    levels = sorted(r[0] for r in rows.select("level").distinct().collect())
    per_event = rows.groupBy("event_id", "event_perf_count").agg(
        F.collect_set("level").alias("performer_levels")
    )
    return per_event, levels[1:]


def multihot_vector(df: DataFrame, sets: str, slots: Sequence[str], output: str) -> DataFrame:
    """0/1 vector of a set column; NULL and unknown levels leave zeros."""
    model = CountVectorizerModel.from_vocabulary(list(slots), inputCol=sets, outputCol=output, binary=True)
    known = F.coalesce(F.col(sets), F.array().cast("array<string>"))
    return model.transform(df.withColumn(sets, known)).drop(sets)


def performer_columns(performers: DataFrame, levels: Sequence[str], min_events: int = 10) -> DataFrame:
    """Wide form of the multi-hot for given levels: one 0/1 column per level."""
    rows = performer_levels(performers, None, min_events)
    flags = [
        F.max((F.col("level") == F.lit(level)).cast("int")).alias(f"performer_id_{level}") for level in levels
    ]
    return rows.groupBy("event_id", "event_perf_count").agg(*flags)


def temporal_holdout(df: DataFrame, date: str = "date") -> tuple[DataFrame, DataFrame]:
    """Rows before the last snapshot day, and rows of that day; rows without a day are no holdout."""
    last = df.agg(F.max(date)).scalar()
    return df.filter(F.col(date).isNull() | (F.col(date) < last)), df.filter(F.col(date) == last)


@dataclass
class OneHot:
    """Fitted encoding: vector columns it adds and the name of every slot, in order."""

    model: PipelineModel
    columns: list[str]
    names: list[str]


def one_hot(df: DataFrame, columns: Sequence[str], drop_first: bool = True) -> OneHot:
    """Encoding of the levels found in ``df``, all columns fitted in one pass.

    The first level in text order is the baseline and has no slot; NULL and
    levels not seen encode as all zeros.
    """
    index = [f"{c}_idx" for c in columns]
    full = [f"{c}_all" for c in columns]
    indexer = StringIndexer(
        inputCols=list(columns), outputCols=index, stringOrderType="alphabetAsc", handleInvalid="keep"
    ).fit(df)
    # The encoder drops the last slot, which is the one for NULL and unseen levels.
    stages = [indexer, OneHotEncoder(inputCols=index, outputCols=full, dropLast=True)]
    skip = 1 if drop_first else 0
    outputs, names = [], []
    for column, levels, vector in zip(columns, indexer.labelsArray, full):
        kept = list(range(skip, len(levels)))
        if kept:
            stages.append(VectorSlicer(inputCol=vector, outputCol=f"{column}_vec", indices=kept))
            outputs.append(f"{column}_vec")
            names += [f"{column}_{levels[i]}" for i in kept]
    return OneHot(Pipeline(stages=stages).fit(df), outputs, names)


@dataclass
class FeatureMatrix:
    """Rows before and on the last day, each with ``features`` and ``label``."""

    train: DataFrame
    holdout: DataFrame
    names: list[str]


def prepared_rows(
    main: DataFrame,
    venues: bool = True,
    max_venues: int | None = None,
    venues_min_events: int = 5,
    events: bool = True,
    max_events: int | None = None,
    events_min_listings: int = 1000,
    zones: bool = True,
    max_zones: int | None = None,
    zones_min_listings: int = 1000,
    keep_dow: bool = False,
) -> tuple[DataFrame, list[str]]:
    """Cleaned base table with lumped levels, and the names of its text columns."""
    df = main
    text = (["dow_listing_avail"] if keep_dow else []) + ["dow_show", "geos", "category", "dirty_ticket_ind"]
    if venues:
        df = lump_rare(df, "venue_id", F.countDistinct("event_id"), max_venues, venues_min_events)
        text.append("venue_id_simp")
    if events:
        df = lump_rare(df, "event_id", F.count("event_id"), max_events, events_min_listings)
        text.append("event_id_simp")
    if zones:
        df = lump_rare(df, "zone_name", F.count("zone_name"), max_zones, zones_min_listings)
        text.append("zone_name_simp")
    df = df.withColumns(
        {
            "dow_listing_avail": level_text(F.col("dow_listing_avail")),
            "dow_show": level_text(F.col("dow_show")),
            "geos": clean_level(F.col("geos")),
            "category": clean_level(F.col("category")),
            "dirty_ticket_ind": empty_to(F.col("dirty_ticket_ind"), "False"),
        }
    )
    dropped = ["venue_id", "zone_name"] + ([] if keep_dow else ["dow_listing_avail"])
    return df.drop(*dropped), text


NUMERIC = [
    "ticket_splits_option",
    "days_until_show",
    "event_parking",
    "price_curr",
    "quantity",
    "popularity",
    "totallistings",
    "price_over_min",
    "minprice",
    "full_listing",
]


def feature_matrix(
    main: DataFrame,
    performers: DataFrame | None,
    max_perf: int | None = None,
    perf_min_events: int = 10,
    levels_from: str = "all",
    handle_invalid: str = "error",
    **options,
) -> FeatureMatrix:
    """Base table to sparse feature vectors, split at the last snapshot day.

    ``levels_from='all'`` takes category levels from both parts of the split,
    ``'train'`` from the rows before the last day only.  ``options`` are those of
    :func:`prepared_rows`.

    The base table is read once per lumped column and the prepared rows once per
    fit and per model, so both are written to the shared folder instead of being
    joined together again each time.
    """
    df, text = prepared_rows(stage_table(main, "main"), **options)
    numeric, vectors, names = list(NUMERIC), [], list(NUMERIC)
    if performers is not None:
        hot, slots = performer_multihot(performers, max_perf, perf_min_events)
        df = df.join(hot, "event_id", "left").fillna(0, ["event_perf_count"])
        numeric.append("event_perf_count")
        names.append("event_perf_count")
        if slots:
            df = multihot_vector(df, "performer_levels", slots, "performer_vec")
            vectors.append("performer_vec")
            names += [f"performer_id_{s}" for s in slots]
    df = stage_table(df.withColumns({c: F.col(c).cast("double") for c in numeric}), "prepared")
    encoding = one_hot(df if levels_from == "all" else temporal_holdout(df)[0], text)
    df = encoding.model.transform(df)
    vectors += encoding.columns
    names += encoding.names
    assembler = VectorAssembler(
        inputCols=numeric + vectors, outputCol="features", handleInvalid=handle_invalid
    )
    rows = assembler.transform(df).select(
        "listing_id",
        "ticket_splits_option",
        "date",
        F.col("indicator").cast("double").alias("label"),
        "features",
    )
    train, holdout = temporal_holdout(rows)
    return FeatureMatrix(train, holdout, names)
