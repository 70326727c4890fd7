from __future__ import annotations

import datetime as dt
import os

from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions.dates import snapshot_date
from tidemark.operators import parse
from tidemark.operators.keyed import first_seen
from tidemark.schemas import EVENT_SCHEMA, LISTING_SCHEMA, TABLES
from tidemark.sources import raw, snapshots, tables
from tidemark.streaming.daily_load import load_new_days

DAY = dt.date(2018, 9, 8)


def write_json(folder, kind, day, lines):
    path = f"{folder}/{kind}/snapshot_date={day}"
    os.makedirs(path)
    with open(f"{path}/part.json", "w", encoding="utf-8") as out:
        out.write("\n".join(lines))


EVENTS = [
    '{"id": 1, "name": "Show", "geos": [{"name": "NY"}, {"name": "Queens"}], "categoriesCollection": [{"name": "Rock"}],'
    ' "eventAttributes": {"parking": "y"}, "score": 1.5, "venue": {"id": 9, "name": "Hall", "webURI": "w"},'
    ' "venueConfiguration": {"name": "Main"}, "dt_accessed": "2018-09-08 10:00:00.1", "performersCollection":'
    ' [{"id": 5, "name": "Band", "role": "", "url": "u", "seoURI": "s"}, {"id": 6, "name": "Duo"}],'
    ' "ticketInfo": {"minPrice": 10.5, "totalListings": 250, "minPriceWithCurrency": {"amount": 1.0}}}',
    '{"id": 1, "name": "Show copy", "dt_accessed": "2018-09-08 10:05:00"}',
    '{"id": 2, "name": "PARKING PASSES ONLY Show", "dt_accessed": "2018-09-08 10:00:00"}',
    '{"id": 3, "name": null, "geos": [], "venue": {"id": 9, "name": "Hall"}, "dt_accessed": "2018_09_08"}',
]
LISTINGS = [
    '{"listingId": 7, "event_id": 1, "isGA": false, "currentPrice": {"amount": 20.0, "currency": "USD"},'
    ' "listingPrice": {"amount": 18.0, "currency": "USD"}, "splitVector": [1, null, 2], "deliveryTypeList": [5],'
    ' "deliveryMethodList": [], "quantity": 2, "dt_accessed": "2018-09-08 11:00:00"}',
    '{"listingId": 7, "event_id": 1, "quantity": 3, "dt_accessed": "2018-09-08 11:01:00"}',
    '{"listingId": 8, "event_id": 1, "faceValue": {"amount": 30.0}, "splitVector": [], "listingAttributeList": [3, 4]}',
]


def test_events_are_flattened(spark, tmp_path):
    write_json(tmp_path, "events", DAY, EVENTS)
    out = parse.parse_events(raw.read_events_json(spark, str(tmp_path)))
    events = out["events_df"]
    assert [c for c in events.columns if c != "snapshot_date"] == TABLES["events_df"].fieldNames()
    assert rows(events, "event_id", "name", "geos", "category", "event_parking", "venue_id", "venue_config") == [
        (1, "Show", "Queens", "Rock", True, 9, "Main"),
        (3, None, None, None, False, 9, None),
    ]
    # An access time that is only the day falls back to the snapshot day.
    assert rows(events.filter("event_id = 3"), F.col("dt_accessed").cast("string"), "date_accessed") == [
        ("2018-09-08 00:00:00", "2018_09_08")
    ]
    assert rows(out["events_perf"], "event_id", "performer_id", "performer_name", "role") == [
        (1, 5, "Band", ""),
        (1, 6, "Duo", None),
    ]
    assert "seouri" not in [c.lower() for c in out["events_perf"].columns]
    assert rows(out["events_ticket_summary"], "event_id", "minprice", "totallistings") == [(1, 10.5, 250)]
    assert not [c for c in out["events_ticket_summary"].columns if "with" in c]
    assert rows(out["venues_df"], "venue_id", "name") == [(9, "Hall")]
    assert rows(out["events_scores"], "event_id", "score") == [(1, 1.5), (3, None)]
    assert "snapshot_date" not in EVENT_SCHEMA.fieldNames()
    volume = parse.catalogue_volume(out["events_ticket_summary"])
    assert rows(volume) == [(1, 250, 3, 3 / 600)]


def test_listings_are_flattened(spark, tmp_path):
    write_json(tmp_path, "listings", DAY, LISTINGS)
    out = parse.parse_listings(raw.read_listings_json(spark, str(tmp_path)))
    listings = out["tickets_df"]
    assert [c for c in listings.columns if c != "snapshot_date"] == TABLES["tickets_df"].fieldNames()
    # The copy without an access time counts as read at the start of the day.
    assert rows(listings, "listing_id", "quantity", "price_curr", "face_value") == [(7, 2, 20.0, None), (8, None, None, 30.0)]
    assert rows(out["tickets_splits"], "listing_id", "ticket_splits_option") == [(7, 1), (7, 2)]
    assert rows(out["tickets_deliv_type"], "listing_id", "listings_deliv_type") == [(7, 5)]
    assert out["tickets_deliv_method"].count() == 0
    assert rows(out["tickets_listing_attr"], "listing_id", "listings_listing_attr") == [(8, 3), (8, 4)]


def test_batches_without_optional_fields(spark):
    short = spark.createDataFrame([(7, "2018-09-08 11:00:00")], "listingId long, dt_accessed string")
    full = parse.with_fields(short.withColumn("snapshot_date", F.lit(DAY)), LISTING_SCHEMA)
    assert rows(parse.parse_listings(full)["tickets_df"], "listing_id", "face_value") == [(7, None)]


def test_metro_filter_and_trial_mode(spark):
    df = spark.createDataFrame([(1, "Bronx"), (2, "Washington, DC"), (3, "Medford"), (4, None)], "event_id long, city string")
    assert rows(parse.metro_filter(df, ["NYC", "DC"]), "event_id") == [(1,), (2,)]
    assert rows(parse.first_events(df, 2), "event_id") == [(1,), (2,)]


def test_backfill_reads_only_the_asked_days_and_replaces_them(spark, tmp_path):
    source, target = str(tmp_path / "raw"), str(tmp_path / "out")
    for day in (8, 9, 10):
        write_json(source, "events", dt.date(2018, 9, day), EVENTS)
        write_json(source, "listings", dt.date(2018, 9, day), LISTINGS)
    days = [dt.date(2018, 9, 8), dt.date(2018, 9, 9)]
    snapshots.backfill(spark, source, target, days)
    snapshots.backfill(spark, source, target, days[1:])
    listings = snapshots.read_snapshot(spark, target, "tickets_df")
    assert rows(listings.groupBy("snapshot_date").count()) == [(days[0], 2), (days[1], 2)]
    assert os.path.isdir(f"{target}/events/ticket_summary/snapshot_date=2018-09-09")


def test_csv_columns_are_taken_by_position(spark, tmp_path):
    path = tmp_path / "splits.csv"
    path.write_text('listingId,tickets_splits_option,date,dt_accessed\n12,2.0,2018_09_08  ,2018-09-08 10:00:00\n13,,2018_09_08,\n')
    df = snapshots.read_table_csv(spark, str(path), TABLES["tickets_splits"])
    assert rows(df, "listing_id", "ticket_splits_option", "date_accessed") == [(12, 2, "2018_09_08"), (13, None, "2018_09_08")]


def test_csv_export_is_replaced_and_survives_quotes_and_breaks(spark, tmp_path):
    path = str(tmp_path / "x")
    df = spark.createDataFrame([(1, 'say "hi",\nthere')], "id int, text string")
    snapshots.export_csv(df.union(df), path)
    snapshots.export_csv(df, path)
    back = spark.read.options(header=True, quote='"', escape='"', multiLine=True).csv(path)
    assert [r["text"] for r in back.collect()] == ['say "hi",\nthere']


def day_batches(spark):
    data = [("a", 1, 8), ("a", 1, 8), ("b", 2, 8), ("b", 3, 9), ("c", 4, 9), ("c", 4, 9), (None, 5, 9), (None, 5, 9), ("a", 6, 10), ("d", 7, 10), (None, 8, 10)]
    return spark.createDataFrame(
        [(k, v, dt.date(2018, 9, d)) for k, v, d in data], "k string, v int, snapshot_date date"
    )


def test_daily_inserts_equal_the_closed_form_and_can_be_repeated(spark, tmp_path):
    path, all_days = str(tmp_path / "t"), day_batches(spark)
    for day in (8, 9, 9, 10, 10):
        batch = all_days.filter(F.dayofmonth("snapshot_date") == day)
        snapshots.insert_absent(spark, path, batch, ["k"], dt.date(2018, 9, day))
    stored = spark.read.parquet(path)
    assert rows(stored, "k", "v") == rows(first_seen(all_days, ["k"], "snapshot_date"), "k", "v")


def test_absent_rows_on_two_keys(spark):
    target = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    batch = spark.createDataFrame([(1, "x"), (1, "y"), (1, "y"), (2, None)], "a int, b string")
    assert rows(snapshots.absent_rows(target, batch, ["a", "b"])) == [(1, "y"), (1, "y"), (2, None)]


def test_streamed_days_equal_the_closed_form(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "t")
    all_days = day_batches(spark)
    for day in (8, 9, 10):
        all_days.filter(F.dayofmonth("snapshot_date") == day).coalesce(1).write.mode("append").parquet(source)
        load_new_days(spark, source, all_days.schema, target, ["k"], str(tmp_path / "c")).awaitTermination()
    stored = spark.read.parquet(target)
    assert rows(stored, "k", "v") == rows(first_seen(all_days, ["k"], "snapshot_date"), "k", "v")


def test_days_in_one_micro_batch_give_the_same_rows(spark, tmp_path):
    source, all_days = str(tmp_path / "in"), day_batches(spark)
    all_days.repartition(3).write.parquet(source)
    load_new_days(spark, source, all_days.schema, str(tmp_path / "t"), ["k"], str(tmp_path / "c")).awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert rows(stored, "k", "v") == rows(first_seen(all_days, ["k"], "snapshot_date"), "k", "v")


def test_tables_batches_and_views(spark):
    tables.create_schema(spark, "working")
    for name in ("working.perf", "working.staged"):
        tables.drop_table(spark, name)
    tables.create_table(spark, "working.perf", TABLES["events_perf"])
    tables.create_like(spark, "working.staged", "working.perf")
    assert spark.table("working.staged").columns == TABLES["events_perf"].fieldNames()
    batch = spark.createDataFrame([(1, 5), (1, 5), (2, 6)], "event_id long, performer_id long")
    full = parse.with_fields(batch, TABLES["events_perf"]).select(*TABLES["events_perf"].fieldNames())
    full.write.insertInto("working.staged")
    tables.insert_absent_batch(spark, "working.perf", "working.staged", ["event_id", "performer_id"])
    assert spark.table("working.perf").count() == 3 and spark.table("working.staged").count() == 0
    full.write.insertInto("working.staged")
    tables.insert_absent_batch(spark, "working.perf", "working.staged", ["event_id", "performer_id"])
    assert spark.table("working.perf").count() == 3
    full.write.insertInto("working.staged")
    tables.append_batch(spark, "working.perf", "working.staged")
    assert spark.table("working.perf").count() == 6
    tables.replace_view(spark.table("working.perf"), "perf_view")
    assert tables.query(spark, "SELECT count(*) AS n FROM {p}", p=spark.table("perf_view")).first()["n"] == 6
    tables.drop_table(spark, "working.staged")
    assert not spark.catalog.tableExists("working.staged")


def test_snapshot_text_parses(spark):
    df = spark.createDataFrame([("2018_09_08",)], "t string").select(snapshot_date(F.col("t")))
    assert df.first()[0] == DAY
    assert EVENT_SCHEMA["id"].nullable
