"""Parsing and loading queries: nested objects built from orders and line items."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from tidemark.functions.dates import day_of_week, days_until, local_date, snapshot_date, snapshot_text
from tidemark.operators import parse
from tidemark.operators.keyed import first_seen
from tidemark.schemas import EVENT_SCHEMA, LISTING_SCHEMA
from tidemark.sources.snapshots import absent_rows, append_rows
from tidemark.workload.market import Market
from tidemark.workload.registry import Registry

REGISTRY = Registry()


def later_by(time: str, micros) -> F.Column:
    return (F.col(time) + F.make_dt_interval(secs=(micros / 1000000).cast("decimal(18,6)"))).cast("string")


def shaped(objects: DataFrame, schema: StructType) -> DataFrame:
    """Objects with every field of the raw schema, the ones not given as NULL."""
    return objects.to(StructType([*schema.fields, StructField("snapshot_date", DateType())]))


def through_text(objects: DataFrame, schema: StructType) -> DataFrame:
    """Objects through JSON text and back, as a reader of raw files sees them."""
    fields = [c for c in objects.columns if c != "snapshot_date"]
    text = objects.select("snapshot_date", F.to_json(F.struct(*fields)).alias("j"))
    return text.select(F.from_json("j", schema).alias("o"), "snapshot_date").select("o.*", "snapshot_date")


def raw_events(m: Market) -> DataFrame:
    """An event object per order; the orders of a customer in a year are copies of one event."""
    rows = (
        m.table("orders")
        .join(m.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(m.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(m.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    named = lambda *cols: F.array(*[F.struct(c.alias("name")) for c in cols])
    money = F.struct(F.col("o_totalprice").alias("amount"), F.lit("USD").alias("currency"))
    performer = lambda i, n, r: F.struct(
        i.cast("long").alias("id"), n.alias("name"), F.lit(r).alias("role"), F.lit("u").alias("url"),
        F.lit("s").alias("seoURI"))
    objects = rows.select(
        F.to_date(F.date_trunc("year", "o_orderdate")).alias("snapshot_date"),
        F.col("o_custkey").alias("id"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("PARKING Passes Only "), "c_name"))
        .otherwise(F.col("c_name"))
        .alias("name"),
        F.col("o_orderdate").cast("string").alias("eventDateLocal"),
        named(F.col("c_mktsegment"), F.col("o_orderstatus")).alias("categoriesCollection"),
        F.when(F.col("o_orderstatus") == "P", F.array().cast("array<struct<name:string>>"))
        .otherwise(named(F.col("r_name"), F.col("n_name")))
        .alias("geos"),
        F.when(F.col("c_acctbal") > 5000, F.struct(F.lit("lot").alias("parking"))).alias("eventAttributes"),
        F.when(
            F.col("o_orderstatus") != "P",
            F.array(
                performer(F.expr("o_orderkey div 100"), F.col("o_orderpriority"), ""),
                performer(F.col("c_nationkey"), F.col("n_name"), "HEADLINE"),
            ),
        ).alias("performersCollection"),
        F.col("o_totalprice").alias("score"),
        F.when(
            F.col("o_orderpriority") != "4-NOT SPECIFIED",
            F.struct(
                F.col("o_totalprice").alias("minPrice"),
                (F.col("o_orderkey") % 400).cast("int").alias("totalListings"),
                (F.col("o_orderkey") % 900).cast("int").alias("totalTickets"),
                F.lit("USD").alias("currencyCode"),
                money.alias("minPriceWithCurrency"),
            ),
        ).alias("ticketInfo"),
        F.struct(
            F.col("c_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"),
            F.col("r_name").alias("city"), F.lit("w").alias("webURI"),
        ).alias("venue"),
        F.struct(F.col("r_name").alias("name")).alias("venueConfiguration"),
        later_by("o_orderdate", F.col("o_orderkey")).alias("dt_accessed"),
    )
    return shaped(objects, EVENT_SCHEMA)


def raw_listings(m: Market) -> DataFrame:
    """A listing object per line item; repeated order lines in a year are copies of one listing."""
    money = lambda c: F.struct(c.alias("amount"), F.lit("USD").alias("currency"))
    at_least = lambda q, n: F.when(F.col("l_quantity") >= q, F.lit(n))
    line = F.col("l_linenumber")
    objects = m.table("lineitem").select(
        F.to_date(F.date_trunc("year", "l_shipdate")).alias("snapshot_date"),
        (F.col("l_orderkey") * 8 + line).alias("listingId"),
        F.col("l_partkey").alias("event_id"),
        (F.col("l_linestatus") == "O").alias("isGA"),
        money(F.col("l_extendedprice")).alias("currentPrice"),
        money(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("listingPrice"),
        F.when(F.col("l_returnflag") != "N", F.struct(F.col("l_tax").alias("amount"))).alias("faceValue"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.concat(F.lit("Section "), F.col("l_suppkey").cast("string")).alias("sectionName"),
        F.array(F.lit(1), at_least(2, 2), at_least(10, 4)).alias("splitVector"),
        F.array(line).alias("deliveryTypeList"),
        F.array(line, line + 10).alias("deliveryMethodList"),
        F.when(F.col("l_linestatus") == "F", F.array(line % 3)).alias("listingAttributeList"),
        later_by("l_shipdate", F.col("l_partkey") * 100000 + F.col("l_suppkey")).alias("dt_accessed"),
    )
    return shaped(objects, LISTING_SCHEMA)


EVENTS = """
copies AS (
  SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS snapshot_date, o.*, c.*, n_name, r_name,
         row_number() OVER (PARTITION BY date_trunc('year', o_orderdate), o_custkey
                            ORDER BY o_orderdate + to_microseconds(o_orderkey)) AS rn
  FROM orders o JOIN customer c ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
ev AS (SELECT * FROM copies WHERE rn = 1 AND o_orderpriority <> '5-LOW')
"""
SUMMARY = """
summ AS (SELECT o_totalprice AS minprice, CAST(o_orderkey % 400 AS INTEGER) AS totallistings,
                CAST(o_orderkey % 900 AS INTEGER) AS totaltickets, 'USD' AS currencycode, o_custkey AS event_id, snapshot_date
         FROM ev WHERE o_orderpriority <> '4-NOT SPECIFIED')
"""
LISTINGS = """
copies AS (
  SELECT CAST(date_trunc('year', l_shipdate) AS DATE) AS snapshot_date, l_orderkey * 8 + l_linenumber AS listing_id, l.*,
         row_number() OVER (PARTITION BY date_trunc('year', l_shipdate), l_orderkey * 8 + l_linenumber
                            ORDER BY l_shipdate + to_microseconds(l_partkey * 100000 + l_suppkey)) AS rn
  FROM lineitem l),
li AS (SELECT * FROM copies WHERE rn = 1)
"""


@REGISTRY.add(f"""
WITH {EVENTS} SELECT o_custkey AS event_id, c_name AS name, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS eventdatelocal,
  CASE WHEN o_orderstatus <> 'P' THEN n_name END AS geos, c_mktsegment AS category, c_acctbal > 5000 AS event_parking,
  CAST(c_nationkey AS BIGINT) AS venue_id, r_name AS venue_config, strftime(snapshot_date, '%Y_%m_%d') AS date_accessed FROM ev""")
def parsed_events(m: Market) -> DataFrame:
    return parse.parse_events(raw_events(m))["events_df"].select(
        "event_id", "name", "eventdatelocal", "geos", "category", "event_parking", "venue_id", "venue_config",
        "date_accessed")


@REGISTRY.add(f"""
WITH {EVENTS} SELECT o_custkey AS event_id, snapshot_date, o_orderkey // 100 AS performer_id, o_orderpriority AS performer_name,
  '' AS role, 'u' AS url FROM ev WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_custkey, snapshot_date, CAST(c_nationkey AS BIGINT), n_name, 'HEADLINE', 'u' FROM ev WHERE o_orderstatus <> 'P'""")
def parsed_performers(m: Market) -> DataFrame:
    return parse.parse_events(raw_events(m))["events_perf"].drop("dt_accessed")


@REGISTRY.add(f"WITH {EVENTS} SELECT o_custkey AS event_id, o_totalprice AS score, snapshot_date FROM ev")
def parsed_scores(m: Market) -> DataFrame:
    """Scores of events that were read as JSON text."""
    raw = through_text(raw_events(m), EVENT_SCHEMA)
    return parse.parse_events(raw)["events_scores"].drop("dt_accessed")


@REGISTRY.add(f"WITH {EVENTS}, {SUMMARY} SELECT * FROM summ")
def parsed_summary(m: Market) -> DataFrame:
    return summary(m).select(
        "minprice", "totallistings", "totaltickets", "currencycode", "event_id", "snapshot_date")


def summary(m: Market) -> DataFrame:
    return parse.parse_events(raw_events(m))["events_ticket_summary"]


@REGISTRY.add(f"""
WITH {EVENTS} SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS venue_id, n_name AS name, r_name AS city, snapshot_date FROM ev""")
def parsed_venues(m: Market) -> DataFrame:
    return parse.parse_events(raw_events(m))["venues_df"].select("venue_id", "name", "city", "snapshot_date")


@REGISTRY.add(f"WITH {EVENTS}, {SUMMARY} SELECT event_id, totallistings FROM summ WHERE totallistings > 0")
def events_with_inventory(m: Market) -> DataFrame:
    return parse.events_with_inventory(summary(m))


@REGISTRY.add(f"""
WITH {EVENTS}, {SUMMARY}, v AS (
  SELECT count(*) AS events, CAST(sum(totallistings) AS BIGINT) AS listings,
         CAST(sum(ceil(totallistings / 100)) AS BIGINT) AS queries FROM summ)
SELECT *, queries / 600 AS hours FROM v""")
def catalogue_volume(m: Market) -> DataFrame:
    return parse.catalogue_volume(summary(m))


@REGISTRY.add(f"WITH {EVENTS} SELECT o_custkey AS event_id, snapshot_date, c_name AS name FROM ev ORDER BY 1, 2 LIMIT 3")
def first_events(m: Market) -> DataFrame:
    """Trial mode: the first three events."""
    events = parse.parse_events(raw_events(m))["events_df"].select("event_id", "snapshot_date", "name")
    return parse.first_events(events, 3, key=F.struct("event_id", "snapshot_date"))


@REGISTRY.add("""
SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_name IN ('NATION_1', 'NATION_6', 'NATION_4')""")
def metro_customers(m: Market) -> DataFrame:
    """Customers of the nations that make up two areas."""
    areas = {"EAST": ["NATION_1", "NATION_6"], "WEST": ["NATION_4"], "NORTH": ["NATION_9"]}
    homes = m.table("customer").join(m.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return parse.metro_filter(homes.select("c_custkey", "n_name"), ["EAST", "WEST"], "n_name", areas)


def listing_tables(m: Market) -> dict[str, DataFrame]:
    return parse.parse_listings(raw_listings(m))


@REGISTRY.add(f"""
WITH {LISTINGS} SELECT l_partkey AS event_id, CASE WHEN l_returnflag <> 'N' THEN l_tax END AS face_value,
  l_linestatus = 'O' AS is_ga, listing_id, l_extendedprice * (1 - l_discount) AS listing_price,
  CAST(l_quantity AS INTEGER) AS quantity, 'Section ' || l_suppkey AS section_name, l_extendedprice AS price_curr,
  'USD' AS currency_curr, strftime(snapshot_date, '%Y_%m_%d') AS date_accessed FROM li""")
def parsed_listings(m: Market) -> DataFrame:
    return listing_tables(m)["tickets_df"].select(
        "event_id", "face_value", "is_ga", "listing_id", "listing_price", "quantity", "section_name",
        "price_curr", "currency_curr", "date_accessed")


@REGISTRY.add(f"""
WITH {LISTINGS} SELECT listing_id, o.opt AS ticket_splits_option, strftime(snapshot_date, '%Y_%m_%d') AS date_accessed
FROM li, (VALUES (1, 1), (2, 2), (10, 4)) o(q, opt) WHERE l_quantity >= o.q""")
def parsed_splits(m: Market) -> DataFrame:
    return listing_tables(m)["tickets_splits"].select("listing_id", "ticket_splits_option", "date_accessed")


@REGISTRY.add(f"WITH {LISTINGS} SELECT listing_id, l_linenumber AS listings_deliv_type, snapshot_date FROM li")
def parsed_delivery_types(m: Market) -> DataFrame:
    return listing_tables(m)["tickets_deliv_type"].drop("dt_accessed")


@REGISTRY.add(f"""
WITH {LISTINGS} SELECT listing_id, CAST(l_linenumber + x AS INTEGER) AS listings_deliv_method, snapshot_date
FROM li, (VALUES (0), (10)) v(x)""")
def parsed_delivery_methods(m: Market) -> DataFrame:
    return listing_tables(m)["tickets_deliv_method"].drop("dt_accessed")


@REGISTRY.add(f"""
WITH {LISTINGS} SELECT listing_id, CAST(l_linenumber % 3 AS INTEGER) AS listings_listing_attr, snapshot_date
FROM li WHERE l_linestatus = 'F'""")
def parsed_listing_attributes(m: Market) -> DataFrame:
    return listing_tables(m)["tickets_listing_attr"].drop("dt_accessed")


def monthly(m: Market) -> DataFrame:
    return m.table("orders").withColumn("batch", F.to_date(F.date_trunc("month", "o_orderdate")))


MONTHLY = "b AS (SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS batch FROM orders)"


@REGISTRY.add(f"""
WITH {MONTHLY} SELECT o_orderkey, o_custkey, batch FROM b
WHERE NOT EXISTS (SELECT 1 FROM b p WHERE p.o_custkey = b.o_custkey AND p.batch < b.batch)""")
def first_seen_customers(m: Market) -> DataFrame:
    """All orders of the first month a customer appears in."""
    return first_seen(monthly(m).select("o_orderkey", "o_custkey", "batch"), ["o_custkey"], "batch")


@REGISTRY.add(f"""
WITH {MONTHLY} SELECT o_orderkey, o_custkey, o_orderpriority, batch FROM b
WHERE NOT EXISTS (SELECT 1 FROM b p WHERE p.o_custkey = b.o_custkey AND p.o_orderpriority = b.o_orderpriority
                  AND p.batch < b.batch)""")
def first_seen_pairs(m: Market) -> DataFrame:
    rows = monthly(m).select("o_orderkey", "o_custkey", "o_orderpriority", "batch")
    return first_seen(rows, ["o_custkey", "o_orderpriority"], "batch")


@REGISTRY.add("""
SELECT o_orderkey, o_custkey FROM orders w WHERE o_orderdate >= TIMESTAMP '1996-01-01'
AND NOT EXISTS (SELECT 1 FROM orders p WHERE p.o_orderdate < TIMESTAMP '1996-01-01' AND p.o_custkey = w.o_custkey)""")
def insert_absent_customers(m: Market) -> DataFrame:
    """Orders from 1996 on of customers unknown before."""
    rows = m.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cut = F.lit("1996-01-01").cast("timestamp_ntz")
    fresh = absent_rows(rows.filter(F.col("o_orderdate") < cut), rows.filter(F.col("o_orderdate") >= cut), ["o_custkey"])
    return fresh.drop("o_orderdate")


@REGISTRY.add("""
SELECT o_orderkey, o_custkey, NULL::DOUBLE AS o_totalprice FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'""")
def append_batches(m: Market) -> DataFrame:
    """Two batches, one of them without prices."""
    rows = m.table("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    finished = rows.filter("o_orderstatus = 'F'").drop("o_totalprice", "o_orderstatus")
    return append_rows(finished, rows.filter("o_orderstatus <> 'F'").drop("o_orderstatus"))


@REGISTRY.add(f"""
WITH {LISTINGS} SELECT listing_id, strftime(snapshot_date, '%Y_%m_%d') AS date_accessed, l_extendedprice AS price_curr
FROM li WHERE snapshot_date IN (DATE '1997-01-01', DATE '1999-01-01')""")
def reparsed_days(m: Market) -> DataFrame:
    """Listings of two stored days parsed again in one job."""
    days = [dt.date(1997, 1, 1), dt.date(1999, 1, 1)]
    chosen = raw_listings(m).filter(F.col("snapshot_date").isin(days))
    return parse.parse_listings(chosen)["tickets_df"].select("listing_id", "date_accessed", "price_curr")


@REGISTRY.add("""
SELECT o_orderkey, strftime(o_orderdate, '%Y_%m_%d') AS day_text, CAST(o_orderdate AS DATE) AS day,
  CAST(o_orderdate AS DATE) + 1 AS next_day, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31') AS INTEGER) AS days_left,
  CAST(dayofweek(o_orderdate) AS INTEGER) AS weekday FROM orders""")
def calendar_columns(m: Market) -> DataFrame:
    """Snapshot text and back, local time text to a day, day arithmetic and weekdays."""
    texts = m.table("orders").select(
        "o_orderkey",
        snapshot_text(F.col("o_orderdate")).alias("day_text"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T19:30:00-0400")).alias("local"),
    )
    day = local_date(F.col("local"))
    return texts.select(
        "o_orderkey",
        "day_text",
        snapshot_date(F.col("day_text")).alias("day"),
        F.date_add(day, 1).alias("next_day"),
        days_until(F.lit("2001-12-31").cast("date"), day).alias("days_left"),
        day_of_week(day).alias("weekday"),
    )
