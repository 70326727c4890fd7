"""Round trips: raw days, tables and batches written to the shared folder or the warehouse and read back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.operators import parse
from tidemark.schemas import EVENT_SCHEMA
from tidemark.session import checkpoint_root, stage_table
from tidemark.sources import raw, snapshots, tables, tolerant
from tidemark.workload.loading import LISTINGS, raw_events, raw_listings
from tidemark.workload.market import Market
from tidemark.workload.registry import Registry

REGISTRY = Registry()


def new_folder(m: Market, name: str) -> str:
    return f"{checkpoint_root(m.spark)}/{name}-{uuid.uuid4().hex}"


def damaged_days(m: Market) -> DataFrame:
    """Lines of raw event days, written as files and read back.

    Of fifty orders one gives a line that breaks off, one ticket figures that are a text, one no venue, one an
    access time that is none, one a total that is no number, one a bare number and one no id.
    """
    key = F.col("order_key")
    fields = [f.name for f in EVENT_SCHEMA.fields]
    # The order's key is found again in the access time: micro-seconds after the day.
    order_key = F.expr("unix_micros(to_timestamp(dt_accessed)) - unix_micros(to_timestamp(eventDateLocal))")
    objects = raw_events(m).withColumn("order_key", order_key)
    unknown = F.when(key % 50 == 3, F.concat(F.lit("unknown "), key.cast("string"))).otherwise(F.col("dt_accessed"))
    chosen = objects.withColumns(
        {
            "dt_accessed": unknown,
            "venue": F.when(key % 50 != 2, F.col("venue")),
            "id": F.when(key % 50 != 6, F.col("id")),
        }
    )
    text = F.to_json(F.struct(*fields))
    text = F.when(key % 50 == 0, F.substring(text, 1, 40)).when(key % 50 == 5, key.cast("string")).otherwise(text)
    text = F.when(key % 50 == 1, F.regexp_replace(text, r'"ticketInfo":\{.*?\}\}', '"ticketInfo":"sold out"')).otherwise(text)
    text = F.when(key % 50 == 4, F.regexp_replace(text, r'"totalListings":\d+', '"totalListings":"many"')).otherwise(text)
    path = f"{new_folder(m, 'raw')}/events"
    chosen.select(text.alias("value"), "snapshot_date").write.partitionBy("snapshot_date").text(path)
    return tolerant.read_lines(m.spark, path)


LINES = """
lines AS (
  SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS snapshot_date, o.*, c.*, n_name, r_name, o_orderkey % 50 AS odd
  FROM orders o JOIN customer c ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
readable AS (
  SELECT *, row_number() OVER (PARTITION BY snapshot_date, o_custkey
    ORDER BY odd = 3, CASE WHEN odd <> 3 THEN o_orderdate + to_microseconds(o_orderkey) END, CAST(o_orderkey AS VARCHAR)) AS rn
  FROM lines WHERE odd NOT IN (0, 5, 6)),
ev AS (SELECT * FROM readable WHERE rn = 1 AND o_orderpriority <> '5-LOW')
"""
ACCESSED = "CASE WHEN odd = 3 THEN CAST(snapshot_date AS TIMESTAMP) ELSE o_orderdate + to_microseconds(o_orderkey) END AS dt_accessed"


def plain_time(df: DataFrame) -> DataFrame:
    return df.withColumn("dt_accessed", F.col("dt_accessed").cast("timestamp_ntz"))


def read_events(m: Market) -> dict[str, DataFrame]:
    good, _ = tolerant.read_tolerant(damaged_days(m), EVENT_SCHEMA, "id")
    return parse.parse_events(stage_table(good, "events"))


@REGISTRY.add(f"""
WITH {LINES} SELECT NULL::VARCHAR AS created_date, NULL::VARCHAR AS dateonsale, NULL::VARCHAR AS description, {ACCESSED},
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS eventdatelocal, NULL::VARCHAR AS eventdateutc, NULL::VARCHAR AS eventurl,
  CASE WHEN o_orderstatus <> 'P' THEN n_name END AS geos, o_custkey AS event_id, NULL::VARCHAR AS lastupdateddate, c_name AS name,
  NULL::VARCHAR AS originalname, c_mktsegment AS category, c_acctbal > 5000 AS event_parking,
  CASE WHEN odd <> 2 THEN CAST(c_nationkey AS BIGINT) END AS venue_id, r_name AS venue_config,
  strftime(snapshot_date, '%Y_%m_%d') AS date_accessed, snapshot_date FROM ev""")
def events_read_tolerantly(m: Market) -> DataFrame:
    """All columns of the event table, from files with damaged lines."""
    return plain_time(read_events(m)["events_df"])


@REGISTRY.add(f"""
WITH {LINES} SELECT o_totalprice AS minprice, CASE WHEN odd <> 4 THEN CAST(o_orderkey % 400 AS INTEGER) END AS totallistings,
  CAST(o_orderkey % 900 AS INTEGER) AS totaltickets, 'USD' AS currencycode, o_custkey AS event_id, {ACCESSED}, snapshot_date
FROM ev WHERE o_orderpriority <> '4-NOT SPECIFIED' AND odd <> 1""")
def summary_read_tolerantly(m: Market) -> DataFrame:
    """Ticket figures: a text for all of them gives no row, a text for one of them a NULL."""
    return plain_time(read_events(m)["events_ticket_summary"]).select(
        "minprice", "totallistings", "totaltickets", "currencycode", "event_id", "dt_accessed", "snapshot_date")


@REGISTRY.add(f"""
WITH {LINES} SELECT snapshot_date, CASE odd WHEN 0 THEN 'no JSON' WHEN 5 THEN 'no object' ELSE 'no key' END AS reason, count(*) AS n
FROM lines WHERE odd IN (0, 5, 6) GROUP BY ALL""")
def quarantined_lines(m: Market) -> DataFrame:
    """Lines that are no event, by day and reason, from the quarantine they were written to."""
    _, bad = tolerant.read_tolerant(damaged_days(m), EVENT_SCHEMA, "id")
    path = new_folder(m, "quarantine")
    tolerant.quarantine(bad, path)
    kept = m.spark.read.schema(tolerant.QUARANTINE).parquet(path)
    return kept.groupBy("snapshot_date", "reason").agg(F.count(F.lit(1)).alias("n"))


@REGISTRY.add(f"""
WITH {LISTINGS} SELECT NULL::VARCHAR AS dirty_ticket_ind,
  l_shipdate + to_microseconds(l_partkey * 100000 + l_suppkey) AS dt_accessed, l_partkey AS event_id,
  CASE WHEN l_returnflag <> 'N' THEN l_tax END AS face_value, l_linestatus = 'O' AS is_ga, listing_id,
  l_extendedprice * (1 - l_discount) AS listing_price, CAST(l_quantity AS INTEGER) AS quantity, NULL::VARCHAR AS row_,
  NULL::DOUBLE AS score, NULL::VARCHAR AS seat_numbers, NULL::BIGINT AS section_id, 'Section ' || l_suppkey AS section_name,
  l_extendedprice AS price_curr, 'USD' AS currency_curr, l_extendedprice * (1 - l_discount) AS price_list, 'USD' AS currency_list,
  strftime(snapshot_date, '%Y_%m_%d') AS date_accessed, snapshot_date
FROM li WHERE snapshot_date IN (DATE '1997-01-01', DATE '1999-01-01')""")
def backfilled_days(m: Market) -> DataFrame:
    """Two stored raw days parsed again into the dated tables; the other days are not read."""
    root, target = new_folder(m, "raw"), new_folder(m, "tables")
    raw.write_raw(raw_events(m), root, "events")
    raw.write_raw(raw_listings(m), root, "listings")
    snapshots.backfill(m.spark, root, target, [dt.date(1997, 1, 1), dt.date(1999, 1, 1)])
    listings = snapshots.read_snapshot(m.spark, target, "tickets_df")
    accessed = F.to_timestamp("dt_accessed").cast("timestamp_ntz")
    return listings.withColumn("dt_accessed", accessed).select(
        "dirty_ticket_ind", "dt_accessed", "event_id", "face_value", "is_ga", "listing_id", "listing_price", "quantity", "row_",
        "score", "seat_numbers", "section_id", "section_name", "price_curr", "currency_curr", "price_list", "currency_list",
        "date_accessed", "snapshot_date")


ORDER_ROWS = StructType(
    [
        StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()), StructField("o_totalprice", DoubleType()),
        StructField("o_orderpriority", StringType()), StructField("line_break", StringType()), StructField("o_orderdate", DateType()),
        StructField("shop", IntegerType()),
    ]
)


@REGISTRY.add("""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, 'a "quoted", ' || o_orderkey AS line_break,
       CAST(o_orderdate AS DATE) AS o_orderdate, CAST(o_orderkey % 7 AS INTEGER) AS shop FROM orders""")
def orders_through_csv(m: Market) -> DataFrame:
    """Exported as text and read back: quotes and commas, whole numbers written as ``2.0``."""
    path = new_folder(m, "csv")
    rows = m.table("orders").select(
        F.col("o_orderkey").cast("double").cast("decimal(20,1)").alias("o_orderkey"), "o_custkey", "o_totalprice",
        F.concat("o_orderpriority", F.lit("  ")).alias("o_orderpriority"),
        F.concat(F.lit('a "quoted", '), F.col("o_orderkey").cast("string")).alias("line_break"),
        F.to_date("o_orderdate").alias("o_orderdate"), (F.col("o_orderkey") % 7).alias("shop"))
    snapshots.export_csv(rows, path)
    return snapshots.read_table_csv(m.spark, path, ORDER_ROWS, multi_line=False)


@REGISTRY.add("""
SELECT o_orderkey, o_custkey, o_orderpriority, o_orderpriority AS batch FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')""")
def staged_batches(m: Market) -> DataFrame:
    """Two batches through a staging table; the second is loaded, staged once more and loaded again."""
    name = f"tidemark_{uuid.uuid4().hex}"
    schema = m.table("orders").select("o_orderkey", "o_custkey", "o_orderpriority").schema
    target, staging, ledger = (f"{name}.{t}" for t in ("orders", "staging", "ledger"))
    tables.create_schema(m.spark, name)
    tables.create_table(m.spark, staging, schema)
    tables.create_table(m.spark, target, StructType([*schema.fields, StructField("batch", StringType())]), ["batch"])
    tables.create_table(m.spark, ledger, StructType([StructField("batch", StringType())]))
    for batch in ("1-URGENT", "5-LOW", "5-LOW"):
        rows = m.table("orders").filter(F.col("o_orderpriority") == batch).select(*schema.names)
        rows.write.insertInto(staging)
        tables.append_once(m.spark, target, staging, ledger, batch)
    tables.replace_view(m.spark.table(target), f"{name}_view")
    result = stage_table(tables.query(m.spark, f"SELECT * FROM {name}_view"), "batches")
    m.spark.catalog.dropTempView(f"{name}_view")
    for table in (target, staging, ledger):
        tables.drop_table(m.spark, table)
    m.spark.sql(f"DROP SCHEMA {name}")
    return result
