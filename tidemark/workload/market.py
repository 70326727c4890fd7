"""The warehouse tables of a marketplace, read off the driver's tables.

A user stands for a listing, an event type for a split option, ten neighbouring
users for an event; the event's place comes from the customer with its number and
its performers from the suppliers of that customer's orders.  ``CTE`` states the
same tables in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.dates import snapshot_text
from tidemark.plans.label import EXCLUDED_SECTIONS, EXCLUDED_ZONES


class Market:
    """Frames over one data folder; every attribute is a lazy DataFrame."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._schemas: dict[str, StructType] = {}

    def table(self, name: str) -> DataFrame:
        """A table of the folder; its footer is read once per query, not once per mention."""
        path = f"{self.folder}/{name}.parquet"
        if name not in self._schemas:
            self._schemas[name] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[name]).parquet(path)

    @property
    def sightings(self) -> DataFrame:
        """One row per raw observation; a listing and option can repeat within a day."""
        kind = F.col("event_type")
        return self.table("events").select(
            F.col("user_id").alias("listing_id"),
            F.expr("user_id div 10").alias("event_id"),
            F.when(kind == "view", 1)
            .when(kind == "click", 2)
            .when(kind == "purchase", 4)
            .when(kind == "signup", 6)
            .otherwise(8)
            .alias("ticket_splits_option"),
            F.to_date("ts").alias("snapshot_date"),
            "value",
            F.get_json_object("props", "$.k").cast("int").alias("k"),
        )

    @property
    def splits(self) -> DataFrame:
        return self.sightings.select("listing_id", "ticket_splits_option", "snapshot_date").distinct()

    @property
    def listings(self) -> DataFrame:
        k, price = F.max("k"), F.max("value")
        rows = self.sightings.groupBy("listing_id", "event_id", "snapshot_date").agg(
            price.alias("price_curr"),
            F.count(F.lit(1)).cast("int").alias("quantity"),
            (F.min("k") < 5).alias("is_ga"),
            F.when(price < 1, F.lit("PARKING PASS"))
            .when(price < 2, F.lit(None))
            .otherwise(F.concat(F.lit("Section "), F.min("ticket_splits_option").cast("string")))
            .alias("section_name"),
            F.when(k < 10, F.lit("General Admission"))
            .when(k < 25, F.lit(""))
            .when(k < 50, F.lit("Floor"))
            .when(k < 75, F.lit("Balcony"))
            .otherwise(F.lit("Upper Tier"))
            .alias("zone_name"),
            F.when(F.min("k") < 30, F.lit(""))
            .when(F.min("k") < 65, F.lit("True"))
            .otherwise(F.lit("False"))
            .alias("dirty_ticket_ind"),
        )
        return with_text(rows)

    @property
    def summary(self) -> DataFrame:
        rows = self.sightings.groupBy("event_id", "snapshot_date").agg(
            F.min("value").alias("minprice"),
            F.max("value").alias("maxprice"),
            F.countDistinct("listing_id").cast("int").alias("totallistings"),
            F.count(F.lit(1)).cast("int").alias("totaltickets"),
            (F.count(F.lit(1)) / F.countDistinct("listing_id")).alias("popularity"),
        )
        return with_text(rows)

    @property
    def events(self) -> DataFrame:
        shows = (
            self.table("events")
            .groupBy(F.expr("user_id div 10").alias("event_id"))
            .agg(F.to_date(F.max("ts")).alias("last_day"))
        )
        place = self.table("customer").join(
            self.table("nation").join(
                self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
            ),
            F.col("c_nationkey") == F.col("n_nationkey"),
        )
        return shows.join(place, F.col("event_id") == F.col("c_custkey")).select(
            "event_id",
            F.col("c_name").alias("name"),
            F.concat(F.date_add("last_day", F.col("c_nationkey")).cast("string"), F.lit("T20:00:00")).alias(
                "eventdatelocal"
            ),
            F.concat("n_name", F.lit("   ")).alias("geos"),
            F.concat("r_name", F.lit(" / "), "c_mktsegment").alias("category"),
            (F.col("c_acctbal") > 5000).alias("event_parking"),
            F.col("c_nationkey").cast("long").alias("venue_id"),
            F.concat("r_name", F.lit(" hall")).alias("venue_config"),
        )

    @property
    def performers(self) -> DataFrame:
        flag = F.col("l_returnflag")
        pairs = (
            self.table("lineitem")
            .join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy(F.col("o_custkey").alias("event_id"), F.col("l_suppkey").alias("performer_id"))
            .agg(F.max(F.when(flag == "N", F.lit("")).otherwise(flag)).alias("role"))
        )
        return pairs.join(self.table("supplier"), F.col("performer_id") == F.col("s_suppkey")).select(
            "event_id", "performer_id", F.col("s_name").alias("performer_name"), "role"
        )


def with_text(df: DataFrame) -> DataFrame:
    return df.withColumn("date_accessed", snapshot_text(F.col("snapshot_date")))


CTE = """
sightings AS (
  SELECT user_id AS listing_id, user_id // 10 AS event_id,
         CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 4
              WHEN 'signup' THEN 6 ELSE 8 END AS ticket_splits_option,
         strftime(ts, '%Y_%m_%d') AS date_accessed, CAST(ts AS DATE) AS snapshot_date, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
splits AS (SELECT DISTINCT listing_id, ticket_splits_option, date_accessed FROM sightings),
listings AS (
  SELECT listing_id, event_id, date_accessed, max(value) AS price_curr,
         CAST(count(*) AS INTEGER) AS quantity, min(k) < 5 AS is_ga,
         CASE WHEN max(value) < 1 THEN 'PARKING PASS' WHEN max(value) < 2 THEN NULL
              ELSE 'Section ' || min(ticket_splits_option) END AS section_name,
         CASE WHEN max(k) < 10 THEN 'General Admission' WHEN max(k) < 25 THEN ''
              WHEN max(k) < 50 THEN 'Floor' WHEN max(k) < 75 THEN 'Balcony'
              ELSE 'Upper Tier' END AS zone_name,
         CASE WHEN min(k) < 30 THEN '' WHEN min(k) < 65 THEN 'True' ELSE 'False' END AS dirty_ticket_ind
  FROM sightings GROUP BY listing_id, event_id, date_accessed),
summary AS (
  SELECT event_id, snapshot_date, date_accessed, min(value) AS minprice, max(value) AS maxprice,
         CAST(count(DISTINCT listing_id) AS INTEGER) AS totallistings,
         CAST(count(*) AS INTEGER) AS totaltickets,
         count(*) / count(DISTINCT listing_id) AS popularity
  FROM sightings GROUP BY event_id, snapshot_date, date_accessed),
shows AS (SELECT user_id // 10 AS event_id, CAST(max(ts) AS DATE) AS last_day FROM events GROUP BY 1),
events_dim AS (
  SELECT event_id, c_name AS name, CAST(last_day + c_nationkey AS VARCHAR) || 'T20:00:00' AS eventdatelocal,
         n_name || '   ' AS geos, r_name || ' / ' || c_mktsegment AS category,
         c_acctbal > 5000 AS event_parking, CAST(c_nationkey AS BIGINT) AS venue_id,
         r_name || ' hall' AS venue_config
  FROM shows JOIN customer ON c_custkey = event_id JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey),
performers AS (
  SELECT p.event_id, p.performer_id, s_name AS performer_name, p.role
  FROM (SELECT o_custkey AS event_id, l_suppkey AS performer_id,
               max(CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END) AS role
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2) p
  JOIN supplier ON s_suppkey = p.performer_id),
seats AS (
  SELECT listing_id, event_id, date_accessed, price_curr, quantity, zone_name, dirty_ticket_ind FROM listings
  WHERE is_ga = false AND section_name IS NOT NULL AND zone_name IS NOT NULL
    AND NOT list_contains(@sections@, section_name) AND NOT list_contains(@zones@, zone_name)),
-- An observation is gone when its day is the greatest one of its listing and option; of several
-- copies on that day the first one is.
seen AS (
  SELECT listing_id, ticket_splits_option, date_accessed, CAST(replace(date_accessed, '_', '-') AS DATE) AS date,
         date_accessed = max(date_accessed) OVER (PARTITION BY listing_id, ticket_splits_option)
         AND 1 = row_number() OVER (PARTITION BY listing_id, ticket_splits_option, date_accessed) AS gone
  FROM splits),
-- Label rows with what their listing says, where the event is seen on the next day too.
seat_labels AS (
  SELECT seats.*, seen.date, seen.ticket_splits_option, CAST(seen.gone AS INTEGER) AS indicator
  FROM seen JOIN seats USING (listing_id, date_accessed)
  WHERE (seats.event_id, seen.date) IN (SELECT (event_id, snapshot_date - 1) FROM summary)),
labels_v AS (SELECT listing_id, ticket_splits_option, date_accessed, date, indicator FROM seat_labels),
date_features AS (
  SELECT event_id, date_accessed, CAST(show_day - day AS INTEGER) AS days_until_show,
         CAST(extract(dow FROM day) AS INTEGER) AS dow_listing_avail, CAST(extract(dow FROM show_day) AS INTEGER) AS dow_show
  FROM (SELECT DISTINCT event_id, date_accessed, CAST(replace(date_accessed, '_', '-') AS DATE) AS day FROM listings)
  JOIN (SELECT event_id, CAST(left(eventdatelocal, 10) AS DATE) AS show_day FROM events_dim) USING (event_id)),
event_sizes AS (SELECT event_id, count(DISTINCT listing_id) AS event_listing_n FROM listings GROUP BY event_id)
""".replace("@sections@", str(EXCLUDED_SECTIONS)).replace("@zones@", str(EXCLUDED_ZONES))


def with_market(select: str) -> str:
    """``select`` after the market tables; it may bring more tables of its own."""
    select = select.strip()
    if select.startswith("WITH "):
        return f"WITH {CTE.strip()},\n{select[5:]}"
    return f"WITH {CTE.strip()}\n{select}"
