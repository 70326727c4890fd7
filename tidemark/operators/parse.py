"""Nested event and listing objects to relational tables.

Raw frames carry ``snapshot_date``; several days can be parsed in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.dates import snapshot_text
from tidemark.functions.text import contains_ignoring_case
from tidemark.operators.keyed import keep_first

PARKING = "parking passes only"
LISTINGS_PER_QUERY = 100
QUERIES_PER_HOUR = 10 * 60
LINK_COLUMNS = ("seoURI", "webURI")
VENUE_DROPS = ("webURI", "seoURI", "venueUrl", "venueConfigId")

# The cities that make up a metropolitan area.
METRO_CITIES = {
    "NYC": ["New York", "Brooklyn", "Bronx", "Flushing", "East Rutherford"],
    "SF": ["San Francisco", "Oakland", "Berkeley", "San Jose"],
    "DC": ["Washington, DC", "Vienna"],
    "CHI": ["Chicago", "Rosemont", "Evanston"],
    "LA": ["Los Angeles", "Hollywood", "West Hollywood", "Pasadena"],
    "BOS": ["Boston", "Medford"],
}


def with_fields(df: DataFrame, schema: StructType) -> DataFrame:
    """Adds the fields of ``schema`` a batch came without, as NULL."""
    missing = [f for f in schema.fields if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})


def access_time(df: DataFrame) -> Column:
    """Time of access; the snapshot day where it was not recorded."""
    return F.coalesce(F.try_to_timestamp(F.col("dt_accessed")), F.col("snapshot_date").cast("timestamp"))


def first_copies(raw: DataFrame, key: str) -> DataFrame:
    """First copy of each object per day: pages of the catalogue overlap."""
    return keep_first(raw, ["snapshot_date", key], ["dt_accessed", F.xxhash64(*raw.columns)])


def explode_list(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row per element of an array of scalars, NULL elements left out."""
    return df.select(
        F.col("listingId").alias("listing_id"),
        F.explode(column).alias(name),
        access_time(df).alias("dt_accessed"),
        "snapshot_date",
    ).filter(F.col(name).isNotNull())


def struct_columns(df: DataFrame, column: str, without: Sequence[str] = (), lower: bool = False) -> list[Column]:
    """Fields of a struct as columns, leaving out the named ones."""
    fields = df.schema[column].dataType.fieldNames()
    kept = [f for f in fields if f not in without]
    return [F.col(f"{column}.{f}").alias(f.lower() if lower else f) for f in kept]


def clean_events(raw: DataFrame) -> DataFrame:
    """First copies without events that only sell parking."""
    return first_copies(raw, "id").filter(~contains_ignoring_case(F.col("name"), PARKING))


def events_table(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("createdDate").alias("created_date"),
        F.col("dateOnsale").alias("dateonsale"),
        "description",
        access_time(events).alias("dt_accessed"),
        F.col("eventDateLocal").alias("eventdatelocal"),
        F.col("eventDateUTC").alias("eventdateutc"),
        F.col("eventURL").alias("eventurl"),
        F.try_element_at("geos", F.lit(-1))["name"].alias("geos"),
        F.col("id").alias("event_id"),
        F.col("lastUpdatedDate").alias("lastupdateddate"),
        "name",
        F.col("originalName").alias("originalname"),
        F.get("categoriesCollection", F.lit(0))["name"].alias("category"),
        F.col("eventAttributes").isNotNull().alias("event_parking"),
        F.col("venue.id").alias("venue_id"),
        F.col("venueConfiguration.name").alias("venue_config"),
        snapshot_text(F.col("snapshot_date")).alias("date_accessed"),
        "snapshot_date",
    )


def event_performers(events: DataFrame) -> DataFrame:
    """One row per event and performer; events without performers give none."""
    rows = events.select(
        access_time(events).alias("dt_accessed"),
        F.col("id").alias("event_id"),
        "snapshot_date",
        F.explode("performersCollection").alias("p"),
    )
    wanted = [c for c in struct_columns(rows, "p", LINK_COLUMNS)]
    return rows.select("dt_accessed", "event_id", "snapshot_date", *wanted).withColumnsRenamed(
        {"id": "performer_id", "name": "performer_name"}
    )


def event_scores(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("id").alias("event_id"), "score", access_time(events).alias("dt_accessed"), "snapshot_date"
    )


def ticket_summary(events: DataFrame) -> DataFrame:
    """Market figures per event and day; objects and events without figures are left out."""
    nested = [f for f in events.schema["ticketInfo"].dataType.fieldNames() if "With" in f]
    return events.filter(F.col("ticketInfo").isNotNull()).select(
        *struct_columns(events, "ticketInfo", nested, lower=True),
        F.col("id").alias("event_id"),
        access_time(events).alias("dt_accessed"),
        snapshot_text(F.col("snapshot_date")).alias("date_accessed"),
        "snapshot_date",
    )


def venue_table(events: DataFrame) -> DataFrame:
    """Venues, first copy per day."""
    venues = events.filter(F.col("venue.id").isNotNull()).select(
        *struct_columns(events, "venue", VENUE_DROPS), "dt_accessed", "snapshot_date"
    )
    first = first_copies(venues, "id")
    return first.withColumn("dt_accessed", access_time(first)).withColumnRenamed("id", "venue_id")


def parse_events(raw: DataFrame) -> dict[str, DataFrame]:
    return event_tables(clean_events(raw))


def event_tables(events: DataFrame) -> dict[str, DataFrame]:
    """The five event tables of cleaned events."""
    return {
        "events_df": events_table(events),
        "events_perf": event_performers(events),
        "events_scores": event_scores(events),
        "events_ticket_summary": ticket_summary(events),
        "venues_df": venue_table(events),
    }


def listings_table(listings: DataFrame) -> DataFrame:
    return listings.select(
        F.col("dirtyTicketInd").alias("dirty_ticket_ind"),
        access_time(listings).cast("string").alias("dt_accessed"),
        "event_id",
        F.col("faceValue.amount").alias("face_value"),
        F.col("isGA").alias("is_ga"),
        F.col("listingId").alias("listing_id"),
        F.col("listingPrice.amount").alias("listing_price"),
        "quantity",
        F.col("row").alias("row_"),
        "score",
        F.col("seatNumbers").alias("seat_numbers"),
        F.col("sectionId").alias("section_id"),
        F.col("sectionName").alias("section_name"),
        F.col("sellerSectionName").alias("seller_section_name"),
        F.col("splitOption").alias("split_option"),
        F.col("ticketSplit").alias("ticket_split"),
        F.col("zoneId").alias("zone_id"),
        F.col("zoneName").alias("zone_name"),
        F.col("currentPrice.amount").alias("price_curr"),
        F.col("currentPrice.currency").alias("currency_curr"),
        F.col("listingPrice.amount").alias("price_list"),
        F.col("listingPrice.currency").alias("currency_list"),
        snapshot_text(F.col("snapshot_date")).alias("date_accessed"),
        "snapshot_date",
    )


def split_table(listings: DataFrame) -> DataFrame:
    rows = explode_list(listings, "splitVector", "ticket_splits_option")
    return rows.withColumn("date_accessed", snapshot_text(F.col("snapshot_date")))


def clean_listings(raw: DataFrame) -> DataFrame:
    return first_copies(raw, "listingId")


def parse_listings(raw: DataFrame) -> dict[str, DataFrame]:
    return listing_tables(clean_listings(raw))


def listing_tables(listings: DataFrame) -> dict[str, DataFrame]:
    """The five listing tables of listings without copies."""
    return {
        "tickets_df": listings_table(listings),
        "tickets_deliv_type": explode_list(listings, "deliveryTypeList", "listings_deliv_type"),
        "tickets_deliv_method": explode_list(listings, "deliveryMethodList", "listings_deliv_method"),
        "tickets_listing_attr": explode_list(listings, "listingAttributeList", "listings_listing_attr"),
        "tickets_splits": split_table(listings),
    }


def events_with_inventory(summary: DataFrame) -> DataFrame:
    return summary.filter(F.col("totallistings") > 0).select("event_id", "totallistings")


def catalogue_volume(summary: DataFrame) -> DataFrame:
    """Events, listings, and the queries and hours it takes to read them page by page."""
    pages = F.ceil(F.col("totallistings") / LISTINGS_PER_QUERY)
    volume = summary.agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.col("totallistings").cast("long")).alias("listings"),
        F.sum(pages).alias("queries"),
    )
    return volume.withColumn("hours", F.col("queries") / QUERIES_PER_HOUR)


def metro_filter(
    df: DataFrame, metros: Sequence[str], city: str = "city", members: dict[str, list[str]] = METRO_CITIES
) -> DataFrame:
    """Rows of the cities of the given areas; a literal list, so the scan can use it."""
    return df.filter(F.col(city).isin([c for metro in metros for c in members[metro]]))


def first_events(events: DataFrame, n: int = 3, key: str = "event_id") -> DataFrame:
    """Trial mode: the first ``n`` events by key."""
    return events.orderBy(key).limit(n)
