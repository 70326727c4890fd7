"""Schemas of the raw snapshots and of the warehouse tables; every field may be NULL."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TEXT, LONG, INT, DOUBLE, FLAG, TIME = (
    StringType(), LongType(), IntegerType(), DoubleType(), BooleanType(), TimestampType(),
)


def struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


NAMED = ArrayType(struct(name=TEXT))
MONEY = struct(amount=DOUBLE, currency=TEXT)

EVENT_SCHEMA = struct(
    id=LONG, name=TEXT, originalName=TEXT, description=TEXT,
    createdDate=TEXT, lastUpdatedDate=TEXT, dateOnsale=TEXT,
    eventDateLocal=TEXT, eventDateUTC=TEXT, eventURL=TEXT,
    categoriesCollection=NAMED, geos=NAMED, eventAttributes=struct(parking=TEXT),
    performersCollection=ArrayType(struct(id=LONG, name=TEXT, role=TEXT, url=TEXT, seoURI=TEXT, webURI=TEXT)),
    score=DOUBLE,
    ticketInfo=struct(
        minPrice=DOUBLE, maxPrice=DOUBLE, minListPrice=DOUBLE, maxListPrice=DOUBLE,
        originalMinListPrice=DOUBLE, totalTickets=INT, totalPostings=INT, totalListings=INT,
        popularity=DOUBLE, currencyCode=TEXT, maxSaleEndDate=TEXT, totalTicketsAtMinPrice=DOUBLE,
        minPriceWithCurrency=MONEY, maxPriceWithCurrency=MONEY,
    ),
    venue=struct(
        id=LONG, name=TEXT, city=TEXT, state=TEXT, country=TEXT,
        webURI=TEXT, seoURI=TEXT, venueUrl=TEXT, venueConfigId=LONG,
    ),
    venueConfiguration=struct(name=TEXT),
    dt_accessed=TEXT,
)

LISTING_SCHEMA = struct(
    listingId=LONG, event_id=LONG, dirtyTicketInd=TEXT, isGA=FLAG,
    currentPrice=MONEY, listingPrice=MONEY, faceValue=struct(amount=DOUBLE),
    quantity=INT, row=TEXT, score=DOUBLE, seatNumbers=TEXT,
    sectionId=LONG, sectionName=TEXT, sellerSectionName=TEXT,
    splitOption=INT, ticketSplit=INT, zoneId=LONG, zoneName=TEXT,
    splitVector=ArrayType(INT), deliveryTypeList=ArrayType(INT), deliveryMethodList=ArrayType(INT),
    listingAttributeList=ArrayType(INT),
    dt_accessed=TEXT,
)

TABLES = {
    "tickets_splits": struct(
        listing_id=LONG, ticket_splits_option=INT, date_accessed=TEXT, dt_accessed=TIME,
    ),
    "tickets_df": struct(
        dirty_ticket_ind=TEXT, dt_accessed=TEXT, event_id=LONG, face_value=DOUBLE, is_ga=FLAG,
        listing_id=LONG, listing_price=DOUBLE, quantity=INT, row_=TEXT, score=DOUBLE,
        seat_numbers=TEXT, section_id=LONG, section_name=TEXT, seller_section_name=TEXT,
        split_option=INT, ticket_split=INT, zone_id=LONG, zone_name=TEXT, price_curr=DOUBLE,
        currency_curr=TEXT, price_list=DOUBLE, currency_list=TEXT, date_accessed=TEXT,
    ),
    "events_ticket_summary": struct(
        minprice=DOUBLE, maxprice=DOUBLE, minlistprice=DOUBLE, maxlistprice=DOUBLE,
        originalminlistprice=DOUBLE, totaltickets=INT, totalpostings=INT, totallistings=INT,
        popularity=DOUBLE, currencycode=TEXT, maxsaleenddate=TEXT, totalticketsatminprice=DOUBLE,
        event_id=LONG, dt_accessed=TIME, date_accessed=TEXT,
    ),
    "events_df": struct(
        created_date=TEXT, dateonsale=TEXT, description=TEXT, dt_accessed=TIME,
        eventdatelocal=TEXT, eventdateutc=TEXT, eventurl=TEXT, geos=TEXT, event_id=LONG,
        lastupdateddate=TEXT, name=TEXT, originalname=TEXT, category=TEXT,
        event_parking=FLAG, venue_id=LONG, venue_config=TEXT, date_accessed=TEXT,
    ),
    "events_perf": struct(
        dt_accessed=TIME, event_id=LONG, performer_id=LONG, performer_name=TEXT, role=TEXT, url=TEXT,
    ),
}
