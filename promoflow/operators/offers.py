"""Offer rows from offer events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promoflow import settings as S
from promoflow.functions import columns as C


def normalise_times(offer_events: DataFrame, default_zone: str = S.DEFAULT_TIME_ZONE) -> DataFrame:
    """Start/end as 'date time' text, event time cut to seconds, empty zone defaulted."""
    p = "e.payload"
    return (offer_events
            .withColumn("start_text", C.date_and_time(F.col(f"{p}.startDate"), F.col(f"{p}.startTime")))
            .withColumn("end_text", C.date_and_time(F.col(f"{p}.endDate"), F.col(f"{p}.endTime")))
            .withColumn("event_time_text", C.event_time_text(F.col(f"{p}.eventTimeStamp")))
            .withColumn("zone", C.zone_or_default(F.col(f"{p}.timeZone"), default_zone)))


def member_list_location() -> Column:
    """Location of an offer event's member list, empty without one."""
    return C.joined_text_or_empty(F.col("e.payload.memberDetails.membersPayload.memberBigListURL"))


def project_offers(offer_events: DataFrame) -> DataFrame:
    """Flat offer rows (P1-P5) from normalised events with trimmed ``awards``.

    ``club_list`` is that of store resolution where the events carry it, else the inline
    lists as sent; the ``combination`` of lists still to be attached goes along.  The result
    keeps ``event_id`` and ``arrival``.
    """
    p = "e.payload"
    awards = F.col("awards")
    df = offer_events
    if "club_list" not in df.columns:
        df = df.withColumn("club_list", C.long_array(C.flatten_lists(F.col(f"{p}.clubDetails.clubsPayload.clubList"))))
    return df.select(
        "event_id", "arrival",
        F.col(f"{p}.promotionNumber").try_cast("bigint").alias("offer_id"),
        F.col(f"{p}.status").alias("status"),
        C.parse_ts(F.col("start_text")).alias("start_datetime"),
        C.parse_ts(F.col("end_text")).alias("end_datetime"),
        C.parse_ts(F.col("event_time_text")).alias("event_timestamp"),
        F.col("zone").alias("time_zone"),
        F.col("offer_source"),
        C.joined_text(awards["discountMethod"]).alias("discount_type"),
        F.when(awards.isNotNull(), F.concat_ws(",", awards["value"]).try_cast("double")).alias("discount_value"),
        F.col(f"{p}.channels").alias("applicable_channel"),
        F.col("club_list"),
        member_list_location().alias("member_list_location"),
        F.col(f"{p}.membershipType").alias("membership_type"),
        C.joined_text_or_empty(F.col(f"{p}.itemDetails.itemsPayload.itemBigListURL")).alias("item_list_location"),
        F.col(f"{p}.labels").alias("labels"),
        F.lit("").alias("offer_set_id"),
        F.lit(None).cast("bigint").alias("campaign_id"),
        F.lit("").alias("campaign_name"),
        F.lit("").alias("member_list_name"),
        *[c for c in df.columns if c == "combination"])


def expired_offers(offers: DataFrame, as_of) -> DataFrame:
    """Add ``is_expired``: the current time in the offer's zone, cut to seconds, is after
    the end (F15).  ``as_of`` is a UTC instant (literal or column); an unknown zone gives
    NULL.  Wall-clock end times are turned into instants with their zone's rules.
    """
    as_of_col = as_of if not isinstance(as_of, str) else F.lit(as_of).cast("timestamp")
    region = C.zone_region(F.col("time_zone"))
    local_now = F.date_trunc("second", F.from_utc_timestamp(as_of_col, region))
    return offers.withColumn("is_expired", local_now > F.col("end_datetime").cast("timestamp"))


def latest_per_offer(df: DataFrame, order_cols=("arrival", "event_id"), key: str = "offer_id") -> DataFrame:
    """The last event of each offer in arrival order.

    Written as a max over (order columns, row) per offer rather than a window, so each task
    reduces its share of a hot offer before the shuffle (partial aggregation).
    """
    cols = df.columns
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)],
                      F.struct(*cols).alias("_row"))
    best = df.groupBy(key).agg(F.max(packed).alias("_best"))
    return best.select(*[F.col(f"_best._row.{c}").alias(c) for c in cols])


def source_conflicts(accepted: DataFrame, stored: DataFrame) -> DataFrame:
    """Flag events whose source differs from the offer's fixed source.

    An offer's source never changes once created: it is the stored one, or for a new
    offer the source of its first usable event in arrival order.  ``accepted``:
    (event_id, arrival, offer_id, offer_source), and ``missing_list`` or ``fault`` for events
    that fail, which create nothing and so fix no source; returns it with
    ``stored_source``, ``fixed_source``, ``conflict`` and ``message``.  The per-offer source is a partial
    aggregate (hot offers are reduced map-side) joined back.
    """
    at = F.struct("arrival", "event_id")
    usable = F.lit(True)
    for c in {"missing_list", "fault"} & set(accepted.columns):
        usable = usable & F.col(c).isNull()
    first = accepted.groupBy("offer_id").agg(
        F.min_by("offer_source", F.when(usable, at)).alias("first_source"), F.min(F.when(usable, at)).alias("first_at"))
    st = stored.select("offer_id", F.col("offer_source").alias("stored_source"))
    fixed = (first.join(st, "offer_id", "left")
             .select("offer_id", "stored_source", "first_at",
                     F.coalesce("stored_source", "first_source").alias("fixed_source")))
    x = accepted.join(fixed, "offer_id", "left")
    created = F.col("stored_source").isNotNull() | F.coalesce(at > F.col("first_at"), F.lit(False))
    conflict = created & ~F.col("offer_source").eqNullSafe(F.col("fixed_source"))
    msg = F.format_string(S.SOURCE_CONFLICT_FORMAT, F.col("fixed_source"), F.col("offer_id").cast("string"))
    return x.withColumn("conflict", conflict).withColumn("message", F.when(conflict, msg)).drop("first_at")


def list_faults(offer_events: DataFrame, available: DataFrame | None, item_rows: DataFrame, store_rows: DataFrame) -> DataFrame:
    """(event_id, missing_list, fault) of the events that name a list they cannot be applied
    with.

    ``missing_list``: a big-list file that is not among ``available`` (list_key), or that has
    no ``named`` column for a source that reads its items by name.  ``fault``:
    a file or an inline list holds a value that is no whole number, or a store part was sent
    as null.  Item lists count when their payload is referenced by the first award.  Of every
    file only its key and whether it is bad leave the scan.
    """
    from promoflow.operators.items import bad_item_numbers, referenced_payloads, rows_of
    from promoflow.operators.sites import bad_store_ids, store_files_named
    payloads = referenced_payloads(offer_events)
    items = payloads.filter(F.col("list_type") != "list").select("event_id", "list_key", "offer_source")
    stores = store_files_named(offer_events)
    bad_rows = lambda rows, by: rows.filter(F.col("c0").try_cast("bigint").isNull()).select(*by).distinct()
    by = rows_of(item_rows)
    bad = (items.join(bad_rows(item_rows, by), by).select("event_id", "list_key")
           .unionByName(stores.join(bad_rows(store_rows, ["list_key"]), "list_key").select("event_id", "list_key")))
    said = lambda what: F.format_string(S.BAD_VALUE_FORMAT, what)
    none = F.lit(None).cast("string")
    found = bad.select("event_id", none.alias("missing_list"), said(F.col("list_key")).alias("fault"))
    if available is not None:
        named = F.col("named") if "named" in available.columns else F.lit(True)
        there = available.select("list_key", named.alias("named")).groupBy("list_key").agg(F.max("named").alias("named"))
        by_name = F.lower(F.coalesce("offer_source", F.lit(""))) == S.LABEL_TETRIS
        needed = items.unionByName(stores.withColumn("offer_source", none)).join(there, "list_key", "left")
        gone = needed.filter(F.col("named").isNull() | (by_name & ~F.col("named")))
        found = found.unionByName(gone.select("event_id", F.col("list_key").alias("missing_list"), none.alias("fault")))
    own = offer_events.select("event_id", F.when(F.size("nulls") > 0, F.format_string(S.NULL_PART_FORMAT, F.get("nulls", F.lit(0))))
                              .when(bad_store_ids(), said(F.lit("clubList"))).alias("fault"))
    inline = payloads.filter(bad_item_numbers()).select("event_id", said(F.lit("itemList")).alias("fault"))
    inline = own.filter(F.col("fault").isNotNull()).unionByName(inline).select("event_id", none.alias("missing_list"), "fault")
    return found.unionByName(inline).groupBy("event_id").agg(F.min("missing_list").alias("missing_list"), F.min("fault").alias("fault"))
