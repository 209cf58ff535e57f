"""Offer events of one batch -> new offers, items, store overrides and views."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoflow import settings as S
from promoflow.operators import items as I
from promoflow.operators import offers as O
from promoflow.operators import sites as ST
from promoflow.operators.joins import kept
from promoflow.operators.snapshot import replace_by_key, upsert
from promoflow.operators.serve import offer_view
from promoflow.settings import DEFAULT_CONFIG, EngineConfig
from promoflow.sources.biglists import unnamed_column


@dataclass
class OfferBatch:
    checked: DataFrame      # ready events with conflict flag and message
    applied: DataFrame      # the event applied per offer (last non-conflicting one)
    narrow: DataFrame       # new offers before their store lists are attached
    club_lists: DataFrame
    offers_new: DataFrame
    items_new: DataFrame
    overrides_new: DataFrame
    offers: DataFrame       # snapshots after the batch
    offer_items: DataFrame
    site_overrides: DataFrame
    outcomes: DataFrame     # (event_id, arrival, oid, status, comments)


def applicable(checked: DataFrame) -> DataFrame:
    """The checked events that change the stored tables."""
    return checked.filter(~F.col("conflict") & F.col("missing_list").isNull() & F.col("fault").isNull())


def check_offer_batch(ready: DataFrame, stored_offers: DataFrame, item_rows: DataFrame, store_rows: DataFrame,
                      cfg: EngineConfig = DEFAULT_CONFIG,
                      available_lists: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(events, checked, outcomes) of ready offer events: what the audit needs, without
    planning any item, store or override rows."""
    ev = O.normalise_times(ready).withColumn(
        "offer_id", F.col("e.payload.promotionNumber").try_cast("bigint"))
    # Batch-sized control tables, read by several size checks and sub-plans: kept once.
    accepted = ev.select("event_id", "arrival", "offer_id", "offer_source", O.member_list_location().alias("location"))
    accepted = accepted.join(O.list_faults(ev, available_lists, item_rows, store_rows), "event_id", "left")
    checked = kept(O.source_conflicts(accepted, stored_offers), "checked")
    ok = F.format_string(S.OFFER_DONE_FORMAT, F.col("offer_id").cast("string"))
    blob = F.col("missing_list").isNotNull() & ~F.col("conflict")
    fault = F.col("fault").isNotNull() & ~F.col("conflict")
    outcomes = checked.select(
        "event_id", "arrival", F.col("offer_id").cast("string").alias("oid"),
        F.when(blob | fault, F.lit(cfg.status_failed)).otherwise(F.lit(cfg.status_processed)).alias("status"),
        F.when(blob, F.concat(F.lit("blob: "), F.coalesce("missing_list", F.lit("")),
                              F.lit(" could not be read")))
        .when(fault, F.col("fault")).otherwise(F.coalesce(F.col("message"), ok)).alias("comments"),
        F.when(blob, F.lit(S.CLASS_BLOB)).when(fault, F.lit(S.CLASS_OTHER)).alias("failure_class"))
    return ev, checked, outcomes


def settled_rows(ready: DataFrame, item_rows: DataFrame, store_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Item and store rows with their columns settled: files with open layout
    (``read_list_lines``) are read by the source of the events that name them; store files
    have one unnamed column for every source."""
    if "cells" in item_rows.columns:
        item_rows = I.item_rows_by_source(item_rows, ready)
    if "cells" in store_rows.columns:
        store_rows = unnamed_column(store_rows)
    return item_rows, store_rows


def plan_offer_batch(ready: DataFrame, stored_offers: DataFrame, stored_items: DataFrame,
                     stored_overrides: DataFrame, directory: DataFrame, store_rows: DataFrame,
                     item_rows: DataFrame, catalogue: DataFrame,
                     cfg: EngineConfig = DEFAULT_CONFIG, available_lists: DataFrame | None = None) -> OfferBatch:
    """Apply ready (gated, trimmed, valid) offer events in arrival order.

    Every non-conflicting event is processed; since each one replaces the offer's rows,
    the state after the batch is that of the offer's last such event, so only that one
    is materialised.  Conflicting events change nothing and end with a message.  Events
    that need a big-list file that is not among ``available_lists`` (list_key) fail
    (BlobReadError) and change nothing either, and so do those with a list that holds a value
    that is no id or number; the source check comes first, as in the original order of steps.  Without a manifest the caller answers for every named file
    being there; whatever writes stored tables passes one.
    """
    item_rows, store_rows = settled_rows(ready, item_rows, store_rows)
    ev, checked, outcomes = check_offer_batch(ready, stored_offers, item_rows, store_rows, cfg, available_lists)
    last = O.latest_per_offer(applicable(checked).select("event_id", "arrival", "offer_id"))
    applied = kept(ev.join(last.select("event_id"), "event_id", "left_semi").drop("raw"), "applied")

    combined, club_lists = ST.club_combinations(applied, directory, store_rows, cfg.online_site_id)
    narrow = O.project_offers(combined)
    offers_new = ST.attach_club_lists(narrow, club_lists)
    items_new = I.offer_items(applied, item_rows, catalogue, cfg)
    overrides_new = ST.site_overrides(applied)

    updated = last.select("offer_id")
    offers = upsert(stored_offers, offers_new.drop("event_id", "arrival"), ["offer_id"])
    offer_items = replace_by_key(stored_items, items_new.drop("event_id"), updated, ["offer_id"])
    site_overrides = replace_by_key(stored_overrides, overrides_new.drop("event_id"), updated, ["offer_id"])
    return OfferBatch(checked, applied, narrow, club_lists, offers_new, items_new, overrides_new, offers, offer_items,
                      site_overrides, outcomes)


def offer_serving_view(batch: OfferBatch, max_items_per_chunk: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """View entries of the offers updated by the batch (K9): (offer rows, item chunks).  Store
    lists are attached to the joined rows, so that the join moves narrow ones."""
    rows, chunks = offer_view(batch.narrow.drop("event_id", "arrival"), batch.items_new, batch.overrides_new, max_items_per_chunk)
    return ST.attach_club_lists(rows, batch.club_lists), chunks
