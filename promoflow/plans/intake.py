"""Intake of a batch of raw events (C14): decode, route, gate, trim, validate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoflow import settings as S
from promoflow.operators.gates import gate, route_source, trim_awards
from promoflow.operators.validate import list_errors, offer_errors
from promoflow.settings import DEFAULT_CONFIG, EngineConfig
from promoflow.sources.events import KIND_LIST, decode_events, first_offer_id, route_event_kind


@dataclass
class Intake:
    decoded: DataFrame        # the decoded batch, kept in the shared folder
    dead_letters: DataFrame   # raw rows that are not one JSON object or have no event id
    offers: DataFrame         # offer events with gate columns, trimmed awards, errors, status
    lists: DataFrame          # member-list events with errors, status
    outcomes: DataFrame       # (event_id, arrival, kind, oid, source_label, status, reason, failure_class)


def judged(events: DataFrame, cfg: EngineConfig = DEFAULT_CONFIG) -> DataFrame:
    """Parsed events with ``oid``, source, gate result, ``errors``, ``status``, ``reason`` and
    ``failure_class``; a member-list event passes no gate and has no source."""
    is_list = F.col("kind") == KIND_LIST
    failed, ready = F.lit(cfg.status_failed), F.lit(cfg.status_processing)
    x = trim_awards(gate(route_source(first_offer_id(events)), cfg))
    x = x.withColumns({
        "source_label": F.when(is_list, F.lit("")).otherwise(F.col("source_label")),
        "gate_status": F.when(~is_list, F.col("gate_status")), "gate_reason": F.when(~is_list, F.col("gate_reason")),
        "errors": F.when(is_list, list_errors()).otherwise(offer_errors(cfg))})
    broken = F.size("errors") > 0
    x = x.withColumns({"status": F.coalesce(F.col("gate_status"), F.when(broken, failed), ready),
                       "reason": F.coalesce(F.col("gate_reason"), F.when(broken, F.array_join("errors", "; ")))})
    # A failed gate (no award list) is a plain error, a broken rule a payload error.
    why = F.when(F.col("gate_status").isNotNull(), F.lit(S.CLASS_OTHER)).otherwise(F.lit(S.CLASS_PAYLOAD))
    return x.withColumn("failure_class", F.when(F.col("status") == failed, why)).drop("awards")


def run_intake(raw: DataFrame, cfg: EngineConfig = DEFAULT_CONFIG, keep_raw: bool = True) -> Intake:
    """Gate and validate a batch.  Status is SKIPPED or FAILED with a reason, or
    PROCESSING for events ready to be applied (audit first, gates, trim, validation).
    The batch is judged in the pass that parses it, as its events are read many times later.
    The texts are kept for the audit; without ``keep_raw`` they end at the parser."""
    good, bad = decode_events(raw, keep_raw, lambda parsed: judged(parsed, cfg))
    offers, lists = route_event_kind(good)
    cols = ["event_id", "arrival", "kind", "oid", "source_label", "status", "reason", "failure_class"]
    return Intake(good, bad, trim_awards(offers), lists.drop("offer_source", "gate_status", "gate_reason"), good.select(*cols))
