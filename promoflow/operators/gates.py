"""Intake gates for offer events.

Order matters and is kept: source routing, then the member-details gates, the label
block list, then the award trim and the "no award left" gate.  Each gate is a column, and
the first one that fires gives the event's status and reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promoflow import settings as S
from promoflow.functions.columns import any_label_in, source_from_labels
from promoflow.settings import DEFAULT_CONFIG, EngineConfig


def route_source(offer_events: DataFrame) -> DataFrame:
    """Add ``offer_source`` (stored form) and ``source_label`` (lower-case audit form)."""
    src = source_from_labels(F.col("e.payload.labels"))
    return offer_events.withColumn("offer_source", src).withColumn("source_label", F.lower(src))


def trimmed_awards(awards: Column, award_type: str = S.AWARD_TYPE_KEPT) -> Column:
    """Keep only awards of the wanted type (every one of them, in order)."""
    return F.filter(awards, lambda a: a["awardType"] == F.lit(award_type))


def trim_awards(offer_events: DataFrame, award_type: str = S.AWARD_TYPE_KEPT) -> DataFrame:
    """Add ``awards``: the award list trimmed to the wanted type.

    Kept as its own column rather than written back into the event struct, so later
    rules read one flat column instead of a rebuilt nested struct.
    """
    return offer_events.withColumn("awards", trimmed_awards(F.col("e.payload.awardList"), award_type))


def gate(offer_events: DataFrame, cfg: EngineConfig = DEFAULT_CONFIG) -> DataFrame:
    """Add ``gate_status`` and ``gate_reason`` (NULL when the event passes every gate).

    Expects ``route_source`` to have run.  An absent award list cannot be trimmed and
    fails the event (the original loop raised on it).
    """
    p = "e.payload"
    g1 = (F.col("source_label") != S.SOURCE_BROADREACH.lower()) & ~F.col("has_members")
    g2 = F.col("has_members") & ~F.col("one_member")  # by its raw type: the text "1" is not the number 1
    g3 = any_label_in(F.col(f"{p}.labels"), cfg.blocked_labels)
    no_awards = F.col(f"{p}.awardList").isNull()
    g4 = F.size(trimmed_awards(F.col(f"{p}.awardList"))) == 0
    skipped, failed = F.lit(cfg.status_skipped), F.lit(cfg.status_failed)
    status = (F.when(g1, skipped).when(g2, skipped).when(g3, skipped)
              .when(no_awards, failed).when(g4, skipped))
    reason = (F.when(g1, F.lit(S.REASON_MISSING_MEMBERS))
              .when(g2, F.lit(S.REASON_MEMBER_LIST_COUNT))
              .when(g3, F.lit(S.REASON_BLOCKED_LABEL))
              .when(no_awards, F.lit("awardList is missing"))
              .when(g4, F.lit(S.REASON_NO_AWARD)))
    return offer_events.withColumn("gate_status", status).withColumn("gate_reason", reason)
