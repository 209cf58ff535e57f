"""Member-list events of one batch -> audience changes (C10, C11, C12 as one plan)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoflow import settings as S
from promoflow.operators import audience as A
from promoflow.operators.end_state import EndState
from promoflow.operators.joins import kept
from promoflow.operators.serve import member_view, net_changes
from promoflow.sources.events import list_event_rows


class AppliedLists:
    """What the effective events of a batch do to the stored audience.  The audience grows with
    offers times members of a list: each part is worked out when it is first read, and only the
    changes by round need the spells, which are kept."""

    def __init__(self, effective: DataFrame, member_offers: DataFrame, member_files: DataFrame, cards: DataFrame):
        self.effective, self.current, self.member_files, self.cards = effective, member_offers, member_files, cards

    @cached_property
    def members(self) -> DataFrame:
        """Resolved members per (list_key, offer_source)."""
        return resolved_members_for(self.effective, self.member_files, self.cards)

    @cached_property
    def targets(self) -> DataFrame:
        return kept(effective_targets(self.effective), "targets")

    @cached_property
    def spells(self) -> DataFrame:
        """How long each member stays, over the rounds of the batch."""
        return kept(A.audience_spells(self.current, self.targets, self.members), "spells")

    @cached_property
    def end(self) -> EndState:
        return EndState(self.current, self.targets, self.members)


@dataclass
class ListBatch:
    looked: DataFrame        # every (event, listed id) with lookup result
    effective: DataFrame     # found (event, offer) pairs with effective flag and round
    applied: AppliedLists
    offers: DataFrame        # stored offers with the new list locations

    @property
    def delta(self) -> DataFrame:
        """(offer_id, membership_uuid, action, membership_id, propensity, round)."""
        return A.spell_changes(self.applied.spells)

    @cached_property
    def member_offers(self) -> DataFrame:
        """The stored audience after the batch."""
        return self.applied.end.audience


def resolved_members_for(effective: DataFrame, member_files: DataFrame, cards: DataFrame) -> DataFrame:
    """Resolve the files of the effective events, each read by its event's source."""
    list_sources = (effective.filter("effective")
                    .select(F.col("location").alias("list_key"),
                            F.col("event_source").alias("offer_source")).distinct())
    rows = A.member_rows_by_source(member_files, list_sources)
    return A.resolve_members(rows, A.active_member_cards(cards))


def effective_targets(effective: DataFrame) -> DataFrame:
    """(offer_id, round, list_key, offer_source) of the effective events."""
    return (effective.filter("effective")
            .select("offer_id", "round", F.col("location").alias("list_key"), F.col("event_source").alias("offer_source")))


def with_missing_list(looked: DataFrame, available: DataFrame) -> DataFrame:
    """Adds ``missing_list``: the location where the event cannot read its file, because it is
    not among ``available`` or, for a source that reads by name, has no named columns."""
    named = F.col("named") if "named" in available.columns else F.lit(True)
    avail = (available.select(F.col("list_key").alias("location"), named.alias("_named"))
             .groupBy("location").agg(F.max("_named").alias("_named")))
    readable = F.col("_named") | (F.lower(F.coalesce("event_source", F.lit(""))) != S.LABEL_TETRIS)
    return (looked.join(avail, "location", "left")
            .withColumn("missing_list", F.when(~F.coalesce(F.col("_named").isNotNull() & readable, F.lit(False)), F.col("location")))
            .drop("_named"))


def look_up_list_batch(decoded_list_events: DataFrame, offers: DataFrame,
                       available_lists: DataFrame | None = None) -> DataFrame:
    """Every (event, listed id) with its lookup result and ``missing_list``: what the
    outcomes need, without resolving any member."""
    pairs = A.explode_list_events(list_event_rows(decoded_list_events))
    looked = A.offers_for_list_events(pairs, offers)
    if available_lists is not None:
        looked = with_missing_list(looked, available_lists)
    else:
        looked = looked.withColumn("missing_list", F.lit(None).cast("string"))
    return kept(looked, "looked")


def plan_list_batch(decoded_list_events: DataFrame, offers: DataFrame, member_offers: DataFrame,
                    member_files: DataFrame, cards: DataFrame,
                    available_lists: DataFrame | None = None) -> ListBatch:
    """Apply a batch of (valid) member-list events.

    However many effective events an offer has in the batch, they are applied at once, with
    the rows that applying them in arrival order would leave (``audience_spells``, ``EndState``).

    An event whose file is not among ``available_lists`` (list_key) gets ``missing_list``
    set; it fails (BlobReadError) and is left out before the effective-event computation,
    so it changes neither audience nor location.  Without a manifest the caller answers
    for every named file being there; whatever writes stored tables passes one.
    """
    looked = look_up_list_batch(decoded_list_events, offers, available_lists)
    eff = kept(A.effective_list_events(looked.filter(F.col("missing_list").isNull())), "effective")
    new_offers = A.update_list_location(offers, A.final_list_locations(eff))
    return ListBatch(looked, eff, AppliedLists(eff, member_offers, member_files, cards), new_offers)


def member_view_changes(batch: ListBatch, view: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(upserts, deletes) of the stored member view after the batch."""
    return member_view(view, net_changes(batch.delta))
