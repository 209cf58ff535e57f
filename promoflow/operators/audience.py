"""Audience maintenance: list events -> members -> per-offer add/delete.

Set-at-a-time form of the per-event, per-offer loop: every list event of a batch is one
row, every (event, offer) pair one row of a small control table, and every member change
one row of a delta keyed ``(offer_id, membership_uuid)``.  The big inputs (audience files,
the stored audience) are only ever shuffled on ``(offer_id, membership_uuid)`` or on the
card number, never on the offer or list alone, so a list holding a third of all members
still spreads over all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promoflow import settings as S
from promoflow.operators.joins import kept
from promoflow.operators.running import running_locations
from promoflow.sources.biglists import named_columns, unnamed_column


# -- member cards (S5, F4) ----------------------------------------------------
def active_member_cards(cards: DataFrame) -> DataFrame:
    """Cards that map to a member: both current flags, a live status, the account type."""
    return (cards
            .filter((F.col("current_ind") == S.CARD_CURRENT_FLAG)
                    & (F.col("card_current_ind") == S.CARD_CURRENT_FLAG)
                    & F.trim(F.col("cardStatus")).isin(*S.CARD_STATUSES)
                    & (F.col("cardType") == S.CARD_TYPE))
            .select(F.col("cardNumber").cast("string").alias("cardNumber"),
                    F.col("membershipId").cast("string").alias("membershipId")))


# -- audience file layout by source (C9) ------------------------------------------
def member_rows_by_source(rows: DataFrame, list_sources: DataFrame) -> DataFrame:
    """Give raw file rows their columns by the source of the list that reads them.

    ``rows``: (list_key, c0, c1) as read from the files.  ``list_sources``: (list_key,
    offer_source).  Personalised-ranking (tetris) files carry the card number and a
    propensity; the others one unnamed column, the card number.  Rows with open layout
    (``read_list_lines``) are read so, by the names of each file's header; others have the
    card number in ``c0`` and the propensity in ``c1``.
    """
    tetris = F.lower(F.col("offer_source")) == S.LABEL_TETRIS
    sources = kept(list_sources.dropDuplicates(["list_key", "offer_source"]), "list-sources")
    if "cells" in rows.columns:
        by_name = rows.join(sources.filter(tetris).select("list_key").distinct(), "list_key", "left_semi")
        by_place = rows.join(sources.filter(~tetris).select("list_key").distinct(), "list_key", "left_semi")
        read = [(named_columns(by_name, S.CARD_COLUMN, S.PROPENSITY_COLUMN), tetris), (unnamed_column(by_place), ~tetris)]
        a, b = (_with_sources(r, sources.filter(which), tetris) for r, which in read)
        return a.unionByName(b)
    return _with_sources(rows, sources, tetris)


def _with_sources(rows: DataFrame, sources: DataFrame, tetris) -> DataFrame:
    return (rows.join(sources, "list_key")
            .select("list_key", "offer_source",
                    F.col("c0").alias("membership_id"),
                    F.when(tetris, F.col("c1").try_cast("double")).alias("propensity")))


# -- card -> member (C8, J1, A1/A2) -----------------------------------------------
def resolve_members(members: DataFrame, cards: DataFrame) -> DataFrame:
    """Card numbers of each list to member ids, one row per (list, member).

    ``members``: (list_key, membership_id, propensity), and offer_source where one file is
    read by events of several sources; ``cards``: active cards.  A member
    with several cards keeps the card with the highest propensity, ties and lists without
    propensity going to the smallest card number.  Written as a min over a struct, so the
    choice is made by a partial (map-side) aggregate before the shuffle: a member or list
    with a huge number of rows is reduced in every task first.

    Files that already hold ``membership_uuid`` are passed through unchanged (P8).
    """
    if "membership_uuid" in members.columns:
        return members
    lists = [c for c in ("list_key", "offer_source") if c in members.columns]
    joined = (members
              .join(cards, members["membership_id"] == cards["cardNumber"])
              .select(*lists, F.col("membershipId").alias("membership_uuid"),
                      "membership_id", "propensity"))
    rank_key = F.struct(F.col("propensity").isNull().alias("no_prop"),
                        (-F.col("propensity")).alias("neg_prop"),
                        F.col("membership_id").alias("card"),
                        F.col("propensity").alias("prop"))
    best = joined.groupBy(*lists, "membership_uuid").agg(F.min(rank_key).alias("b"))
    return best.select(*lists, "membership_uuid",
                       F.col("b.card").alias("membership_id"),
                       F.col("b.prop").alias("propensity"))


# -- list events -> offers (S9, J5, J7, O3) ------------------------------------
def explode_list_events(events: DataFrame) -> DataFrame:
    """(event_id, arrival, offer_ids, location) -> one row per listed id with its position;
    an event with an empty list keeps one row without an id, so that it gets an outcome."""
    return (events.select("event_id", "arrival", "location",
                          F.posexplode_outer("offer_ids").alias("pos", "offer_id_text"))
            .withColumn("offer_id", F.col("offer_id_text").try_cast("bigint")))


def offers_for_list_events(pairs: DataFrame, offers: DataFrame) -> DataFrame:
    """Look the listed ids up among stored personalised offers.

    Returns every (event, listed id) with ``found``, the stored source and location, and
    ``event_source``: the source of the first found offer of the event, which decides how
    the event's audience file is read.
    """
    personalised = (offers.filter(F.col("offer_source") != S.SOURCE_BROADREACH)
                    .select("offer_id", "offer_source",
                            F.col("member_list_location").alias("stored_location")))
    # Cut the offer table down to the listed ids first; the remaining lookup is then between
    # two batch-sized tables.
    ids = kept(pairs.filter(F.col("offer_id").isNotNull()).select("offer_id").distinct(), "listed-ids")
    listed = personalised.join(ids, "offer_id", "left_semi")
    looked = pairs.join(listed, "offer_id", "left")
    looked = looked.withColumn("found", F.col("offer_source").isNotNull())
    # first found offer per event: a partial aggregate (an event may list very many ids)
    first = (looked.filter("found").groupBy("event_id")
             .agg(F.min_by("offer_source", "pos").alias("event_source")))
    return looked.join(first, "event_id", "left")


def unprocessed_offer_ids(looked: DataFrame) -> DataFrame:
    """Listed ids with no stored offer (reported back in the event's outcome)."""
    return (looked.filter(~F.col("found") & F.col("pos").isNotNull())
            .select("event_id", "pos", "offer_id_text"))


# -- effective events in arrival order (F14, W3) -------------------------------------
def effective_list_events(looked: DataFrame) -> DataFrame:
    """Which (event, offer) pairs change the audience, and in which round.

    Each processed event sets the offer's list location to its own.  The location an event
    sees is therefore the previous event's location for the same offer, the stored one for
    the first.  A pair is effective when that location differs from the event's; ``round``
    numbers the effective pairs of an offer in arrival order, so offers with several
    effective events in one batch are applied round by round, exactly as sequential
    processing would.
    """
    found = looked.filter(F.col("found")).dropDuplicates(["event_id", "offer_id"])
    stored = found.groupBy("offer_id").agg(F.first("stored_location").alias("location"))
    steps = found.withColumns({"is_list": F.lit(True), "sets": F.lit(True)}).unionByName(
        stored.withColumns({"is_list": F.lit(False), "sets": F.lit(True)}), allowMissingColumns=True)
    # The stored row has no arrival and sorts first.
    return running_locations(steps, ["arrival", "event_id"]).filter("is_list").drop("is_list", "sets")


# -- the delta (C10, SET2, SET3, J3) -------------------------------------------------
def audience_spells(current: DataFrame, targets: DataFrame, new_members: DataFrame) -> DataFrame:
    """For how long each member stays in the audience of each target offer, over a batch.

    ``current``: stored audience, one row per (offer_id, membership_uuid).  ``targets``:
    (offer_id, round, list_key), the effective lists of an offer numbered from 1 in arrival
    order.  ``new_members``: resolved list members (list_key, membership_uuid, membership_id,
    propensity).  Where both carry the ``offer_source`` that a list was read for, they meet
    on (list_key, offer_source).

    A member is present in round 0 if stored and in every round whose list holds the member;
    a run of consecutive rounds is one spell, whose row is that of its first round, as it
    would be if the lists were applied one after the other.  Output: (offer_id,
    membership_uuid, membership_id, propensity, from_round, to_round, last_round).  However
    many rounds there are, the rows move once, on (offer_id, membership_uuid).
    """
    key = ["offer_id", "membership_uuid"]
    by = ["list_key"] + ["offer_source"] * ("offer_source" in targets.columns and "offer_source" in new_members.columns)
    cols = [*key, "membership_id", "propensity", "round", "last_round"]
    last = targets.groupBy("offer_id").agg(F.max("round").alias("last_round"))
    listed = new_members.join(targets.select("offer_id", "round", *by).join(last, "offer_id"), by)
    stored = current.join(last, "offer_id").withColumn("round", F.lit(0))
    present = listed.select(*cols).unionByName(stored.select(*cols))
    run = F.col("round") - F.dense_rank().over(Window.partitionBy(*key).orderBy("round"))
    first = F.min(F.struct("round", "membership_id", "propensity"))
    return (present.withColumn("run", run).groupBy(*key, "run")
            .agg(first.alias("first"), F.max("round").alias("to_round"), F.max("last_round").alias("last_round"))
            .select(*key, "first.membership_id", "first.propensity", F.col("first.round").alias("from_round"),
                    "to_round", "last_round"))


def spell_changes(spells: DataFrame) -> DataFrame:
    """(offer_id, membership_uuid, action, membership_id, propensity, round): an ``add`` where
    a spell begins after the stored state, a ``delete`` where it ends before the last round."""
    cols = ["offer_id", "membership_uuid", "action", "membership_id", "propensity", "round"]
    adds = spells.filter("from_round > 0").withColumn("action", F.lit("add")).withColumn("round", F.col("from_round"))
    dels = (spells.filter("to_round < last_round").withColumn("action", F.lit("delete"))
            .withColumn("round", F.col("to_round") + 1))
    return adds.select(*cols).unionByName(dels.select(*cols))


def audience_delta(current: DataFrame, targets: DataFrame, new_members: DataFrame) -> DataFrame:
    """Members to add and to delete for each target offer, one effective list per offer:
    (offer_id, membership_uuid, action, membership_id, propensity)."""
    return spell_changes(audience_spells(current, targets.withColumn("round", F.lit(1)), new_members)).drop("round")


def delta_counts(delta: DataFrame) -> DataFrame:
    """Adds and deletes per offer (A3), from one aggregate over the delta."""
    return delta.groupBy("offer_id").agg(
        F.count(F.when(F.col("action") == "add", 1)).alias("n_add"),
        F.count(F.when(F.col("action") == "delete", 1)).alias("n_delete"))


def changed_members(delta: DataFrame) -> DataFrame:
    """Members whose set of offers changed (A6/SET5)."""
    return delta.select("membership_uuid").distinct()


def update_list_location(offers: DataFrame, new_locations: DataFrame) -> DataFrame:
    """Set ``member_list_location`` of matched offers (K4), NULL included."""
    upd = new_locations.select("offer_id", F.col("location").alias("_new_loc"),
                               F.lit(True).alias("_matched"))
    out = offers.join(upd, "offer_id", "left")
    return (out.withColumn("member_list_location",
                           F.when(F.col("_matched"), F.col("_new_loc"))
                           .otherwise(F.col("member_list_location")))
            .drop("_new_loc", "_matched"))


def final_list_locations(eff: DataFrame) -> DataFrame:
    """Location of each processed offer after the batch: that of its last event."""
    return (eff.groupBy("offer_id").agg(F.max(F.struct("arrival", "event_id", "location")).alias("last"))
            .select("offer_id", "last.location"))
