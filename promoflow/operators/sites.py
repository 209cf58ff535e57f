"""Stores of an offer (C7, S6, F5, F6, F16, J4) and store overrides.

Store lists come in four forms: an inline list, a big-list file (included or excluded
stores), a standard list (all stores, Puerto Rico only, all but Puerto Rico) and, for
online-only offers without any store payload, the online store.  Every payload names its
set by a key, computed in the event's own row; an event's keys together are its combination.
An inline list is read from the event's own row.  Each distinct set of a file or standard list
is resolved once, as bitmaps of store positions by bucket (an exclusion file is the ALL bitmap
less the file's), each distinct combination once, and events only join the combinations, as the
last step: no event x store rows are made on the way.

A store that one list names twice is in its set once; one that two payloads name is in the
event's list twice, as the payloads are concatenated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promoflow import settings as S
from promoflow.functions import columns as C
from promoflow.operators.joins import kept


def active_sites(directory: DataFrame) -> DataFrame:
    """DISTINCT (club_id, state) of active regular stores."""
    return (directory
            .filter((F.col("isActive") == F.lit(True))
                    & (F.col("clubType").isNull() | (F.col("clubType") == S.SITE_TYPE_REGULAR)))
            .select(F.col("id").cast("bigint").alias("club_id"), F.col("address.state").alias("state"))
            .distinct())


def standard_site_lists(sites: DataFrame) -> DataFrame:
    """(list_name, club_id) of the three standard lists.

    ``state != 'PR'`` also drops stores with no state, as SQL three-valued logic does.
    """
    all_ = sites.select(F.lit(S.STANDARD_LIST_ALL).alias("list_name"), "club_id")
    pr = sites.filter(F.col("state") == S.PUERTO_RICO_STATE).select(
        F.lit(S.STANDARD_LIST_PR_ONLY).alias("list_name"), "club_id")
    us = sites.filter(F.col("state") != S.PUERTO_RICO_STATE).select(
        F.lit(S.STANDARD_LIST_US_EXCLUDING_PR).alias("list_name"), "club_id")
    return all_.unionByName(pr).unionByName(us)


#: Bits of one bitmap, of the words it is read by, and of a byte.
_BITMAP, _WORD, _BYTE = 32_768, 32, 8
ALL_KEY = f"S:{S.STANDARD_LIST_ALL}"
ONLINE_KEY = "O:"


def _no_stores() -> Column:
    return F.array().cast("array<bigint>")


def inline_stores(payload: Column) -> Column:
    """The stores of an inline list as a sorted set; values that are no ids are left out
    (events that hold one fail, see ``bad_values``)."""
    return F.sort_array(F.array_distinct(F.filter(C.long_array(F.coalesce(payload["clubList"], F.array())), lambda c: c.isNotNull())))


def set_key(payload: Column) -> Column:
    """Name of the set of stores a payload stands for: ``S:`` standard list, ``F:`` file,
    ``X:`` all stores but a file's, ``L:`` inline list; NULL for a file payload that says
    neither in nor out, which has no stores."""
    kind = F.lower(F.coalesce(payload["clubType"], F.lit("")))
    url, inside = F.coalesce(payload["clubBigListURL"], F.lit("")), payload["clubInclusion"]
    return (F.when(kind == "standard", F.concat(F.lit("S:"), F.coalesce(payload["bigListName"], F.lit(""))))
            .when(kind == "biglist", F.when(inside, F.concat(F.lit("F:"), url)).when(~inside, F.concat(F.lit("X:"), url)))
            .otherwise(F.concat(F.lit("L:"), F.sha2(F.array_join(inline_stores(payload), ",").cast("binary"), 256))))


def _only_online() -> Column:
    return F.coalesce(F.col("e.payload.channels") == F.array(*[F.lit(c) for c in S.ONLINE_ONLY_CHANNELS]), F.lit(False))


def set_keys() -> Column:
    """The keys of an event's store payloads in order; the online store for an online-only
    event that sent no store payload (F16; a null one is not absent); NULL for the others."""
    payloads = F.col("e.payload.clubDetails.clubsPayload")
    return (F.when(payloads.isNotNull(), F.transform(payloads, set_key))
            .when(F.col("no_stores") & _only_online(), F.array(F.lit(ONLINE_KEY))))


def set_bitmaps(rows: DataFrame) -> DataFrame:
    """(key, bucket, bits) of (key, club_id) rows: one bitmap for 32,768 store ids, built
    map-side, so a list of any length moves as bitmaps."""
    return (rows.filter(F.col("club_id").isNotNull())
            .groupBy("key", F.bitmap_bucket_number("club_id").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("club_id")).alias("bits")))


def _words(bits: Column) -> Column:
    """The 32-bit words of a bitmap, first byte first."""
    return F.transform(F.regexp_extract_all(F.hex(bits), F.lit("(.{8})"), F.lit(1)), lambda w: F.conv(w, 16, 10).cast("bigint"))


def without(bits: Column, other: Column) -> Column:
    """Bitwise difference of two bitmaps; a NULL other takes nothing out."""
    left = F.zip_with(_words(bits), _words(other), lambda x, y: F.lpad(F.hex(x.bitwiseAND(F.bitwise_not(y))), _BYTE, "0"))
    return F.when(other.isNull(), bits).otherwise(F.unhex(F.array_join(left, "")))


def bitmap_stores(bits: Column, bucket: Column) -> Column:
    """The ids of one bitmap's set bits, in no order."""
    words = F.filter(F.transform(_words(bits), lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"] != 0)
    places = F.flatten(F.transform(words, lambda x: F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(_WORD - 1)), lambda k: F.substr(F.lpad(F.bin(x["w"]), _WORD, "0"), k + 1, F.lit(1)) == "1"),
        # The k-th digit from the left is bit 7 - k % 8 of the word's byte k / 8.
        lambda k: x["i"] * _WORD + F.shiftright(k, 3) * _BYTE + (_BYTE - 1) - k % _BYTE)))
    return F.transform(places, lambda p: F.when(bucket > 0, (bucket - 1) * _BITMAP + p + 1).otherwise(bucket * _BITMAP - p))


def store_sets(offer_events: DataFrame, directory: DataFrame, store_rows: DataFrame,
               online_site_id: int = S.ONLINE_SITE_ID) -> DataFrame:
    """(key, clubs): every distinct set that ``offer_events`` name, as a sorted array.
    Sets are bounded by the stores there are; files that no event names are not read."""
    sent = F.explode("e.payload.clubDetails.clubsPayload")
    payloads = offer_events.select(sent.alias("p")).select(set_key(F.col("p")).alias("key"), F.col("p.clubBigListURL").alias("url"),
                                                           inline_stores(F.col("p")).alias("clubs"))
    distinct = payloads.filter(F.col("key").isNotNull()).groupBy("key").agg(F.first("url").alias("url"), F.first("clubs").alias("clubs"))
    distinct = kept(distinct, "store-set-keys")
    kind = F.substring("key", 1, 2)
    named = distinct.filter(kind.isin("F:", "X:")).select(F.coalesce("url", F.lit("")).alias("list_key")).distinct()
    in_files = (store_rows.select("list_key", F.col("c0").try_cast("bigint").alias("club_id")).join(named, "list_key", "left_semi")
                .select(F.concat(F.lit("F:"), "list_key").alias("key"), "club_id"))
    standard = standard_site_lists(active_sites(directory)).select(F.concat(F.lit("S:"), "list_name").alias("key"), "club_id")
    bitmaps = kept(set_bitmaps(in_files.unionByName(standard)), "store-bitmaps")
    wanted = distinct.filter(kind.isin("F:", "S:")).select("key").join(bitmaps, "key")
    out = (distinct.filter(kind == "X:").select("key", F.lit(ALL_KEY).alias("whole"), F.concat(F.lit("F:"), F.coalesce("url", F.lit(""))).alias("out"))
           .join(bitmaps.select(F.col("key").alias("whole"), "bucket", "bits"), "whole")
           .join(bitmaps.select(F.col("key").alias("out"), "bucket", F.col("bits").alias("less")), ["out", "bucket"], "left")
           .select("key", "bucket", without(F.col("bits"), F.col("less")).alias("bits")))
    ids = bitmap_stores(F.col("bits"), F.col("bucket"))
    from_bitmaps = (wanted.unionByName(out).groupBy("key").agg(F.sort_array(F.flatten(F.collect_list(ids))).alias("clubs")))
    listed = distinct.select("key", F.when(kind == "L:", F.col("clubs")).alias("inline"))
    return (listed.join(from_bitmaps, "key", "left").select("key", F.coalesce("inline", "clubs", _no_stores()).alias("clubs"))
            .unionByName(offer_events.sparkSession.createDataFrame([(ONLINE_KEY, [online_site_id])], "key string, clubs array<bigint>")))


def with_set_ids(sets: DataFrame) -> DataFrame:
    """Sets interned by content: ``set_id`` is a digest of the stores, so lists of one
    content, whatever they are called, share it."""
    return sets.withColumn("set_id", _set_id(F.col("clubs")))


def _far(key: Column) -> Column:
    """The set of this key has to be looked up; the others are in the event's own row."""
    return F.coalesce(F.substring(key, 1, 2).isin("S:", "F:", "X:"), F.lit(False))


def _own(payload: Column, key: Column) -> Column:
    """The stores of a payload whose set is in the event's own row: an inline list, or none."""
    return F.when(key.startswith("L:"), inline_stores(payload)).otherwise(_no_stores())


def _payload_keys(offer_events: DataFrame, online_site_id: int) -> DataFrame:
    """(event_id, offer_id, pos, key, clubs) of every payload that names a set; ``clubs`` where
    the event's own row has it."""
    payloads = F.col("e.payload.clubDetails.clubsPayload")
    keys = offer_events.select("event_id", F.col("e.payload.promotionNumber").try_cast("bigint").alias("offer_id"),
                               payloads.alias("sent"), F.posexplode(set_keys()).alias("pos", "key"))
    clubs = (F.when(F.col("key") == ONLINE_KEY, F.array(F.lit(online_site_id).cast("bigint")))
             .when(~_far(F.col("key")), _own(F.get("sent", F.col("pos")), F.col("key"))))
    return keys.filter(F.col("key").isNotNull()).select("event_id", "offer_id", "pos", "key", clubs.alias("clubs"))


def _with_far_sets(offer_events: DataFrame) -> DataFrame:
    """The events that name a set which has to be looked up."""
    return offer_events.filter(F.exists(F.coalesce(set_keys(), F.array().cast("array<string>")), _far))


def _set_id(clubs: Column) -> Column:
    return F.sha2(F.array_join(clubs, ",").cast("binary"), 256)


def event_sets(offer_events: DataFrame, directory: DataFrame, store_rows: DataFrame,
               online_site_id: int = S.ONLINE_SITE_ID) -> tuple[DataFrame, DataFrame]:
    """((event_id, offer_id, pos, set_id, n_clubs), (set_id, club_id)): which set each store
    payload is, and the stores of each set, instead of a row for each event and store.  Only
    the sets of files and standard lists are looked up, an inline list names itself."""
    sets = kept(with_set_ids(store_sets(_with_far_sets(offer_events), directory, store_rows, online_site_id)), "store-sets")
    keys = _payload_keys(offer_events, online_site_id)
    cols = ["event_id", "offer_id", "pos", "set_id", "n_clubs"]
    own = keys.filter(F.col("clubs").isNotNull()).withColumn("set_id", _set_id(F.col("clubs")))
    far = keys.filter(F.col("clubs").isNull()).select("event_id", "offer_id", "pos", "key").join(
        sets.select("key", "set_id", F.size("clubs").alias("n_clubs")), "key").select(*cols)
    rows = own.withColumn("n_clubs", F.size("clubs")).select(*cols).unionByName(far)
    named = sets.filter(_far(F.col("key"))).select("set_id", "clubs")
    stores = (own.select("set_id", "clubs").unionByName(named).groupBy("set_id").agg(F.first("clubs").alias("clubs"))
              .select("set_id", F.explode("clubs").alias("club_id")))
    return rows, stores


def resolve_sites(offer_events: DataFrame, directory: DataFrame, store_rows: DataFrame,
                  online_site_id: int = S.ONLINE_SITE_ID) -> DataFrame:
    """(event_id, offer_id, club_id) for every store the offer applies to (C7).  A payload
    meets its whole set as one array, and the array is written out last: what is joined and
    moved is one row a payload, however many stores its set has."""
    keys = _payload_keys(offer_events, online_site_id)
    sets = kept(store_sets(_with_far_sets(offer_events), directory, store_rows, online_site_id), "store-sets")
    far = keys.filter(F.col("clubs").isNull()).select("event_id", "offer_id", "key").join(
        sets.filter(_far(F.col("key"))), "key")
    cols = ["event_id", "offer_id", F.explode("clubs").alias("club_id")]
    return keys.filter(F.col("clubs").isNotNull()).select(*cols).unionByName(far.select(*cols))


def complement_site_list(offer_events: DataFrame, directory: DataFrame, store_rows: DataFrame) -> DataFrame:
    """(event_id, offer_id, club_id) of exclusion payloads (J4): all active stores minus the
    listed ones, a difference of bitmaps."""
    keys = offer_events.select("event_id", F.col("e.payload.promotionNumber").try_cast("bigint").alias("offer_id"),
                               F.explode(set_keys()).alias("key")).filter(F.col("key").startswith("X:"))
    sets = kept(store_sets(_with_far_sets(offer_events), directory, store_rows).filter(F.col("key").startswith("X:")), "store-sets")
    return keys.join(sets, "key").select("event_id", "offer_id", F.explode("clubs").alias("club_id"))


def club_combinations(offer_events: DataFrame, directory: DataFrame, store_rows: DataFrame,
                      online_site_id: int = S.ONLINE_SITE_ID) -> tuple[DataFrame, DataFrame]:
    """(events, lists): events with ``club_list`` where their own row has it and ``combination``,
    the key of their list, where it has to be looked up; ``lists`` (combination, club_list) is
    kept, each distinct combination of sets put together once."""
    payloads = F.col("e.payload.clubDetails.clubsPayload")
    events = offer_events.withColumn("set_keys", set_keys())
    only_own = ~F.exists("set_keys", _far)
    own = (F.when(payloads.isNotNull(), F.sort_array(F.flatten(F.transform(payloads, lambda p: _own(p, set_key(p))))))
           .otherwise(F.array(F.lit(online_site_id).cast("bigint"))))
    events = events.withColumns({"club_list": F.when(only_own, own), "combination": F.when(~only_own, F.to_json("set_keys"))})
    sets = store_sets(_with_far_sets(offer_events), directory, store_rows, online_site_id)
    combos = events.filter(F.col("combination").isNotNull()).select("combination", "set_keys").dropDuplicates(["combination"])
    parts = combos.select("combination", F.explode_outer("set_keys").alias("key")).join(sets, "key", "left")
    lists = kept(parts.groupBy("combination").agg(
        F.sort_array(F.flatten(F.collect_list(F.coalesce("clubs", _no_stores())))).alias("club_list")), "club-lists")
    return events.drop("set_keys"), lists


def as_text(rows: DataFrame) -> DataFrame:
    """``club_list`` as text.  Done to the lists and to the rows that have their own before
    they meet, the text of a list is made once, not once a row."""
    return rows.withColumn("club_list", F.array_join("club_list", ","))


def attach_club_lists(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """``club_list`` of the rows with a ``combination`` from ``lists``.  Rows with many stores
    are wide, so this is the last step that moves rows; those that have their list already get
    a key of their own, so that they are spread over the tasks, and sorted behind the others:
    a Parquet writer decides by the first rows whether a dictionary is worth it."""
    named = F.col("combination").isNotNull()
    own = F.concat(F.lit("~"), F.xxhash64("event_id" if "event_id" in rows.columns else "offer_id").cast("string"))
    keyed = rows.withColumn("_by", F.when(named, F.col("combination")).otherwise(own))
    found = keyed.join(lists.select(F.col("combination").alias("_by"), F.col("club_list").alias("_clubs")), "_by", "left")
    return found.withColumn("club_list", F.when(named, F.col("_clubs")).otherwise(F.col("club_list"))).drop("_by", "_clubs", "combination")


def with_club_lists(offer_events: DataFrame, directory: DataFrame, store_rows: DataFrame,
                    online_site_id: int = S.ONLINE_SITE_ID) -> DataFrame:
    """Events with ``club_list``: the stores of their payloads, concatenated and sorted; NULL
    for events with neither store payload nor the online default."""
    return attach_club_lists(*club_combinations(offer_events, directory, store_rows, online_site_id))


def bad_store_ids() -> Column:
    """An inline store list holds a value that is no id."""
    def bad(p):
        inline = ~F.lower(F.coalesce(p["clubType"], F.lit(""))).isin("standard", "biglist")
        return inline & F.exists(F.coalesce(p["clubList"], F.array()), lambda c: c.try_cast("bigint").isNull())
    return F.coalesce(F.exists("e.payload.clubDetails.clubsPayload", bad), F.lit(False))


def store_files_named(offer_events: DataFrame) -> DataFrame:
    """(event_id, list_key) of the store files events name."""
    x = offer_events.select("event_id", F.explode("e.payload.clubDetails.clubsPayload").alias("p"))
    return (x.filter(F.lower(F.coalesce("p.clubType", F.lit(""))) == "biglist")
            .select("event_id", F.col("p.clubBigListURL").alias("list_key")))


def site_overrides(offer_events: DataFrame) -> DataFrame:
    """Store-specific date overrides (C6): (event_id, club_number, start, end, zone, offer_id).

    Times that do not look like a time of day fall back to the start / end of the day;
    values that still do not parse give NULL.  No store details means no rows.
    """
    p = "e.payload"
    x = offer_events.select(
        "event_id", F.col(f"{p}.promotionNumber").try_cast("bigint").alias("offer_id"),
        F.explode(f"{p}.clubDetails.clubOverride").alias("o"))
    start = C.date_and_time(F.col("o.startDate"), C.time_or_default(F.col("o.startTime"), S.DEFAULT_START_TIME))
    end = C.date_and_time(F.col("o.endDate"), C.time_or_default(F.col("o.endTime"), S.DEFAULT_END_TIME))
    return x.select("event_id", F.col("o.clubNumber").try_cast("bigint").alias("club_number"),
                    C.parse_ts(start).alias("start_datetime"), C.parse_ts(end).alias("end_datetime"),
                    F.col("o.timeZone").alias("time_zone"), "offer_id")
