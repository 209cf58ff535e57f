"""Event intake: raw JSON text -> decoded events.

A batch (or micro-batch) of events is a DataFrame with at least ``event_id``, ``arrival``
(the order events were received in) and ``raw`` (the JSON text).  Each text is parsed once,
to a VARIANT; the fixed event schema, key presence, JSON nulls and wrong types are all read
from that value, and what the operators need is kept as one table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promoflow import settings as S
from promoflow.functions.columns import those_said
from promoflow.operators.joins import kept
from promoflow.schemas import EVENT_ENVELOPE

KIND_LIST = "list"
KIND_OFFER = "offer"

NOT_AN_OBJECT = "not one JSON object"
NO_EVENT_ID = "no event id"

#: Optional parts of an offer event whose type is checked as sent.
TYPED_PARTS = ("payload.awardList", "payload.memberDetails", "payload.memberDetails.membersPayload", "payload.itemDetails",
               "payload.itemDetails.itemsPayload", "payload.clubDetails", "payload.clubDetails.clubsPayload")
#: Parts that may be absent but not null: what reads them takes presence for a value.
STORE_PARTS = ("payload.clubDetails", "payload.clubDetails.clubsPayload")


def _is_container(v: Column) -> Column:
    return F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)")


def parse_events(raw_events: DataFrame, keep_raw: bool = True) -> DataFrame:
    """Every row with ``dead`` (why it is no event, else NULL) and, for events, ``kind``
    (``list`` when the ``offerIdList`` key is present, else ``offer``), ``e`` (the envelope),
    ``has_members`` (the key is there), ``one_member`` (the member count is the number 1, as
    sent), ``wrong`` (parts of the wrong type), ``nulls`` (store parts sent as null) and
    ``no_stores`` (no store payload sent).  Without ``keep_raw`` only dead letters keep
    their text.

    The text is parsed inside an array and before a mark of its own, as a parser alone stops
    after the first value: whatever follows the object breaks the syntax or moves the mark.
    A part that is in the envelope was sent and has its type, so only the others are looked for
    in the parsed text, each of which is a copy of that part: the conditions stand in branches
    of ``when``, which are not evaluated ahead.
    """
    mark = F.xxhash64("raw")
    parsed = raw_events.withColumn("v", F.try_parse_json(
        F.concat(F.lit("["), F.col("raw"), F.lit(","), mark.cast("string"), F.lit("]"))))
    at = lambda path, kind="variant": F.try_variant_get("v", f"$[0].{path}", kind)
    whole = F.when(F.try_variant_get("v", "$[1]", "bigint") == mark,
                   F.try_variant_get("v", "$[0]", EVENT_ENVELOPE.simpleString()))
    x = parsed.withColumn("e", whole)
    here = lambda path: F.col(f"e.{path}").isNotNull()
    sent = lambda path: F.when(here(path), True).otherwise(at(path).isNotNull())
    sent_null = lambda path: F.when(here(path), False).otherwise(F.coalesce(F.is_variant_null(at(path)), F.lit(False)))
    mistyped = lambda path: F.when(here(path), False).otherwise(at(path).isNotNull() & ~F.coalesce(F.is_variant_null(at(path)), F.lit(False)))
    refs = at("payload.awardList", "array<struct<awardType:string,itemRefId:variant>>")

    def odd_refs(a):
        """References that may be bad: none in the envelope, or one that is null there or was no plain value."""
        odd = F.exists(a["itemRefId"], lambda i: i.isNull() | i.startswith("{") | i.startswith("["))
        return (a["awardType"] == F.lit(S.AWARD_TYPE_KEPT)) & (a["itemRefId"].isNull() | odd)

    def bad_refs(a):
        r = a["itemRefId"]
        items = F.try_variant_get(r, "$", "array<variant>")
        odd = items.isNull() | F.exists(items, lambda i: F.is_variant_null(i) | _is_container(i))
        return (a["awardType"] == F.lit(S.AWARD_TYPE_KEPT)) & r.isNotNull() & ~F.is_variant_null(r) & odd

    count = at("payload.memberDetails.memberListCount")
    is_number = F.schema_of_variant(count).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)")
    is_object, has_id = F.col("e").isNotNull(), F.col("event_id").isNotNull()
    return x.select(
        *[F.col(c) for c in raw_events.columns if c != "raw"],
        (F.col("raw") if keep_raw else F.when(~(is_object & has_id), F.col("raw"))).alias("raw"),
        F.when(~is_object, NOT_AN_OBJECT).when(~has_id, NO_EVENT_ID).alias("dead"), "e",
        F.when(sent("offerIdList"), KIND_LIST).otherwise(KIND_OFFER).alias("kind"),
        sent("payload.memberDetails").alias("has_members"),
        F.coalesce(is_number & (F.try_variant_get(count, "$", "double") == 1.0), F.lit(False)).alias("one_member"),
        those_said(*[F.when(mistyped(p), p) for p in TYPED_PARTS], F.when(
            F.exists("e.payload.awardList", odd_refs), F.when(F.exists(refs, bad_refs), "payload.awardList.itemRefId"))).alias("wrong"),
        those_said(*[F.when(sent_null(p), p) for p in STORE_PARTS]).alias("nulls"),
        (~sent(STORE_PARTS[1]) & ~sent_null(STORE_PARTS[0])).alias("no_stores"))


def decode_events(raw_events: DataFrame, keep_raw: bool = True,
                  judge: Callable[[DataFrame], DataFrame] = lambda parsed: parsed) -> tuple[DataFrame, DataFrame]:
    """Split a batch into decoded events and dead letters (with ``dead``, the reason).

    Dead letters are texts that are not one JSON object (malformed, empty, a bare value, an
    array, or an object with anything after it) and rows without an event id: neither can be
    audited, and both are only reported.  The parsed batch is kept, so it is parsed once, and
    what ``judge`` adds to it is kept along, so that is found once as well.
    """
    parsed = kept(judge(parse_events(raw_events, keep_raw)), "parsed")
    good = parsed.filter(F.col("dead").isNull()).drop("dead")
    bad = parsed.filter(F.col("dead").isNotNull()).select(*raw_events.columns, "dead")
    return good, bad


def route_event_kind(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(offer events, member-list events) of a decoded batch."""
    return (decoded.filter(F.col("kind") == KIND_OFFER),
            decoded.filter(F.col("kind") == KIND_LIST))


def list_event_rows(list_events: DataFrame) -> DataFrame:
    """Member-list events as (event_id, arrival, offer_ids, location)."""
    return list_events.select("event_id", "arrival",
                              F.col("e.offerIdList").alias("offer_ids"),
                              F.col("e.memberBigListLocation").alias("location"))


def first_offer_id(decoded: DataFrame) -> DataFrame:
    """The offer id an event is audited under: the first listed id or the promotion number."""
    return decoded.withColumn(
        "oid", F.when(F.col("kind") == KIND_LIST, F.coalesce(F.get(F.col("e.offerIdList"), 0), F.lit("")))
        .otherwise(F.coalesce(F.col("e.payload.promotionNumber"), F.lit(""))))


# -- S1: the event stream -----------------------------------------------------------
RAW_EVENT_FILE = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("arrival", T.TimestampType()),
    T.StructField("raw", T.StringType()),
])


def read_events_stream(spark: SparkSession, path: str, schema: T.StructType = RAW_EVENT_FILE,
                       fmt: str = "parquet", glob: str | None = None,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming source of raw events landed as files by the broker connector.

    The offset log of the checkpoint replaces the broker acknowledgement: a micro-batch is
    committed only after its sink finished, so a failure re-delivers it (at least once).
    Run with ``trigger(availableNow=True)`` to drain what is there and stop, as the pull
    loop that stops when idle did.
    """
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)
