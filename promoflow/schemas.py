"""Wire and table schemas.

The wire schema reads every integer-like field of an event as text (counts, ``refId``,
``itemRefId``, ``offerIdList``) so that a value sent as ``"5"`` or ``5`` decodes alike and
the validator decides with ``try_cast`` whether it is an integer, the way a coercing
per-row validator would.  All fields are nullable: an absent key and a JSON ``null`` both
decode to NULL; presence tests use the key list of the raw text instead.  Only fields that
an operator reads are listed.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
B = T.BooleanType()


def _arr(t):
    return T.ArrayType(t, True)


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


AWARD = _struct(
    ("awardType", S), ("value", S), ("discountMethod", S), ("itemRefId", _arr(S)),
)

ITEM_PAYLOAD = _struct(
    ("itemType", S), ("itemListType", S), ("itemList", _arr(S)),
    ("itemBigListURL", S), ("refId", S),
)

CLUB_PAYLOAD = _struct(
    ("clubType", S), ("bigListName", S), ("clubList", _arr(S)), ("clubBigListURL", S),
    ("clubInclusion", B),
)

CLUB_OVERRIDE = _struct(
    ("clubNumber", S), ("startDate", S), ("startTime", S), ("endDate", S), ("endTime", S),
    ("timeZone", S),
)

MEMBER_PAYLOAD = _struct(
    ("memberType", S), ("memberList", _arr(S)), ("memberBigListURL", S),
)

PAYLOAD = _struct(
    ("eventTimeStamp", S), ("status", S), ("promotionNumber", S),
    ("startDate", S), ("endDate", S), ("startTime", S), ("endTime", S), ("timeZone", S),
    ("channels", _arr(S)), ("labels", _arr(S)),
    ("awardList", _arr(AWARD)),
    ("itemDetails", _struct(("itemListCount", S), ("itemsPayload", _arr(ITEM_PAYLOAD)))),
    ("clubDetails", _struct(("clubListCount", S), ("clubsPayload", _arr(CLUB_PAYLOAD)),
                            ("clubOverride", _arr(CLUB_OVERRIDE)))),
    ("memberDetails", _struct(("memberListCount", S), ("membersPayload", _arr(MEMBER_PAYLOAD)))),
    ("membershipType", _arr(S)),
)

# One schema decodes both event kinds; the kind is decided by key presence.
EVENT_ENVELOPE = _struct(
    ("payload", PAYLOAD),
    ("offerIdList", _arr(S)),
    ("memberBigListLocation", S),
)

# Stored tables ------------------------------------------------------------
OFFERS = T.StructType([
    T.StructField("offer_id", T.LongType()),
    T.StructField("status", S),
    T.StructField("start_datetime", T.TimestampNTZType()),
    T.StructField("end_datetime", T.TimestampNTZType()),
    T.StructField("event_timestamp", T.TimestampNTZType()),
    T.StructField("time_zone", S),
    T.StructField("offer_source", S),
    T.StructField("discount_type", S),
    T.StructField("discount_value", T.DoubleType()),
    T.StructField("applicable_channel", _arr(S)),
    T.StructField("club_list", _arr(T.LongType())),
    T.StructField("member_list_location", S),
    T.StructField("membership_type", _arr(S)),
    T.StructField("item_list_location", S),
    T.StructField("labels", _arr(S)),
    T.StructField("offer_set_id", S),
    T.StructField("campaign_id", T.LongType()),
    T.StructField("campaign_name", S),
    T.StructField("member_list_name", S),
])

OFFER_ITEMS = T.StructType([
    T.StructField("item_number", T.LongType()),
    T.StructField("item_type", S),
    T.StructField("offer_id", T.LongType()),
    T.StructField("product_id", S),
])

SITE_OVERRIDES = T.StructType([
    T.StructField("club_number", T.LongType()),
    T.StructField("start_datetime", T.TimestampNTZType()),
    T.StructField("end_datetime", T.TimestampNTZType()),
    T.StructField("time_zone", S),
    T.StructField("offer_id", T.LongType()),
])

MEMBER_OFFERS = T.StructType([
    T.StructField("offer_id", T.LongType()),
    T.StructField("membership_uuid", S),
    T.StructField("membership_id", S),
    T.StructField("propensity", T.DoubleType()),
])

# Serving views: a member's offers, and an offer's items by chunk.
MEMBER_VIEW = T.StructType([
    T.StructField("membership_uuid", S),
    T.StructField("offer_ids", _arr(T.LongType())),
])

OFFER_VIEW_ITEMS = T.StructType([
    T.StructField("offer_id", T.LongType()),
    T.StructField("item_type", S),
    T.StructField("chunk", S),
    T.StructField("items", _arr(T.LongType())),
])
