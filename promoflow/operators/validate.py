"""Event validation as column rules.

Each rule is a boolean column that is true when the event breaks it; ``errors`` is the
array of the codes of broken rules, in rule order.  Arrays of structs are checked with
``exists``; integer fields are "present but not an integer" when the raw text is there
and ``try_cast`` gives NULL, like a coercing validator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promoflow import settings as S
from promoflow.functions.columns import blank, those_said
from promoflow.settings import DEFAULT_CONFIG, EngineConfig

REQUIRED_TEXT = ("eventTimeStamp", "status", "promotionNumber", "startDate", "endDate",
                 "startTime", "endTime", "timeZone")
REQUIRED_LISTS = ("channels", "labels", "membershipType")


def _not_int(c: Column) -> Column:
    return c.try_cast("int").isNull()


def _empty(arr: Column) -> Column:
    return F.coalesce(F.size(arr), F.lit(0)) <= 0


def _wrong_type(path: str) -> Column:
    """The event has a value there, other than null, of another type."""
    return F.array_contains("wrong", path)


def offer_rules(cfg: EngineConfig = DEFAULT_CONFIG) -> list[tuple[str, Column]]:
    """(code, violated) for an offer event; ``awards`` holds the trimmed award list."""
    p = "e.payload"
    col = lambda name: F.col(f"{p}.{name}")
    rules: list[tuple[str, Column]] = []
    for f in REQUIRED_TEXT:
        bad = blank(col(f))
        if f == "promotionNumber":  # the offer's key: an id that is no integer names no offer
            bad = bad | col(f).try_cast("bigint").isNull()
        rules.append((f"V1:{f}", bad))
    for f in REQUIRED_LISTS:
        rules.append((f"V2:{f}", col(f).isNull() | F.coalesce(F.exists(col(f), lambda x: x.isNull()), F.lit(False))))
    rules.append(("V3", ~F.coalesce(col("status").isin(*cfg.offer_statuses), F.lit(False))))
    rules.append(("V4", F.coalesce(F.array_contains(col("labels"), S.LABEL_TETRIS)
                                   & F.array_contains(col("labels"), S.LABEL_TIO), F.lit(False))))
    awards = F.col("awards")
    rules.append(("V5", _wrong_type("payload.awardList") | _wrong_type("payload.awardList.itemRefId") | F.coalesce(F.exists(awards, lambda a: blank(a["awardType"]) | blank(a["value"])
                                            | blank(a["discountMethod"])), F.lit(False))))
    rules.append(("V6", F.coalesce(F.exists(
        awards, lambda a: (a["awardType"] == F.lit(cfg.item_discount_award))
        & ~F.coalesce(a["discountMethod"].isin(*cfg.discount_methods), F.lit(False))), F.lit(False))))

    md = col("memberDetails")
    rules.append(("V7", _wrong_type("payload.memberDetails.membersPayload") | md.isNotNull() & F.coalesce(F.exists(
        col("memberDetails.membersPayload"),
        lambda m: ~F.coalesce(m["memberType"].isin(*S.MEMBER_TYPES), F.lit(False))
        | m["memberList"].isNull() | m["memberBigListURL"].isNull()
        | ((m["memberType"] == "list") & _empty(m["memberList"]))
        | ((m["memberType"] == "biglist") & blank(m["memberBigListURL"]))), F.lit(False))))
    rules.append(("V8", _wrong_type("payload.memberDetails") | md.isNotNull() & _not_int(col("memberDetails.memberListCount"))))

    idt = col("itemDetails")
    rules.append(("V9", _wrong_type("payload.itemDetails.itemsPayload") | idt.isNotNull() & F.coalesce(F.exists(
        col("itemDetails.itemsPayload"),
        lambda i: i["itemType"].isNull()
        | ~F.coalesce(i["itemListType"].isin(*S.ITEM_LIST_TYPES), F.lit(False))
        | i["itemList"].isNull() | _not_int(i["refId"])
        | ((i["itemListType"] == "list") & _empty(i["itemList"]))
        | ((i["itemListType"] == "biglist") & blank(i["itemBigListURL"]))), F.lit(False))))
    rules.append(("V10", _wrong_type("payload.itemDetails") | idt.isNotNull() & _not_int(col("itemDetails.itemListCount"))))

    cd = col("clubDetails")
    rules.append(("V11", _wrong_type("payload.clubDetails.clubsPayload") | cd.isNotNull() & F.coalesce(F.exists(
        col("clubDetails.clubsPayload"),
        lambda c: ~F.coalesce(c["clubType"].isin(*S.CLUB_TYPES), F.lit(False))
        | c["bigListName"].isNull() | c["clubInclusion"].isNull() | c["clubList"].isNull()
        | ((c["clubType"] == "list") & _empty(c["clubList"]))
        | ((c["clubType"] == "biglist") & blank(c["clubBigListURL"]))
        | ((c["clubType"] == "Standard") & ~F.coalesce(c["bigListName"].isin(
            S.STANDARD_LIST_ALL, S.STANDARD_LIST_PR_ONLY, S.STANDARD_LIST_US_EXCLUDING_PR), F.lit(False)))),
        F.lit(False))))
    rules.append(("V12", _wrong_type("payload.clubDetails") | cd.isNotNull() & _not_int(col("clubDetails.clubListCount"))))
    return rules


def list_rules() -> list[tuple[str, Column]]:
    ids = F.col("e.offerIdList")
    return [("V13", ids.isNull() | F.col("e.memberBigListLocation").isNull()
             | F.coalesce(F.exists(ids, lambda x: x.try_cast("bigint").isNull()), F.lit(False)))]


def _errors(rules: list[tuple[str, Column]]) -> Column:
    return those_said(*[F.when(v, F.lit(code)) for code, v in rules])


def offer_errors(cfg: EngineConfig = DEFAULT_CONFIG) -> Column:
    """Codes of the rules that an offer event with trimmed ``awards`` breaks."""
    return _errors(offer_rules(cfg))


def list_errors() -> Column:
    """Codes of the rules that a member-list event breaks."""
    return _errors(list_rules())


def validate_offers(offer_events: DataFrame, cfg: EngineConfig = DEFAULT_CONFIG) -> DataFrame:
    """Add ``errors`` (array of broken rule codes) to trimmed offer events."""
    return offer_events.withColumn("errors", offer_errors(cfg))


def validate_lists(list_events: DataFrame) -> DataFrame:
    """Add ``errors`` to member-list events."""
    return list_events.withColumn("errors", list_errors())


def error_rows(validated: DataFrame) -> DataFrame:
    """One row per (event, broken rule)."""
    return validated.select("event_id", F.explode("errors").alias("rule"))
