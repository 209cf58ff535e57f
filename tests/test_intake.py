"""Intake cases: decode, gates, trim, validation (FIXTURES intake-01..11)."""

from conftest import base_payload, offer, raw_df

from promoflow import settings as S
from promoflow.plans.intake import run_intake


def outcome(spark, items):
    it = run_intake(raw_df(spark, items))
    return {r["event_id"]: (r["status"], r["reason"]) for r in it.outcomes.collect()}, it


def test_not_json_is_dead_letter_without_audit(spark):
    out, it = outcome(spark, [("a", "not json"), ("b", "[1,2]"), ("c", offer(base_payload()))])
    assert sorted(r["event_id"] for r in it.dead_letters.collect()) == ["a", "b"]
    assert set(out) == {"c"}


def test_personalised_without_members_is_skipped(spark):
    out, _ = outcome(spark, [("e", offer(base_payload(labels=["tetris"])))])
    assert out["e"] == ("SKIPPED", S.REASON_MISSING_MEMBERS)


def test_default_source_without_members_goes_on(spark):
    out, _ = outcome(spark, [("e", offer(base_payload()))])
    assert out["e"] == ("PROCESSING", None)


def test_member_list_count_two_is_skipped(spark):
    md = {"memberListCount": 2, "membersPayload": [{"memberType": "biglist", "memberList": [],
                                                     "memberBigListURL": "m.csv"}]}
    out, _ = outcome(spark, [("e", offer(base_payload(memberDetails=md)))])
    assert out["e"] == ("SKIPPED", S.REASON_MEMBER_LIST_COUNT)


def test_gate_order_member_count_before_labels(spark):
    md = {"memberListCount": 2, "membersPayload": []}
    out, _ = outcome(spark, [("e", offer(base_payload(memberDetails=md, labels=["JOIN"])))])
    assert out["e"] == ("SKIPPED", S.REASON_MEMBER_LIST_COUNT)


def test_blocked_label_is_skipped(spark):
    out, _ = outcome(spark, [("e", offer(base_payload(labels=["weekly", "RENEW"])))])
    assert out["e"] == ("SKIPPED", S.REASON_BLOCKED_LABEL)


def test_trim_keeps_every_wanted_award(spark):
    aw = [{"awardType": "X", "value": "1", "discountMethod": "DOLLAR_OFF"},
          {"awardType": "X", "value": "1", "discountMethod": "DOLLAR_OFF"},
          {"awardType": "DISCOUNT_ITEM_PRICE", "value": "5", "discountMethod": "DOLLAR_OFF", "itemRefId": ["1"]}]
    out, it = outcome(spark, [("e", offer(base_payload(awardList=aw)))])
    assert out["e"][0] == "PROCESSING"
    assert it.offers.select("awards").first()[0][0]["value"] == "5"
    assert len(it.offers.select("awards").first()[0]) == 1


def test_no_wanted_award_is_skipped(spark):
    aw = [{"awardType": "X", "value": "1", "discountMethod": "DOLLAR_OFF"}] * 2
    out, _ = outcome(spark, [("e", offer(base_payload(awardList=aw)))])
    assert out["e"] == ("SKIPPED", S.REASON_NO_AWARD)


def test_draft_status_fails(spark):
    out, _ = outcome(spark, [("e", offer(base_payload(status="DRAFT")))])
    assert out["e"] == ("FAILED", "V3")


def test_empty_lists_fail_each_rule(spark):
    md = {"memberListCount": 1, "membersPayload": [{"memberType": "list", "memberList": [],
                                                     "memberBigListURL": ""}]}
    idt = {"itemListCount": 1, "itemsPayload": [{"itemType": "DISCOUNTED_ITEMS", "itemListType": "list",
                                                 "itemList": [], "refId": 1}]}
    cd = {"clubListCount": 1, "clubsPayload": [{"clubType": "list", "bigListName": "x", "clubList": [],
                                                "clubInclusion": True}]}
    out, _ = outcome(spark, [("e", offer(base_payload(memberDetails=md, itemDetails=idt, clubDetails=cd)))])
    assert out["e"] == ("FAILED", "V7; V9; V11")


def test_both_personalised_labels_fail(spark):
    md = {"memberListCount": 1, "membersPayload": []}
    out, _ = outcome(spark, [("e", offer(base_payload(labels=["tetris", "tio"], memberDetails=md)))])
    assert out["e"] == ("FAILED", "V4")


def test_missing_required_text_and_bad_count(spark):
    idt = {"itemListCount": "many", "itemsPayload": []}
    out, _ = outcome(spark, [("e", offer(base_payload(timeZone=..., endTime="", itemDetails=idt)))])
    assert out["e"] == ("FAILED", "V1:endTime; V1:timeZone; V10")


def test_list_event_text_ids_are_accepted(spark):
    out, _ = outcome(spark, [("l", {"offerIdList": ["5", 6], "memberBigListLocation": "m.csv"}),
                             ("m", {"offerIdList": ["x"], "memberBigListLocation": "m.csv"})])
    assert out["l"] == ("PROCESSING", None)
    assert out["m"] == ("FAILED", "V13")


def award(refs):
    return [{"awardType": "DISCOUNT_ITEM_PRICE", "value": "5", "discountMethod": "DOLLAR_OFF", "itemRefId": refs}]


def test_item_references_of_a_wrong_type_fail(spark):
    cases = {"text": "1", "object": {"a": 1}, "in": [{"a": 1}], "null in": [None], "fine": ["1", 2], "null": None, "none": []}
    out, _ = outcome(spark, [(k, offer(base_payload(awardList=award(v)))) for k, v in cases.items()])
    assert {k for k, v in out.items() if v == ("FAILED", "V5")} == {"text", "object", "in", "null in"}
    assert {k for k, v in out.items() if v[0] == "PROCESSING"} == {"fine", "null", "none"}


def test_events_without_an_id_are_dead_letters_and_repeated_keys_take_the_last(spark):
    out, it = outcome(spark, [(None, offer(base_payload())), (None, offer(base_payload())), (None, "junk"),
                              ("twice", '{"offerIdList": ["x"], "offerIdList": [1], "memberBigListLocation": "m"}')])
    assert out == {"twice": ("PROCESSING", None)}
    assert sorted(r["dead"] for r in it.dead_letters.collect()) == ["no event id", "no event id", "not one JSON object"]
    assert all(r["raw"] for r in it.dead_letters.collect())


def test_the_text_is_parsed_once(spark):
    from promoflow.sources.events import parse_events
    df = raw_df(spark, [("a", offer(base_payload()))])
    plan = parse_events(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") + plan.count("try_parse_json") <= 1, plan
    assert "from_json" not in plan and "get_json_object" not in plan and "json_object_keys" not in plan
