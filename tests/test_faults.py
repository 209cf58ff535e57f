"""Events and stores that are damaged, incomplete or tied must lose nothing."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import T0, base_payload, offer, raw_df
from promoflow import settings as S
from promoflow.operators.audit import current_status, failure_report
from promoflow.plans.audit_batch import audit_rows, failures, list_event_outcomes
from promoflow.plans.intake import run_intake
from promoflow.plans.list_batch import plan_list_batch
from promoflow.plans.offer_batch import plan_offer_batch
from promoflow.schemas import OFFER_ITEMS, OFFERS, SITE_OVERRIDES
from promoflow.sources.events import decode_events
from promoflow.streaming.apply_stream import Lookups, Stored, apply_sink
from test_audience import CARDS, _ev, cards
from test_offers import catalogue, directory, empty, ready, rows


def member(count=1):
    return {"memberListCount": count, "membersPayload": [
        {"memberType": "biglist", "memberList": [], "memberBigListURL": "m.csv"}]}


@pytest.mark.parametrize("raw, is_event", [
    ('{"a":1}', True), (' {"a":1} \n', True), ("{}", True), ('{"a":1} trailing', False), ('{"a":1}{', False),
    ('{"a":1}]', False), ('{"a":1}] }', False), ('{"a":1}}', False), ('{"a":1},{"b":2}', False), ("[1]", False),
    ('"x"', False), ("", False), ('{"a":', False), (None, False)])
def test_only_one_whole_object_is_an_event(spark, raw, is_event):
    df = spark.createDataFrame([("e", T0, raw)], "event_id string, arrival timestamp, raw string")
    good, bad = decode_events(df)
    assert (good.count(), bad.count()) == (int(is_event), int(not is_event))


@pytest.mark.parametrize("change, rule", [
    ({"itemDetails": "oops"}, "V10"), ({"clubDetails": [1, 2]}, "V12"), ({"labels": [None]}, "V2:labels"),
    ({"promotionNumber": "abc"}, "V1:promotionNumber"), ({"itemDetails": {"itemListCount": 1, "itemsPayload": "x"}}, "V9"),
    ({"clubDetails": {"clubListCount": 1, "clubsPayload": {"a": 1}}}, "V11"),
    ({"itemDetails": {"itemListCount": "many", "itemsPayload": []}}, "V10")])
def test_parts_of_the_wrong_type_fail_the_event(spark, change, rule):
    it = run_intake(raw_df(spark, [("e", offer(base_payload(**change)))]))
    r = it.outcomes.first()
    assert r["status"] == "FAILED" and rule in r["reason"].split("; ") and r["failure_class"] == S.CLASS_PAYLOAD


@pytest.mark.parametrize("count, status", [(1, "PROCESSING"), ("1", "SKIPPED"), (2, "SKIPPED"), (None, "SKIPPED")])
def test_the_member_count_is_compared_as_sent(spark, count, status):
    it = run_intake(raw_df(spark, [("e", offer(base_payload(labels=["tio"], memberDetails=member(count))))]))
    assert it.outcomes.first()["status"] == status


def lists(spark, events, offers, stored, files, available=None):
    good, _ = decode_events(raw_df(spark, events))
    return plan_list_batch(
        good, spark.createDataFrame(offers, "offer_id bigint, offer_source string, member_list_location string"),
        spark.createDataFrame(stored, "offer_id bigint, membership_uuid string, membership_id string, propensity double"),
        spark.createDataFrame(files, "list_key string, c0 string, c1 string"), cards(spark, CARDS),
        available_lists=None if available is None else spark.createDataFrame([(k,) for k in available], "list_key string"))


def test_an_empty_id_list_ends_failed(spark):
    b = lists(spark, [("e", _ev([], "n.csv"))], [(1, "TIO", "o.csv")], [(1, "ua", "a", None)], [("n.csv", "b", None)])
    assert tuple(list_event_outcomes(b.looked).first()) == ("e", "FAILED", S.REASON_NO_OFFERS, S.CLASS_OTHER)
    assert [r["membership_uuid"] for r in b.member_offers.collect()] == ["ua"]


def test_one_file_read_for_two_sources(spark):
    files = [("l.csv", c, p) for c, p in zip([c for c, _ in CARDS], ["0.2", "0.9", "0.5", "0.4", "0.3", "0.1"])]
    one = {}
    for source in ("TIO", "TETRIS"):
        b = lists(spark, [("e", _ev([1], "l.csv"))], [(1, source, None)], [], files)
        one[source] = sorted(tuple(r)[1:] for r in b.member_offers.collect())
    both = lists(spark, [("e1", _ev([1], "l.csv")), ("e2", _ev([2], "l.csv"))], [(1, "TIO", None), (2, "TETRIS", None)], [], files)
    got = {o: sorted(tuple(r)[1:] for r in both.member_offers.filter(F.col("offer_id") == o).collect()) for o in (1, 2)}
    assert got == {1: one["TIO"], 2: one["TETRIS"]}
    assert all(p is None for _, _, p in got[1]) and all(p is not None for _, _, p in got[2])


def test_a_failed_event_fixes_no_source(spark):
    gone = {"itemListCount": 1, "itemsPayload": [{"itemType": "ELIGIBLE_ITEMS", "itemListType": "biglist", "itemList": [],
                                                  "itemBigListURL": "gone.csv", "refId": 1}]}
    tio = {"labels": ["tio"], "memberDetails": member()}
    evs = [("e1", offer(base_payload(promotionNumber="7", itemDetails=gone, **tio))),  # fails, creates nothing
           ("e2", offer(base_payload(promotionNumber="7"))),                            # creates the offer
           ("e3", offer(base_payload(promotionNumber="7", itemDetails=gone, **tio)))]   # the source check comes first
    b = plan_offer_batch(ready(spark, evs), empty(spark, OFFERS), empty(spark, OFFER_ITEMS), empty(spark, SITE_OVERRIDES),
                         directory(spark), rows(spark, []), rows(spark, []), catalogue(spark),
                         available_lists=spark.createDataFrame([("m.csv",)], "list_key string"))
    out = {r["event_id"]: r for r in b.outcomes.collect()}
    assert out["e1"]["failure_class"] == S.CLASS_BLOB
    assert out["e2"]["comments"] == S.OFFER_DONE_FORMAT % 7
    assert out["e3"]["comments"] == S.SOURCE_CONFLICT_FORMAT % (S.SOURCE_BROADREACH, 7)
    assert [r["offer_source"] for r in b.offers.collect()] == [S.SOURCE_BROADREACH]


def stored_with(spark, path, offers, audience):
    """Stored tables with (offer_id, source, location) offers and an audience."""
    rows_ = spark.createDataFrame(offers, "offer_id bigint, offer_source string, member_list_location string")
    store = Stored(spark, path, buckets=4)
    store.seed(empty(spark, OFFERS).unionByName(rows_, allowMissingColumns=True), empty(spark, OFFER_ITEMS), empty(spark, SITE_OVERRIDES),
               spark.createDataFrame(audience, "offer_id bigint, membership_uuid string, membership_id string, propensity double"))
    return store


def lookups(spark, files):
    return Lookups(directory(spark), rows(spark, []), rows(spark, []), catalogue(spark),
                   spark.createDataFrame(files, "list_key string, c0 string, c1 string"), cards(spark, CARDS))


def test_a_missing_file_leaves_the_streamed_audience(spark, tmp_path):
    store = stored_with(spark, str(tmp_path / "tables"), [(1, "TIO", "o.csv")], [(1, "ua", "a", None)])
    out = str(tmp_path / "out")
    apply_sink(store, lookups(spark, [("other.csv", "b", None)]), out)(raw_df(spark, [("e", _ev([1], "gone.csv"))]), 0)
    assert [r["membership_uuid"] for r in store.read("member_offers").collect()] == ["ua"]
    assert [r["member_list_location"] for r in store.read("offers").collect()] == ["o.csv"]
    assert [(r["event_id"], r["failure_class"]) for r in spark.read.parquet(f"{out}/failures").collect()] == [("e", S.CLASS_BLOB)]


def test_the_stream_loses_no_dead_letter_and_merges_no_nameless_event(spark, tmp_path):
    store = stored_with(spark, str(tmp_path / "tables"), [], [])
    out = str(tmp_path / "out")
    sink = apply_sink(store, lookups(spark, [("l.csv", "b", None)]), out)
    batch = raw_df(spark, [("a", "junk"), (None, offer(base_payload(promotionNumber="5"))), (None, offer(base_payload(promotionNumber="6"))),
                           (None, "more junk"), ("ok", offer(base_payload(promotionNumber="7")))])
    sink(batch, 0)
    sink(batch, 0)  # run again, as after a failure: nothing is doubled
    dead = spark.read.parquet(f"{out}/dead_letters").collect()
    assert sorted((r["event_id"] or "", r["dead"]) for r in dead) == [
        ("", "no event id"), ("", "no event id"), ("", "not one JSON object"), ("a", "not one JSON object")]
    assert all(r["raw"] for r in dead) and spark.read.parquet(f"{out}/failures").count() == 4
    assert [r["offer_id"] for r in store.read("offers").collect()] == [7]


def test_tied_events_keep_their_own_status_and_dead_letters_are_reported(spark):
    body = json.dumps(offer(base_payload()))
    bad = json.dumps(offer(base_payload(status="NONE")))
    raw = spark.createDataFrame([("e1", T0, body), ("e2", T0, bad), ("e3", T0, body + " x")],
                                "event_id string, arrival timestamp, raw string")
    it = run_intake(raw)
    none = spark.createDataFrame([], "event_id string, status string, comments string, failure_class string")
    now = current_status(audit_rows(it, none, none))
    assert {r["event_id"]: r["status"] for r in now.collect()} == {"e1": "PROCESSING", "e2": "FAILED"}
    rep = {r["failure_class"]: r["n_failed"] for r in failure_report(failures(it, now)).collect()}
    assert rep == {S.CLASS_PAYLOAD: 1, S.CLASS_OTHER: 1}


def test_a_named_file_without_its_header_fails_the_event(spark, tmp_path):
    """Files by source: swapped and quoted headers, one unnamed column, and a ranking list
    one of whose part files lost its header, which must not pass for an empty list."""
    from promoflow.settings import CARD_COLUMN
    from promoflow.sources.biglists import list_manifest, read_list_lines
    for name, text in {"ranked.csv": '"propensity", MembershipNumber\n0.5,c\n0.9,b\n', "plain.csv": "c\nb\n",
                       "cut/part-0.csv": "MembershipNumber,Propensity\nb,0.1\n", "cut/part-1.csv": "c,0.2\n"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    lines = read_list_lines(spark, str(tmp_path))
    assert {r["list_key"]: r["named"] for r in list_manifest(lines, CARD_COLUMN).collect()} == {
        "ranked.csv": True, "plain.csv": False, "cut": False}
    offers = spark.createDataFrame([(1, "TETRIS", None), (2, "TIO", None), (3, "TETRIS", None), (4, "TETRIS", None)],
                                   "offer_id bigint, offer_source string, member_list_location string")
    stored = spark.createDataFrame([(3, "old", "z", 0.1), (4, "old", "z", 0.1)],
                                   "offer_id bigint, membership_uuid string, membership_id string, propensity double")
    events = [([1], "ranked.csv"), ([2], "plain.csv"), ([3], "cut"), ([4], "plain.csv")]
    good, _ = decode_events(raw_df(spark, [(f"e{i}", _ev(*e)) for i, e in enumerate(events)]))
    b = plan_list_batch(good, offers, stored, lines, cards(spark, [("b", "u1"), ("c", "u1")]),
                        available_lists=list_manifest(lines, CARD_COLUMN))
    assert sorted(tuple(r) for r in b.member_offers.collect()) == [
        (1, "u1", "b", 0.9), (2, "u1", "b", None), (3, "old", "z", 0.1), (4, "old", "z", 0.1)]
    assert {r["offer_id"]: r["missing_list"] for r in b.looked.collect()} == {1: None, 2: None, 3: "cut", 4: "plain.csv"}
