"""Member resolution, audience delta, rounds, views (FIXTURES member/delta/view)."""

from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from promoflow.operators import audience as A
from promoflow.plans.audit_batch import list_event_outcomes
from promoflow.operators.serve import member_entries
from promoflow.plans.list_batch import member_view_changes, plan_list_batch
from promoflow.sources.events import decode_events

T0 = datetime(2024, 1, 1)


def cards(spark, pairs):
    return spark.createDataFrame([(c, m, "Y", "Y", "ACTIVE", "MEMBERSHIPACCOUNT") for c, m in pairs],
                                 "cardNumber string, membershipId string, current_ind string, "
                                 "card_current_ind string, cardStatus string, cardType string")


def test_best_card_by_propensity_and_unknown_cards_drop(spark):
    c = A.active_member_cards(cards(spark, [("c1", "u1"), ("c2", "u1"), ("c3", "u2")]))
    m = spark.createDataFrame([("L", "c1", 0.2), ("L", "c2", 0.9), ("L", "c3", None), ("L", "zz", 1.0)],
                              "list_key string, membership_id string, propensity double")
    got = sorted(tuple(r) for r in A.resolve_members(m, c).collect())
    assert got == [("L", "u1", "c2", 0.9), ("L", "u2", "c3", None)]


def test_card_predicate_trims_status(spark):
    df = spark.createDataFrame(
        [("1", "u", "Y", "Y", " PICKUP ", "MEMBERSHIPACCOUNT"), ("2", "u", "N", "Y", "ACTIVE", "MEMBERSHIPACCOUNT"),
         ("3", "u", "Y", "Y", "CLOSED", "MEMBERSHIPACCOUNT"), ("4", "u", "Y", "Y", "ACTIVE", "OTHER")],
        "cardNumber string, membershipId string, current_ind string, card_current_ind string, "
        "cardStatus string, cardType string")
    assert [r[0] for r in A.active_member_cards(df).collect()] == ["1"]


def test_resolved_files_pass_through(spark):
    m = spark.createDataFrame([("L", "u9", "c9", None)],
                              "list_key string, membership_uuid string, membership_id string, propensity double")
    assert A.resolve_members(m, cards(spark, [])).collect() == m.collect()


def _batch(spark, events, offers, stored, files, card_pairs, available=None):
    rows = [(eid, T0 + timedelta(minutes=i), raw) for i, (eid, raw) in enumerate(events)]
    raw = spark.createDataFrame(rows, "event_id string, arrival timestamp, raw string")
    good, _ = decode_events(raw)
    off = spark.createDataFrame(offers, "offer_id bigint, offer_source string, member_list_location string")
    cur = spark.createDataFrame(stored, "offer_id bigint, membership_uuid string, membership_id string, "
                                        "propensity double")
    f = spark.createDataFrame(files, "list_key string, c0 string, c1 string")
    av = None if available is None else spark.createDataFrame([(k,) for k in available], "list_key string")
    return plan_list_batch(good, off, cur, f, cards(spark, card_pairs), available_lists=av)


def _ev(ids, loc):
    return '{"offerIdList": [%s], "memberBigListLocation": "%s"}' % (",".join(map(str, ids)), loc)


CARDS = [(c, "u" + c) for c in "abcdefg"]


def test_delta_add_and_delete(spark):
    b = _batch(spark, [("e1", _ev([1], "new.csv"))], [(1, "TIO", "old.csv")],
               [(1, "ua", "a", None), (1, "ub", "b", None), (1, "uc", "c", None)],
               [("new.csv", x, None) for x in "bcd"], CARDS)
    got = sorted((r["membership_uuid"], r["action"]) for r in b.delta.collect())
    assert got == [("ua", "delete"), ("ud", "add")]
    assert sorted(r["membership_uuid"] for r in b.member_offers.collect()) == ["ub", "uc", "ud"]
    assert {r["offer_id"]: r["member_list_location"] for r in b.offers.collect()} == {1: "new.csv"}


def test_same_location_is_unchanged_but_processed(spark):
    b = _batch(spark, [("e1", _ev([1, 7], "same.csv"))], [(1, "TIO", "same.csv")],
               [(1, "ua", "a", None)], [("same.csv", "b", None)], CARDS)
    assert b.delta.count() == 0
    out = {r["event_id"]: (r["status"], r["comments"]) for r in list_event_outcomes(b.looked).collect()}
    assert out["e1"] == ("PROCESSED", "Memeberlist updated successfully of offer_ids : [1]. Ignored processing [7].")


def test_no_stored_offer_fails(spark):
    b = _batch(spark, [("e1", _ev([8, 9], "x.csv"))], [(1, "TIO", "a.csv"), (8, "BROADREACH", "a.csv")],
               [], [("x.csv", "a", None)], CARDS)
    out = {r["event_id"]: r["status"] for r in list_event_outcomes(b.looked).collect()}
    assert out == {"e1": "FAILED"}


def test_member_left_without_offers_is_deleted_from_view(spark):
    stored = [(1, "ua", "a", None), (1, "ub", "b", None), (2, "ub", "b", None)]
    b = _batch(spark, [("e1", _ev([1], "new.csv"))], [(1, "TIO", "old.csv"), (2, "TIO", "o2.csv")],
               stored, [("new.csv", "c", None)], CARDS)
    view = member_entries(spark.createDataFrame([r[:2] for r in stored], "offer_id bigint, membership_uuid string"))
    ups, dels = member_view_changes(b, view)
    assert sorted(r[0] for r in dels.collect()) == ["ua"]
    assert sorted((r[0], tuple(r[1])) for r in ups.collect()) == [("ub", (2,)), ("uc", (1,))]


def test_two_events_for_one_offer_apply_in_order(spark):
    # e1 sets {b, c}, e2 sets {c, d} with tetris propensities: final = {c, d}; c kept from e1 row
    b = _batch(spark, [("e1", _ev([1], "l1.csv")), ("e2", _ev([1], "l2.csv")), ("e3", _ev([1], "l2.csv"))],
               [(1, "TETRIS", "l0.csv")], [(1, "ua", "a", 0.1)],
               [("l1.csv", "b", "0.5"), ("l1.csv", "c", "0.6"), ("l2.csv", "c", "0.9"), ("l2.csv", "d", "0.7")],
               CARDS)
    eff = {r["event_id"]: (r["effective"], r["round"]) for r in b.effective.collect()}
    assert eff == {"e1": (True, 1), "e2": (True, 2), "e3": (False, None)}
    final = sorted((r["membership_uuid"], r["propensity"]) for r in b.member_offers.collect())
    assert final == [("uc", 0.6), ("ud", 0.7)]


def test_missing_member_file_fails_and_changes_nothing(spark):
    b = _batch(spark, [("e1", _ev([1], "gone.csv")), ("e2", _ev([1], "new.csv"))], [(1, "TIO", "old.csv")],
               [(1, "ua", "a", None)], [("new.csv", "b", None)], CARDS, available=["new.csv", "old.csv"])
    out = {r["event_id"]: (r["status"], r["comments"]) for r in list_event_outcomes(b.looked).collect()}
    assert out["e1"] == ("FAILED", "blob: gone.csv could not be read")
    assert out["e2"][0] == "PROCESSED"
    assert sorted(r["membership_uuid"] for r in b.member_offers.collect()) == ["ub"]
    assert {r["offer_id"]: r["member_list_location"] for r in b.offers.collect()} == {1: "new.csv"}


@settings(max_examples=5, deadline=None)
@given(old=st.sets(st.sampled_from("abcdefg"), max_size=7), new=st.sets(st.sampled_from("abcdefg"), max_size=7))
def test_delta_properties(spark, old, new):
    b = _batch(spark, [("e1", _ev([1], "n.csv"))], [(1, "TIO", "o.csv")],
               [(1, "u" + x, x, None) for x in sorted(old)], [("n.csv", x, None) for x in sorted(new)], CARDS)
    adds = {r["membership_uuid"] for r in b.delta.filter(F.col("action") == "add").collect()}
    dels = {r["membership_uuid"] for r in b.delta.filter(F.col("action") == "delete").collect()}
    o, n = {"u" + x for x in old}, {"u" + x for x in new}
    assert not adds & dels
    assert (o - dels) | adds == n
    final = [r["membership_uuid"] for r in b.member_offers.collect()]
    assert sorted(final) == sorted(n) and len(final) == len(set(final))


pytestmark = pytest.mark.filterwarnings("ignore")
