"""Events of both kinds in arrival order, against one event after the other in Python."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import base_payload, offer, raw_df
from promoflow.plans.intake import run_intake
from promoflow.plans.list_batch import plan_list_batch
from promoflow.plans.mixed_batch import plan_mixed_batch
from promoflow.schemas import OFFER_ITEMS, OFFERS, SITE_OVERRIDES
from promoflow.sources.events import decode_events
from promoflow.streaming.apply_stream import Lookups, Stored, run_apply_stream
from test_audience import _ev, cards
from test_offers import catalogue, directory, empty, rows

AUDIENCE = "offer_id bigint, membership_uuid string, membership_id string, propensity double"
PEOPLE = "abcdef"
FILES = {f"f{i}.csv": {p: round(0.1 * (i + j + 1), 2) for j, p in enumerate(PEOPLE) if (i + 2) * (j + 3) % 5 < 3}
         for i in range(5)}


def file_rows(spark):
    return spark.createDataFrame([(f, p, str(v)) for f, m in FILES.items() for p, v in m.items()],
                                 "list_key string, c0 string, c1 string")


def own_cards(spark):
    return cards(spark, [(p, "u" + p) for p in PEOPLE])


def apply_list(state, audience, ids, file):
    """One member-list event: ``state`` offer -> [source, location], ``audience`` (offer, member) -> row."""
    found = [i for i in ids if i in state and state[i][0] != "BROADREACH"]
    if not found or file not in FILES:
        return
    ranked = state[found[0]][0] == "TETRIS"
    for i in found:
        if state[i][1] != file:
            for k in [k for k in audience if k[0] == i and k[1][1:] not in FILES[file]]:
                del audience[k]
            for p, v in FILES[file].items():
                audience.setdefault((i, "u" + p), (p, v if ranked else None))
        state[i][1] = file


def audience_of(df):
    got = [tuple(r) for r in df.select("offer_id", "membership_uuid", "membership_id", "propensity").collect()]
    assert len({g[:2] for g in got}) == len(got)
    return {g[:2]: g[2:] for g in got}


@pytest.mark.parametrize("seed", [1, 2])
def test_many_list_events_of_one_offer_equal_one_after_the_other(spark, seed):
    rnd = random.Random(seed)
    state = {1: ["TETRIS", "f0.csv"], 2: ["TIO", None], 3: ["BROADREACH", None]}
    audience = {(o, "u" + p): ("old", 9.0) for o in state for p in "abz"}
    events = [([1], f"f{1 + i % 2}.csv") for i in range(6)]
    events += [(rnd.sample([1, 2, 3, 8], 2), f"f{rnd.randrange(5)}.csv") for _ in range(8)]
    offers = spark.createDataFrame([(o, *v) for o, v in state.items()], "offer_id bigint, offer_source string, member_list_location string")
    stored = spark.createDataFrame([(*k, *v) for k, v in audience.items()], AUDIENCE)
    good, _ = decode_events(raw_df(spark, [(f"e{i:02}", _ev(*e)) for i, e in enumerate(events)]))
    b = plan_list_batch(good, offers, stored, file_rows(spark), own_cards(spark))
    before = dict(audience)
    for e in events:
        apply_list(state, audience, *e)
    assert audience_of(b.member_offers) == audience
    assert {r["offer_id"]: r["member_list_location"] for r in b.offers.collect()} == {o: v[1] for o, v in state.items()}
    balance = {(r["offer_id"], r["membership_uuid"]): r["n"] for r in b.delta.groupBy("offer_id", "membership_uuid").agg(
        F.sum(F.when(F.col("action") == "add", 1).otherwise(-1)).alias("n")).collect()}
    for k in set(before) | set(audience) | set(balance):
        assert balance.get(k, 0) == (k in audience) - (k in before)


def offer_event(number, label, file):
    members = {"memberListCount": 1, "membersPayload": [
        {"memberType": "biglist", "memberList": [], "memberBigListURL": file}]}
    return offer(base_payload(promotionNumber=str(number), labels=[label], memberDetails=members))


MIX = [("e0", _ev([7, 1], "f1.csv")),               # 7 does not exist yet
       ("e1", offer_event(7, "tetris", "f1.csv")),
       ("e2", _ev([7], "f1.csv")),                  # the offer event set this location
       ("e3", _ev([7, 1], "f2.csv")),
       ("e4", offer_event(7, "tio", "f4.csv")),     # another source: refused
       ("e5", offer_event(7, "tetris", "f3.csv")),
       ("e6", _ev([7], "f2.csv")),                  # effective again, with the same members
       ("e7", _ev([1], "gone.csv"))]


def expected():
    state, audience = {1: ["TIO", "f0.csv"]}, {(1, "ua"): ("old", 9.0), (1, "uz"): ("old", 9.0)}
    for ids, file in (([7, 1], "f1.csv"),):
        apply_list(state, audience, ids, file)
    state[7] = ["TETRIS", "f1.csv"]
    apply_list(state, audience, [7], "f1.csv")
    apply_list(state, audience, [7, 1], "f2.csv")
    state[7][1] = "f3.csv"
    apply_list(state, audience, [7], "f2.csv")
    return state, audience


def start(spark):
    row = {c: None for c in OFFERS.fieldNames()} | {"offer_id": 1, "offer_source": "TIO", "member_list_location": "f0.csv"}
    return (spark.createDataFrame([tuple(row[c] for c in OFFERS.fieldNames())], OFFERS), empty(spark, OFFER_ITEMS),
            empty(spark, SITE_OVERRIDES),
            spark.createDataFrame([(1, "ua", "old", 9.0), (1, "uz", "old", 9.0)], AUDIENCE))


def lists_there(spark):
    return file_rows(spark).select("list_key").distinct()


def test_a_mixed_batch_equals_one_after_the_other(spark):
    it = run_intake(raw_df(spark, MIX))
    ok = [e.filter("status = 'PROCESSING'") for e in (it.offers, it.lists)]
    mb = plan_mixed_batch(*ok, *start(spark), directory(spark), rows(spark, []), rows(spark, []), catalogue(spark),
                          file_rows(spark), own_cards(spark), empty(spark, "list_key string"), lists_there(spark))
    state, audience = expected()
    assert audience_of(mb.member_offers) == audience
    assert {r["offer_id"]: [r["offer_source"], r["member_list_location"]] for r in mb.offers.collect()} == state
    ends = {r["event_id"]: (r["status"], r["failure_class"]) for r in mb.list_outcomes.collect()}
    assert ends.pop("e7") == ("FAILED", "BlobReadError") and set(ends.values()) == {("PROCESSED", None)}


@pytest.mark.parametrize("per_batch", [8, 3])
def test_a_mixed_stream_equals_one_after_the_other(spark, tmp_path, per_batch):
    """One and three micro-batches; in the latter e0 comes again, late, and changes nothing."""
    landing = str(tmp_path / "landing")
    raw = raw_df(spark, MIX).coalesce(1)
    for eid, _ in MIX + [MIX[0]] * (per_batch < 8):
        raw.filter(F.col("event_id") == eid).write.mode("append").parquet(landing)
    store = Stored(spark, str(tmp_path / "tables"), buckets=4)
    store.seed(*start(spark))
    look = Lookups(directory(spark), rows(spark, []), rows(spark, []), catalogue(spark), file_rows(spark), own_cards(spark),
                   lists_there(spark), empty(spark, "list_key string"))
    out = str(tmp_path / "out")
    run_apply_stream(spark, landing, store, look, out, str(tmp_path / "checkpoint"), max_files_per_trigger=per_batch)
    state, audience = expected()
    assert audience_of(store.read("member_offers")) == audience
    assert {r["offer_id"]: [r["offer_source"], r["member_list_location"]] for r in store.read("offers").collect()} == state
    audit = spark.read.parquet(f"{out}/audit")
    assert sorted(r["event_id"] for r in audit.filter("seq = 0").collect()) == [e for e, _ in MIX]
    ends = {r["event_id"]: r["status"] for r in audit.filter("seq = 2").collect()}
    assert ends == {e: "FAILED" if e == "e7" else "PROCESSED" for e, _ in MIX}
    assert {r["offer_id"] for r in spark.read.parquet(f"{out}/offer_view").collect()} == {7}
    assert {r["membership_uuid"] for r in spark.read.parquet(f"{out}/member_view").collect()} >= {m for _, m in audience if m != "uz"}
    # The kept-up view equals the view of the audience, and the failure rows the audit.
    view = {(r["membership_uuid"], i) for r in store.read("member_view").collect() for i in r["offer_ids"]}
    assert view == {(m, o) for o, m in audience}
    assert [(r["event_id"], r["failure_class"]) for r in spark.read.parquet(f"{out}/failures").collect()] == [("e7", "BlobReadError")]
    assert spark.read.parquet(f"{out}/changes").count() == -(-(len(MIX) + (per_batch < 8)) // per_batch)
