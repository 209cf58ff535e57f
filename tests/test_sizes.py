"""Findings of round 3: whole inputs, narrow shuffles, bounded files and writers."""

import glob
from datetime import datetime

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import base_payload, offer, raw_df
from promoflow import queries as Q
from promoflow import testbed as TB
from promoflow.operators import gates as G
from promoflow.operators import items as I
from promoflow.operators import sites as ST
from promoflow.plans.intake import run_intake
from promoflow.plans.mixed_batch import plan_mixed_batch
from promoflow.schemas import OFFER_ITEMS, OFFERS, SITE_OVERRIDES
from promoflow.session import apply_engine_conf, checkpoint_dir
from promoflow.sources.events import decode_events, route_event_kind
from promoflow.streaming.intake_stream import deduplicated

STORE_ROWS = "list_key string, c0 string, c1 string"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def kept_tables(spark, name):
    return set(glob.glob(f"{checkpoint_dir(spark)}/work-{name}-*"))


def test_view_deletes_come_from_the_whole_audience(spark, tmp_path):  # F13
    at = datetime(2024, 1, 1)
    write = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    write("customer", [(10, 1.0, "OTHER", 1), (40, 1.0, "OTHER", 1)], "c_custkey bigint, c_acctbal double, c_mktsegment string, c_nationkey int")
    # U5 has offer 1 alone, which its number does not name; list 1 holds U20 only.
    write("orders", [(1, 10, 100.0)], "o_orderkey bigint, o_custkey bigint, o_totalprice double")
    write("events", [(1, at, 40, "view", 1.0)], "event_id bigint, ts timestamp, user_id bigint, event_type string, value double")
    assert [r[0] for r in Q.q_member_view_deletes(spark, str(tmp_path)).collect()] == ["U5"]


def test_events_are_made_of_lines_after_the_last_shuffle(spark):  # F14, F16-F19, F22, F23, F26-F28
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    plan = plan_of(TB._build_offer_events_raw(spark, "/root/testdata/sf0.001"))
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    for part in ("MEMBERSHIP_DISCOUNT", "items/supplier-", "21:30:00"):
        assert part in plan and not any(part in below for below in plan.split("Exchange")[1:])


def test_stream_reads_no_text_to_drop_copies(spark, tmp_path):  # F25
    raw_df(spark, [("a", "{}"), ("a", "{}")]).write.parquet(f"{tmp_path}/landing")
    src = spark.readStream.schema("event_id string, arrival timestamp, raw string").parquet(f"{tmp_path}/landing")
    assert deduplicated(src).columns == ["event_id", "arrival"]
    below = deduplicated(src)._jdf.queryExecution().analyzed().toString().split("Deduplicate")[1].splitlines()
    assert not any("raw" in line for line in below[:below.index(next(x for x in below if "Project [event_id" in x)) + 1])


def test_landed_files_grow_with_their_text(spark, tmp_path, monkeypatch):  # F25, F28-F30
    raw = spark.range(400).select(F.concat(F.lit("e"), "id").alias("event_id"), F.timestamp_seconds("id").alias("arrival"),
                                  F.lit("x" * 100).alias("raw"))
    monkeypatch.setattr(Q, "_raw_batch", lambda spark, d: raw)
    assert Q._files_for(raw, 4) == 4
    monkeypatch.setattr(Q, "_FILE_CHARS", 1000)
    assert Q._files_for(raw, 4) == 40
    path, files = Q._land(spark, "", str(tmp_path))
    assert files >= 40 and spark.read.parquet(path).count() == 400
    per_chunk = Q._land_chronological(raw, f"{tmp_path}/chunks")
    assert per_chunk == 14 and spark.read.parquet(f"{tmp_path}/chunks").count() == 400


def test_wide_rows_after_narrow_ones_are_written_in_small_pages(spark, tmp_path):  # F1, F6, F12
    apply_engine_conf(spark)
    texts = spark.range(0, 3000, 1, 1).select(F.when(F.col("id") < 200, "x").otherwise(
        F.concat(F.col("id").cast("string"), F.repeat(F.lit("y"), 20_000))).alias("t"))
    texts.write.option("parquet.block.size", 1 << 20).option("compression", "uncompressed").parquet(str(tmp_path / "t"))
    (file,) = glob.glob(f"{tmp_path}/t/*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert max(meta.row_group(i).total_byte_size for i in range(meta.num_row_groups)) < 4 << 20


def test_inline_store_lists_are_not_looked_up(spark):  # F1, F4, F7, F8, F12, F24
    listed = base_payload(clubDetails={"clubListCount": 1, "clubOverride": [], "clubsPayload": [
        {"clubType": "list", "clubList": ["9", "7", "7"], "clubInclusion": True},
        {"clubType": "list", "clubList": ["8", "7"], "clubInclusion": True}]})
    filed = base_payload(clubDetails={"clubListCount": 1, "clubOverride": [], "clubsPayload": [
        {"clubType": "biglist", "clubBigListURL": "s.csv", "clubInclusion": True}, {"clubType": "list", "clubList": ["3"], "clubInclusion": True}]})
    good, _ = decode_events(raw_df(spark, [("a", offer(listed)), ("b", offer(filed)), ("c", offer(base_payload(clubDetails=None)))]))
    ev = G.trim_awards(G.route_source(route_event_kind(good)[0]))
    directory = spark.createDataFrame([(7, (None,), True, None)], "id bigint, address struct<state:string>, isActive boolean, clubType string")
    rows = spark.createDataFrame([("s.csv", "5", None)], STORE_ROWS)
    before = kept_tables(spark, "store-set-keys")
    events, lists = ST.club_combinations(ev, directory, rows)
    (new,) = kept_tables(spark, "store-set-keys") - before
    assert lists.count() == 1
    # Only the event with a file hands its sets on.
    assert spark.read.parquet(new).filter(F.col("key").startswith("L:")).count() == 1
    got = {r["event_id"]: r["club_list"] for r in ST.attach_club_lists(events, lists).collect()}
    assert got == {"a": [7, 7, 8, 9], "b": [3, 5], "c": None}
    sites = sorted((r["event_id"], r["club_id"]) for r in ST.resolve_sites(ev, directory, rows).collect())
    assert sites == [("a", 7), ("a", 7), ("a", 8), ("a", 9), ("b", 3), ("b", 5)]
    # The array is written out above the join.
    plan = plan_of(ST.resolve_sites(ev, directory, rows))
    assert 0 < plan.rfind("Generate explode(clubs") < plan.rfind("Join")


def test_outcomes_of_list_events_apply_no_audience(spark):  # F3, F5
    it = run_intake(raw_df(spark, [("o", offer(base_payload(promotionNumber="101", labels=["tio"], memberDetails={
        "memberListCount": 1, "membersPayload": [{"memberType": "biglist", "memberList": [], "memberBigListURL": "m0.csv"}]}))),
        ("l", '{"offerIdList":["101"],"memberBigListLocation":"m.csv"}')]))
    ready = [e.filter("status = 'PROCESSING'") for e in (it.offers, it.lists)]
    empty = lambda schema: spark.createDataFrame([], schema)
    keys = spark.createDataFrame([("m.csv",), ("m0.csv",)], "list_key string")
    before = kept_tables(spark, "spells")
    mb = plan_mixed_batch(
        *ready, empty(OFFERS), empty(OFFER_ITEMS), empty(SITE_OVERRIDES),
        empty("offer_id bigint, membership_uuid string, membership_id string, propensity double"),
        empty("id bigint, address struct<state:string>, isActive boolean, clubType string"), empty(STORE_ROWS), empty(STORE_ROWS),
        empty("PROD_ID string, MDSE_CATG_CD int, MDSE_SUB_CATG_CD int, ITEM_ID_ARRAY array<bigint>"),
        spark.createDataFrame([("m.csv", "1", None)], STORE_ROWS),
        spark.createDataFrame([("1", "U1", "Y", "Y", "ACTIVE", "MEMBERSHIPACCOUNT")],
                              "cardNumber string, membershipId string, current_ind string, card_current_ind string, cardStatus string, cardType string"),
        keys, keys)
    assert [r["status"] for r in mb.list_outcomes.collect()] == ["PROCESSED"]
    assert [r["member_list_location"] for r in mb.offers.collect()] == ["m.csv"]
    assert kept_tables(spark, "spells") == before
    assert [(r["offer_id"], r["membership_uuid"]) for r in mb.member_offers.collect()] == [(101, "U1")]
    assert mb.delta.count() == 1 and len(kept_tables(spark, "spells") - before) == 1


def test_events_are_judged_once(spark):  # F9, F15, F18, F20, F21
    it = run_intake(raw_df(spark, [
        ("ok", offer(base_payload())), ("bad", offer(base_payload(status="DRAFT", startDate=""))),
        ("gone", offer(base_payload(awardList=...))), ("list", '{"offerIdList":["7"],"memberBigListLocation":"m.csv"}'),
        ("odd", '{"offerIdList":["x"],"memberBigListLocation":"m.csv"}')]))
    # What later steps read is the stored result, not the rules over the event.
    for df in (it.offers.filter("status = 'PROCESSING'").select("event_id"), it.lists.select("event_id", "errors"), it.outcomes):
        assert "clubDetails" not in plan_of(df) and "offerIdList" not in plan_of(df)
    got = {r["event_id"]: (r["kind"], r["oid"], r["source_label"], r["status"], r["reason"], r["failure_class"]) for r in it.outcomes.collect()}
    assert got == {"ok": ("offer", "101", "broadreach", "PROCESSING", None, None),
                   "bad": ("offer", "101", "broadreach", "FAILED", "V1:startDate; V3", "PayloadError"),
                   "gone": ("offer", "101", "broadreach", "FAILED", "awardList is missing", "Error"),
                   "list": ("list", "7", "", "PROCESSING", None, None), "odd": ("list", "x", "", "FAILED", "V13", "PayloadError")}
    errors = it.offers.filter("event_id <> 'gone'").orderBy("event_id").collect()
    assert [r["errors"] for r in errors] == [["V1:startDate", "V3"], []] and errors[1]["awards"][0]["value"] == "5"


def test_references_of_awards_are_told_apart(spark):  # only odd ones are looked for in the text
    refs = {"plain": ["1"], "number": [1], "bracket": ["[x"], "null": [None], "object": [{"a": 1}], "list": [["1"]], "text": "1", "absent": ..., "none": None, "empty": []}
    award = lambda r, kind: {"awardType": kind, "value": "5", "discountMethod": "DOLLAR_OFF"} | ({} if r is ... else {"itemRefId": r})
    rows = [(k, offer(base_payload(awardList=[award(["1"], "DISCOUNT_ITEM_PRICE"), award(r, "DISCOUNT_ITEM_PRICE")]))) for k, r in refs.items()]
    rows += [("other", offer(base_payload(awardList=[award([None], "BONUS"), award(["1"], "DISCOUNT_ITEM_PRICE")]))), ("nothing", offer(base_payload(awardList=None)))]
    good, _ = decode_events(raw_df(spark, rows))
    wrong = {r["event_id"] for r in good.filter("array_contains(wrong, 'payload.awardList.itemRefId')").collect()}
    assert wrong == {"null", "object", "list", "text"}


def test_files_meet_events_in_blocks(spark, monkeypatch):  # F32, F33
    monkeypatch.setattr(I, "BLOCK", 3)
    rows = [("f", str(i)) for i in range(10)] + [("f", "4"), ("f", "x"), ("f", None), ("g", "7"), (None, "8")]
    files = spark.createDataFrame(rows, "list_key string, c0 string")
    sent = spark.createDataFrame([("a", 1, "TIO", "f", "DISCOUNTED_ITEMS"), ("b", 2, "TIO", "f", "DISCOUNTED_ITEMS"), ("c", 3, "TIO", "g", "ELIGIBLE_ITEMS"),
                                  ("d", 4, "TIO", "none", "ELIGIBLE_ITEMS"), ("e", 5, "TIO", None, "ELIGIBLE_ITEMS")],
                                 "event_id string, offer_id bigint, offer_source string, list_key string, payload_item_type string").withColumn("list_type", F.lit("biglist"))
    out = I.biglist_items(sent, files)
    of_f = sorted([*range(10), 4, -1, -1])
    got = lambda e: sorted(-1 if r["item_number"] is None else r["item_number"] for r in out.filter(F.col("event_id") == e).collect())
    assert got("a") == got("b") == of_f and got("c") == [7] and out.count() == 2 * len(of_f) + 1
    blocks = I.item_blocks(I.biglist_numbers(files), ["list_key"])
    assert blocks.filter("list_key = 'f'").count() > 1
    # The items are written out above the join.
    plan = plan_of(out)
    assert 0 <= plan.find("Generate explode(items") < plan.find("Join")
