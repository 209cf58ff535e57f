"""Failure report as a stream, a run that stops when idle, bounded re-delivery history, readers."""

import threading
import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import T0, base_payload, offer, raw_df
from promoflow import settings as S
from promoflow.operators.audience import active_member_cards
from promoflow.operators.audit import current_status, failure_report
from promoflow.operators.items import excluded_items
from promoflow.operators.sites import active_sites
from promoflow.plans.audit_batch import audit_rows, failures
from promoflow.plans.intake import run_intake
from promoflow.sources.events import read_events_stream
from promoflow.sources.lookups import read_catalogue, read_member_cards, read_sites
from promoflow.streaming.apply_stream import fresh_events
from promoflow.streaming.failure_stream import read_failure_report, run_failure_report_stream
from promoflow.streaming.idle import run_until_idle
from promoflow.streaming.intake_stream import put, run_intake_stream

EVENT = "event_id string, arrival timestamp, raw string"


@pytest.mark.parametrize("per_batch", [6, 2])
def test_the_streamed_failure_report_equals_the_batch_report(spark, tmp_path, per_batch):
    bad = offer(base_payload(status="NONE"))
    items = [("a", bad), ("b", "junk"), ("c", offer(base_payload())), (None, bad), ("d", bad), ("e", {"offerIdList": ["x"], "memberBigListLocation": "m"})]
    raw = raw_df(spark, items).withColumn("arrival", F.col("arrival") + F.make_dt_interval(F.when(F.col("event_id") == "d", 2).otherwise(0)))
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    for eid, _ in items:
        raw.filter(F.col("event_id").eqNullSafe(F.lit(eid))).coalesce(1).write.mode("append").parquet(landing)
    run_intake_stream(spark, landing, out, str(tmp_path / "c1"), max_files_per_trigger=per_batch)
    run_failure_report_stream(spark, f"{out}/failures", out, str(tmp_path / "c2"), max_files_per_trigger=per_batch)
    it = run_intake(raw)
    none = spark.createDataFrame([], "event_id string, status string, comments string, failure_class string")
    want = failure_report(failures(it, current_status(audit_rows(it, none, none))))
    rows = lambda df: sorted(tuple(r) for r in df.select("failure_class", "source_label", "day", "n_failed").collect())
    assert rows(read_failure_report(spark, out)) == rows(want)
    assert sum(r[3] for r in rows(want)) == 5


def test_a_run_drains_what_lands_late_and_stops_when_idle(spark, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    chunk = lambda k: spark.createDataFrame([(f"e{k}{i}", T0, "{}") for i in range(5)], EVENT).coalesce(1).write.mode("append").parquet(landing)
    chunk(0)

    def late():
        for k in (1, 2):
            time.sleep(3)
            chunk(k)
    feeder = threading.Thread(target=late)
    q = (read_events_stream(spark, landing).writeStream.foreachBatch(lambda b, i: put(b, out, "events", i))
         .option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="500 milliseconds").start())
    feeder.start()
    began = time.monotonic()
    assert run_until_idle(q, idle_seconds=8) == 15
    feeder.join()
    assert not q.isActive and time.monotonic() - began < 120
    assert spark.read.parquet(f"{out}/events").select("event_id").distinct().count() == 15


def test_redelivered_events_read_their_days_only(spark, tmp_path):
    seen = str(tmp_path / "seen")
    first = spark.createDataFrame([("a", T0, "x"), ("b", T0 + timedelta(days=30), "x")], EVENT)
    assert fresh_events(first, seen, 0).count() == 2
    put(first.select("event_id", F.to_date("arrival").alias("day")), str(tmp_path), "seen", 0, ("day",))
    again = spark.createDataFrame([("b", T0 + timedelta(days=31), "x"), ("c", T0 + timedelta(days=31), "y"), ("c", T0 + timedelta(days=32), "z"),
                                   (None, T0, "n1"), (None, T0, "n2")], EVENT)
    fresh = fresh_events(again, seen, 1)
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(fresh._jdf.queryExecution(), "formatted")
    assert "dynamicpruningexpression(day" in plan
    assert sorted((r["event_id"] or "", r["raw"]) for r in fresh.collect()) == [("", "n1"), ("", "n2"), ("c", "y")]
    assert fresh_events(first, seen, 0).count() == 2  # a batch that is run again knows only the batches before it


def test_readers_scan_what_is_used(spark, tmp_path):
    spark.createDataFrame([("p", "name", c, 0, [c, c + 1]) for c in (50, 51)],
                          "PROD_ID string, PROD_NM string, MDSE_CATG_CD int, MDSE_SUB_CATG_CD int, ITEM_ID_ARRAY array<bigint>").write.parquet(str(tmp_path / "cat"))
    spark.createDataFrame([(1, "n", ("s", "c", "PR", "0"), True, None), (2, "n", ("s", "c", "TX", "0"), False, None)],
                          "id bigint, name string, address struct<street:string,city:string,state:string,postalCode:string>, isActive boolean, clubType string").write.parquet(str(tmp_path / "st"))
    spark.createDataFrame([("1", "u", "h", "Y", "Y", " ACTIVE ", S.CARD_TYPE), ("2", "v", "h", "N", "Y", "ACTIVE", S.CARD_TYPE)],
                          "cardNumber string, membershipId string, holderName string, current_ind string, card_current_ind string, cardStatus string, cardType string").write.parquet(str(tmp_path / "cards"))
    plan = lambda df: spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    ex = excluded_items(read_catalogue(spark, str(tmp_path / "cat"), 50), 50)
    assert sorted(r[0] for r in ex.collect()) == [50, 51]
    assert "ReadSchema: struct<MDSE_CATG_CD:int,ITEM_ID_ARRAY:array<bigint>>" in plan(ex) and "EqualTo(MDSE_CATG_CD,50)" in plan(ex)
    sites = active_sites(read_sites(spark, str(tmp_path / "st")))
    assert [tuple(r) for r in sites.collect()] == [(1, "PR")]
    assert "address:struct<state:string>" in plan(sites) and "EqualTo(isActive,true)" in plan(sites) and "street" not in plan(sites)
    cards = active_member_cards(read_member_cards(spark, str(tmp_path / "cards")))
    assert [tuple(r) for r in cards.collect()] == [("1", "u")]
    assert "EqualTo(current_ind,Y)" in plan(cards) and "holderName" not in plan(cards)
