"""Bucketed tables, the two-level scan of list locations, chunks that split, the kept-up view."""

import os
import random
from datetime import timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import T0
from promoflow.operators.buckets import BucketedTables
from promoflow.operators.running import running_locations, sliced
from promoflow.operators.serve import chunk_changes, item_bits, item_chunks, member_entries, member_view, net_changes
from promoflow.schemas import MEMBER_OFFERS, OFFER_ITEMS

ITEM = "item_number bigint, item_type string, offer_id bigint, product_id string"


# --- bucketed tables ------------------------------------------------------------------

@pytest.fixture
def tables(spark, tmp_path):
    t = BucketedTables(spark, str(tmp_path), {"offer_items": OFFER_ITEMS, "member_offers": MEMBER_OFFERS}, buckets=8)
    t.seed("offer_items", spark.createDataFrame([(i, "A", i % 20, "") for i in range(200)], ITEM))
    t.seed("member_offers", spark.createDataFrame([(i % 20, f"u{i}", None, None) for i in range(200)],
                                                  "offer_id bigint, membership_uuid string, membership_id string, propensity double"))
    return t


def stamps(t, name):
    return {d: sorted(os.listdir(f"{t.path(name)}/{d}")) for d in os.listdir(t.path(name)) if d.startswith("offer_bucket=")}


def test_a_batch_for_one_offer_reads_and_writes_one_bucket(spark, tables):
    t = tables
    ids = spark.createDataFrame([(7,), (None,)], "offer_id bigint")
    touched = t.touched(ids)
    assert touched.count() == 1
    rows = t.rows("offer_items", touched)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "dynamicpruningexpression(offer_bucket" in plan
    before = {n: stamps(t, n) for n in t.schemas}
    new = {"offer_items": rows.filter("offer_id <> 7").unionByName(spark.createDataFrame([(999, "B", 7, "")], ITEM)),
           "member_offers": t.rows("member_offers", touched).filter("offer_id <> 7")}
    t.apply(0, touched, new)
    (bucket,) = [f"offer_bucket={r[0]}" for r in touched.collect()]
    for n in t.schemas:
        after = stamps(t, n)
        assert {d for d in after if after[d] != before[n].get(d)} == {bucket}
    want = sorted([(i, i % 20) for i in range(200) if i % 20 != 7] + [(999, 7)])
    got = lambda: sorted((r["item_number"], r["offer_id"]) for r in t.read("offer_items").collect())
    assert got() == want and t.read("member_offers").filter("offer_id = 7").count() == 0
    t.publish(0)  # a replay gives the same rows
    assert got() == want and t.prepared(0) and not t.prepared(1)


def test_a_bucket_that_loses_its_last_row_is_emptied(spark, tables):
    t = tables
    touched = t.touched(spark.createDataFrame([(i,) for i in range(20)], "offer_id bigint"))
    none = {n: t.rows(n, touched).filter("false") for n in t.schemas}
    t.apply(3, touched, none)
    assert t.read("offer_items").count() == 0 and t.read("member_offers").count() == 0
    t.apply(4, t.touched(spark.createDataFrame([], "offer_id bigint")), none)  # nothing touched, nothing changed
    assert not t.prepared(4)


# --- list locations -------------------------------------------------------------------

def by_window(df):
    """The same columns with a window over each whole offer."""
    order = Window.partitionBy("offer_id").orderBy("arrival", "event_id")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    x = df.withColumn("s", F.when(F.col("sets"), F.struct("location")))
    x = x.withColumn("prev_location", F.last("s", ignorenulls=True).over(before)["location"])
    x = x.withColumn("effective", F.col("is_list") & F.col("sets") & ~F.col("location").eqNullSafe(F.col("prev_location")))
    n = F.sum(F.col("effective").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return x.drop("s").withColumn("round", F.when(F.col("effective"), n).cast("int"))


def steps(spark, n, hot):
    rng = random.Random(n)
    rows = [(o, None, None, rng.choice(["a", "b", None]), False, True) for o in range(40) if o % 3]
    for i in range(n):
        is_list = rng.random() < 0.7
        rows.append((0 if rng.random() < hot else rng.randrange(40), T0 + timedelta(seconds=rng.randrange(n)), f"e{i}",
                     rng.choice(["a", "b", "c", None]), is_list, not is_list or rng.random() < 0.8))
    return spark.createDataFrame(rows, "offer_id bigint, arrival timestamp, event_id string, location string, is_list boolean, sets boolean")


@pytest.mark.parametrize("n, hot, size", [(3000, 0.9, 16), (3000, 0.0, 1024), (200, 0.5, 1), (0, 0, 4)])
def test_the_two_level_scan_equals_a_window(spark, n, hot, size):
    df = steps(spark, n, hot)
    cols = ["offer_id", "event_id", "location", "prev_location", "effective", "round"]
    shown = lambda d: sorted((tuple(r) for r in d.select(*cols).collect()), key=str)
    assert shown(running_locations(df, ["arrival", "event_id"], size)) == shown(by_window(df))


def test_a_hot_offer_is_spread_over_tasks(spark):
    df = steps(spark, 20_000, 0.9)
    s = sliced(df, "offer_id", ["arrival", "event_id"], 64)
    assert max(r["count"] for r in s.groupBy("offer_id", "slice").count().collect()) <= 64
    tasks = [r["count"] for r in s.repartition(8, "offer_id", "slice").groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) == 8 and max(tasks) <= 2 * sorted(tasks)[4]


# --- serving views --------------------------------------------------------------------

def items_of(spark, rows):
    return spark.createDataFrame(rows, "offer_id bigint, item_type string, item_number bigint")


def brute_chunks(spark, rows, size):
    bits = {r["n"]: r["b"] for r in spark.createDataFrame([(n,) for _, _, n in set(rows)], "n bigint").select("n", item_bits(F.col("n")).alias("b")).collect()}
    out = {}
    for o, t, n in set(rows):
        mine = [bits[m] for a, b, m in set(rows) if (a, b) == (o, t)]
        depth = next(d for d in range(33) if sum(m.startswith(bits[n][:d]) for m in mine) <= size or d == 32)
        out.setdefault((o, t, bits[n][:depth]), []).append(n)
    return {k: sorted(v) for k, v in out.items()}


def chunks_of(df):
    return {(r["offer_id"], r["item_type"], r["chunk"]): list(r["items"]) for r in df.collect()}


def test_chunks_split_where_they_are_full_and_changes_equal_a_rebuild(spark):
    small = [(1, "A", n) for n in range(7)] + [(2, "A", n) for n in range(4)] + [(3, "B", 1)]
    large = [(1, "A", n) for n in range(60)] + [(1, "A", 5)] * 3 + [(1, "B", n) for n in range(9)] + [(2, "A", 0)]
    old, new = item_chunks(items_of(spark, small), 8), item_chunks(items_of(spark, large), 8)
    assert chunks_of(old) == brute_chunks(spark, small, 8) and chunks_of(new) == brute_chunks(spark, large, 8)
    assert set(chunks_of(old)) == {(1, "A", ""), (2, "A", ""), (3, "B", "")}
    assert max(len(v) for v in chunks_of(new).values()) <= 8
    ups, dels = chunk_changes(old, new, spark.createDataFrame([(1,), (2,)], "offer_id bigint"))
    view = chunks_of(old)
    for r in dels.collect():
        del view[r["offer_id"], r["item_type"], r["chunk"]]
    view |= chunks_of(ups)
    assert view == chunks_of(new) | {(3, "B", ""): [1]}  # the offer that was not updated stays
    assert (1, "A", "") in {tuple(r) for r in dels.collect()}
    again = chunk_changes(new, new, spark.createDataFrame([(1,), (2,)], "offer_id bigint"))
    assert [d.count() for d in again] == [0, 0]


def test_the_kept_up_view_equals_a_new_one_and_reads_no_audience(spark):
    rng = random.Random(1)
    audience = {(o, f"u{m}") for o in range(6) for m in range(30) if rng.random() < 0.3}
    audience.add((0, "u0"))
    after, delta = set(audience), []
    for round_ in range(1, 5):
        for _ in range(60):
            pair = (rng.randrange(6), f"u{rng.randrange(34)}")
            if any(d[:2] == pair and d[3] == round_ for d in delta):
                continue
            delta.append((*pair, "delete" if pair in after else "add", round_))
            after ^= {pair}
    delta += [(*pair, "delete", 5) for pair in after if pair[1] == "u0"]
    after = {pair for pair in after if pair[1] != "u0"}
    one = lambda s: spark.createDataFrame(sorted(s), "offer_id bigint, membership_uuid string")
    view = member_entries(one(audience))
    changes = net_changes(spark.createDataFrame(delta, "offer_id bigint, membership_uuid string, action string, round int"))
    ups, dels = member_view(view, changes)
    got = {r["membership_uuid"]: list(r["offer_ids"]) for r in view.collect()}
    for r in dels.collect():
        got.pop(r["membership_uuid"], None)
    got |= {r["membership_uuid"]: list(r["offer_ids"]) for r in ups.collect()}
    assert got == {r["membership_uuid"]: list(r["offer_ids"]) for r in member_entries(one(after)).collect()}
    assert dels.count() > 0
