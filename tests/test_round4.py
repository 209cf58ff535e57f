"""Findings of round 4: items move once into chunks, long lists are packed, texts are parsed once."""

import glob
import os
import random
from datetime import datetime

from pyspark.sql import functions as F

from promoflow import queries as Q
from promoflow.operators import serve as SV
from promoflow.operators import sites as ST
from promoflow.operators.end_state import EndState
from test_scale import brute_chunks, chunks_of, items_of


def size_of(path):
    return sum(os.path.getsize(f) for f in glob.glob(f"{path}/*.parquet"))


def test_chunks_are_made_without_rows_by_item_and_level(spark, monkeypatch):  # F6, F7
    rows, real = [], SV.kept

    def counted(df, name):
        out = real(df, name)
        rows.append(out.count())
        return out
    monkeypatch.setattr(SV, "kept", counted)
    items = [(1, "A", n) for n in range(700)]
    got = chunks_of(SV.item_chunks(items_of(spark, items), 4))
    assert got == brute_chunks(spark, items, 4) and max(rows) <= len(items)


def test_offers_of_many_cells_have_the_chunks_of_their_items(spark, monkeypatch):  # F6, F7
    monkeypatch.setattr(SV, "_CELL_ITEMS", 16)
    monkeypatch.setattr(SV, "_CELL_CHUNKS", 2)
    rng = random.Random(4)
    items = [(o, "A", rng.randrange(900)) for o, n in ((1, 5), (2, 40), (3, 300)) for _ in range(n)]
    items += [(4, "B", n % 3) for n in range(90)]  # many lines, few items
    for size in (3, 8):
        assert chunks_of(SV.item_chunks(items_of(spark, items), size)) == brute_chunks(spark, items, size)
    # A NULL item stands alone, one without an offer is left out.
    odd = items_of(spark, [(1, "A", None), (1, "A", 2), (None, "A", 3)])
    assert {(r["offer_id"], r["chunk"], tuple(r["items"])) for r in SV.item_chunks(odd, 3).collect()} == {(1, None, ()), (1, "", (2,))}


def test_rows_with_the_same_long_list_take_the_room_of_one(spark, tmp_path):  # F2, F3, F5, F10
    lists = spark.createDataFrame([('["S:ALL"]', list(range(20000))), ('["F:a"]', list(range(0, 40000, 3)))], "combination string, club_list array<bigint>")
    rows = spark.range(600).select(
        F.concat(F.lit("e"), "id").alias("event_id"), F.when(F.col("id") % 3 == 2, F.array("id")).alias("club_list"),
        F.when(F.col("id") % 3 == 0, '["S:ALL"]').when(F.col("id") % 3 == 1, '["F:a"]').alias("combination"))
    got = ST.attach_club_lists(ST.as_text(rows), ST.as_text(lists))
    want = ST.attach_club_lists(rows, lists).withColumn("club_list", F.array_join("club_list", ","))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    got.coalesce(1).write.parquet(f"{tmp_path}/rows")
    assert size_of(f"{tmp_path}/rows") < 2_000_000  # 40 MB of text, two lists
    stores = spark.range(40).select("id", F.explode(F.sequence(F.lit(0), F.lit(19999))).alias("club_id"))
    stores.coalesce(1).write.parquet(f"{tmp_path}/stores")
    assert size_of(f"{tmp_path}/stores") < 400_000


def tables(spark, path):
    """One order with two lines, of which one is a discount on the item's price."""
    at = datetime(1995, 1, 1)
    write = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    write("customer", [(3, "x", 1, 10.0, "BUILDING")], "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    write("orders", [(1, 3, "F", 5.0, at, "1-URGENT")], "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    write("lineitem", [(1, 7, 5, k, 20.0, 1.0, 0.05, 0.01, flag, "F", at) for k, flag in ((1, "R"), (2, "N"))],
          "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    return str(path)


def test_awards_are_trimmed_on_events_parsed_once(spark, tmp_path, monkeypatch):  # F15
    parsed, real = [], Q.decode_events
    monkeypatch.setattr(Q, "decode_events", lambda *a, **k: parsed.append(1) or real(*a, **k))
    assert [tuple(r) for r in Q.q_trim_awards(spark, tables(spark, tmp_path)).collect()] == [("O000000000001", 2, 1, "2,3")]
    assert len(parsed) == 1


def test_readers_take_in_few_rows_with_long_lists(spark):  # F4
    widest = 60_000 * 8  # bytes of the list of every store at 1 GB
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize", "4096")) * widest <= 200 << 20


def test_offers_with_the_same_lists_are_put_together_once(spark):  # F1
    current = spark.createDataFrame([(1, "u1", "c", 0.5), (2, "u9", "c", 0.5)], "offer_id bigint, membership_uuid string, membership_id string, propensity double")
    targets = spark.createDataFrame([(o, 1, "a") for o in range(1, 40)], "offer_id bigint, round int, list_key string")
    members = spark.createDataFrame([("a", f"u{m}", f"k{m}", None) for m in range(3)], "list_key string, membership_uuid string, membership_id string, propensity double")
    end = EndState(current, targets, members)
    want = {(o, f"u{m}", "c" if (o, m) == (1, 1) else f"k{m}") for o in range(1, 40) for m in range(3)}
    assert {tuple(r)[:3] for r in end.audience.collect()} == want and end.audience.count() == len(want)
    plan = end.audience._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode(offer_ids") < plan.index("array_except(all_ids")  # offers are written out above that
