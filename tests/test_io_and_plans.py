"""Big-list reader, plan shape checks, driver contract smoke."""

import os
import tempfile

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as E
from promoflow.operators.snapshot import replace_by_key
from promoflow.sources.biglists import read_biglists

SF = "/root/testdata/sf0.001"
LIB = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "promoflow")


def test_read_biglists_keys_by_relative_path(spark):
    d = tempfile.mkdtemp(prefix="bl-")
    os.makedirs(f"{d}/stores")
    with open(f"{d}/stores/a.csv", "w") as f:
        f.write("1\n2\n")
    with open(f"{d}/stores/b.csv", "w") as f:
        f.write("MembershipNumber,Propensity\n9,0.5\n")
    got = read_biglists(spark, [f"{d}/stores/a.csv"], base=d).collect()
    assert sorted((r["list_key"], r["c0"]) for r in got) == [("stores/a.csv", "1"), ("stores/a.csv", "2")]
    got = read_biglists(spark, [f"{d}/stores/b.csv"], header=True, base=d).collect()
    assert [(r["list_key"], r["c0"], r["c1"]) for r in got] == [("stores/b.csv", "9", "0.5")]


def test_replace_by_key_deletes_children_of_updated_keys_without_rows(spark):
    cur = spark.createDataFrame([(1, 10), (1, 11), (2, 20)], "offer_id bigint, item bigint")
    new = spark.createDataFrame([(2, 21)], "offer_id bigint, item bigint")
    keys = spark.createDataFrame([(1,), (2,)], "offer_id bigint")
    assert sorted(tuple(r) for r in replace_by_key(cur, new, keys, ["offer_id"]).collect()) == [(2, 21)]


def test_library_has_no_udfs_or_driver_collects():
    bad = []
    for root, dirs, files in os.walk(LIB):
        # The optional training-data operators may use Arrow functions and bounded reads.
        dirs[:] = [x for x in dirs if x != "llm"]
        for fn in files:
            if fn.endswith(".py"):
                text = open(os.path.join(root, fn)).read()
                for pat in ("@udf", "F.udf(", "pandas_udf", ".rdd.", ".collect()", "localCheckpoint", "crossJoin"):
                    if pat in text:
                        bad.append((fn, pat))
    assert bad == []


def test_plans_have_no_cartesian_product_or_python(spark):
    for name in ["audience_delta", "upsert_offers", "resolve_sites", "offer_items_all"]:
        plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_entry_and_oracle_at_smallest_scale(spark):
    df = E.entry(spark)
    assert df.count() > 0
    con = duckdb.connect()
    for t in ["customer", "orders", "events", "lineitem", "part", "supplier", "nation"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name in ["audience_delta", "intake_outcomes", "replace_offer_items"]:
        got = sorted(tuple(r) for r in E.queries()[name](spark, SF).collect())
        exp = sorted(tuple(r) for r in con.execute(
            f"SELECT {', '.join(E.queries()[name](spark, SF).columns)} FROM ({E.oracle_sql()[name]})").fetchall())
        assert got == exp, name


def test_sink_batches_respect_the_size_and_keep_every_row(spark):
    from promoflow.operators.serve import sink_batches
    df = spark.range(0, 10_000, numPartitions=3)
    out = sink_batches(df, 1_000)
    sizes = out.groupBy("batch_partition", "batch_no").count().collect()
    assert max(r["count"] for r in sizes) <= 1_000
    assert sum(r["count"] for r in sizes) == 10_000
    assert out.select("id").distinct().count() == 10_000


def test_landed_member_files_have_parts_each_with_its_header(spark):
    from promoflow import testbed
    from promoflow.settings import CARD_COLUMN
    from promoflow.sources.biglists import list_manifest, read_list_lines
    d = "/root/testdata/sf0.001"
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"  # small tables are put together again
    was = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    try:
        lines = read_list_lines(spark, testbed.landed_member_files(spark, d))
    finally:
        spark.conf.set(coalesce, was)
    files = {r["list_key"]: r["n"] for r in lines.groupBy("list_key").agg(F.countDistinct("file").alias("n")).collect()}
    assert len(files) == 20 and max(files.values()) > 1
    named = {r["list_key"]: r["named"] for r in list_manifest(lines, CARD_COLUMN).collect()}
    assert sum(named.values()) == 7
    heads = lines.filter(F.array_contains("cells", CARD_COLUMN)).count()
    assert lines.count() - heads == testbed.member_files(spark, d).count()
