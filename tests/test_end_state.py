"""The audience after a batch, in tiles: against the spells, and what is moved and kept for it."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from promoflow.operators import audience as A
from promoflow.operators.end_state import EndState
from promoflow.operators.serve import net_changes
from promoflow.plans.list_batch import AppliedLists
from promoflow.session import checkpoint_dir
from promoflow.streaming.intake_stream import put

AUDIENCE = "offer_id bigint, membership_uuid string, membership_id string, propensity double"
TARGETS = "offer_id bigint, round int, list_key string, offer_source string"
MEMBERS = "list_key string, offer_source string, membership_uuid string, membership_id string, propensity double"


def random_batch(spark, seed, offers=12, people=15, files=5):
    """Lists that come back, lists without a member or a name, stored rows that come twice or
    have no member, offers that are stored and untouched."""
    rnd = random.Random(seed)
    uuid = lambda p: None if p == 0 else f"u{p}"
    prop = lambda: rnd.choice([None, 0.5, 1.5])
    current = [(o, uuid(p), f"c{rnd.randrange(3)}", prop()) for o in [None, *range(offers)] for p in range(people) if rnd.random() < 0.4]
    current += rnd.sample(current, 10)
    lists = [(f"f{i}", s) for i in range(files) for s in ("TIO", "TETRIS")]
    targets = [(o, r + 1, *rnd.choice([*lists, (None, "TIO"), ("none", "TIO")])) for o in range(1, offers) for r in range(rnd.choice([1, 2, 2, 3, 7]))]
    members = [(*x, uuid(p), f"c{rnd.randrange(3)}", prop()) for x in lists for p in range(people) if rnd.random() < 0.7]
    members += rnd.sample(members, 5)
    return tuple(spark.createDataFrame(rows, schema) for rows, schema in ((current, AUDIENCE), (targets, TARGETS), (members, MEMBERS)))


def shown(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_the_end_state_equals_the_spells(spark, seed):  # F2, F11
    current, targets, members = random_batch(spark, seed)
    spells = A.audience_spells(current, targets, members)
    cols = ["offer_id", "membership_uuid", "membership_id", "propensity"]
    want = (current.join(targets, "offer_id", "left_anti").select(*cols).unionByName(spells.filter("to_round = last_round").select(*cols)))
    end = EndState(current, targets, members, block=4, group=2)
    assert shown(end.audience, *cols) == shown(want, *cols)
    by = ["offer_id", "membership_uuid", "action"]
    assert shown(end.changes, *by) == shown(net_changes(A.spell_changes(spells)), *by)


def test_no_row_for_each_offer_and_member_is_moved_or_kept(spark):  # F2
    n_offers, n_members = 400, 300
    effective = spark.range(n_offers).select(
        F.col("id").alias("offer_id"), F.lit(1).alias("round"), F.lit("f").alias("location"), F.lit("TIO").alias("event_source"), F.lit(True).alias("effective"))
    files = spark.range(n_members).select(F.lit("f").alias("list_key"), F.col("id").cast("string").alias("c0"), F.lit(None).cast("string").alias("c1"))
    cards = spark.range(n_members).select(
        F.col("id").cast("string").alias("cardNumber"), F.concat(F.lit("u"), "id").alias("membershipId"), F.lit("Y").alias("current_ind"),
        F.lit("Y").alias("card_current_ind"), F.lit("ACTIVE").alias("cardStatus"), F.lit("MEMBERSHIPACCOUNT").alias("cardType"))
    tables = lambda: set(glob.glob(f"{checkpoint_dir(spark)}/work-*"))
    before = tables()
    df = AppliedLists(effective, spark.createDataFrame([], AUDIENCE), files, cards).end.audience
    rows = df.groupBy().agg(F.count("*").alias("n"), F.count_distinct("offer_id").alias("o"), F.count_distinct("membership_uuid").alias("m")).first()
    assert tuple(rows) == (n_offers * n_members, n_offers, n_members)
    assert max(spark.read.parquet(t).count() for t in tables() - before) <= n_offers + n_members
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" not in plan[:plan.index("explode(members")]  # rows are written out above the shuffles


def test_a_sink_by_day_has_a_file_a_day(spark, tmp_path):  # F11
    df = spark.range(0, 400, 1, 8).select(F.col("id").cast("string").alias("event_id"), F.when(F.col("id") % 20 > 0, F.date_add(
        F.lit("2024-01-01").cast("date"), (F.col("id") % 20).cast("int"))).alias("day"))
    put(df, str(tmp_path), "seen", 0, ("day",))
    assert len(glob.glob(f"{tmp_path}/seen/day=*/batch_id=0/*.parquet")) == 20
    got = spark.read.schema("event_id string, day date").parquet(f"{tmp_path}/seen")
    assert shown(got, "event_id", "day") == shown(df, "event_id", "day")
    put(df.limit(0), str(tmp_path), "none", 0, ("day",))
