"""Running list locations without a window over one offer.

A list event compares its file with the location the event before it left, which is a
running last value per offer, and its round is a running count.  Both are found by a
two-level scan: the rows are sorted by (offer, order) over ranges, so a hot offer is spread
like any other rows, and cut into slices of ``SLICE`` rows; a slice is summed up on its
own, the few summaries of an offer are scanned, and what a slice starts from is joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promoflow.operators.joins import kept

#: Rows of a slice; a power of two, so that slices never go over a task's rows.
SLICE = 1024


def sliced(rows: DataFrame, key: str, order: list[str], slice_rows: int = SLICE) -> DataFrame:
    """``rows`` with ``at`` (their place in the order of key and ``order``) and ``slice``,
    runs of at most ``slice_rows`` places, as a kept table."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = [key, *order]
    placed = rows.repartitionByRange(n, *cuts).sortWithinPartitions(*cuts).withColumn("at", F.monotonically_increasing_id())
    return kept(placed.withColumn("slice", F.floor(F.col("at") / slice_rows)), "sliced")


def running_locations(rows: DataFrame, order: list[str], slice_rows: int = SLICE) -> DataFrame:
    """Which list events of an offer change its list, in the order of arrival.

    ``rows``: every step of the offers of a batch (offer_id, ``order``, location, is_list,
    sets): stored rows and offer events set the location without being list events, list
    events that fail set nothing.  Adds ``prev_location`` (what the last step before the row
    set), ``effective`` (a list event that sets another location) and ``round`` (its number
    among the offer's effective events, NULL for the others).
    """
    s = sliced(rows, "offer_id", order, slice_rows).withColumn("set", F.when(F.col("sets"), F.struct("location", "is_list")))
    here = Window.partitionBy("offer_id", "slice").orderBy("at")
    before = F.last("set", ignorenulls=True).over(here.rowsBetween(Window.unboundedPreceding, -1))
    changes = F.col("sets") & F.col("is_list")
    s = s.withColumn("known", before).withColumn(
        "inner", F.coalesce(changes & F.col("known").isNotNull() & ~F.col("location").eqNullSafe(F.col("known.location")), F.lit(False)))
    s = s.withColumn("so_far", F.sum(F.col("inner").cast("bigint")).over(here.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # The one row of a slice that needs to know what came before it is the first that sets.
    s = s.withColumn("opens", F.col("sets") & F.col("known").isNull())

    sums = s.groupBy("offer_id", "slice").agg(
        F.max_by("set", F.when(F.col("sets"), F.col("at"))).alias("last"), F.max(F.when(F.col("opens"), F.col("set"))).alias("first"),
        F.sum(F.col("inner").cast("bigint")).alias("n"))
    over = Window.partitionBy("offer_id").orderBy("slice")
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("carry", F.last("last", ignorenulls=True).over(earlier)).withColumn(
        "opened", F.coalesce(F.col("first.is_list") & ~F.col("first.location").eqNullSafe(F.col("carry.location")), F.lit(False)))
    sums = sums.select("offer_id", "slice", "carry", "opened", F.coalesce(
        F.sum(F.col("n") + F.col("opened").cast("bigint")).over(earlier), F.lit(0)).alias("rounds"))

    known = F.coalesce("known", "carry")
    effective = F.col("inner") | (F.col("opens") & F.col("opened"))
    begun = F.col("known").isNotNull() | F.col("opens")
    number = F.col("rounds") + F.col("so_far") + (F.col("opened") & begun).cast("bigint")
    return s.join(sums, ["offer_id", "slice"]).select(
        *rows.columns, known["location"].alias("prev_location"), effective.alias("effective"),
        F.when(effective, number).cast("int").alias("round"))
