"""Hard-negative mining with segment summaries.

For every anchor: its best rows of the same label are its positives, and for each positive
the best rows of other labels that score between a share of it and itself are its
negatives.  Components are whole numbers and scores integer inner products, so results are
exact and ties are by id.

A vector is stored with the mean and the deviation (length of what the mean leaves) of each
of its segments, on several levels, each level's segments cut finer.  For two vectors the
sum over segments of length times the means' product, plus or minus the deviations'
product, bounds the score.  Anchors meet a block of rows level by level: pairs whose upper
bound stays under what the anchor still needs, or whose lower bound is over the highest
score it can use, are left before the next level; the pairs that remain are scored.

Rows of one length and label are cut into blocks of at most ``BLOCK``, so a hot label is
spread over tasks.  Anchors go in batches of at most ``batch_bytes``, each to all blocks,
once for the positives and once for the negatives; a task keeps the best few an anchor (and
positive) and emits those alone.

Defined cases: rows with a null label or vector, or with a null or non-finite component,
take no part, nor do those with a scaled component of ``LIMIT`` or more (scores would leave
64 bits); vectors of different lengths never meet; an empty vector scores 0; repeated rows
are rows of their own, and an anchor's copy is one of its other rows; a row with a null id
is no anchor and comes last among equal scores; an empty table gives an empty table; other
columns are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promoflow.llm.common import prepare, written

#: Rows of a block, anchors met with it at a time, and pairs scored one by one at a time.
BLOCK, AT_ONCE, PAIRS = 2048, 256, 16_384
#: Scaled components stay under this, and 2 ** 52 * 2 ** 10 components fit in 64 bits.
LIMIT = 1 << 26
#: Length of the segments of each level.
LEVELS = (64, 16, 4)
_NO_ID = np.iinfo(np.int64).max


def summaries(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level (means, deviations) of the segments of every row, both scaled so that a
    plain product of two rows is the segments' part of the bound."""
    out = []
    for size in LEVELS:
        cuts = np.arange(0, x.shape[1], size)
        length = np.diff(np.r_[cuts, x.shape[1]])
        total = np.add.reduceat(x, cuts, axis=1) if len(cuts) else np.zeros((len(x), 0))
        mean = total / length
        rest = x - np.repeat(mean, length, axis=1)
        spread = np.add.reduceat(rest * rest, cuts, axis=1) if len(cuts) else np.zeros((len(x), 0))
        out.append((mean * np.sqrt(length), np.sqrt(spread)))
    return out


@dataclass
class Rows:
    """Vectors of one length: ids, components, length of each and the stored summaries."""

    ids: np.ndarray
    x: np.ndarray
    norm: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def of(ids: np.ndarray, x: np.ndarray) -> Rows:
        return Rows(ids, x, np.sqrt((x * x).sum(1)), summaries(x))

    def at(self, i) -> Rows:
        return Rows(self.ids[i], self.x[i], self.norm[i], [(m[i], d[i]) for m, d in self.levels])

    def summary_bytes(self) -> bytes:
        return b"".join(a.tobytes() for level in self.levels for a in level)

    @staticmethod
    def stored(ids: bytes, x: bytes, summary: bytes, width: int) -> Rows:
        who = np.frombuffer(ids, np.int64)
        values = np.frombuffer(x, np.int32).reshape(len(who), width).astype(np.float64)
        flat, levels, at = np.frombuffer(summary, np.float64), [], 0
        for size in LEVELS:
            k, pair = -(-width // size), []
            for _ in range(2):
                pair.append(flat[at:at + len(who) * k].reshape(len(who), k))
                at += len(who) * k
            levels.append(tuple(pair))
        return Rows(who, values, np.sqrt((values * values).sum(1)), levels)


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of every row of ``a`` with every row of ``b``."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2 ** 53:  # every partial sum is a whole double
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def pairs_between(a: Rows, b: Rows, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score) of all pairs with low[i] <= score <= high[i]; others are left at the
    first level whose bounds rule them out."""
    i, j, maybe = np.arange(len(a.ids)), np.arange(len(b.ids)), None
    for level in range(len(LEVELS)):
        (ma, da), (mb, db) = a.levels[level], b.levels[level]
        middle, reach = ma[i] @ mb[j].T, da[i] @ db[j].T
        reach += 1e-9 * np.outer(a.norm[i], b.norm[j]) + 1e-6  # what rounding may take
        near = (middle + reach >= low[i][:, None]) & (middle - reach <= high[i][:, None])
        maybe = near if maybe is None else maybe & near
        rows, cols = np.flatnonzero(maybe.any(1)), np.flatnonzero(maybe.any(0))
        i, j, maybe = i[rows], j[cols], maybe[np.ix_(rows, cols)]
        if not len(i):
            return (np.zeros(0, np.int64),) * 3
    u, v = np.nonzero(maybe)
    if 8 * len(u) >= maybe.size:
        score = exact_scores(a.x[i], b.x[j])[u, v]
    else:
        whole = np.abs(a.x[i]).max(initial=0) * np.abs(b.x[j]).max(initial=0) * a.x.shape[1] < 2 ** 53
        kind = np.float64 if whole else np.int64
        score = np.concatenate([
            np.einsum("ij,ij->i", a.x[i[u[s:s + PAIRS]]].astype(kind), b.x[j[v[s:s + PAIRS]]].astype(kind)).astype(np.int64)
            for s in range(0, len(u), PAIRS)])
    u, v = i[u], j[v]
    keep = (score >= low[u]) & (score <= high[u])
    return u[keep], v[keep], score[keep]


class Best:
    """The best ``k`` (score, id) of each of n slots, higher scores and then smaller ids first."""

    def __init__(self, n: int, k: int):
        self.k, self.slot = k, np.zeros(0, np.int64)
        self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64)
        #: Score that a slot still needs; under every score while it has room.
        self.needs = np.full(n, np.iinfo(np.int64).min)

    def add(self, slot: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, id_ = np.r_[self.slot, slot], np.r_[self.score, score], np.r_[self.id, id_]
        order = np.lexsort((id_, -score, slot))
        slot, score, id_ = slot[order], score[order], id_[order]
        start = np.r_[True, slot[1:] != slot[:-1]]
        rank = np.arange(len(slot)) - np.maximum.accumulate(np.where(start, np.arange(len(slot)), 0))
        keep = rank < self.k
        self.slot, self.score, self.id = slot[keep], score[keep], id_[keep]
        full = rank[keep] == self.k - 1
        self.needs[self.slot[full]] = self.score[full]


# --- stored rows ----------------------------------------------------------------------

_ENTRY = ["size", "label", "rid", "id", "q"]
_BLOCK = "size int, label bigint, rids binary, ids binary, units binary, summary binary"


def _to_blocks(batches):
    """Sorted rows to blocks of at most BLOCK rows of one length and label."""
    def block(key, rows):
        ids = np.array([r[1] for r in rows], np.int64)
        x = np.array([r[2] for r in rows], np.float64).reshape(len(rows), key[0])
        values = [*key, np.array([r[0] for r in rows], np.int64).tobytes(), ids.tobytes(), x.astype(np.int32).tobytes(),
                  Rows.of(ids, x).summary_bytes()]
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)],
                                          ["size", "label", "rids", "ids", "units", "summary"])

    key, rows = None, []
    for batch in batches:
        for r in zip(*(batch.column(c).to_pylist() for c in _ENTRY), strict=True):
            if r[:2] != key or len(rows) == BLOCK:
                if rows:
                    yield block(key, rows)
                key, rows = r[:2], []
            rows.append(r[2:])
    if rows:
        yield block(key, rows)


@dataclass
class Batch:
    """Anchors of one length, ordered as in the batch's tables."""

    rows: Rows
    rid: np.ndarray
    label: np.ndarray


def _positives(anchors: dict[int, Batch], k: int):
    """Per task the best k other rows of the same label of every anchor."""
    def run(batches):
        best = {size: Best(len(a.rid), k) for size, a in anchors.items()}
        for size, label, rids, ids, units, summary in _stored(batches):
            a = anchors.get(size)
            if a is None:
                continue
            own, b, rids = np.flatnonzero(a.label == label), Rows.stored(ids, units, summary, size), np.frombuffer(rids, np.int64)
            for s in range(0, len(own), AT_ONCE):
                part = own[s:s + AT_ONCE]
                high = np.full(len(part), np.iinfo(np.int64).max)
                i, j, score = pairs_between(a.rows.at(part), b, best[size].needs[part], high)
                other = a.rid[part][i] != rids[j]
                best[size].add(part[i][other], score[other], b.ids[j][other])
        for size, a in anchors.items():
            f = best[size]
            if len(f.slot):
                yield pa.RecordBatch.from_arrays([pa.array(a.rid[f.slot]), pa.array(f.id), pa.array(f.score)], ["rid", "id", "score"])
    return run


def _negatives(anchors: dict[int, Batch], slots: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], k: int):
    """Per task the best k rows of other labels for every (anchor, positive) slot.  ``slots``
    has per length: anchor's place, rank of the positive, least and highest score."""
    def run(batches):
        best = {size: Best(len(s[0]), k) for size, s in slots.items()}
        for size, label, _rids, ids, units, summary in _stored(batches):
            if size not in slots:
                continue
            a, b, (place, _, least, most) = anchors[size], Rows.stored(ids, units, summary, size), slots[size]
            here = np.flatnonzero(a.label[place] != label)
            if not len(here):
                continue
            # Slots of an anchor stand together: its range is the widest of theirs.
            need = np.maximum(least, best[size].needs)[here]
            first = np.flatnonzero(np.r_[True, np.diff(place[here]) != 0])
            who, count = place[here][first], np.diff(np.r_[first, len(here)])
            low, high = np.minimum.reduceat(need, first), np.maximum.reduceat(most[here], first)
            for s in range(0, len(who), AT_ONCE):
                cut = slice(s, s + AT_ONCE)
                i, j, score = pairs_between(a.rows.at(who[cut]), b, low[cut], high[cut])
                # Every found pair serves each of the anchor's slots whose range it lies in.
                times = count[cut][i]
                slot = here[np.repeat(first[cut][i], times) + _within(times)]
                j, score = np.repeat(j, times), np.repeat(score, times)
                fits = (score >= np.maximum(least, best[size].needs)[slot]) & (score <= most[slot])
                best[size].add(slot[fits], score[fits], b.ids[j[fits]])
        for size, (place, rank, _, _) in slots.items():
            f = best[size]
            if len(f.slot):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors[size].rid[place[f.slot]]), pa.array(rank[f.slot]), pa.array(f.id), pa.array(f.score)],
                    ["rid", "nth", "id", "score"])
    return run


def _within(times: np.ndarray) -> np.ndarray:
    """0, 1, .. times - 1 of every element, one after the other."""
    return np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)


def _stored(batches):
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in ("size", "label", "rids", "ids", "units", "summary")), strict=True)


def _first(df: DataFrame, key: list[str], k: int, name: str) -> DataFrame:
    """The best k rows of every key, numbered from 1.  A key has k rows a task at most."""
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "id"))), 1, k)
    rows = df.groupBy(*key).agg(best.alias("best")).select(*key, F.posexplode("best").alias("at", "x"))
    return rows.select(*key, (F.col("at") + 1).alias(name), F.col("x.id").alias("id"), (-F.col("x.s")).alias("score"))


def usable(vector: Column) -> Column:
    big = F.lit(float("inf"))
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big))


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, least_percent: int = 80,
                   scale: float = 256.0, batch_bytes: int = 8 << 20) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of
    ``vectors`` (vec_id, embedding, label); ``is_anchor`` is a condition on ``vec_id``."""
    spark = prepare(vectors.sparkSession)
    q = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    rows = (vectors.select("vec_id", "embedding", F.col("label").cast("bigint").alias("label"))
            .filter(F.col("label").isNotNull() & usable(F.col("embedding")))
            .filter(F.forall("embedding", lambda x: F.abs(x.cast("double") * scale) < LIMIT - 1))
            .select(F.size("embedding").alias("size"), "label", F.coalesce("vec_id", F.lit(int(_NO_ID))).alias("id"),
                    F.coalesce(is_anchor, F.lit(False)).alias("anchor"), q.alias("q"),
                    F.monotonically_increasing_id().alias("rid")))
    rows = written(rows, "whole-vectors")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    order = ["size", "label", "rid"]
    blocks = written(rows.select(*_ENTRY).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
                     .mapInArrow(_to_blocks, _BLOCK), "vector-blocks")
    anchors = rows.filter("anchor")
    out = None
    for low, high in _batches(anchors, batch_bytes):
        part = anchors.filter(F.col("rid").between(low, high)).select("size", "label", "rid", "id", "q").collect()
        found = _mined(blocks, part, positives, negatives, least_percent)
        out = found if out is None else out.union(found)
    if out is None:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
                                         "positive_score bigint, negative_score bigint")
    return out


def _batches(anchors: DataFrame, batch_bytes: int) -> list[tuple[int, int]]:
    """Ranges of row numbers with some ``batch_bytes`` of anchors each, cut between stretches
    of 4096 row numbers, whose sums are read one after the other."""
    stretch = 4096
    groups = (anchors.groupBy(F.floor(F.col("rid") / stretch).alias("g"))
              .agg(F.sum(F.col("size") * 16 + 64).alias("bytes"), F.min("rid").alias("low"), F.max("rid").alias("high"))
              .orderBy("g"))
    out: list[list[int]] = []
    have = 0
    for r in groups.toLocalIterator():
        if out and have + r["bytes"] <= batch_bytes:
            out[-1][1], have = r["high"], have + r["bytes"]
        else:
            out.append([r["low"], r["high"]])
            have = r["bytes"]
    return [(a, b) for a, b in out]


def _mined(blocks: DataFrame, part: list, positives: int, negatives: int, least_percent: int) -> DataFrame:
    spark = blocks.sparkSession
    anchors: dict[int, Batch] = {}
    for size in {r["size"] for r in part}:
        own = [r for r in part if r["size"] == size]
        x = np.array([r["q"] for r in own], np.float64).reshape(len(own), size)
        anchors[size] = Batch(Rows.of(np.array([r["id"] for r in own], np.int64), x), np.array([r["rid"] for r in own], np.int64),
                              np.array([r["label"] for r in own], np.int64))
    best = written(_first(blocks.mapInArrow(_positives(anchors, positives), "rid bigint, id bigint, score bigint"), ["rid"], positives, "nth"),
                   "positives")
    slots, place_of = {}, {int(rid): (size, i) for size, a in anchors.items() for i, rid in enumerate(a.rid)}
    chosen: dict[int, list] = {}
    for r in best.collect():  # at most ``positives`` an anchor of the batch
        low, high = -(-least_percent * r["score"] // 100), r["score"]
        if low <= high:
            size, i = place_of[r["rid"]]
            chosen.setdefault(size, []).append((i, r["nth"], low, high))
    for size, found in chosen.items():
        slots[size] = tuple(np.array(c, np.int64) for c in zip(*sorted(found), strict=True))
    who = spark.createDataFrame(pa.table({"rid": pa.array([r["rid"] for r in part], pa.int64()),
                                          "anchor_id": pa.array([r["id"] for r in part], pa.int64())}))
    far = written(_first(blocks.mapInArrow(_negatives(anchors, slots, negatives), "rid bigint, nth bigint, id bigint, score bigint"),
                         ["rid", "nth"], negatives, "rank"), "negatives")
    known = lambda c: F.when(F.col(c) != F.lit(int(_NO_ID)), F.col(c))
    best = best.select("rid", F.col("nth").cast("bigint").alias("nth"), F.col("id").alias("p"), F.col("score").alias("positive_score"))
    return (far.join(best, ["rid", "nth"]).join(who, "rid").select(
        "anchor_id", known("p").alias("positive_id"), F.col("rank").cast("int").alias("rank"), known("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score")))
