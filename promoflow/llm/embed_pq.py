"""Embedding near-duplicates by product quantisation over coarse inverted lists.

Coarse centroids and residual codebooks are fitted on a bounded sample; every vector is
indexed.  A unit vector joins the list of its nearest centroid, with its residual's
subspace codes and the length of what the codes miss.  As a query it probes every list
whose cell can hold a vector within the link radius: by the distance to the plane between
the two centroids, so the probes are sufficient and no link is lost.  In a probed list the
asymmetric table-lookup distance, less the member's coding error, drops what cannot link;
the rest is decided by exact cosine in double precision.

Lists are cut into blocks of ``BLOCK`` vectors, and only pairs of blocks whose balls come
near meet, so a list of any size is spread over tasks; a pair of lists is met from its
lower list only.  A task emits each vector's number of links and the edges of a spanning
forest, never all pairs; equal vectors of a label are one vector with a weight.

Defined cases: a vector that is null, empty, zero, or holds null or non-finite components,
or has a null label, links with nothing and is its own component; vectors of different
lengths never link; repeated rows are vectors of their own, linked to each other; a null
vec_id takes part and is never kept; an empty table gives an empty table; other columns
are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoflow.llm.common import prepare, written
from promoflow.llm.components import connected_components
from promoflow.llm.simhash import forest

#: Vectors of a block.
BLOCK = 512
_PARTS, _WORDS = 8, 64


def _kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    c = x[np.random.default_rng(5).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = _nearest(x, c)[0]
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centroid, all squared distances)."""
    d = np.maximum(0, (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1))
    return d.argmin(1), d


class Quantiser:
    """Coarse centroids and residual codebooks of unit vectors."""

    def __init__(self, sample: np.ndarray, lists: int):
        self.centroids = _kmeans(sample, max(1, min(lists, len(sample))))
        self.apart = np.sqrt(np.maximum(0, _nearest(self.centroids, self.centroids)[1]))
        self.cuts = np.unique(np.linspace(0, sample.shape[1], _PARTS + 1).astype(int))
        rest = sample - self.centroids[_nearest(sample, self.centroids)[0]]
        self.books = [_kmeans(rest[:, a:b], min(_WORDS, len(rest))) for a, b in self._spans()]

    def _spans(self):
        return list(zip(self.cuts[:-1], self.cuts[1:], strict=True))

    def encode(self, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, length of what the codes miss) of residuals."""
        codes, miss = np.zeros((len(rest), len(self.books)), np.uint8), np.zeros(len(rest))
        for s, ((a, b), book) in enumerate(zip(self._spans(), self.books, strict=True)):
            codes[:, s] = _nearest(rest[:, a:b], book)[0]
            miss += ((rest[:, a:b] - book[codes[:, s]]) ** 2).sum(1)
        return codes, np.sqrt(miss)

    def lookup(self, rest: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Distances of exact residuals (rows) to coded ones (columns), from tables."""
        total = np.zeros((len(rest), len(codes)))
        for s, ((a, b), book) in enumerate(zip(self._spans(), self.books, strict=True)):
            total += _nearest(rest[:, a:b], book)[1][:, codes[:, s]]
        return np.sqrt(total)

    def probes(self, near: np.ndarray, d2: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """(vector, list) for every higher list whose cell may hold something in the radius."""
        own = d2[np.arange(len(near)), near][:, None]
        reach = d2 - own <= 2 * (radius + 1e-7) * self.apart[near]
        return np.nonzero(reach & (np.arange(len(self.centroids))[None] > near[:, None]))


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of a list array as unit vectors in double precision, filled up with zeros."""
    flat, offsets = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64), vectors.offsets.to_numpy()
    size = np.diff(offsets)
    out = np.zeros((len(size), width))
    out[np.arange(width)[None] < size[:, None]] = flat
    # By the largest component first, so that no square overflows or vanishes.
    out /= np.abs(out).max(1, keepdims=True)
    return out / np.sqrt((out * out).sum(1, keepdims=True))


_KEY = ["label", "size", "list"]
_ENTRY = "label bigint, size int, list int, query boolean, place binary, cid bigint, weight bigint, unit binary, codes binary, miss double"
_BLOCK = ("label bigint, size int, list int, query boolean, block bigint, cids binary, weights binary, units binary, "
          "codes binary, misses binary, centre array<double>, ball double")
_LINKS = "cid bigint, links bigint, a bigint, b bigint"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _index_rows(q: Quantiser, width: int, radius: float):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            label, size, cid, weight = (batch.column(i) for i in (0, 1, 2, 3))
            unit = _matrix(batch.column(4), width)
            near, d2 = _nearest(unit, q.centroids)
            codes, miss = q.encode(unit - q.centroids[near])
            who, where = q.probes(near, d2, radius)
            raw = [u.tobytes() for u in unit]
            code = [c.tobytes() for c in codes]
            take = np.r_[np.arange(len(unit)), who]
            at = pa.array(take)
            query = np.r_[np.zeros(len(unit), bool), np.ones(len(who), bool)]
            blob = lambda v: pa.array(v, pa.binary()).take(at)
            yield pa.RecordBatch.from_arrays(
                [label.take(at), size.take(at), pa.array(np.r_[near, where].astype(np.int32)), pa.array(query),
                 blob(code), cid.take(at), weight.take(at), blob(raw), blob(code), pa.array(miss[take])], _names(_ENTRY))
    return run


def _to_blocks(width: int):
    """Sorted entries to blocks of at most BLOCK entries of one list and role."""
    def block(key, rows):
        unit = np.frombuffer(b"".join(r[2] for r in rows), np.float64).reshape(len(rows), width)
        centre = unit.mean(0)
        ball = float(np.sqrt(((unit - centre) ** 2).sum(1).max()))
        ints = [np.array([r[i] for r in rows], np.int64).tobytes() for i in (0, 1)]
        values = [*key, int(rows[0][0]), *ints, unit.tobytes(), b"".join(r[3] for r in rows),
                  np.array([r[4] for r in rows]).tobytes(), centre.tolist(), ball]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), *[pa.binary()] * 5,
                 pa.list_(pa.float64()), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], _names(_BLOCK))

    def run(batches):
        key, rows = None, []
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r[:4] != key or len(rows) == BLOCK:
                    if rows:
                        yield block(key, rows)
                    key, rows = r[:4], []
                rows.append(r[5:])
        if rows:
            yield block(key, rows)
    return run


def _block_links(q: Quantiser, width: int, least: float, radius: float):
    def run(batches):
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at, same, *blobs = r
                (ac, aw, au, codes, miss), (bc, bw, bu) = blobs[:5], blobs[5:]
                ac, aw, bc, bw = (np.frombuffer(x, np.int64) for x in (ac, aw, bc, bw))
                au, bu = (np.frombuffer(x, np.float64).reshape(-1, width) for x in (au, bu))
                codes = np.frombuffer(codes, np.uint8).reshape(len(ac), -1)
                maybe = q.lookup(bu - q.centroids[at], codes) <= radius + np.frombuffer(miss, np.float64) + 1e-7
                if same:
                    maybe &= np.arange(len(bc))[:, None] > np.arange(len(ac))[None]
                j, i = np.nonzero(maybe)
                exact = np.concatenate([np.einsum("ij,ij->i", au[i[s:s + 8192]], bu[j[s:s + 8192]])
                                        for s in range(0, len(i), 8192)]) if len(i) else np.zeros(0)
                j, i = j[exact >= least], i[exact >= least]
                if not len(i):
                    continue
                n = np.zeros(len(ac) + (0 if same else len(bc)), np.int64)
                shift = 0 if same else len(ac)
                np.add.at(n, i, bw[j])
                np.add.at(n, j + shift, aw[i])
                cids = ac if same else np.r_[ac, bc]
                low = forest(len(cids), i, j + shift)
                some, edge = np.flatnonzero(n), np.flatnonzero(low != np.arange(len(low)))
                nulls = lambda k: pa.nulls(k, pa.int64())
                for cols in ([pa.array(cids[some]), pa.array(n[some]), nulls(len(some)), nulls(len(some))],
                             [nulls(len(edge)), nulls(len(edge)), pa.array(cids[edge]), pa.array(cids[low[edge]])]):
                    yield pa.RecordBatch.from_arrays(cols, _names(_LINKS))
    return run


def usable(vector) -> F.Column:
    """No null, only finite components, and one that is not zero."""
    big = F.lit(float("inf"))
    return (vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big))
            & F.exists(vector, lambda x: x != 0))


def cosine_components(vectors: DataFrame, least_cosine: float = 0.98, list_rows: int = 8_000, max_lists: int = 4_096,
                      sample_rows: int = 20_000) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding, label)."""
    spark = prepare(vectors.sparkSession)
    rows = vectors.select("vec_id", "embedding", F.col("label").cast("bigint").alias("label"))
    classes = written(
        rows.filter(F.col("label").isNotNull() & usable(F.col("embedding"))).groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("first"), F.count("*").alias("weight"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")
    n, width = classes.agg(F.count("*"), F.max(F.size("embedding"))).first()
    radius = float(np.sqrt(2 - 2 * least_cosine))
    if n:
        sample = classes.orderBy(F.xxhash64("embedding", "label"), "cid").limit(sample_rows).select("embedding").toArrow()
        unit = _matrix(sample.column(0).combine_chunks(), width)
        q = Quantiser(unit, max(1, min(max_lists, n // list_rows)))
        # The quantiser travels with the functions: at most max_lists centroids and the codebooks.
        # Ranges over the distinct class ids cut any list into even parts.
        entries = written(classes.select("label", F.size("embedding").alias("size"), "cid", "weight", "embedding")
                          .mapInArrow(_index_rows(q, width, radius), _ENTRY), "entries")
        order = [*_KEY, "query", "place", "cid"]
        blocks = written(entries.repartitionByRange(*order).sortWithinPartitions(*order)
                         .select(*_KEY, "query", "place", "cid", "weight", "unit", "codes", "miss")
                         .mapInArrow(_to_blocks(width), _BLOCK), "blocks")
        a = blocks.filter(~F.col("query"))
        b = blocks.select(*[F.col(c).alias(f"{c}2") for c in blocks.columns])
        gap = F.aggregate(F.zip_with("centre", "centre2", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
        reach = F.col("ball") + F.col("ball2") + radius + 1e-7
        same = ~F.col("query2") & (F.col("block") == F.col("block2"))
        meet = a.join(b, [F.col(c) == F.col(f"{c}2") for c in _KEY]
                      + [F.col("query2") | (F.col("block") <= F.col("block2")), gap <= reach * reach])
        found = written(meet.select("list", same.alias("same"), "cids", "weights", "units", "codes", "misses",
                                    "cids2", "weights2", "units2")
                        .mapInArrow(_block_links(q, width, least_cosine, radius), _LINKS), "links")
    else:
        found = spark.createDataFrame([], _LINKS)
    counts = found.filter("cid is not null").groupBy("cid").agg(F.sum("links").alias("links"))
    comp = connected_components(found.filter("a is not null").select("a", "b"))
    rooted = written(classes.join(counts, "cid", "left").join(comp, F.col("cid") == F.col("node"), "left").select(
        "label", "embedding", "first", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("root", "cid").alias("root")), "rooted")
    lowest = written(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "lowest")
    known = written(rooted.join(lowest, "root").select("label", "embedding", "n_links", "component_id"), "known")
    component = F.coalesce("component_id", F.when(F.col("n_links").isNull(), F.col("vec_id")))
    return rows.join(known, ["label", "embedding"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
