"""SimHash near-duplicates over a Gray-order hierarchical index.

Every distinct 64-bit fingerprint is cut into ``max_distance + 3`` blocks.  Two fingerprints
within ``max_distance`` bits agree on at least three blocks, so for each choice of blocks
the bits are permuted to bring those first, and the Gray rank of the permuted code is
sorted by range.  Codes with the same leading blocks then stand together: the shared head
is the top node of the hierarchy, runs of ``LEAF`` codes are its leaves, ``NODE`` codes a
lower node.  A node keeps the bits its codes share and their pattern; a pair of nodes is
dropped whole once the differences in shared bits exceed the distance.  Only links that
join two so far separate parts leave a task, so a group of n codes emits under n edges.

Defined cases: a null text counts as the empty text; no words give fingerprint zero, which
links like any other; rows with a null id take part in links, and their component is the
smallest id reachable, null where no row reached has an id; repeated rows repeat in the
result; an empty table gives an empty table; extra columns are carried through.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from promoflow.llm.common import prepare, utf8, whole_row, written
from promoflow.llm.components import connected_components

#: Codes of a leaf and of a node below it.
LEAF, NODE = 1024, 32
_PART = 1 << 15


def simhash64(text: bytes, words_per_shingle: int = 3) -> int:
    """Signed 64-bit fingerprint of one whole text."""
    words = text.lower().split()
    k = min(words_per_shingle, len(words))
    if not k:
        return 0
    n, ones = len(words) - k + 1, np.zeros(64, np.int64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False))
    hashes = (xxhash.xxh64_intdigest(s, 42) for s in shingles)
    for start in range(0, n, _PART):
        h = np.fromiter(hashes, np.uint64, min(_PART, n - start))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, words_per_shingle: int = 3) -> Column:
    @arrow_udf("bigint")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([simhash64(t, words_per_shingle) for t in utf8(texts)], pa.int64())
    return run(text)


class GrayTables:
    """The block permutations for one distance, and the ranks they give."""

    def __init__(self, max_distance: int):
        self.d, blocks = max_distance, max_distance + 3
        cuts = [64 * i // blocks for i in range(blocks + 1)]
        self.blocks = [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:], strict=False)]
        self.orders = [(*c, *(b for b in range(blocks) if b not in c)) for c in combinations(range(blocks), 3)]
        self.heads = [sum(self.blocks[b][1] for b in o[:3]) for o in self.orders]

    def rank(self, codes: np.ndarray, t: int) -> np.ndarray:
        """Gray rank of the permuted codes, shifted so that signed order is rank order."""
        out = np.zeros_like(codes)
        for b in self.orders[t]:
            lo, n = self.blocks[b]
            out = (out << np.uint64(n)) | ((codes >> np.uint64(lo)) & np.uint64((1 << n) - 1))
        for s in (1, 2, 4, 8, 16, 32):
            out ^= out >> np.uint64(s)
        return (out ^ np.uint64(1 << 63)).view(np.int64)

    def code(self, rank: np.ndarray, t: int) -> np.ndarray:
        """The codes that ``rank`` was taken of."""
        r = rank.view(np.uint64) ^ np.uint64(1 << 63)
        r = r ^ (r >> np.uint64(1))
        out, at = np.zeros_like(r), 64
        for b in self.orders[t]:
            lo, n = self.blocks[b]
            at -= n
            out |= ((r >> np.uint64(at)) & np.uint64((1 << n) - 1)) << np.uint64(lo)
        return out

    def head(self, rank: np.ndarray, t: int) -> np.ndarray:
        return rank >> np.int64(64 - self.heads[t])


def _nodes(codes: np.ndarray):
    """(codes by node, present, shared bits, pattern) of runs of NODE codes."""
    n = -(-len(codes) // NODE)
    grid = np.zeros((n, NODE), np.uint64)
    grid.reshape(-1)[:len(codes)] = codes
    there = (np.arange(n * NODE) < len(codes)).reshape(n, NODE)
    at = np.arange(0, len(codes), NODE)
    low, high = np.bitwise_and.reduceat(codes, at), np.bitwise_or.reduceat(codes, at)
    return grid, there, ~(low ^ high), low


def links_between(a: np.ndarray, b: np.ndarray, d: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of ``a`` and ``b`` within ``d`` bits; pairs of nodes whose shared bits
    already differ in more are never opened.  ``same``: a is b, each pair once."""
    (ga, ta, sa, pa_), (gb, tb, sb, pb) = _nodes(a), _nodes(b)
    apart = np.bitwise_count((pa_[:, None] ^ pb[None]) & sa[:, None] & sb[None])
    i, j = np.nonzero(apart <= d)
    if same:
        i, j = i[i <= j], j[i <= j]
    found = []
    for s in range(0, len(i), 512):
        x, y = i[s:s + 512], j[s:s + 512]
        near = np.bitwise_count(ga[x][:, :, None] ^ gb[y][:, None, :]) <= d
        near &= ta[x][:, :, None] & tb[y][:, None, :]
        k, u, v = np.nonzero(near)
        found.append((x[k] * NODE + u, y[k] * NODE + v))
    u, v = (np.concatenate(z) for z in zip(*found, strict=False)) if found else (np.zeros(0, np.int64),) * 2
    return (u[u < v], v[u < v]) if same else (u, v)


def forest(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For each of n items the smallest item it is connected to."""
    low = np.arange(n)
    while len(u):
        a, b = low[u], low[v]
        far = a != b
        if not far.any():
            break
        u, v, a, b = u[far], v[far], a[far], b[far]
        np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))
        while (low[low] != low).any():
            low = low[low]
    return low


_OUT = "t int, head bigint, first bigint, shared bigint, pattern bigint, codes binary, a bigint, b bigint"
_TYPES = [pa.int32(), *[pa.int64()] * 4, pa.binary(), pa.int64(), pa.int64()]
_NAMES = [c.split()[0] for c in _OUT.split(", ")]


def _edge_rows(codes: np.ndarray, low: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(low != np.arange(len(low)))
    a, b = codes[at].view(np.int64), codes[low[at]].view(np.int64)
    cols = [pa.nulls(len(at), t) for t in _TYPES[:6]] + [pa.array(a), pa.array(b)]
    return pa.RecordBatch.from_arrays(cols, _NAMES)


def _leaf_rows(t: int, head: int, codes: np.ndarray, d: int):
    """A leaf, and the edges that connect its own codes."""
    low, high = np.bitwise_and.reduce(codes), np.bitwise_or.reduce(codes)
    row = [t, head, codes[:1].view(np.int64)[0], (~(low ^ high)).view(np.int64), low.view(np.int64), codes.tobytes()]
    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip([*row, None, None], _TYPES, strict=True)], _NAMES)
    if len(codes) > 1:
        yield _edge_rows(codes, forest(len(codes), *links_between(codes, codes, d, True)))


def _index_partition(tables: GrayTables):
    """Sorted (t, rank) rows to edges, and leaves for the heads that may go on elsewhere."""
    d = tables.d

    def closed(t, ranks):
        """Edges of whole heads: small ones in step, larger ones by leaves."""
        codes, head = tables.code(ranks, t), tables.head(ranks, t)
        start = np.flatnonzero(np.r_[True, head[1:] != head[:-1]])
        size = np.diff(np.r_[start, len(head)])
        mine = np.repeat(size, size)
        keep = (mine > 1) & (mine <= NODE)
        c, h = codes[keep], head[keep]
        us, vs, i = [], [], np.arange(len(c))
        for step in range(1, NODE):
            i = i[i + step < len(c)]
            i = i[h[i] == h[i + step]]
            if not len(i):
                break
            near = np.bitwise_count(c[i] ^ c[i + step]) <= d
            us.append(i[near])
            vs.append(i[near] + step)
        if us:
            yield _edge_rows(c, forest(len(c), np.concatenate(us), np.concatenate(vs)))
        for s, n in zip(start[size > NODE], size[size > NODE], strict=False):
            yield from leaves(t, ranks[s:s + n]) if n > LEAF else [_edge_rows(
                codes[s:s + n], forest(n, *links_between(codes[s:s + n], codes[s:s + n], d, True)))]

    def leaves(t, ranks):
        codes, head = tables.code(ranks, t), int(tables.head(ranks[:1], t)[0])
        for s in range(0, len(codes), LEAF):
            yield from _leaf_rows(t, head, codes[s:s + LEAF], d)

    def run(batches):
        t, held, fresh = None, np.zeros(0, np.int64), True  # held: rows of the last head so far
        for batch in batches:
            ts, ranks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for part in np.split(np.arange(len(ts)), np.flatnonzero(ts[1:] != ts[:-1]) + 1):
                if not len(part):
                    continue
                if ts[part[0]] != t:
                    if len(held):  # the head ends here, but may have begun in the partition before
                        yield from leaves(t, held) if fresh else closed(t, held)
                        fresh = False
                    t, held = int(ts[part[0]]), np.zeros(0, np.int64)
                held = np.r_[held, ranks[part]]
                head = tables.head(held, t)
                if fresh and head[0] != head[-1]:
                    n = int(np.searchsorted(head, head[0], "right"))
                    yield from leaves(t, held[:n])
                    held, head, fresh = held[n:], head[n:], False
                n = int(np.searchsorted(head, head[-1], "left"))
                if n:
                    yield from closed(t, held[:n])
                    held = held[n:]
                while len(held) > 2 * LEAF:  # a head of any size goes out leaf by leaf
                    yield from leaves(t, held[:LEAF])
                    held, fresh = held[LEAF:], True
        if len(held):
            yield from leaves(t, held)

    return run


def _leaf_pairs(d: int):
    def run(batches):
        for batch in batches:
            for x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                u, v = links_between(a, b, d, False)
                low = forest(len(a) + len(b), u, v + len(a))
                codes, at = np.r_[a, b].view(np.int64), np.flatnonzero(low != np.arange(len(low)))
                yield pa.RecordBatch.from_arrays([pa.array(codes[at]), pa.array(codes[low[at]])], ["a", "b"])
    return run


def near_edges(codes: DataFrame, max_distance: int = 3) -> DataFrame:
    """(a, b) edges that connect exactly the distinct codes linked within the distance."""
    tables = GrayTables(max_distance)

    def spread(batches):
        for batch in batches:
            c = batch.column(0).to_numpy().view(np.uint64)
            for t in range(len(tables.orders)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(c), t, np.int32)), pa.array(tables.rank(c, t))], ["t", "rank"])

    # Ranks are distinct within a table, so ranges cut a head of any size into even parts.
    entries = written(codes.mapInArrow(spread, "t int, rank bigint"), "gray")
    found = written(entries.repartitionByRange("t", "rank").sortWithinPartitions("t", "rank")
                    .mapInArrow(_index_partition(tables), _OUT), "leaves")
    leaf = found.filter("codes is not null").select(*_NAMES[:6])
    other = leaf.select(*[F.col(c).alias(f"{c}2") for c in _NAMES[:6]])
    apart = F.bit_count(F.col("pattern").bitwiseXOR(F.col("pattern2")).bitwiseAND(F.col("shared"))
                        .bitwiseAND(F.col("shared2")))
    pairs = (leaf.join(other, (F.col("t") == F.col("t2")) & (F.col("head") == F.col("head2"))
                       & (F.col("first") < F.col("first2")) & (apart <= max_distance))
             .select("codes", "codes2"))
    return (found.filter("a is not null").select("a", "b")
            .union(pairs.mapInArrow(_leaf_pairs(max_distance), "a bigint, b bigint")))


def fingerprint_groups(prints: DataFrame, max_distance: int = 3) -> DataFrame:
    """(fp, root, component_id) of each distinct ``fp`` of ``prints`` (doc_id, fp)."""
    first = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "prints")
    comp = connected_components(near_edges(first.select("fp"), max_distance))
    rooted = written(first.join(comp, F.col("fp") == F.col("node"), "left")
                     .select("fp", "first", F.coalesce("root", "fp").alias("root")), "roots")
    # Written before the join, so that the rows of a large component can be split.
    lowest = written(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "lowest")
    return rooted.join(lowest, "root").select("fp", "root", "component_id")


def simhash_components(docs: DataFrame, words_per_shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``."""
    prepare(docs.sparkSession)
    prints = written(docs.select("doc_id", fingerprint(F.col("text"), words_per_shingle).alias("fp")), "simhash")
    groups = written(fingerprint_groups(prints, max_distance), "groups")
    return prints.join(groups, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, words_per_shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """One row of ``docs`` per component, that of the smallest id (null last), columns kept."""
    prepare(docs.sparkSession)
    rows = written(whole_row(docs).select(
        "__row", F.monotonically_increasing_id().alias("__n"),
        fingerprint(F.col("__row")["text"], words_per_shingle).alias("__fp")), "simhash-rows")
    prints = rows.select("__n", F.col("__row")["doc_id"].alias("doc_id"), F.col("__fp").alias("fp"))
    groups = written(fingerprint_groups(prints.select("doc_id", "fp"), max_distance), "groups")
    kept = (prints.join(groups.select("fp", "root"), "fp").groupBy("root")
            .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__n")).alias("k")).select(F.col("k.__n").alias("__n")))
    # One plan at every size: the kept rows grow with the input, so they are never broadcast.
    return rows.join(written(kept, "kept").hint("merge"), "__n", "left_semi").select("__row.*")
