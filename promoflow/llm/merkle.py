"""Merkle manifest of a table as a persistent path-copying tree.

A row's leaf is the hash of its fields.  The leaves of a scope stand in order of id; two
neighbours become their hash until one node, the scope's subroot, is left, and the
subroots in order of their scopes become the root in the same way.  The leaves are cut
into aligned blocks of ``2 ** HEIGHT``; a block builds its subtree alone, its top is a leaf
of the next stage, and so on, so that a stage of any size is spread over tasks and every
group is bounded by the block.

A tampered leaf makes a new version of the tree.  It copies its ancestors within its
block, shares every other node with version 0, and continues along the block's upper path,
which was found once for the block by the upper stages.  A leaf whose copied top equals
the block's own stays in version 0.

Defined cases: a null field is written ``-``; the null scope comes first and differs from
the empty one; rows with a null id come first in their scope and are never tampered; rows
of one id are ordered by leaf, repeated rows stand side by side, each with its own proof;
a lone leaf is its scope's subroot; an empty table gives an empty table; other columns are
left out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from promoflow.llm.common import prepare, written

#: Levels of an aligned block.
HEIGHT = 8
_WIDTH = 1 << HEIGHT
#: A step of a path without a sibling: the node's hash alone.
_ALONE = "-"


def digest_of(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf_of(fields: list[Column]) -> Column:
    """Hash of the fields in order, each with its length in bytes."""
    part = lambda c: F.when(c.isNull(), "-").otherwise(
        F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))
    return F.sha2(F.concat(*[part(c) for c in fields]), 256)


# --- one block ------------------------------------------------------------------------

def build(leaves: list[str], whole: bool) -> list[list[str]]:
    """Levels of a block's subtree, leaves first: to its single node if the block is the
    ``whole`` of its scope, else up the full height."""
    levels = [leaves]
    while len(levels[-1]) > 1 if whole else len(levels) <= HEIGHT:
        low = levels[-1]
        levels.append([digest_of("".join(low[i:i + 2])) for i in range(0, len(low), 2)])
    return levels


def siblings(levels: list[list[str]], at: int) -> list[str]:
    """Steps from a leaf to the top of its block: side and hash of each sibling."""
    out = []
    for low in levels[:-1]:
        other = at ^ 1
        out.append(_ALONE if other >= len(low) else ("L" if other < at else "R") + low[other])
        at >>= 1
    return out


def climbed(node: str, path: list[str]) -> list[str]:
    """The copied nodes along a path, one a step."""
    out = []
    for step in path:
        other = step[1:]
        node = digest_of(node if step == _ALONE else other + node if step[0] == "L" else node + other)
        out.append(node)
    return out


# --- stages ---------------------------------------------------------------------------

def ranked(rows: DataFrame, key: str, order: list[str], name: str) -> tuple[DataFrame, int]:
    """``rows`` with ``pos`` (rank within ``key`` by ``order``) and ``n`` (rows of the key),
    and the largest n.  ``order`` must end in a unique column, so that ranges cut any key
    and any run of ties; positions come from counts by range and key."""
    cuts = [key, *order]
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    low = F.lit((1 << 33) - 1)
    sorted_ = written(rows.repartitionByRange(n, *cuts).sortWithinPartitions(*cuts).withColumns(
        {"part": F.spark_partition_id(), "at": F.monotonically_increasing_id().bitwiseAND(low)}), name)
    runs = sorted_.groupBy(key, "part").agg(F.min("at").alias("first"), F.count("*").alias("here"))
    w = W.partitionBy(key)
    before = F.coalesce(F.sum("here").over(w.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = written(runs.select(key, "part", (before - F.col("first")).alias("shift"), F.sum("here").over(w).alias("n")),
                   f"{name}-runs")
    most = runs.agg(F.max("n")).first()[0] or 0
    return sorted_.join(runs, [key, "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift"), most


def in_blocks(nodes: DataFrame, fields: list[str]) -> DataFrame:
    """(key, block, n, nodes): nodes (key, pos, n, fields) of one aligned block in order."""
    return (nodes.groupBy("key", F.shiftright("pos", HEIGHT).alias("block"))
            .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", *fields))).alias("nodes")))


def _tops(batches):
    for b in batches:
        tops = [build([x["digest"] for x in nodes], n <= _WIDTH)[-1][0]
                for n, nodes in zip(b.column("n").to_pylist(), b.column("nodes").to_pylist(), strict=True)]
        up = [-(-n // _WIDTH) for n in b.column("n").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("key"), b.column("block"), pa.array(up, pa.int64()), pa.array(tops, pa.string())],
                                         ["key", "pos", "n", "digest"])


def _own_paths(batches):
    for b in batches:
        for key, block, n, nodes in zip(*(b.column(c).to_pylist() for c in ("key", "block", "n", "nodes")), strict=True):
            levels = build([x["digest"] for x in nodes], n <= _WIDTH)
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * len(nodes), pa.string()), pa.array([block] * len(nodes), pa.int64()),
                 pa.array([x["pos"] for x in nodes], pa.int64()), pa.array([levels[-1][0]] * len(nodes), pa.string()),
                 pa.array([siblings(levels, i) for i in range(len(nodes))], pa.list_(pa.string()))],
                ["key", "block", "pos", "top", "path"])


def tops_of(blocks: DataFrame) -> DataFrame:
    return blocks.select("key", "block", "n", F.col("nodes")).mapInArrow(_tops, "key string, pos bigint, n bigint, digest string")


def paths(nodes: DataFrame, most: int) -> DataFrame:
    """(key, pos, path, root) of nodes (key, pos, n, digest): the steps of each to the one
    node of its key, stage by stage; ``most`` is the largest n."""
    blocks = written(in_blocks(nodes, ["digest"]), "stage")
    own = blocks.mapInArrow(_own_paths, "key string, block bigint, pos bigint, top string, path array<string>")
    if most <= _WIDTH:
        return written(own.select("key", "pos", "path", F.col("top").alias("root")), "paths")
    above = paths(written(tops_of(blocks), "tops"), -(-most // _WIDTH))
    above = above.select("key", F.col("pos").alias("block"), F.col("path").alias("rest"), "root")
    return written(own.join(above, ["key", "block"]).select("key", "pos", F.concat("path", "rest").alias("path"), "root"), "paths")


# --- the manifest ---------------------------------------------------------------------

@dataclass
class Manifest:
    """Version 0: (key, block, n, nodes, up, subroot, root), a row a block of leaves.  A
    leaf has pos, digest, id and changed (its tampered hash, null if none); ``up`` is the
    block's path to the root."""

    blocks: DataFrame
    id_type: str


def manifest(docs: DataFrame, scope: str, id_: str, fields: Callable[[Callable[[str], Column]], list[Column]],
             tampered: Column, change: dict[str, Column]) -> Manifest:
    """The tree of ``docs``.  ``fields`` lists the hashed columns, taken through a function
    of the column's name; rows where ``tampered`` holds are hashed again with the columns of
    ``change`` in place of their own."""
    prepare(docs.sparkSession)
    own = lambda c: F.col(c).cast("string")
    new = lambda c: change[c].cast("string") if c in change else own(c)
    key = F.when(F.col(scope).isNull(), "").otherwise(F.concat(F.lit("="), F.col(scope)))  # null before the empty text
    leaves = written(docs.select(
        key.alias("key"), F.col(id_).alias("id"), leaf_of(fields(own)).alias("digest"),
        F.when(F.coalesce(tampered, F.lit(False)), leaf_of(fields(new))).alias("changed"),
        F.monotonically_increasing_id().alias("tie")), "leaves")
    nodes, most = ranked(leaves, "key", ["id", "digest", "tie"], "ranked-leaves")
    blocks = written(in_blocks(nodes, ["digest", "id", "changed"]), "leaf-blocks")
    sub = paths(written(tops_of(blocks), "tops"), -(-most // _WIDTH)).withColumnRenamed("root", "subroot")
    scopes = written(sub.groupBy("key").agg(F.min("subroot").alias("digest")), "subroots")
    scopes, n = ranked(scopes.select(F.lit("").alias("key"), F.col("key").alias("scope"), "digest"), "key", ["scope"], "ranked-scopes")
    scopes = written(scopes, "scopes")
    top = (paths(scopes.select("key", "pos", "n", "digest"), n).join(scopes.select("pos", "scope"), "pos")
           .select(F.col("scope").alias("key"), F.col("path").alias("rest"), "root"))
    up = (sub.join(top, "key").select("key", F.col("pos").alias("block"), F.concat("path", "rest").alias("up"), "subroot", "root"))
    return Manifest(blocks.join(up, ["key", "block"]), leaves.schema["id"].dataType.simpleString())


def _blocks_of(batches):
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in ("key", "block", "n", "nodes", "up", "subroot", "root")), strict=True)


def _report(id_type: pa.DataType):
    def run(batches):
        for _key, _block, n, nodes, up, subroot, root in _blocks_of(batches):
            levels = build([x["digest"] for x in nodes], n <= _WIDTH)
            roots: dict[str, str] = {}  # of each top, version 0 among them
            proofs, folded = [], []
            rest = "".join(s[1:] for s in up)
            for i, x in enumerate(nodes):
                path = siblings(levels, i)
                proofs.append(digest_of("".join(s[1:] for s in path) + rest))
                leaf = x["changed"] or x["digest"]
                top = climbed(leaf, path)[-1] if path else leaf
                if top not in roots:
                    roots[top] = climbed(top, up)[-1] if up else top
                folded.append(roots[top])
            k = len(nodes)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x["id"] for x in nodes], id_type), pa.array([x["digest"] for x in nodes], pa.string()),
                 pa.array([subroot] * k, pa.string()), pa.array([root] * k, pa.string()), pa.array(proofs, pa.string()),
                 pa.array(folded, pa.string()), pa.array([f == root for f in folded], pa.bool_())],
                ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
    return run


def _versions(id_type: pa.DataType):
    def run(batches):
        for key, _block, n, nodes, up, _subroot, _root in _blocks_of(batches):
            levels = build([x["digest"] for x in nodes], n <= _WIDTH)
            for i, x in enumerate(nodes):
                if x["changed"]:
                    copies = [x["changed"], *climbed(x["changed"], siblings(levels, i) + up)]
                    k = len(copies)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key[1:] if key else None] * k, pa.string()), pa.array([x["id"]] * k, id_type),
                         pa.array([x["pos"]] * k, pa.int64()), pa.array(range(k), pa.int32()), pa.array(copies, pa.string())],
                        ["scope", "id", "pos", "step", "digest"])
    return run


def _arrow_type(simple: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8(), "string": pa.string()}[simple]


def proofs(m: Manifest) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every leaf."""
    return m.blocks.mapInArrow(_report(_arrow_type(m.id_type)),
                               f"doc_id {m.id_type}, leaf string, subroot string, root string, proof_sha256 string, "
                               "folded_root string, verified boolean")


def version_nodes(m: Manifest) -> DataFrame:
    """(scope, id, pos, step, digest): the nodes each tampered leaf's version copies, from
    the leaf (step 0) to its root.  Every other node is version 0's."""
    return m.blocks.mapInArrow(_versions(_arrow_type(m.id_type)), f"scope string, id {m.id_type}, pos bigint, step int, digest string")


def document_manifest(docs: DataFrame) -> Manifest:
    """The manifest of ``documents`` by language, where the character count of every
    document whose id has a crc32 divisible by 7 is tampered with."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return manifest(docs, "lang", "doc_id", lambda c: [c(x) for x in ("doc_id", "source", "lang", "n_chars", "text")],
                    crc % 7 == 0, {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1})
