"""SimHash, embeddings, components, toxicity, quality and packing, and the pipeline."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from promoflow.llm import decontam, embed_pq, packing, pii, quality, simhash, toxicity
from promoflow.llm.common import table
from promoflow.llm.components import connected_components
from promoflow.llm.queries import VOCABULARY

VOCAB = public_tokenizers.path(VOCABULARY)
SMALL = "/root/testdata/sf0.001"


class Sets:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 400)] + [(7, 7), (500, 501), (501, 500), (None, 1)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 400)} | {500: 500, 501: 500}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- SimHash --------------------------------------------------------------------------

def brute_simhash(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in __import__("re").split("[\x20\x09-\x0D]+", w) if x]
    sh = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprints_match_brute_force(spark):
    texts = ["a b c d", "A  b\tc\nd", "one", "one two", "", None, " \x0b ", "É é x y É", "z " * 70_000, "a b c d e f"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, fp string")
    got = {r["doc_id"]: r["fingerprint"] for r in simhash.simhash_components(df).collect()}
    assert got == {i: f"{brute_simhash(t):016x}" for i, t in enumerate(texts)}
    (h,) = spark.sql("select xxhash64('a b c')").first()
    assert h % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


def test_index_links_exactly_what_is_near(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40, dtype=np.int64).astype(np.uint64)
    codes = {0, 1, 2**64 - 1, 2**63}
    for b in base:  # families around a centre, the first one larger than a leaf
        for _ in range(3000 if b == base[0] else 12):
            flips = rng.integers(0, 64, rng.integers(0, 4))
            codes.add(int(b) ^ int(np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64))) if len(flips) else int(b))
    # a chain under one 32-bit head, for heads that go over several leaves and partitions
    codes |= {(5 << 32) | int(x) for x in rng.integers(0, 2**14, 3000)}
    codes = np.array(sorted(codes), np.uint64)
    sets = Sets(codes.tolist())
    for i, c in enumerate(codes):
        for j in np.flatnonzero(np.bitwise_count(c ^ codes[i + 1:]) <= 3):
            sets.join(int(c), int(codes[i + 1 + j]))
    df = spark.createDataFrame([(i, int(c.view(np.int64))) for i, c in enumerate(codes)], "doc_id bigint, fp bigint")
    got = simhash.fingerprint_groups(df).collect()
    groups = {}
    for r in got:
        groups.setdefault(r["root"], set()).add(r["fp"] % 2**64)
    want = {}
    for c in codes.tolist():
        want.setdefault(sets.find(c), set()).add(c)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
    first = {int(c): i for i, c in enumerate(codes)}
    assert all(r["component_id"] == min(first[c] for c in groups[r["root"]]) for r in got)


def test_one_row_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(500))
    rows = [(5, text), (3, text), (3, text), (None, text), (9, text + " tail"), (7, "other text here now"), (None, "alone here now"),
            (8, ""), (6, None)]
    df = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id bigint, text string, __row string")
    kept = simhash.drop_near_copies(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [3, 6, 7, None]
    assert simhash.drop_near_copies(df.filter("false")).count() == 0


# --- embeddings -----------------------------------------------------------------------

def test_embedding_links_match_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(None, [1.0, 0.0], 1), (900_000, None, 1), (900_001, [0.0, 0.0], 1), (900_002, [float("nan"), 1.0], 1),
            (900_003, [1.0, None], 1), (900_004, [float("inf"), 1.0], 1), (900_005, [], 1), (900_006, [1.0, 0.0], None)]
    centre = rng.normal(size=16)
    x = [*(centre + rng.normal(size=16) * 0.05 for _ in range(1300)), *rng.normal(size=(500, 16))]  # one group above a block
    x += [x[0]] * 30 + [-x[1], x[2] * 1e30, x[3] * 1e-30]
    x = [np.asarray(v, np.float32) for v in x]
    lab = [1 if i < 1300 or i % 3 else 2 for i in range(len(x))]
    rows += [(i, [float(c) for c in v], k) for i, (v, k) in enumerate(zip(x, lab, strict=True))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = {r["vec_id"]: r for r in embed_pq.cosine_components(df, list_rows=300).collect()}
    u = np.array(x, np.float64)
    u /= np.abs(u).max(1, keepdims=True)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = (u @ u.T >= 0.98) & (np.array(lab)[:, None] == np.array(lab)[None])
    np.fill_diagonal(near, False)
    sets = Sets(range(len(x)))
    for i, j in zip(*np.nonzero(np.triu(near)), strict=True):
        sets.join(int(i), int(j))
    for i in range(len(x)):
        r = got[i]
        assert (r["n_links"], r["component_id"], r["kept"]) == (near[i].sum(), sets.find(i), sets.find(i) == i)
    for v in range(900_000, 900_007):
        assert (got[v]["n_links"], got[v]["component_id"], got[v]["kept"]) == (0, v, True)
    assert got[None]["n_links"] == 0 and not got[None]["kept"]
    assert embed_pq.cosine_components(df.filter("false")).count() == 0


# --- toxicity and quality -------------------------------------------------------------

def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    v = toxicity.toxicity_verdicts(docs, labels)
    n = {(r["toxic"], r["predicted"]): r["n"] for r in
         v.filter("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").agg(F.count("*").alias("n")).collect()}
    # Some labelled texts of this table hold no toxic word at all.
    assert n[1, 1] >= 0.8 * (n[1, 1] + n.get((1, 0), 0))
    assert n.get((0, 1), 0) <= 0.01 * (n[0, 0] + n.get((0, 1), 0))
    ids = [r["doc_id"] for r in v.select("doc_id", "held_out").filter("held_out").limit(50).collect()]
    assert all(zlib.crc32(str(i).encode()) % 3 == 1 for i in ids)


def test_training_rows_are_bounded_for_repeated_ids(spark):
    ids = [r["id"] for r in spark.range(200).filter(~toxicity.held_out(F.col("id"))).limit(21).collect()]
    hot, others = ids[0], ids[1:]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in ids], "doc_id bigint, quality int, toxic int")
    copies = [(hot, "you moron")] * 500 + [(i, f"text {i}") for i in others] + [(others[0], "text 2nd"), (others[1], None)]
    got = toxicity.training_rows(spark.createDataFrame(copies, "doc_id bigint, text string"), labels).collect()
    assert sorted(str(r["text"]) for r in got) == sorted({str(t) for _, t in copies})
    many = [(hot, f"you moron {k}") for k in range(500)] + [(i, f"text {i}") for i in others]
    got = toxicity.training_rows(spark.createDataFrame(many, "doc_id bigint, text string"), labels, 30).collect()
    assert len(got) == 30 and {f"text {i}" for i in others} < {r["text"] for r in got}


def test_scores_without_labels_and_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (None, "", "y"), (2, "you idiot " * 30_000, None), (2, "fine", None)],
                                 "doc_id bigint, text string, score string").withColumns({"source": F.lit(None).cast("string"), "lang": F.lit("en")})
    labels = spark.createDataFrame([(1, None, None), (2, 5, 7), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    got = toxicity.toxicity_verdicts(docs, labels).collect()
    assert [r["score"] for r in got] == [0.5] * 4 and sum(r["held_out"] for r in got) == 0 + (zlib.crc32(b"1") % 3 == 1) + 2 * (zlib.crc32(b"2") % 3 == 1)
    assert toxicity.toxicity_verdicts(docs.filter("false"), labels).count() == 0
    got = quality.quality_report(docs, labels).collect()
    assert len(got) == 4 and all(0 <= r["score"] <= 1 for r in got)
    assert quality.quality_report(docs.filter("false"), labels).count() == 0


def test_sparse_sites_shrink_toward_their_host(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents").select("doc_id", "text", F.lit("big").alias("source"),
                                                F.when(F.col("doc_id") == 5, "rare").otherwise("main").alias("lang"))
    rows = quality.score_quality(docs, table(spark, sf, "labels")).select(F.col("__row")["lang"].alias("lang"), "__doc", "__host", "__path").collect()
    total = sum(r["__doc"] for r in rows)
    (rare,) = [r for r in rows if r["lang"] == "rare"]
    assert rare["__path"] == pytest.approx(rare["__host"])  # nothing of its own is left
    assert rare["__host"] == pytest.approx((total - rare["__doc"]) / (len(rows) - 1), abs=0.01)


# --- packing --------------------------------------------------------------------------

def test_pieces_carry_the_tokenizers_ids_and_fill_sequences(spark):
    texts = ["", None, "Hello, world 123 éè \U0001f600\n\n x", "<|endoftext|> inside", "a " * 5000, "don't  stop"] + [f"row {i}" for i in range(300)]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(2, texts[2], 0)], "doc_id bigint, text string, length int").repartition(5)
    rows = packing.pack(df, VOCAB).collect()
    t = Tokenizer.from_file(VOCAB)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
        assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    assert len(by[2]) == 2
    for i, text in enumerate(texts):
        want = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        got = [x for r in sorted(by[i], key=lambda r: r["start"]) for x in r["ids"]]
        assert got == (want * 2 if i == 2 else want) and by[i][0]["doc_tokens"] == len(want)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(df.filter("false"), VOCAB).count() == 0


def test_shortest_pack_first_places_every_length():
    hist = {2048: 3, 1300: 10, 700: 25, 48: 7, 1: 5000, 600: 11}
    patterns = packing.shortest_pack_first(hist)
    placed = {}
    for count, runs in patterns:
        assert sum(n * k for n, k in runs) <= 2048
        for n, k in runs:
            placed[n] = placed.get(n, 0) + count * k
    assert placed == hist
    assert packing.shortest_pack_first({}) == []


# --- pipeline -------------------------------------------------------------------------

def test_pipeline_keeps_and_packs_what_its_stages_decide(spark):
    docs = table(spark, SMALL, "documents")
    toxic = {r["doc_id"] for r in toxicity.toxicity_verdicts(docs, table(spark, SMALL, "labels")).filter("predicted = 1").collect()}
    left = docs.filter(~F.col("doc_id").isin(*toxic)) if toxic else docs
    comp = {r["doc_id"]: r["component_id"] for r in simhash.simhash_components(left).collect()}
    left = left.filter(F.col("doc_id").isin(*{c for c in comp.values()}))
    bad = {r["doc_id"] for r in decontam.contamination(left, table(spark, SMALL, "benchmark")).filter("contaminated").collect()}
    texts = {r["doc_id"]: r["text"] for r in pii.pseudonym_report(left).collect() if r["doc_id"] not in bad}
    rows = corpus_pipeline.run(spark, SMALL).collect()
    t, got = Tokenizer.from_file(VOCAB), {}
    for r in sorted(rows, key=lambda r: r["start"]):
        got.setdefault(r["doc_id"], []).extend(r["ids"])
    assert {k: t.decode(v[:-1], skip_special_tokens=False) for k, v in got.items()} == texts
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_return_the_columns_of_documents(spark):
    docs = table(spark, SMALL, "documents").withColumn("__score", F.lit("own"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns
        assert stage(spark, docs.filter("false"), SMALL).count() == 0
