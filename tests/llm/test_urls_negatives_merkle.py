"""URL filters, hard negatives and the Merkle manifest against brute force."""

import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from promoflow.llm import merkle, negatives, urls
from promoflow.llm.queries import URL_RULES

# --- URL filters ----------------------------------------------------------------------

PAGES = [
    # page_id, url, html, rule, verdict
    (1, "http://A.example.com/de/5#top", None, "com/de/", "block"),
    (2, "https://x.net/1", '<head><link href="http://a.example.com/de/5/" rel="alternate canonical">', None, "block"),
    (3, "https://x.net/1?utm_source=a", "", None, "block"),
    (3, "https://x.net/1?utm_source=a", "", None, "block"),
    (4, "http://y.net/q", "<META content=\"0; URL='/z'\" http-equiv=Refresh>", None, "block"),
    (5, "http://www.y.net/z/", "<link rel=canonical href='//x.net/1'>", None, "block"),
    (6, "http://q.org/a", "<link rel=canonical href='http://x.net/1'>", "org/", "allow"),
    (7, None, "<link rel=canonical href='http://x.net/1'>", None, "allow"),
    (8, "no address", None, None, "allow"),
    (9, "http://q.net/a", "<link rel=canonical href='http://[bad/1'>", None, "allow"),
    (10, "ftp://x.net/1", None, None, "allow"),
    (11, "http://example.org/es/", None, "example.org/es/", "block"),
    (12, "http://sub.example.org/en/17", None, "example.org/en/1", "block"),
    (13, "http://example.org", None, None, "allow"),
    (14, "http://notexample.org/es/", None, "org/", "allow"),
    (15, "http://c.net/", '<!-- <link rel="canonical" href="http://b.com/de/1"> -->'
                          '<script>"<link rel=canonical href=http://b.com/de/1>"</script>', None, "allow"),
    (16, "http://d.net/", "<base href='http://b.com/de/'><link rel=canonical href=7>", None, "block"),
    (17, "http://e.net/", "<link rel=canonical href='http://org.com/x'><link rel=canonical href='http://f.org/'>", None, "allow"),
    (None, "http://z.com?x=://a.org/", "canonical " * 200_000, None, "allow"),
    (18, "http://b.com/en/" + "p/" * 100_000, None, None, "allow"),
    (19, "http://r.net/old", None, None, "block"),
    (20, "http://b.com/de", "", None, "block"),  # one address with /de/ below
    (21, "http://b.com/de/", "", "com/de/", "block"),
]


def pages_of(spark, rows):
    return spark.createDataFrame([(a, b, c, "clash", "clash") for a, b, c, _, _ in rows],
                                 "page_id bigint, url string, html string, host string, address string")


def test_aliases_of_blocked_addresses_are_blocked_and_allows_stay(spark):
    redirects = spark.createDataFrame([("http://r.net/old", "http://r.net/new"), ("https://www.r.net/new/", "http://m.b.com/de/9"),
                                       (None, "http://b.com/de/1"), ("http://c.net/", None)], "source string, target string")
    got = urls.judge_urls(pages_of(spark, PAGES), URL_RULES, redirects).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(((r["page_id"], r["rule"], r["verdict"]) for r in got), key=key) == sorted(
        ((p, rule, v) for p, _, _, rule, v in PAGES), key=key)
    one = {r["page_id"]: r for r in got}
    assert (one[1]["host"], one[1]["path"]) == ("a.example.com", "/de/5") and (one[7]["host"], one[7]["path"]) == ("", "")
    assert one[18]["path"] == "/en/" + "p/" * 100_000 and not one[1]["by_alias"] and one[2]["by_alias"]


def test_no_pages_and_no_links(spark):
    assert urls.judge_urls(pages_of(spark, []), URL_RULES).count() == 0
    (r,) = urls.judge_urls(pages_of(spark, [(1, "http://a.net/", None, None, None)]), []).collect()
    assert (r["rule"], r["verdict"]) == (None, "allow")


def test_chain_of_canonical_links(spark):
    rows = [(i, f"http://h{i}.net/", f"<link rel=canonical href='http://h{i + 1}.net/'>", None, "block") for i in range(60)]
    rows += [(60, "http://h60.net/", "<meta http-equiv=refresh content='5;url=https://k.com/de/'>", None, "block"),
             (61, "http://h61.net/", None, None, "allow")]
    got = {r["page_id"]: r["verdict"] for r in urls.judge_urls(pages_of(spark, rows), URL_RULES).collect()}
    assert got == {r[0]: r[4] for r in rows}


# --- hard negatives -------------------------------------------------------------------

def brute_negatives(rows, anchor):
    good = [(v, [math.floor(256 * x) for x in e], y) for v, e, y in rows
            if y is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    key = lambda t: (-t[0], t[1] is None, t[1] or 0)
    out = []
    for a, (v, e, y) in enumerate(good):
        if v is None or not anchor(v):
            continue
        scored = [(sum(map(int.__mul__, e, f)), w, z) for b, (w, f, z) in enumerate(good) if b != a and len(f) == len(e)]
        for ps, p, _ in sorted((t for t in scored if t[2] == y), key=key)[:5]:
            found = sorted((t for t in scored if t[2] != y and 80 * ps <= 100 * t[0] <= 100 * ps), key=key)[:5]
            out += [(v, p, r, n, ps, s) for r, (s, n, _) in enumerate(found, 1)]
    return out


def full(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x or 0) for x in r))


def vectors_of(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "vec_id bigint, embedding array<float>, label int, rank string")


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    rows = []
    for i in range(1500):
        w = 16 if i % 9 else 70
        x = rng.normal(size=w)
        if i % 5 == 0 and rows and len(rows[-1][1]) == w:
            x = np.array(rows[-1][1]) + rng.normal(size=w) * 0.1
        rows.append((int(rng.integers(0, 1500)), x.astype(np.float32).tolist(), int(rng.integers(0, 3) if i % 3 else 1)))
    nan, inf = float("nan"), float("inf")
    rows += [(100, None, 1), (200, [nan] * 16, 1), (300, [1.0] * 16, None), (400, [], 1), (500, [], 1), (7, [], 2), (600, [None] * 16, 1),
             (700, [inf] * 16, 2), (None, rows[0][1], 1), (None, rows[0][1], 2), (800, [0.0] * 16, 1), (801, [0.0] * 16, 1)]
    return rows + [rows[50]] * 40 + [(100, rows[50][1], 2)]


@pytest.mark.parametrize("batch_bytes, block", [(8 << 20, 2048), (3000, 90)])
def test_negatives_match_brute_force(spark, monkeypatch, vectors, batch_bytes, block):
    monkeypatch.setattr(negatives, "BLOCK", block)
    got = negatives.hard_negatives(vectors_of(spark, vectors), F.col("vec_id") % 100 == 0, batch_bytes=batch_bytes).collect()
    assert full(got) == full(brute_negatives(vectors, lambda v: v % 100 == 0))


def test_no_vectors_and_no_partners(spark):
    anchor = F.col("vec_id") % 100 == 0
    assert negatives.hard_negatives(vectors_of(spark, []), anchor).count() == 0
    assert negatives.hard_negatives(vectors_of(spark, [(0, [1.0], 1), (1, [1.0], 2)]), anchor).count() == 0
    got = negatives.hard_negatives(vectors_of(spark, [(0, [1.0], 1), (1, [1.0], 2), (3, [1.0], 1), (4, [1e30], 2)]), anchor).collect()
    assert full(got) == [(0, 3, 1, 1, 65536, 65536)]


def test_bounds_hold_and_shut_out(spark):
    rng = np.random.default_rng(7)
    x = np.floor(rng.normal(size=(300, 64)) * 40 + np.repeat(rng.normal(size=(300, 4)) * 200, 16, axis=1))
    rows = negatives.Rows.of(np.arange(300), x)
    exact = x @ x.T
    for (m, d) in rows.levels:
        assert (m @ m.T + d @ d.T >= exact - 1e-3).all() and (m @ m.T - d @ d.T <= exact + 1e-3).all()
    low, high = np.full(300, np.int64(2_000_000)), np.full(300, np.int64(4_000_000))
    i, j, score = negatives.pairs_between(rows, rows, low, high)
    want = np.nonzero((exact >= 2_000_000) & (exact <= 4_000_000))
    assert sorted(zip(i, j, score, strict=True)) == sorted(zip(*want, exact[want].astype(int), strict=True))
    (m, d) = rows.levels[1]
    assert ((m @ m.T + d @ d.T < 2_000_000).mean()) > 0.5  # whole pairs are left before exact scores


# --- Merkle manifest ------------------------------------------------------------------

def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def tree(low):
    out = [low]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def brute_leaf(r):
    return h("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in r))


def brute_proofs(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    if not langs:
        return []
    kept = {x: sorted(((r[0] is not None, r[0] or 0, brute_leaf(r), r) for r in rows if r[2] == x), key=lambda t: t[:3]) for x in langs}
    trees = {x: tree([t[2] for t in kept[x]]) for x in langs}
    top = tree([trees[x][-1][0] for x in langs])
    root, out = top[-1][0], []
    for place, x in enumerate(langs):
        for i, (_, _, leaf, r) in enumerate(kept[x]):
            node, path = leaf, []
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                node = brute_leaf((*r[:3], None if r[3] is None else r[3] + 1, r[4]))
            for levels, at in ((trees[x], i), (top, place)):
                for low in levels[:-1]:
                    other = at ^ 1
                    path += [low[other]] if other < len(low) else []
                    node = h(node) if other >= len(low) else h(low[other] + node) if other < at else h(node + low[other])
                    at >>= 1
            out.append((r[0], leaf, trees[x][-1][0], root, h("".join(path)), node, node == root))
    return out


DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


@pytest.mark.parametrize("rows", [
    [(i, "s", "en", i, f"text {i}") for i in range(1100)] + [(i, None, "fr", None, None) for i in range(257)]
    + [(None, None, None, None, None)] * 3 + [(5, "x", "", 1, "")] + [(7, "a", "zz", 2**63 - 1, "é\n" * 100_000)] * 600
    + [(9, "b", "zz", 1, "tie"), (9, "a", "zz", 1, "tie")] + [(3, "s", f"l{i}", 2, "one") for i in range(300)],
    [(1, "s", "en", 3, "one leaf")], [(12, "s", None, None, "x"), (12, "s", None, None, "x")], []],
    ids=["many", "one", "null scope", "none"])
def test_proofs_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, DOCS).withColumn("leaf", F.lit("clash")).withColumn("key", F.lit(1))
    got = merkle.proofs(merkle.document_manifest(df)).collect()
    assert full(got) == full(brute_proofs(rows))


def test_versions_copy_ancestors_only(spark):
    rows = [(i, "s", "en", i, f"text {i}") for i in range(700)] + [(i, "s", "fr", i, "t") for i in range(3)]
    m = merkle.document_manifest(spark.createDataFrame(rows, DOCS))
    roots = {(r["doc_id"], r["subroot"]): r["folded_root"] for r in merkle.proofs(m).collect()}
    versions = {}
    for r in merkle.version_nodes(m).collect():
        versions.setdefault((r["scope"], r["id"]), []).append((r["step"], r["digest"]))
    tampered = [(r[2], r[0]) for r in rows if zlib.crc32(str(r[0]).encode()) % 7 == 0]
    assert sorted(versions) == sorted(tampered)
    for (scope, _), nodes in versions.items():
        assert len(nodes) == 1 + {"en": 10, "fr": 2}[scope] + 1  # leaf, levels of its scope, one level of scopes
        assert max(nodes)[1] in roots.values()
