"""Quality posteriors and toxicity scores recomputed in plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from promoflow.llm import quality, secrets, toxicity
from promoflow.llm.common import table

SMALL = "/root/testdata/sf0.001"


# --- quality --------------------------------------------------------------------------

def brute_posteriors(rows):
    """{key: (host, path, score)} from (key, host, path, own evidence)."""
    n, total = len(rows), sum(r[3] for r in rows)
    m = total / n
    hosts, paths = {}, {}
    for _, h, p, e in rows:
        hosts.setdefault(h, []).append(e)
        paths.setdefault((h, p), []).append(e)

    def strength(groups):  # (values, mean it is shrunk toward)
        many = [(v, t) for v, t in groups if len(v) > 1]
        if not many:
            return 1000.0
        k = len(many)
        around = sum((sum(v) / len(v) - t) ** 2 for v, t in many) / k
        noise = sum(t * (1 - t) / len(v) for v, t in many) / k
        return min(1000.0, max(1.0, sum(t * (1 - t) for _, t in many) / k / max(around - noise, 1e-6)))

    kh = strength([(v, m) for v in hosts.values()])
    shrunk = {h: (sum(v) + kh * m) / (len(v) + kh) for h, v in hosts.items()}
    kp = strength([(v, shrunk[h]) for (h, _), v in paths.items()])
    logit = lambda x: math.log(min(max(x, 1e-6), 1 - 1e-6) / (1 - min(max(x, 1e-6), 1 - 1e-6)))
    out = []
    for key, h, p, e in rows:
        host = (sum(hosts[h]) - e + kh * m) / (len(hosts[h]) - 1 + kh)
        path = (sum(paths[h, p]) - e + kp * host) / (len(paths[h, p]) - 1 + kp)
        odds = logit(e) + logit(path) - logit(m)
        out.append((key, host, path, 1 / (1 + math.exp(-odds))))
    return out


def test_posteriors_match_plain_python(spark):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(300):
        good = rng.random() < (0.9 if i % 3 else 0.2)
        text = " ".join(rng.choice(["plain", "words", "of", "prose.", "More"]) for _ in range(40)) if good else "| BUY | " * rng.randrange(1, 30)
        docs.append((i, text, f"host{i % 3}" if i % 50 else None, f"path{i % 7}" if i % 11 else None))
        labels.append((i, int(good), 0))
    docs += [docs[7]] * 5 + [(None, None, "alone", "once"), (900, "", "", ""), (901, "x " * 50_000, "host1", "tie"), (902, "x " * 50_000, "host1", "tie")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string, lang string").withColumn("np", F.lit("clash"))
    lab = spark.createDataFrame(labels + [(3, 1 - labels[3][1], 0), (None, 1, 0), (4, None, 0), (5, 7, 0)], "doc_id bigint, quality int, toxic int")
    got = [(r["__row"]["doc_id"], r["__row"]["source"], r["__row"]["lang"], r["__doc"], r["__host"], r["__path"], r["__score"])
           for r in quality.score_quality(df, lab).collect()]
    assert len(got) == len(docs) and {r[0] for r in got} == {d[0] for d in docs}
    want = brute_posteriors([r[:4] for r in got])
    for r, w in zip(got, want, strict=True):
        assert r[4:] == pytest.approx(w[1:], rel=1e-9)
    one = {r[0]: r for r in got}
    assert one[901][3:] == pytest.approx(one[902][3:])  # ties share everything


def test_training_rows_are_bounded_for_repeated_ids(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id bigint, quality int, toxic int")
    copies = spark.createDataFrame([(3, "same text")] * 300 + [(i, f"text {i}") for i in range(20)], "doc_id bigint, text string")
    assert quality.training_rows(copies, labels).count() == 21
    many = spark.createDataFrame([(3, f"text {k} " * k) for k in range(300)] + [(i, f"text {i}") for i in range(20)], "doc_id bigint, text string")
    assert quality.training_rows(many, labels, 10).count() == 10
    bounded = quality.training_rows(many, labels, 25)
    assert bounded.count() == 25 and bounded.filter("y = 0").count() >= 10  # one of every id comes first


def test_no_text_is_carried_past_its_features(spark):
    df = table(spark, SMALL, "documents").select("doc_id", "text", "source", "lang")
    s = quality.score_quality(df, table(spark, SMALL, "labels"))
    assert "text" not in s.schema["__row"].dataType.names


# --- toxicity -------------------------------------------------------------------------

def test_scores_are_the_models_trees_and_levels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    train = toxicity.training_rows(docs, labels)
    learned = toxicity.learned_lexicon(train)
    dense = train.select(toxicity.features_of(learned)("text").alias("f"), "y", "fold")
    trees, level = toxicity.fit(dense.coalesce(1).sortWithinPartitions("fold", "y", "f").select(array_to_vector("f").alias("__tox_x"), "y", "fold"))
    x, y = np.array(level.boundaries.toArray()), np.array(level.predictions.toArray())
    texts = {r["doc_id"]: r["text"] for r in docs.orderBy(F.xxhash64("doc_id")).limit(60).collect()}
    texts |= {r["doc_id"]: r["text"] for r in docs.join(labels.filter("toxic = 1"), "doc_id").limit(20).collect()}
    got = {r["doc_id"]: r for r in toxicity.toxicity_verdicts(docs, labels).collect()}
    from pyspark.ml.linalg import Vectors
    for i, text in texts.items():
        f = Vectors.dense(toxicity.text_features((text or "").encode(), learned))
        margin = sum(w * t.predict(f) for w, t in zip(trees.treeWeights, trees.trees, strict=True))
        score = float(np.clip(np.interp(margin, x, y), 0, 1))
        assert got[i]["score"] == pytest.approx(score, abs=1e-9) and got[i]["predicted"] == int(score >= 0.7)


# --- secrets --------------------------------------------------------------------------

def test_a_text_with_very_many_matches_takes_linear_time(spark):
    n = 100_000
    df = spark.createDataFrame([(1, "token=abcdefgh1 " * n), (2, "AKIA" + "Q" * 12 + "\n" + "é token: zyxwvuts9" * 70), (3, None)],
                               "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in secrets.secret_report(df).collect()}
    assert got[1]["n_assign"] == n
    spans = got[1]["spans"].split(",")
    assert spans == [f"assign:{16 * i}:{16 * i + 15}" for i in range(n)]
    assert got[2]["n_access"] == 1 and got[2]["n_assign"] == 70 and got[2]["spans"].startswith("access:0:16,assign:19:35,assign:37:53")


def test_a_second_delivery_scans_only_what_is_new(spark):
    first = spark.createDataFrame([(1, "token=abcdefgh1"), (2, "b"), (2, "b"), (3, None)], "doc_id bigint, text string")
    ledger = secrets.new_ledger(spark)
    secrets.update_ledger(first, ledger)
    both = first.union(spark.createDataFrame([(4, "token=abcdefgh1"), (5, "new"), (6, "")], "doc_id bigint, text string"))
    got = sorted((r["doc_id"], r["scan"], r["n_assign"]) for r in secrets.secret_report(both, ledger).collect())
    assert got == [(1, 1, 1), (2, 1, 0), (2, 1, 0), (3, 1, 0), (4, 1, 1), (5, 2, 0), (6, 1, 0)]
    assert spark.read.parquet(ledger).groupBy("blob_id").count().filter("count > 1").count() == 0
