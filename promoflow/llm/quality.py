"""Quality classifier with hierarchical empirical Bayes.

A logistic regression over dense text features gives each document's own evidence.  Its
mean by host and by path within the host, over all documents, is shrunk by grouped
aggregation: path posteriors toward their host's, host posteriors toward the global mean,
each with a prior strength from the method of moments, so sparse sites stay near the
prior.  A document's score joins its own log-odds with those of its site, from which its
own share is taken out first.

Defined cases: a null text counts as the empty text; a null or other than 0/1 label is no
label; several labels of one id count as their minimum; a null host or path is a site of
its own; repeated rows each give a row and train once; without labelled rows of both classes the evidence
is the smoothed share of label 1; an empty table gives an empty table; extra columns
but the text are carried through.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from promoflow.llm.common import prepare, utf8, whole_row, written

_SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"?!-()")
_DIGITS, _CAPITALS = bytes(range(48, 58)), bytes(range(65, 91))
_WORD = re.compile(rb"[^\x00-\x20]+")


def text_features(text: bytes) -> list[float]:
    """Dense features of one whole text; the empty text has zeros."""
    n = max(1, len(text))
    words = _WORD.findall(text)
    lines = [x for x in text.split(b"\n") if x.strip()]
    share = lambda chars: (len(text) - len(text.translate(None, chars))) / n
    w, k = max(1, len(words)), max(1, len(lines))
    return [math.log1p(len(words)), len(set(words)) / w, len(text) / w, share(_SYMBOLS), share(_DIGITS), share(_CAPITALS),
            1 - len(set(lines)) / k if lines else 0.0, max(Counter(lines).values(), default=0) / k,
            text.count(b"|") / w, sum(x[-1:] in b".!?" for x in lines) / k, len(words) / k,
            max(Counter(words).values(), default=0) / w]


def features(text: Column) -> Column:
    @arrow_udf("array<double>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([text_features(t) for t in utf8(texts)], pa.list_(pa.float64()))
    return array_to_vector(run(text))


def training_rows(docs: DataFrame, labels: DataFrame, max_train_rows: int = 20_000) -> DataFrame:
    """(x, y) of at most ``max_train_rows`` rows of as many labelled ids at most, written.
    Ids are taken by a hash; equal rows of an id count once, and where ids have more texts
    than fit, one of every id comes first, then the others by their hash."""
    known = (labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min("quality").cast("double").alias("y"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train_rows))
    # The ids are bounded and narrow: broadcast, so no text moves; copies then meet by hash.
    mine = (docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
            .select("doc_id", "y", F.xxhash64("text").alias("h"), features(F.col("text")).alias("__q_x")))
    rows = written(mine.groupBy("doc_id", "h").agg(F.first("y").alias("y"), F.first("__q_x").alias("__q_x")), "quality-train")
    if rows.count() > max_train_rows:
        first = rows.groupBy("doc_id").agg(F.min("h").alias("first"))
        rows = written(rows.join(F.broadcast(first), "doc_id").orderBy(F.col("h") != F.col("first"), "h", "doc_id")
                       .limit(max_train_rows), "quality-bounded")
    # Few rows of numbers, sorted in one partition: the same coefficients in every run.
    return written(rows.coalesce(1).sortWithinPartitions("doc_id", "h").select("__q_x", "y"), "quality-sorted")


def _logit(p: Column) -> Column:
    q = F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), p))
    return F.log(q / (1 - q))


def _strength(groups: DataFrame, n: str, mean: str, toward: str) -> float:
    """Prior strength of group means around ``toward``: sampling variance over the variance
    between groups, by moments.  Without groups of two and more the prior is strong."""
    m = F.col(toward)
    r = groups.filter(f"{n} > 1").agg(
        F.avg((F.col(mean) - m) ** 2).alias("all"), F.avg(m * (1 - m) / F.col(n)).alias("noise"),
        F.avg(m * (1 - m)).alias("own")).first()
    if r["all"] is None:
        return 1000.0
    between = max(r["all"] - r["noise"], 1e-6)
    return min(1000.0, max(1.0, r["own"] / between))


def score_quality(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang",
                  max_train_rows: int = 20_000) -> DataFrame:
    """Every row of ``docs``, but for its text, as the struct ``__row`` with ``__doc`` (its own
    evidence), ``__host`` and ``__path`` (posteriors without it) and ``__score``, all 0 to 1."""
    prepare(docs.sparkSession)
    train = training_rows(docs, labels, max_train_rows)
    seen = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count("*").alias("n")).collect()}
    row = F.col("__row")
    # Texts end here: what is written and joined are ids, sites and numbers.
    rows = whole_row(docs.drop("text")) if len(seen) != 2 else docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("__row"), features(F.col("text")).alias("__q_x"))
    if len(seen) == 2:
        model = LogisticRegression(featuresCol="__q_x", labelCol="y", probabilityCol="__q_p", rawPredictionCol="__q_r",
                                   predictionCol="__q_l", regParam=0.001).fit(train)
        rows = model.transform(rows).select("__row", vector_to_array("__q_p")[1].alias("__doc"))
    else:
        rows = rows.withColumn("__doc", F.lit((seen.get(1.0, 0) + 1) / (sum(seen.values()) + 2)))
    site = lambda c: F.coalesce(row[c].cast("string"), F.lit("\0"))  # noqa: E731  no site is named by a null character
    rows = written(rows.select("__row", "__doc", site(host).alias("__h"), site(path).alias("__p")), "quality-rows")

    paths = written(rows.groupBy("__h", "__p").agg(F.count("*").alias("np"), F.sum("__doc").alias("sp")), "paths")
    hosts = written(paths.groupBy("__h").agg(F.sum("np").alias("nh"), F.sum("sp").alias("sh")), "hosts")
    total = hosts.agg(F.sum("sh") / F.sum("nh")).first()[0]
    if total is None:
        total = 0.5
    m = F.lit(float(total))
    hosts = hosts.select("__h", "nh", "sh", (F.col("sh") / F.col("nh")).alias("mean"), m.alias("m"))
    kh = _strength(hosts, "nh", "mean", "m")
    sites = written(paths.join(hosts.select("__h", "nh", "sh", ((F.col("sh") + kh * m) / (F.col("nh") + kh)).alias("ph")), "__h"),
                    "sites")
    kp = _strength(sites.withColumn("mean", F.col("sp") / F.col("np")), "np", "mean", "ph")

    p = F.col("__doc")
    own_host = (F.col("sh") - p + kh * m) / (F.col("nh") - 1 + kh)
    own_path = (F.col("sp") - p + kp * F.col("__host")) / (F.col("np") - 1 + kp)
    joined = (rows.join(sites, ["__h", "__p"]).withColumn("__host", own_host).withColumn("__path", own_path))
    odds = _logit(p) + _logit(F.col("__path")) - _logit(m)
    return joined.select("__row", "__doc", "__host", "__path", (1 / (1 + F.exp(-odds))).alias("__score"))


def quality_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    return score_quality(docs, labels).select(
        F.col("__row")["doc_id"].alias("doc_id"), F.col("__doc").alias("doc_score"), F.col("__host").alias("host_posterior"),
        F.col("__path").alias("path_posterior"), F.col("__score").alias("score"),
        (F.col("__score") >= threshold).alias("kept"))
