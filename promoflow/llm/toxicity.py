"""Toxicity: gradient-boosted trees over dense text features with isotonic calibration.

Features per whole text: densities of insult lexicons, insults near a second-person word,
capitals, punctuation, and obfuscated spellings.  Beside the fixed lexicons, one is learned:
words and word beginnings whose log-odds for label 1, at the lower confidence bound, are
positive.  Three disjoint folds of a bounded sample of labelled ids (``max_train_rows``)
give that lexicon, the trees and the calibration; scoring runs over every row.

Defined cases: a null text counts as the empty text and is scored; a null or other than
0/1 label is no label; several labels of one id count as their maximum; rows repeat as
often as they come; a null id is never held out; without rows of both classes in both
later folds every score is the smoothed share of label 1; equal rows of an id are learned
from once, and rows are bounded like ids; an empty table gives an empty
table.  Extra columns, whatever their names, are carried through.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from promoflow.llm.common import prepare, utf8, whole_row, written

INSULTS = frozenset(
    "bastard clown coward creep cretin disgusting dumbass filth fool idiot imbecile jerk loser "
    "moron parasite pathetic pig psycho scum stupid trash vermin weirdo worthless".split())
HARSH = frozenset("awful crap damn die dumb garbage hate hell horrible kill lame nasty shut sick sucks ugly".split())
SECOND_PERSON = frozenset("you your yours yourself ur u du dich dein ihr tu toi vous te usted".split())
#: Words between an insult and a second-person word that count as near.
NEAR = 5

#: Characters of the word beginnings that the learned lexicon also weighs.
STARTS = (4, 5)

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MASKED = re.compile(r"(?<![0-9a-z@$*])[a-z]+[0-9@$*]+[a-z]+[0-9a-z@$*]*")
_PLAIN = str.maketrans("013457@$", "oieastas")
_CAPITALS, _LETTERS = bytes(range(65, 91)), bytes(range(97, 123))
_OTHER = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def _units(words: set[str]) -> set[str]:
    """The words and their beginnings, the latter marked by a hyphen."""
    return words.union(*({w[:k] + "-" for w in words if len(w) > k} for k in STARTS))


def text_features(text: bytes, learned: dict[str, float]) -> list[float]:
    """Dense features of one whole text; the empty text has zeros."""
    low = text.lower()
    plain = low.decode()
    words = _WORD.findall(plain)
    own, n, chars = set(words), len(words), max(1, len(text))
    found = INSULTS & own
    at = [i for i, w in enumerate(words) if w in found] if found else []
    near = sum(not SECOND_PERSON.isdisjoint(words[max(0, i - NEAR):i + NEAR + 1]) for i in at)
    harsh = sum(map(words.count, HARSH & own))
    second = sum(map(words.count, SECOND_PERSON & own))
    masked = _MASKED.findall(plain) if any(c in plain for c in "013457@$*") else []
    hidden = sum(w.translate(_PLAIN) in INSULTS for w in masked)
    weights = sorted((learned[u] for u in learned.keys() & _units(own)), reverse=True)
    caps = len(text) - len(text.translate(None, _CAPITALS))
    letters = max(1, len(low) - len(low.translate(None, _LETTERS)))
    shout = low.count(b"!") + low.count(b"?")
    other = len(low) - len(low.translate(None, _OTHER)) - shout
    per = 1000.0 / max(1, n)
    return [math.log1p(len(at)), len(at) * per, float(len(found)), math.log1p(harsh), harsh * per,
            near * per, second * per, math.log1p(hidden), len(masked) * per, caps / letters,
            shout / chars, other / chars, math.log1p(n),
            weights[0] if weights else 0.0, sum(weights[:4]), sum(weights), sum(weights) * per]


def features_of(learned: dict[str, float]):
    @arrow_udf("array<double>")
    def features(texts: pa.Array) -> pa.Array:
        return pa.array([text_features(t, learned) for t in utf8(texts)], pa.list_(pa.float64()))
    return features


def units_of(texts):
    @arrow_udf("array<string>")
    def units(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(_units(set(_WORD.findall(t.lower().decode())))) for t in utf8(texts)],
                        pa.list_(pa.string()))
    return units(texts)


def held_out(doc_id):
    """True for the ids whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_train_rows: int = 20_000) -> DataFrame:
    """(text, y, fold) of at most ``max_train_rows`` rows, written, of as many labelled ids outside
    the held-out fold at most, taken by a hash of the id.  Equal rows of an id count once; where
    ids have more texts than fit, one of every id comes first, then the others by their hash."""
    known = (labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").cast("double").alias("y"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train_rows))
    # The ids are bounded and narrow: broadcast, so that copies meet before any shuffle.
    rows = written(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").distinct(), "tox-train")
    if rows.count() > max_train_rows:
        rows = rows.withColumn("h", F.xxhash64("doc_id", "text"))
        first = rows.groupBy("doc_id").agg(F.min("h").alias("first"))
        taken = (rows.select("doc_id", "h").join(F.broadcast(first), "doc_id")
                 .orderBy(F.col("h") != F.col("first"), "h", "doc_id").limit(max_train_rows).select("doc_id", "h"))
        rows = written(rows.join(F.broadcast(taken), ["doc_id", "h"], "left_semi"), "tox-bounded")
    return rows.select("text", "y", F.least(F.lit(2), F.greatest(F.lit(0), F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) - 1))
                       .cast("int").alias("fold"))


def learned_lexicon(train: DataFrame, max_units: int = 5_000, min_rows: int = 3) -> dict[str, float]:
    """Units of the first fold with their log-odds for label 1, less 1.64 standard errors:
    the ``max_units`` largest above zero, each in ``min_rows`` toxic rows at least.

    The rows are a bounded sample, equal texts counting once, so the counts are bounded too.
    """
    first = train.filter("fold = 0").groupBy(F.xxhash64("text").alias("h"), "y").agg(F.first("text").alias("text"))
    size = {r["y"]: r["n"] for r in first.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = size.get(1.0, 0), size.get(0.0, 0)
    if not toxic or not clean:
        return {}
    t, c = F.col("t") + 0.5, F.col("c") + 0.5
    w = F.log(t / (toxic + 1)) - F.log(c / (clean + 1)) - 1.64 * F.sqrt(1 / t + 1 / c)
    seen = (first.select("y", F.explode(units_of("text")).alias("unit")).groupBy("unit")
            .agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c")).filter(F.col("t") >= min_rows)
            .select("unit", w.alias("w")).filter("w > 0").orderBy(F.desc("w"), "unit").limit(max_units))
    return {r["unit"]: r["w"] for r in seen.collect()}


def fit(train: DataFrame):
    """(trees, calibration) or, without both classes in both folds, the constant score."""
    n = {(r["fold"], r["y"]): r["n"] for r in train.groupBy("fold", "y").agg(F.count("*").alias("n")).collect()}
    ones = sum(v for (_, y), v in n.items() if y == 1)
    if any((f, y) not in n for f in (1, 2) for y in (0.0, 1.0)):
        return (ones + 1) / (sum(n.values()) + 2)
    trees = GBTClassifier(
        featuresCol="__tox_x", labelCol="y", predictionCol="__tox_p",
        maxDepth=3, maxIter=16, stepSize=0.3, minInstancesPerNode=4,
        seed=11, checkpointInterval=-1).fit(train.filter("fold = 1"))
    level = IsotonicRegression(featuresCol="rawPrediction", featureIndex=1, labelCol="y", predictionCol="__tox_s")
    return trees, level.fit(trees.transform(train.filter("fold = 2")))


def score_toxicity(docs: DataFrame, labels: DataFrame, max_train_rows: int = 20_000) -> DataFrame:
    """Every row of ``docs`` as the struct ``__row`` with ``__score`` (0 to 1)."""
    prepare(docs.sparkSession)
    # The bounded sample is written once: the lexicon and the features read it.
    train = training_rows(docs, labels, max_train_rows)
    features = features_of(learned_lexicon(train))
    # Dense vectors only, sorted in one partition: the sample is bounded, the trees read it in
    # every round, and sums in one order give the same trees in every run.
    dense = written(train.select(features("text").alias("f"), "y", "fold"), "tox-x")
    model = fit(written(dense.coalesce(1).sortWithinPartitions("fold", "y", "f"), "tox-sorted")
                .select(array_to_vector("f").alias("__tox_x"), "y", "fold"))
    rows = whole_row(docs)
    if isinstance(model, float):
        return rows.withColumn("__score", F.lit(model))
    trees, level = model
    x = rows.withColumn("__tox_x", array_to_vector(features(F.col("__row")["text"])))
    scored = level.transform(trees.transform(x))
    return scored.select("__row", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("__tox_s"))).alias("__score"))


def toxicity_verdicts(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    s = score_toxicity(docs, labels)
    doc = F.col("__row")["doc_id"]
    return s.select(doc.alias("doc_id"), held_out(doc).alias("held_out"), F.col("__score").alias("score"),
                    (F.col("__score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` scored under ``threshold``, with their own columns."""
    return score_toxicity(docs, labels).filter(F.col("__score") < threshold).select("__row.*")
