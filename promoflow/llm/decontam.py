"""Benchmark decontamination as a prefix-filtered set join, verified over item-sized windows.

Every item gives windows of ``window`` consecutive words; a shorter item is one window.
A window counts only where all its words stand, so the containment threshold is 1 and the
necessary prefix is its one rarest word, by document frequency over all documents.  A
document word that is some window's prefix proposes the windows with that word; the
positional bound places the window's start and the length bound must leave room for it;
the exact words then decide.

Windows are matched in blocks of at most about ``block_windows`` (window, item) pairs, a
stated query set against all rows, so what travels to the tasks is bounded for any
benchmark; between blocks the rows are written to the shared folder.

Defined cases: a null or empty text has no words and no hits; an item without words has no
window; a null item_id hits words but adds no id; repeated items count once; repeated
documents each give a row; empty tables give no hits or no rows; extra columns are carried
through.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from promoflow.llm.common import ascii_lower, prepare, utf8, whole_row, written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # the same words, in UTF-8 after lower-casing A-Z
_HITS = "struct<n_words:bigint,spans:array<struct<start:bigint,end:bigint>>,items:array<string>>"
_HITS_PA = pa.struct([("n_words", pa.int64()),
                      ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                      ("items", pa.list_(pa.string()))])


def item_windows(benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Distinct (words, item) of every item's windows, words joined by blanks."""
    w = F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(WORD), F.lit(0))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (window - 1)))
    return (benchmark.select(F.col("item_id").cast("string").alias("item"), w.alias("w")).filter(F.size("w") > 0)
            .select("item", "w", F.explode(starts).alias("at"))
            .select(F.array_join(F.slice("w", F.col("at"), window), " ").alias("words"), "item").distinct())


def document_frequency(texts: DataFrame, vocabulary: frozenset[bytes]) -> Counter:
    """In how many of ``texts`` each word of the (bounded) vocabulary stands."""
    def count(batches):
        seen = Counter()
        for batch in batches:
            for t in utf8(batch.column(0)):
                seen.update(vocabulary.intersection(_WORD.findall(t.lower())))
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                             ["word", "n"])
    parts = texts.mapInArrow(count, "word binary, n bigint")
    return Counter({bytes(r["word"]): r["n"] for r in parts.groupBy("word").agg(F.sum("n").alias("n")).collect()})


def prefix_index(windows: list[tuple[bytes, str | None]], frequency: Counter) -> dict:
    """Rarest word -> (its place in the window, window length) -> window -> item ids."""
    index: dict = defaultdict(lambda: defaultdict(lambda: defaultdict(set)))
    for text, item in windows:
        words = text.split(b" ")
        rank, at = min((frequency[w], w, i) for i, w in enumerate(words))[1:]
        index[rank][at, len(words)][text].update(() if item is None else (item,))
    return {w: {k: {t: tuple(i) for t, i in v.items()} for k, v in by.items()} for w, by in index.items()}


def merge_spans(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(e, out[-1][1])
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def find_windows(text: bytes, index: dict) -> tuple[int, set, set]:
    """(words of the text, (start, end) of occurring windows, ids of their items)."""
    words = _WORD.findall(text.lower())
    n, spans, items = len(words), set(), set()
    prefix = index.keys() & set(words)
    for p, w in enumerate(words) if prefix else ():
        if w in prefix:
            for (at, size), windows in index[w].items():
                s = p - at
                if s >= 0 and s + size <= n:
                    ids = windows.get(b" ".join(words[s:s + size]))
                    if ids is not None:
                        spans.add((s, s + size))
                        items.update(ids)
    return n, spans, items


def _match(index: dict):
    @arrow_udf(_HITS)
    def run(texts: pa.Array, before: pa.Array) -> pa.Array:
        out = []
        for t, b in zip(utf8(texts), before.to_pylist(), strict=True):
            n, spans, items = find_windows(t, index)
            if b:
                spans |= {(s["start"], s["end"]) for s in b["spans"]}
                items |= set(b["items"])
            out.append({"n_words": n, "spans": [{"start": s, "end": e} for s, e in merge_spans(spans)],
                        "items": sorted(items)})
        return pa.array(out, _HITS_PA)
    return run


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_windows: int = 50_000) -> DataFrame:
    """Every row of ``docs`` as the struct ``__row`` with ``__hits``: its number of words,
    the merged word spans inside item windows, and the ids of the items found."""
    prepare(docs.sparkSession)
    windows = written(item_windows(benchmark, window), "windows")
    blocks = max(1, -(-windows.count() // block_windows))
    block_of = F.pmod(F.xxhash64("words", "item"), F.lit(blocks))
    rows = whole_row(docs).withColumn("__hits", F.lit(None).cast(_HITS))
    for k in range(blocks):
        part = [(r["words"].encode(), r["item"]) for r in windows.filter(block_of == k).collect()]
        words = frozenset(w for t, _ in part for w in t.split(b" "))
        index = prefix_index(part, document_frequency(docs.select("text"), words))
        rows = rows.select("__row", _match(index)(F.col("__row")["text"], F.col("__hits")).alias("__hits"))
        if k + 1 < blocks:
            rows = written(rows, "hits")
    return rows


def hit_words(hits: Column) -> Column:
    return F.aggregate(hits["spans"], F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The digest of each row's hits."""
    hits = benchmark_hits(docs, benchmark, window).select(F.col("__row")["doc_id"].alias("doc_id"), F.col("__hits").alias("h"))
    h = F.col("h")
    return (hits.select("doc_id", h["n_words"].alias("n_words"), hit_words(h).alias("n_hit"),
                        F.size(h["items"]).cast("bigint").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort(h["items"]), ",").cast("binary"), 256).alias("items_sha256"))
            .withColumn("contaminated", F.col("n_hit") > 0))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs`` in which no item window occurs, with their own columns."""
    return benchmark_hits(docs, benchmark, window).filter(F.size(F.col("__hits")["spans"]) == 0).select("__row.*")
