"""Sequence packing: shortest-pack-first over the histogram of piece lengths.

Documents become token ids with a closing id; a document over the capacity is cut into
full pieces and a rest.  The histogram of piece lengths (at most ``capacity`` bins) is
packed longest length first: pieces go to the open pattern with the most room, and where
none has room, new patterns open; patterns are (lengths, count) pairs, so the work on the
driver is bounded by the number of bins, not of documents.  Each piece then finds its
place by its length and its rank among the pieces of that length, which is its rank within
its task plus the counts of the tasks before, so that no length is gathered in one place.

Defined cases: a null text counts as the empty text, whose one piece is the closing id;
repeated documents are packed as often as they come; a null id is kept; an empty table
gives an empty table; other columns are left out.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promoflow.llm.common import prepare, utf8, written

CAPACITY = 2048
END_ID = 1
#: Pre-tokenisation of the vocabulary file's byte-level model.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def load_encoder(vocabulary: str, more_special: tuple[str, ...] = ()) -> tiktoken.Encoding:
    """The byte-level BPE of a ``tokenizers`` JSON file, run by a faster library: its ids
    are the merge ranks, its added tokens are special also inside texts.  Further special
    tokens get the next ids."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = json.load(f)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in plain}
    shown |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(shown[c] for c in w): i for w, i in spec["model"]["vocab"].items() if w not in special}
    top = 1 + max([*special.values(), *ranks.values()])
    special |= {t: top + i for i, t in enumerate(more_special)}
    return tiktoken.Encoding("json-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


#: Runs of blanks from this length on go to the file's own library: the faster one's matcher
#: keeps a place for every blank of a run and gives up at a million.
LONG_BLANKS = 500_000
_LONG_BLANKS = re.compile(r"(?<!\s)\s{%d}" % LONG_BLANKS)


class Encoder:
    """Ids of whole texts of any kind; special tokens are special also inside texts."""

    def __init__(self, vocabulary: str, more_special: tuple[str, ...] = ()):
        self.bpe = load_encoder(vocabulary, more_special)
        self._source, self._special = (vocabulary, more_special), self.bpe.special_tokens_set

    def encode(self, text: str) -> list[int]:
        if len(text) >= LONG_BLANKS and _LONG_BLANKS.search(text):
            vocabulary, more_special = self._source
            own = tokenizers.Tokenizer.from_file(vocabulary)
            own.add_special_tokens(list(more_special))
            return own.encode(text, add_special_tokens=False).ids
        if any(s in text for s in self._special):
            return self.bpe.encode(text, allowed_special="all")
        return self.bpe.encode_ordinary(text)


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """Pieces of at most ``capacity`` ids, with the task that made them and their rank among
    its pieces of that length.  Write the result before use: ranks follow the tasks."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, part int, nth bigint"
              + ", ids array<int>" * with_ids)

    def run(batches):
        enc, part, seen = Encoder(vocabulary), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows, ids_out, who = [], [], []
            for i, t in enumerate(utf8(batch.column(1))):
                ids = enc.encode(t.decode())
                ids.append(END_ID)
                ids = np.array(ids, dtype="<u4")
                for s in range(0, len(ids), capacity):
                    cut = ids[s:s + capacity]
                    n = len(cut)
                    rows.append((s, n, zlib.crc32(cut.tobytes()), len(ids), part, seen[n]))
                    seen[n] += 1
                    who.append(i)
                    if with_ids:
                        ids_out.append(cut)
            if rows:
                cols = [batch.column(0).take(pa.array(who))]
                kinds = [pa.int64()] * 4 + [pa.int32(), pa.int64()]
                cols += [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                if with_ids:
                    ends = np.cumsum([0, *map(len, ids_out)]).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids_out).astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in schema.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def shortest_pack_first(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple]]:
    """Patterns (count, ((length, times), ...)) that place every piece of the histogram."""
    open_: dict[int, list[tuple[int, tuple]]] = {}
    room: list[int] = []  # negative, a heap of the keys of open_

    def put(left, count, runs):
        if left not in open_:
            open_[left] = []
            heapq.heappush(room, -left)
        open_[left].append((count, runs))

    def longer(runs, length, times=1):
        if runs and runs[-1][0] == length:
            return (*runs[:-1], (length, runs[-1][1] + times))
        return (*runs, (length, times))

    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        while n:
            while room and not open_[-room[0]]:
                del open_[-heapq.heappop(room)]
            left = -room[0] if room else 0
            if left < length:  # none has room: new patterns take as many as they hold
                each = capacity // length
                if n // each:
                    put(capacity - each * length, n // each, ((length, each),))
                if n % each:
                    put(capacity - (n % each) * length, 1, ((length, n % each),))
                break
            count, runs = open_[left].pop()
            used = min(n, count)
            put(left - length, used, longer(runs, length))
            if count > used:
                put(left, count - used, runs)
            n -= used
    return [p for left in sorted(open_) for p in open_[left]]


def slots(patterns: list[tuple[int, tuple]]):
    """Arrays by (length, first rank): what a piece of that rank range looks up."""
    rank, rows, base = Counter(), [], 0
    for count, runs in patterns:
        at = 0
        for length, times in runs:
            rows.append((length, rank[length], base, times, at))
            rank[length] += count * times
            at += length * times
        base += count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def place(packed: DataFrame, patterns: list[tuple[int, tuple]]) -> DataFrame:
    """``packed`` (length, rank, ...) with sequence_id and offset."""
    table = slots(patterns)
    keys = (table[:, 0] << 48) + table[:, 1]

    def run(batches):
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            row = table[np.searchsorted(keys, (length << 48) + rank, "right") - 1]
            nth = rank - row[:, 1]
            got = [pa.array(row[:, 2] + nth // row[:, 3]), pa.array(row[:, 4] + nth % row[:, 3] * length)]
            yield pa.RecordBatch.from_arrays(batch.columns + got, batch.schema.names + ["sequence_id", "offset"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in packed.schema.fields)
    return packed.mapInArrow(run, f"{kept}, sequence_id bigint, offset bigint").drop("rank")


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, (ids), sequence_id, offset."""
    prepare(docs.sparkSession)
    cut = written(pieces(docs, vocabulary, capacity, with_ids), "pieces")
    # Per length a row of each task that has such pieces.
    counts = written(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranked = (cut.join(bases, ["length", "part"])
              .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids,
                      (F.col("base") + F.col("nth")).alias("rank")))
    return place(ranked, shortest_pack_first(histogram, capacity))
