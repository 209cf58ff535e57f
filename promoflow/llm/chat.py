"""Chat formatting with offset-aligned loss masks.

A whole conversation is rendered once: each turn is ``<|turn|>role<|says|>text<|end|>``.
The markers are special tokens of the encoder, so no token reaches over them; the rendered
text is encoded once, its tokens' offsets are the running sum of their byte lengths, and the
sorted spans of the assistant texts are intersected with the token spans by binary search.
Control strings of this and other common templates inside roles and texts get a backslash
after their first character (one more where there are some already), which reading back
takes off.

Defined cases: rows are ordered by turn (null first), then role and text; repeated rows are
turns of their own; a null role or text counts as empty; each row without a conv_id is a
conversation of its own; an empty table gives an empty table; extra columns are left out.
A conversation is one training example and has to fit into a task's memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from promoflow.llm.common import prepare
from promoflow.llm.packing import Encoder

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
#: A control string, or one that is escaped already; the same in Spark, RE2 and Python.
CONTROL = r"([<\[])(\\*)(\||/?s>|<SYS>>|/?INST\]|/?SYS\])"
_CONTROL = re.compile(CONTROL)
_ESCAPED = re.compile(r"([<\[])\\(\\*)(\||/?s>|<SYS>>|/?INST\]|/?SYS\])")
_READ = re.compile(re.escape(TURN) + "(.*?)" + re.escape(SAYS) + "(.*?)" + re.escape(END), re.DOTALL)
LEARNED_ROLE = "assistant"


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the UTF-8 byte spans of its assistant texts, in order."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        lead, body = TURN + escape(role) + SAYS, escape(text)
        begin = at + len(lead.encode())
        end = begin + len(body.encode())
        if role == LEARNED_ROLE:
            spans.append((begin, end))
        parts += [lead, body, END]
        at = end + len(END)
    return "".join(parts), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(r), unescape(t)) for r, t in _READ.findall(formatted)]


class TurnEncoder(Encoder):
    """The vocabulary with the markers as special tokens, and the byte length of each token."""

    def __init__(self, vocabulary: str):
        super().__init__(vocabulary, (TURN, SAYS, END))
        self.size = np.array([len(self.bpe.decode_single_token_bytes(i)) for i in range(self.bpe.n_vocab)], np.int64)

    def encode_with_offsets(self, formatted: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, byte offset of each token)"""
        ids = np.array(self.encode(formatted), np.int32)
        size = self.size[ids]
        return ids, np.cumsum(size) - size


def loss_mask(starts: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """1 for every token inside a span; no token reaches over a span's ends, so the tokens
    of a span are the range between two binary searches in the sorted offsets."""
    mask = np.zeros(len(starts), np.int8)
    for s, e in zip(*np.searchsorted(starts, np.array(spans, np.int64).reshape(-1, 2).T), strict=True):
        mask[s:e] = 1
    return mask


def _lists(parts: list[np.ndarray], dtype) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, dtype), *parts])))


_OUT = "struct<formatted:string,input_ids:array<int>,loss_mask:array<tinyint>>"


def format_conversations(rows: DataFrame, vocabulary: str) -> DataFrame:
    """One row per conversation: conv_id, formatted, input_ids, loss_mask."""
    prepare(rows.sparkSession)
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    own = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    turns = (rows.select("conv_id", own.alias("__own"), F.struct("turn", text("role").alias("role"), text("text").alias("text")).alias("t"))
             .groupBy("conv_id", "__own").agg(F.array_sort(F.collect_list("t")).alias("t"))
             .select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")))

    @arrow_udf(_OUT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = TurnEncoder(vocabulary)
        for conversations in batches:
            texts, ids, masks = [], [], []
            for conv in conversations.to_pylist():
                formatted, spans = render([(t["role"], t["text"]) for t in conv])
                tokens, starts = encoder.encode_with_offsets(formatted)
                texts.append(formatted)
                ids.append(tokens)
                masks.append(loss_mask(starts, spans))
            yield pa.StructArray.from_arrays([pa.array(texts, pa.string()), _lists(ids, np.int32), _lists(masks, np.int8)],
                                             ["formatted", "input_ids", "loss_mask"])

    return turns.select("conv_id", run("turns").alias("o")).select("conv_id", "o.*")


_DIGEST = "struct<n_turns:bigint,turns_sha256:string,loss_chars:bigint,loss_sha256:string,formatted_chars:bigint>"
_DIGEST_PA = pa.struct([("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def learned_text(ids: np.ndarray, mask: np.ndarray, encoder: TurnEncoder) -> str:
    """What the ids under the mask say, run by run, unescaped."""
    edges = np.flatnonzero(np.diff(np.r_[np.int8(0), mask, np.int8(0)]))
    return "".join(unescape(encoder.bpe.decode_bytes(ids[s:e].tolist()).decode())
                   for s, e in zip(edges[::2], edges[1::2], strict=True))


def conversation_report(rows: DataFrame, vocabulary: str) -> DataFrame:
    """Digests read back from the formatted conversations, their ids and masks."""
    @arrow_udf(_DIGEST)
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        encoder = TurnEncoder(vocabulary)
        for formatted, ids, masks in batches:
            out = []
            for k, f in enumerate(formatted.to_pylist()):
                i, m = (x[k].values.to_numpy() for x in (ids, masks))
                turns, learned = read_back(f), learned_text(i, m, encoder)
                digest = "".join(f"{r}\n{t}\n" for r, t in turns)
                out.append({"n_turns": len(turns), "turns_sha256": hashlib.sha256(digest.encode()).hexdigest(),
                            "loss_chars": len(learned), "loss_sha256": hashlib.sha256(learned.encode()).hexdigest(),
                            "formatted_chars": len(f)})
            yield pa.array(out, _DIGEST_PA)

    done = format_conversations(rows, vocabulary)
    return done.select("conv_id", run("formatted", "input_ids", "loss_mask").alias("d")).select("conv_id", "d.*")
