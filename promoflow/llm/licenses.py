"""License scans: Aho-Corasick finds identifier tags and notice phrases in one pass over
the words of the whole text; a shunting-yard evaluation of and/or/with licence expressions
decides what a tag allows.

Words are lower-cased A-Z and joined by blanks, so a phrase is found where its words stand
consecutively.  A tag is the words "spdx license identifier"; the expression after it is
read from the text itself, to the end of its line.

Defined cases: a null text counts as the empty text, with no words, no labels and the
neutral score; a malformed expression labels its identifiers and scores as unknown;
overlapping places all count; repeated rows each give a row; an empty table gives an empty
table; extra columns are carried through.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from promoflow.llm.common import prepare, utf8, whole_row

# Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Further notices, each with its label.
NOTICES = {
    "apache license": "apache", "mit license": "mit", "bsd license": "bsd",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl", "lesser general public license": "lgpl",
    "affero general public license": "agpl", "creative commons": "cc", "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc0": "cc0", "public domain": "public-domain",
    "proprietary and confidential": "proprietary",
}
#: How freely a text under a label may be used, 0 to 1; unknown identifiers are neutral.
OPENNESS = {
    "public-domain": 1.0, "cc0": 1.0, "mit": 0.95, "bsd": 0.95, "apache": 0.95, "isc": 0.95, "unlicense": 1.0,
    "cc-by": 0.9, "mpl": 0.7, "lgpl": 0.7, "cc-by-sa": 0.7, "cc": 0.6, "gpl": 0.5, "agpl": 0.4,
    "cc-by-nc": 0.2, "cc-by-nd": 0.2, "proprietary": 0.0, "reserved": 0.05,
}
NEUTRAL = 0.5
TAG = "spdx license identifier"

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_TAG = re.compile(r"spdx-license-identifier:", re.IGNORECASE)
_TOKEN = re.compile(r"[A-Za-z0-9][A-Za-z0-9.+:-]*|[()\r\n]")
_POWER = {"or": 1, "and": 2, "with": 3}


def identifier_openness(name: str) -> float:
    """Openness of an SPDX identifier by its family: the longest known label it begins with."""
    low = name.lower()
    known = [k for k in OPENNESS if low == k or low.startswith(k + "-")]
    return OPENNESS[max(known, key=len)] if known else NEUTRAL


def evaluate_expression(text: str, at: int = 0) -> tuple[float, list[str]]:
    """(openness, identifiers) of the licence expression from ``at`` on, which goes as far as
    tokens of its line make one, by shunting yard: ``or`` leaves the
    choice, so the freer side counts; ``and`` binds to both; ``with`` is an exception that
    loosens its licence a little.  What is no expression is neutral."""
    out: list[tuple[float, str]] = []
    held: list[str] = []
    names: list[str] = []

    def apply():
        op, (y, b), (x, _) = held.pop(), out.pop(), out.pop()
        if op == "with":
            out.append(((x + 1) / 2 if b else x, ""))
        else:
            out.append((max(x, y) if op == "or" else min(x, y), ""))

    want = True  # an identifier or an opening parenthesis
    try:
        for m in _TOKEN.finditer(text, at):
            token, low = m[0], m[0].lower()
            if token in "\r\n":
                break
            if low in _POWER and not want:
                while held and held[-1] != "(" and _POWER[held[-1]] >= _POWER[low]:
                    apply()
                held.append(low)
                want = True
            elif token == "(" and want:
                held.append(token)
            elif token == ")" and not want:
                while held[-1] != "(":
                    apply()
                held.pop()
            elif want and low not in _POWER and token != ")":
                exception = bool(held) and held[-1] == "with"
                out.append((identifier_openness(token), low if exception else ""))
                if not exception:
                    names.append(low)
                want = False
            else:
                break  # the expression ends here
        while held:
            apply()
        return (out[-1][0] if len(out) == 1 else NEUTRAL), names
    except IndexError:
        return NEUTRAL, names


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for phrase, label in {**NOTICES, **BASE, TAG: None}.items():
        a.add_word(f" {phrase} ", (phrase, label, phrase in BASE))
    a.make_automaton()
    return a


def scan_text(text: bytes, a: ahocorasick.Automaton) -> dict:
    """Places, labels and score of one whole text."""
    words = _WORD.findall(text.lower())
    line = b" ".join([b"", *words, b""]).decode("latin-1")  # one character per byte, phrases are ASCII
    first = last = None
    base, labels, scores, n, at, counted = set(), set(), [], 0, 0, 0
    tagged = False
    for end, (phrase, label, is_base) in sorted(a.iter(line), key=lambda x: x[0] - len(x[1][0])):
        start = end - len(phrase)  # of the phrase's first word
        counted, at = counted + line.count(" ", at, start), start
        if label is None:
            tagged = True
            continue
        labels.add(label)
        scores.append(OPENNESS[label])
        if is_base:
            word = counted - 1
            n, first, last = n + 1, word if first is None else first, word
            base.add(label)
    if tagged:
        whole = text.decode()
        for m in _TAG.finditer(whole):
            score, names = evaluate_expression(whole, m.end())
            scores.append(score)
            labels.update(names)
    return {"n_words": len(words), "n_base": n, "first_word": first, "last_word": last,
            "base_labels": sorted(base), "labels": sorted(labels), "score": min(scores, default=NEUTRAL)}


_FOUND = ("struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,"
          "base_labels:array<string>,labels:array<string>,score:double>")
_FOUND_PA = pa.struct([*[(c, pa.int64()) for c in ("n_words", "n_base", "first_word", "last_word")],
                       ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("score", pa.float64())])


def license_findings(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` as the struct ``__row`` with ``__found``."""
    prepare(docs.sparkSession)

    @arrow_udf(_FOUND)
    def run(texts: pa.Array) -> pa.Array:
        a = automaton()
        return pa.array([scan_text(t, a) for t in utf8(texts)], _FOUND_PA)

    return whole_row(docs).select("__row", run(F.col("__row")["text"]).alias("__found"))


def license_report(docs: DataFrame) -> DataFrame:
    f = F.col("__found")
    return license_findings(docs.select("doc_id", "text")).select(
        F.col("__row")["doc_id"].alias("doc_id"), *[f[c].alias(c) for c in ("n_words", "n_base", "first_word", "last_word")],
        *[F.array_join(f[c], ",").alias(c) for c in ("base_labels", "labels")], f["score"].alias("score"))
