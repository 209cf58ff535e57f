"""Corpus pipeline: toxicity, near copies, benchmark passages, personal data, packing.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and
returns a DataFrame that is written as Parquet and reread as the next one's docs.
"""

from __future__ import annotations

import public_tokenizers

from promoflow.llm.common import table, written
from promoflow.llm.decontam import drop_contaminated
from promoflow.llm.packing import pack
from promoflow.llm.pii import pseudonymised
from promoflow.llm.queries import VOCABULARY
from promoflow.llm.simhash import drop_near_copies
from promoflow.llm.toxicity import drop_toxic


def toxicity(spark, docs, sf_dir):
    """Documents scored under 0.7 stay."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_copies(spark, docs, sf_dir):
    """One document of each SimHash component (three-word shingles, three bits) stays."""
    return drop_near_copies(docs, words_per_shingle=3, max_distance=3)


def decontamination(spark, docs, sf_dir):
    """Documents without any window of a benchmark item stay."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii(spark, docs, sf_dir):
    """Personal numbers, dates and addresses become pseudonyms."""
    return pseudonymised(docs)


def packing(spark, docs, sf_dir):
    """Token pieces with their ids, packed into sequences of 2048."""
    return pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [("toxicity", toxicity), ("simhash_near_dedup", near_copies), ("decontamination", decontamination),
          ("pii", pii), ("packing", packing)]


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name)
    return docs


#: Trained scores and hashed links have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None
