"""Secret scans over an incremental blob ledger, as column expressions and joins only.

Every version of every path is content-addressed by the SHA-256 of its whole text.  Only
blobs that the ledger does not hold for the current rule version are scanned, once each
however many paths share them; their findings are appended to the ledger, a table in the
shared folder, and joined back to all paths.  A blob without findings is in the ledger too.

Matches are found by splitting the text at the pattern and running the lengths of the
pieces, so spans are code-point offsets without any per-row function.

Defined cases: a null text counts as the empty text; repeated rows each get the findings
of their blob; an empty table gives an empty table; extra columns are carried through.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promoflow.llm.common import sha256_hex, whole_row
from promoflow.session import checkpoint_dir

# Kinds in the order that breaks ties, with pattern, and for a match that
# must be longer than the pattern says, the group that counts and its least length.
BASE_RULES = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    # Maximal runs, so the length may stand in the pattern.
    ("hex", r"[0-9a-f]{32,}", 0, 32),
]
MORE_RULES = [
    ("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 0),
    ("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ("forge_token", r"\bgh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("chat_token", r"\bxox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("maps_key", r"\bAIza[A-Za-z0-9_-]{35}", 0, 0),
    ("url_password", r"\b[a-z][a-z0-9+.-]{1,20}://[^\s:/@]{1,64}:[^\s:/@]{3,64}@", 0, 0),
]
RULES = BASE_RULES + MORE_RULES
#: Goes up with every change of the rules; the ledger keeps findings by it.
RULE_VERSION = 1
#: One cheap test that holds for every text with a match of any rule.
_MAYBE = r"(?i)passw|secret|token|api_?key|AKIA|[0-9a-f]{32}|-----BEGIN|eyJ|gh[pousr]_|xox[abprs]-|AIza|://"
_SPAN = "struct<kind:string,rank:int,start:bigint,end:bigint>"


#: Elements summed at a time where the start of a match is found.
_RUN = 1 << 6


def _div(c: Column) -> Column:
    return F.shiftright(c, 6)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _summed(a: Column, first: Column, end: Column) -> Column:
    """Sum of a[first] .. a[end - 1]."""
    return F.when(end > first, F.aggregate(F.sequence(first, end - 1), F.lit(0).cast("bigint"), lambda s, j: s + F.get(a, j))
                  ).otherwise(F.lit(0).cast("bigint"))


def _run_sums(a: Column) -> Column:
    n = F.size(a)
    return F.transform(F.sequence(F.lit(0), _div(n - 1)), lambda b: _summed(a, b * _RUN, F.least(b * _RUN + _RUN, n)))


def matches(text: Column, rule: tuple) -> Column:
    """(gap, hit, ok) of the leftmost non-overlapping matches of one rule: the lengths of what
    lies between them and of themselves, and whether they are long enough."""
    kind, pattern, group, least = rule
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def sized(gap, hit):
        long_enough = F.length(F.regexp_extract(hit, pattern, group)) >= least if group else F.length(hit) >= least
        return F.struct(F.length(gap).alias("gap"), F.length(hit).alias("hit"), long_enough.alias("ok"))

    pairs = F.zip_with(F.split(text, pattern, -1), hits, sized)  # the last piece has no match after it
    return F.when(text.rlike(pattern), F.filter(pairs, lambda x: x["hit"].isNotNull()))


def placed(m: Column, kind: Column, rank: Column) -> Column:
    """Spans of the matches ``m`` that are long enough.

    What lies before a match is the rest of its run of 64 matches, the runs before in its
    run of runs, and those before, so a text with very many matches takes linear time."""
    def spans(steps, runs, wide):
        def span(x, i):
            r = _div(i)
            before = _summed(steps, r * _RUN, i) + _summed(runs, _div(r) * _RUN, r) + _summed(wide, F.lit(0), _div(r))
            return F.struct(before.alias("at"), x.alias("x"))

        return F.transform(F.filter(F.transform(m, span), lambda s: s["x"]["ok"]), lambda s: F.struct(
            kind.alias("kind"), rank.alias("rank"), (s["at"] + s["x"]["gap"]).alias("start"),
            (s["at"] + s["x"]["gap"] + s["x"]["hit"]).alias("end")))

    return _let(F.transform(m, lambda x: (x["gap"] + x["hit"]).cast("bigint")), lambda steps: _let(
        _run_sums(steps), lambda runs: _let(_run_sums(runs), lambda wide: spans(steps, runs, wide))))


def scan(blobs: DataFrame, rule_version: int = RULE_VERSION) -> DataFrame:
    """(blob_id, text) to (blob_id, rule_version, spans), spans in order of start and kind."""
    none = F.array().cast(f"array<{_SPAN}>")
    # One expression places the matches of all rules: a copy for each would take long to plan.
    found = F.filter(F.array(*[F.struct(F.lit(r[0]).alias("kind"), F.lit(i).alias("rank"), matches(F.col("text"), r).alias("m"))
                               for i, r in enumerate(RULES)]), lambda x: F.size(x["m"]) > 0)
    spans = F.flatten(F.transform(found, lambda x: placed(x["m"], x["kind"], x["rank"])))
    by_place = F.transform(F.sort_array(F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"]))),
                           lambda s: F.struct(s["kind"].alias("kind"), s["rank"].alias("rank"),
                                              s["start"].alias("start"), s["end"].alias("end")))
    return blobs.select("blob_id", F.lit(rule_version).alias("rule_version"),
                        F.when(F.col("text").rlike(_MAYBE), by_place).otherwise(none).alias("spans"))


def new_ledger(spark) -> str:
    """Path of an empty ledger in the shared folder."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-ledger-{uuid.uuid4().hex}"
    spark.createDataFrame([], f"blob_id string, rule_version int, spans array<{_SPAN}>, scan int").write.parquet(path)
    return path


def update_ledger(versions: DataFrame, ledger: str, rule_version: int = RULE_VERSION) -> None:
    """Scan the texts of ``versions`` that the ledger does not hold under this rule version.
    The ledger numbers its scans from 1, and each blob keeps the number of its own."""
    spark = versions.sparkSession
    text = F.coalesce("text", F.lit(""))
    # Copies meet map-side first; of a text with a great many copies, one goes on per task.
    blobs = versions.select(sha256_hex(text).alias("blob_id"), text.alias("text")).groupBy("blob_id").agg(
        F.first("text").alias("text"))
    kept = spark.read.parquet(ledger)
    number = (kept.agg(F.max("scan")).first()[0] or 0) + 1
    seen = kept.filter(F.col("rule_version") == rule_version).select("blob_id")
    (scan(blobs.join(seen, "blob_id", "left_anti"), rule_version).withColumn("scan", F.lit(number))
     .write.mode("append").parquet(ledger))


def findings(versions: DataFrame, ledger: str, rule_version: int = RULE_VERSION) -> DataFrame:
    """Every row of ``versions`` as the struct ``__row`` with its ``__blob``, ``__spans`` and
    ``__scan``, the number of the scan that read its blob."""
    spark = versions.sparkSession
    found = (spark.read.parquet(ledger).filter(F.col("rule_version") == rule_version)
             .select(F.col("blob_id").alias("__blob"), "spans", "scan"))
    rows = whole_row(versions).withColumn("__blob", sha256_hex(F.coalesce(F.col("__row")["text"], F.lit(""))))
    return rows.join(found, "__blob", "left").select(
        "__row", "__blob", F.coalesce("spans", F.array().cast(f"array<{_SPAN}>")).alias("__spans"), F.col("scan").alias("__scan"))


def secret_report(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, scan) of every row, through the
    ledger: texts it holds are not scanned again."""
    ledger = ledger or new_ledger(docs.sparkSession)
    update_ledger(docs.select("text"), ledger)
    slim = docs.select("doc_id", "text")
    rows = findings(slim, ledger).select(F.col("__row")["doc_id"].alias("doc_id"), F.col("__spans").alias("s"), "__scan")
    count = lambda k: F.size(F.filter("s", lambda x: x["kind"] == k)).cast("bigint")
    shown = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("s", lambda x: x["rank"] < len(BASE_RULES))
    return rows.select("doc_id", *[count(k).alias(f"n_{k}") for k, *_ in BASE_RULES],
                       sha256_hex(shown(base)).alias("base_sha256"), shown(F.col("s")).alias("spans"), F.col("__scan").alias("scan"))
