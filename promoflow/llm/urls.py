"""URL filters with redirect equivalence.

A rule allows or blocks a host with all its subdomains below a path prefix; the longest
rule that fits decides.  Addresses no rule fits take the decision of their aliases.  Two
addresses are aliases when they are one address written in two ways (scheme, default port,
``www.`` or ``m.``, fragment, closing slash, tracking parameters), or when a redirect or
canonical link leads from one to the other.  Links come from the pages themselves
(``<link rel=canonical>``, ``<meta http-equiv=refresh>``) and from an optional table of
redirects.  Components over these edges are found distributed; a component with one
blocked address, crawled or only linked to, blocks all its addresses, except those an
explicit rule allows.

Page texts are read for their links only and never move; one narrow row a page does.

Defined cases: a null address, or one without ``://``, has an empty host and path, fits no
rule, has no aliases and is allowed; links that cannot be resolved, and links in comments,
scripts and styles, are none; null and empty page texts have no links; repeated rows each
give a row; of rules of one length the one with the longer host wins, then block before
allow; an empty table gives an empty table; other columns are left out.
"""

from __future__ import annotations

import html as markup
import re
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from promoflow.llm.common import LOWER, UPPER, prepare, written
from promoflow.llm.components import connected_components

_REST = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
#: Query parameters that say where a reader came from, not what is read.
TRACKING = r"^(?:utm_[^=]*|gclid|fbclid|msclkid|ref|ref_src)(?:=|$)"

_SKIPPED = re.compile(r"<!--.*?(?:-->|$)|<(script|style)\b.*?(?:</\1\s*>|$)", re.S | re.I)
_TAG = re.compile(r"""<(link|meta|base)\b((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.I)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_REFRESH = re.compile(r"""\s*[\d.]*\s*[;,]\s*url\s*=\s*["']?([^"']+)""", re.I)


def page_links(url: str | None, text: str | None) -> list[str]:
    """Absolute targets of the canonical and refresh links of one page."""
    base, found = url or "", []
    for tag, inside in _TAG.findall(_SKIPPED.sub(" ", text or "")):
        a: dict[str, str] = {}
        for name, *values in _ATTRIBUTE.findall(inside):
            a.setdefault(name.lower(), markup.unescape("".join(values)).strip())
        target = ""
        if tag.lower() == "base":
            base = _resolved(url or "", a.get("href", "")) or base
        elif tag.lower() == "link" and "canonical" in a.get("rel", "").lower().split():
            target = a.get("href", "")
        elif tag.lower() == "meta" and a.get("http-equiv", "").lower() == "refresh":
            m = _REFRESH.match(a.get("content", ""))
            target = m[1].strip() if m else ""
        if target and (whole := _resolved(base, target)):
            found.append(whole)
    return found


def _resolved(base: str, target: str) -> str:
    try:
        whole = urljoin(base, target)
    except ValueError:
        return ""
    return whole if "://" in whole else ""


def _links(url: Column, text: Column) -> Column:
    @arrow_udf("array<string>")
    def run(urls: pa.Array, texts: pa.Array) -> pa.Array:
        return pa.array([page_links(u, t) for u, t in zip(urls.to_pylist(), texts.to_pylist(), strict=True)],
                        pa.list_(pa.string()))
    return run(url, text)


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _REST, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _REST, 2), F.lit(""))


def address_of(url: Column) -> Column:
    """The one form of all ways to write an address; null where there is none."""
    host = F.regexp_replace(host_of(url), r":(?:80|443)$", "")
    host = F.regexp_replace(host, r"^(?:www|m)\.(?=[^.]+\.[^.])", "")
    asked = F.filter(F.split(F.regexp_extract(url, _REST, 3), "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING))
    scheme = F.lower(F.regexp_extract(url, r"^\s*([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    return F.when(F.contains(url, F.lit("://")), F.concat(
        F.when(scheme.isin("http", "https", ""), "").otherwise(F.concat(scheme, F.lit("://"))), host,
        F.rtrim(path_of(url), F.lit("/")),
        F.when(F.size(asked) > 0, F.concat(F.lit("?"), F.array_join(asked, "&"))).otherwise("")))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """(text, verdict) of the longest rule that fits, else null.  ``rules`` has (verdict,
    host, path) and travels with the plan: a list of hundreds, not a table."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block", r[1]))
    fits = lambda h, p: ((host == h) | host.endswith("." + h)) & path.startswith(p)
    kind = "struct<text:string,verdict:string>"
    return F.coalesce(F.lit(None).cast(kind), *[
        F.when(fits(h, p), F.struct(F.lit(h + p).alias("text"), F.lit(v).alias("verdict"))) for v, h, p in order])


def _judged(df: DataFrame, url: str, rules: list[tuple[str, str, str]]) -> DataFrame:
    c = F.col(url)
    return (df.withColumns({"__host": host_of(c), "__path": path_of(c)})
            .withColumns({"__rule": rule_of(F.col("__host"), F.col("__path"), rules), "__address": address_of(c)}))


def alias_blocks(pages: DataFrame, links: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Distinct (address) that are blocked by a rule of their own or of an alias.
    ``pages`` has (url), ``links`` has (source, target) addresses as they are written."""
    both = links.select("source", "target").union(links.select("target", "source"))
    seen = _judged(pages.select("url").union(both.select(F.col("source").alias("url"))), "url", rules)
    own = written(seen.filter((F.col("__rule.verdict") == "block") & F.col("__address").isNotNull())
                  .select(F.col("__address").alias("address")).distinct(), "blocked")
    edges = (links.select(address_of(F.col("source")).alias("a"), address_of(F.col("target")).alias("b"))
             .filter("a is not null and b is not null and a <> b").distinct())
    names = written(edges.select(F.col("a").alias("address")).union(edges.select("b")).distinct()
                    .withColumn("id", F.monotonically_increasing_id()), "addresses")
    numbered = (edges.join(names.select(F.col("address").alias("a"), F.col("id").alias("u")), "a")
                .join(names.select(F.col("address").alias("b"), F.col("id").alias("v")), "b").select("u", "v"))
    members = written(connected_components(numbered).join(names, F.col("node") == F.col("id")).select("root", "address"),
                      "aliases")
    roots = members.join(own, "address", "left_semi").select("root").distinct()
    return own.union(members.join(roots, "root", "left_semi").select("address")).distinct()


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, address, by_alias) of every row of ``pages``
    (page_id, url, html).  ``redirects`` has (source, target) addresses of a crawl."""
    prepare(pages.sparkSession)
    said = F.col("html").rlike("(?i)canonical|refresh")
    links = (pages.filter(said & F.contains(F.col("url"), F.lit("://"))).select("url", _links(F.col("url"), F.col("html")).alias("to"))
             .select(F.col("url").alias("source"), F.explode("to").alias("target")))
    if redirects is not None:
        links = links.union(redirects.select("source", "target"))
    blocked = written(alias_blocks(pages, written(links, "page-links"), rules), "blocked-aliases")
    rows = _judged(pages.select("page_id", "url"), "url", rules)
    out = lambda df, verdict, by_alias: df.select(
        "page_id", F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__rule.text").alias("rule"),
        verdict.alias("verdict"), F.col("__address").alias("address"), by_alias.alias("by_alias"))
    free = rows.filter(F.col("__rule").isNull()).join(
        blocked.select(F.col("address").alias("__address"), F.lit(True).alias("__hit")), "__address", "left")
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    return out(rows.filter(F.col("__rule").isNotNull()), F.col("__rule.verdict"), F.lit(False)).union(
        out(free, F.when(hit, "block").otherwise("allow"), hit))
