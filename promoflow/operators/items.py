"""Offer items (C2-C5): item payloads -> (offer_id, item_number, item_type) rows.

One plan for all events of a batch: explode the item payloads, keep those referenced by
the first award, explode inline lists and join big-list payloads to their files by list
key, map item types, drop excluded-category items with one anti join.  The plan does not
grow with the number of payloads or events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promoflow import settings as S
from promoflow.functions.columns import first_element
from promoflow.operators.joins import kept
from promoflow.settings import DEFAULT_CONFIG, EngineConfig
from promoflow.sources.biglists import named_columns, unnamed_column


def item_type_mapping(item_type: Column, cfg: EngineConfig = DEFAULT_CONFIG) -> Column:
    """Payload item type (plural) -> stored item type; NULL for any other type (X11)."""
    return (F.when(item_type == F.lit(cfg.discounted_items), F.lit(cfg.discounted_item))
            .when(item_type == F.lit(cfg.eligible_items), F.lit(cfg.eligible_item)))


def referenced_payloads(offer_events: DataFrame) -> DataFrame:
    """Item payloads whose ``refId`` is among the first (trimmed) award's ``itemRefId``.

    Returns (event_id, offer_id, offer_source, pos, item_type, list_type, item_list,
    list_key).  A NULL or empty award list, or NULL references, match nothing.
    """
    p = "e.payload"
    refs = F.transform(first_element(F.col("awards"))["itemRefId"], lambda x: x.try_cast("int"))
    x = offer_events.select(
        "event_id", F.col(f"{p}.promotionNumber").try_cast("bigint").alias("offer_id"), "offer_source",
        refs.alias("refs"), F.posexplode(f"{p}.itemDetails.itemsPayload").alias("pos", "ip"))
    ref_id = F.col("ip.refId").try_cast("int")
    return (x.filter(F.coalesce(F.array_contains("refs", ref_id), F.lit(False)))
            .select("event_id", "offer_id", "offer_source", "pos",
                    F.col("ip.itemType").alias("payload_item_type"),
                    F.lower(F.col("ip.itemListType")).alias("list_type"),
                    F.col("ip.itemList").alias("item_list"),
                    F.col("ip.itemBigListURL").alias("list_key")))


def bad_item_numbers() -> Column:
    """A referenced inline list holds a value that is no item number."""
    return (F.col("list_type") == "list") & F.coalesce(
        F.exists("item_list", lambda x: x.try_cast("bigint").isNull()), F.lit(False))


def inline_items(payloads: DataFrame, cfg: EngineConfig = DEFAULT_CONFIG) -> DataFrame:
    """Items of ``list`` payloads (C2): (event_id, offer_id, item_number, item_type)."""
    return (payloads.filter(F.col("list_type") == "list")
            .select("event_id", "offer_id", F.explode("item_list").alias("item"),
                    item_type_mapping(F.col("payload_item_type"), cfg).alias("item_type"))
            .filter(F.col("item_type").isNotNull())
            .select("event_id", "offer_id", F.col("item").try_cast("bigint").alias("item_number"), "item_type"))


def item_rows_by_source(lines: DataFrame, offer_events: DataFrame) -> DataFrame:
    """(list_key, offer_source, c0) of item files with open layout (``read_list_lines``), each
    read as the sources of the events that name it do: by the name of its column for
    personalised-ranking (tetris) offers, as one unnamed column for the others."""
    sources = kept(referenced_payloads(offer_events).filter(F.col("list_type") != "list")
                   .select("list_key", "offer_source").distinct(), "item-sources")
    tetris = F.lower("offer_source") == S.LABEL_TETRIS
    read = [(named_columns, (S.ITEM_COLUMN, S.PROPENSITY_COLUMN), tetris), (unnamed_column, (), ~tetris)]
    parts = []
    for reader, names, which in read:
        own = sources.filter(which)
        rows = reader(lines.join(own.select("list_key").distinct(), "list_key", "left_semi"), *names)
        parts.append(rows.join(own, "list_key").select("list_key", "offer_source", "c0"))
    return parts[0].unionByName(parts[1])


def rows_of(item_rows: DataFrame) -> list[str]:
    """The columns that tell which rows of item files an event reads: the file, and the source
    where files are read by it."""
    return ["list_key"] + ["offer_source"] * ("offer_source" in item_rows.columns)


def biglist_numbers(item_rows: DataFrame) -> DataFrame:
    """(list_key, item_number) of item files: the first column is the item number in every
    layout (a second, propensity column is dropped)."""
    return item_rows.select(*rows_of(item_rows), F.col("c0").try_cast("bigint").alias("item_number"))


def biglist_payloads(payloads: DataFrame, cfg: EngineConfig = DEFAULT_CONFIG) -> DataFrame:
    """(event_id, offer_id, offer_source, list_key, item_type) of referenced big-list payloads."""
    return (payloads.filter(F.col("list_type") != "list")
            .select("event_id", "offer_id", "offer_source", "list_key", item_type_mapping(F.col("payload_item_type"), cfg).alias("item_type"))
            .filter(F.col("item_type").isNotNull()))


#: Items of a block of a file, about.
BLOCK = 1024


def item_blocks(numbers: DataFrame, by: list[str]) -> DataFrame:
    """(``by``, items): the item numbers of each file in blocks of about ``BLOCK`` lines, cut by
    a hash of the number, so a file of any length is several rows.  An event meets the blocks of
    its file and they are written out last: what is joined is a row for each event and block."""
    n = numbers.groupBy(*by).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    cut = numbers.join(n, by).select(*by, "item_number", F.pmod(F.xxhash64("item_number"), F.col("blocks")).alias("block"))
    # In structs, as NULL numbers are lines too; spread by block, as one file may be most of all lines.
    return (cut.repartition(*by, "block").groupBy(*by, "block").agg(F.collect_list(F.struct("item_number")).alias("items"))
            .drop("block"))


def _listed_items(blocks: DataFrame, payloads: DataFrame, by: list[str]) -> DataFrame:
    """(event_id, offer_id, item_number, item_type) of payloads and the blocks of their files."""
    return (blocks.join(payloads, by).select("event_id", "offer_id", "item_type", F.explode("items").alias("item"))
            .select("event_id", "offer_id", "item.item_number", "item_type"))


def biglist_items(payloads: DataFrame, item_rows: DataFrame, cfg: EngineConfig = DEFAULT_CONFIG) -> DataFrame:
    """Items of big-list payloads (C3), joined to the file rows by list key: (event_id,
    offer_id, item_number, item_type)."""
    by = rows_of(item_rows)
    return _listed_items(item_blocks(biglist_numbers(item_rows), by), biglist_payloads(payloads, cfg), by)


def excluded_items(catalogue: DataFrame, category: int) -> DataFrame:
    """Item numbers of the excluded merchandise category."""
    return (catalogue.filter(F.col("MDSE_CATG_CD") == category)
            .select(F.explode("ITEM_ID_ARRAY").alias("item_id"))
            .select(F.col("item_id").cast("bigint").alias("item_number"))
            .distinct())


def exclude_items(items: DataFrame, catalogue: DataFrame, category: int) -> DataFrame:
    """Drop items of the excluded category (SET1 + J2 as one anti join); NULL numbers drop."""
    return items.filter(F.col("item_number").isNotNull()).join(excluded_items(catalogue, category), "item_number", "left_anti")


def offer_items(offer_events: DataFrame, item_rows: DataFrame, catalogue: DataFrame,
                cfg: EngineConfig = DEFAULT_CONFIG) -> DataFrame:
    """All items of each event (C5): (event_id, item_number, item_type, offer_id, product_id).

    Repeated items stay repeated (UNION ALL), like the original union of chunks.  The lines
    of a file are cast and cleared of the excluded category once, before the events that name
    the file fan them out.
    """
    pl = referenced_payloads(offer_events)
    clear = lambda df: exclude_items(df, catalogue, cfg.excluded_category)
    big = biglist_payloads(pl, cfg)
    by = rows_of(item_rows)
    files = clear(biglist_numbers(item_rows).join(big.select(*by).distinct(), by, "left_semi"))
    both = clear(inline_items(pl, cfg)).select("event_id", "offer_id", "item_number", "item_type").unionByName(_listed_items(item_blocks(files, by), big, by))
    return both.select("event_id", "item_number", "item_type", "offer_id", F.lit("").alias("product_id"))
