"""Engine inputs built from the driver's test tables.

These adapters only give rows in the shapes the engine expects (events as JSON text,
audience and list files as raw text rows, lookup and stored tables); they do none of the
engine's work.  The matching oracle SQL in ``promoflow/oracle_sql.py`` re-derives the same
inputs with the same expressions and computes the expected results in flat SQL.

Audience domain
  cards           customer: card = c_custkey, member = 'U' || (c_custkey div 2), flags by
                  balance, segment and nation
  member files    events: file 'members/list-<event_id % 20>.csv', card = user_id,
                  propensity text = value
  list offers     one stored offer per key (o_orderkey % 20) of orders, source and stored
                  list location by key
  member_offers   orders: (o_orderkey % 20, member of o_custkey), card = smallest card,
                  propensity = largest o_totalprice / 100000
  list events     one per file key of events: ids [k, k + 100], location of file k,
                  arrival = first event time of the key; every fourth sends ids as text

Offer domain
  offer events    one JSON event per order; offer id = o_custkey (so an offer has many
                  update events), awards and item payloads from the order's lineitems,
                  labels from the customer segment, stores and overrides from suppliers
  item files      'items/supplier-<s>.csv': parts of supplier s's lines with quantity >= 45
  store files     'stores/nation-<n>.csv': suppliers of nation n
  catalogue       part grouped by (p_brand, p_size): category = p_size
  store directory supplier x nation
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# ---------------------------------------------------------------------------
# Audience domain
# ---------------------------------------------------------------------------
def cards(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("cardNumber"),
        F.expr("'U' || cast(c_custkey div 2 as string)").alias("membershipId"),
        F.expr("CASE WHEN c_acctbal < 0 THEN 'N' ELSE 'Y' END").alias("current_ind"),
        F.lit("Y").alias("card_current_ind"),
        F.expr("CASE c_mktsegment WHEN 'MACHINERY' THEN ' ACTIVE ' WHEN 'BUILDING' THEN 'PICKUP' "
               "WHEN 'AUTOMOBILE' THEN 'EXPIRED ' WHEN 'FURNITURE' THEN 'SUSPENDED' "
               "ELSE 'ACTIVE' END").alias("cardStatus"),
        F.expr("CASE WHEN c_nationkey = 24 THEN 'AFFILIATE' ELSE 'MEMBERSHIPACCOUNT' END")
        .alias("cardType"))


def member_files(spark, d) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(
        F.expr("'members/list-' || cast(event_id % 20 as string) || '.csv'").alias("list_key"),
        F.col("user_id").cast("string").alias("c0"),
        F.col("value").cast("string").alias("c1"))


def list_offers(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    k = o.select((F.col("o_orderkey") % 20).alias("offer_id")).distinct()
    return k.select(
        "offer_id",
        F.expr("CASE offer_id % 3 WHEN 0 THEN 'BROADREACH' WHEN 1 THEN 'TETRIS' ELSE 'TIO' END")
        .alias("offer_source"),
        F.expr("CASE WHEN offer_id % 5 = 4 THEN 'members/list-' || cast(offer_id as string) || '.csv' "
               "ELSE 'members/list-' || cast(offer_id as string) || '-prev.csv' END")
        .alias("member_list_location"))


def member_offers(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    return (o.select((F.col("o_orderkey") % 20).alias("offer_id"),
                     F.expr("'U' || cast(o_custkey div 2 as string)").alias("membership_uuid"),
                     F.col("o_custkey").cast("string").alias("card"),
                     "o_totalprice")
            .groupBy("offer_id", "membership_uuid")
            .agg(F.min("card").alias("membership_id"),
                 F.round(F.max("o_totalprice") / 100000, 4).alias("propensity")))


def list_events_raw(spark, d) -> DataFrame:
    """(event_id, arrival, raw): member-list events as JSON text."""
    e = table(spark, d, "events")
    g = (e.groupBy((F.col("event_id") % 20).alias("k"))
         .agg(F.min("ts").alias("first_ts")))
    ids = F.expr("CASE WHEN k % 4 = 3 "
                 "THEN '\"' || cast(k as string) || '\",\"' || cast(k + 100 as string) || '\"' "
                 "ELSE cast(k as string) || ',' || cast(k + 100 as string) END")
    raw = F.concat(F.lit('{"offerIdList":['), ids, F.lit('],"memberBigListLocation":"members/list-'),
                   F.col("k").cast("string"), F.lit('.csv"}'))
    return g.select(F.concat(F.lit("L"), F.col("k").cast("string")).alias("event_id"),
                    F.col("first_ts").cast("timestamp").alias("arrival"),
                    raw.alias("raw"))


# ---------------------------------------------------------------------------
# Offer domain
# ---------------------------------------------------------------------------
_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
               "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _order_lines(spark, d) -> DataFrame:
    """(l_orderkey, lines): the lines of an order, sorted.  Only the table's own columns move;
    the parts of an event are made of them where the event is made."""
    li = table(spark, d, "lineitem")
    return li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(*_LINE_ORDER))).alias("lines"))


def _award(x):
    percent = F.round(x["l_discount"] * 100).cast("bigint").cast("string")
    return F.struct(
        x["l_partkey"].cast("string").alias("promotionItemNumber"),
        F.when(x["l_returnflag"] == "R", "MEMBERSHIP_DISCOUNT").otherwise("DISCOUNT_ITEM_PRICE").alias("awardType"),
        F.when((x["l_discount"] == 0) & (x["l_tax"] == 0), "").otherwise(percent).alias("value"),
        F.when(x["l_quantity"] == 50, "BOGO").when(x["l_linestatus"] == "O", "DOLLAR_OFF")
        .otherwise("PERCENTAGE_OFF").alias("discountMethod"),
        F.array(x["l_linenumber"].cast("string"), (x["l_linenumber"] + 1).cast("string")).alias("itemRefId"))


def _item(x):
    is_big = x["l_returnflag"] == "A"
    return F.struct(
        F.when(x["l_quantity"] > 48, "BONUS_ITEMS").when(x["l_linestatus"] == "O", "DISCOUNTED_ITEMS")
        .otherwise("ELIGIBLE_ITEMS").alias("itemType"),
        F.lit("1").alias("mpq"),
        F.when(is_big, "biglist").when((x["l_tax"] == 0.08) & (x["l_discount"] == 0.1), "List")
        .otherwise("list").alias("itemListType"),
        F.when(is_big, F.array().cast("array<string>")).otherwise(F.array(x["l_partkey"].cast("string"))).alias("itemList"),
        F.when(is_big, F.concat(F.lit("items/supplier-"), x["l_suppkey"].cast("string"), F.lit(".csv")))
        .alias("itemBigListURL"),
        x["l_linenumber"].cast("string").alias("refId"))


def _override(x):
    return F.struct(
        x["l_suppkey"].cast("string").alias("clubNumber"),
        F.date_format(x["l_shipdate"], "yyyy-MM-dd").alias("startDate"),
        F.when(x["l_returnflag"] == "A", "08:00:00").when(x["l_returnflag"] == "N", "").otherwise("7:5").alias("startTime"),
        F.date_format(F.date_add(x["l_shipdate"], 30), "yyyy-MM-dd").alias("endDate"),
        F.when(x["l_quantity"] < 10, "abc").otherwise("21:30:00").alias("endTime"),
        F.when(x["l_returnflag"] == "R", "EST").otherwise("CST").alias("timeZone"))


def _line_structs(x: DataFrame) -> DataFrame:
    """Adds the number of lines, awards, item payloads, store overrides and store ids of an
    order, made of its ``lines``."""
    suppliers = F.filter(F.transform("lines", lambda x: x["l_suppkey"]), lambda k: k.isNotNull())
    return x.select(
        "*", F.when(F.col("lines").isNotNull(), F.size("lines")).alias("n_lines"),
        F.transform("lines", _award).alias("awards"), F.transform("lines", _item).alias("items"),
        F.transform(F.filter("lines", lambda x: x["l_linestatus"] == "F"), _override).alias("overrides"),
        F.transform(F.sort_array(F.array_distinct(suppliers)), lambda k: k.cast("string")).alias("supplier_ids"))


def offer_events_raw(spark, d) -> DataFrame:
    """(event_id, arrival, raw): one offer event per order, as JSON text.

    The events are landed once per session as Parquet files under the shared checkpoint
    folder, as a broker connector would deliver them, and read from there.
    """
    return _landed(spark, d, "offer-events", _build_offer_events_raw)


_LANDED: dict = {}
#: Bytes of a row group of landed events, compressed to about a tenth of their text.
_ROW_GROUP = 4 << 20


def _landed(spark, d, name, build) -> DataFrame:
    from promoflow.session import checkpoint_dir
    import hashlib
    key = (id(spark), d, name)
    if key not in _LANDED:
        tag = hashlib.sha1(f"{d}|{name}".encode()).hexdigest()[:12]
        path = f"{checkpoint_dir(spark).rstrip('/')}/landing/{name}-{tag}"
        # Small row groups: a text takes long to parse, and a reader's task is a row group at least.
        (build(spark, d).write.mode("overwrite").option("compression", "zstd")
         .option("parquet.block.size", _ROW_GROUP).parquet(path))
        _LANDED[key] = path
    return spark.read.parquet(_LANDED[key])


def _build_offer_events_raw(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    lines = _order_lines(spark, d)
    x = _line_structs(o.join(c, o["o_custkey"] == c["c_custkey"], "left")
                      .join(lines, o["o_orderkey"] == lines["l_orderkey"], "left"))
    empty_s = F.array().cast("array<string>")
    no_members = F.col("o_orderpriority") == "5-LOW"
    club = F.expr("""CASE o_orderpriority
        WHEN '1-URGENT' THEN named_struct('clubType', 'list', 'bigListName', 'custom',
            'clubList', coalesce(supplier_ids, array()), 'clubBigListURL', cast(null as string), 'clubInclusion', true)
        WHEN '2-HIGH' THEN named_struct('clubType', 'biglist', 'bigListName', 'nation list',
            'clubList', array(), 'clubBigListURL', 'stores/nation-' || cast(c_nationkey as string) || '.csv',
            'clubInclusion', true)
        WHEN '3-MEDIUM' THEN named_struct('clubType', 'biglist', 'bigListName', 'nation list',
            'clubList', array(), 'clubBigListURL', 'stores/nation-' || cast(c_nationkey as string) || '.csv',
            'clubInclusion', o_orderstatus <> 'F')
        ELSE named_struct('clubType', 'Standard', 'bigListName',
            CASE o_orderstatus WHEN 'F' THEN 'ALL' WHEN 'O' THEN 'STANDARD CLUBS - PUERTO RICO ONLY'
                 ELSE 'STANDARD CLUBS - US EXCLUDING PUERTO RICO' END,
            'clubList', array(), 'clubBigListURL', cast(null as string), 'clubInclusion', true) END""")
    payload = F.struct(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("eventTimeStamp"),
        F.expr("CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'DRAFT' "
               "WHEN o_orderstatus = 'F' THEN 'PUBLISHED' WHEN o_orderstatus = 'O' THEN 'LIVE' "
               "ELSE 'DISABLED' END").alias("status"),
        F.col("o_custkey").cast("string").alias("promotionNumber"),
        F.concat(F.lit("Offer "), F.col("o_orderkey").cast("string")).alias("promotionName"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("startDate"),
        F.date_format(F.date_add("o_orderdate", 90), "yyyy-MM-dd").alias("endDate"),
        F.lit("00:00:00").alias("startTime"),
        F.lit("23:59:59").alias("endTime"),
        F.expr("CASE o_orderpriority WHEN '1-URGENT' THEN 'EST' WHEN '2-HIGH' THEN 'CDT' "
               "WHEN '3-MEDIUM' THEN 'PST' WHEN '4-NOT SPECIFIED' THEN 'MST' ELSE 'CST' END").alias("timeZone"),
        F.expr("CASE o_orderstatus WHEN 'O' THEN array('D2H') WHEN 'F' THEN array('CLUB', 'D2H') "
               "ELSE array('CLUB') END").alias("channels"),
        F.expr("CASE c_mktsegment WHEN 'MACHINERY' THEN array('tetris', 'weekly') "
               "WHEN 'BUILDING' THEN array('tio') WHEN 'AUTOMOBILE' THEN array('seasonal', 'JOIN') "
               "WHEN 'FURNITURE' THEN CASE WHEN c_nationkey < 5 THEN array('tetris', 'tio') "
               "ELSE array('tetris') END ELSE array() END").alias("labels"),
        F.coalesce("awards", F.expr("array()").cast(
            "array<struct<promotionItemNumber:string,awardType:string,value:string,"
            "discountMethod:string,itemRefId:array<string>>>")).alias("awardList"),
        F.struct(F.coalesce(F.col("n_lines"), F.lit(0)).cast("string").alias("itemListCount"),
                 F.col("items").alias("itemsPayload")).alias("itemDetails"),
        F.when(~no_members, F.struct(
            F.lit("1").alias("clubListCount"),
            F.array(club).alias("clubsPayload"),
            F.coalesce(F.col("overrides"), F.expr("array()")).alias("clubOverride"))).alias("clubDetails"),
        F.when(~no_members, F.struct(
            F.expr("CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' "
                   "THEN 2 ELSE 1 END").alias("memberListCount"),
            F.array(F.struct(F.lit("biglist").alias("memberType"), empty_s.alias("memberList"),
                             F.concat(F.lit("members/list-"), (F.col("o_orderkey") % 20).cast("string"),
                                      F.lit(".csv")).alias("memberBigListURL"),
                             F.lit(True).alias("isMemberInclusion"))).alias("membersPayload")))
        .alias("memberDetails"),
        F.array(F.lit("PLUS"), F.lit("CLUB")).alias("membershipType"))
    # to_json drops NULL fields, so an absent part is absent in the text as well.
    return x.select(
        F.concat(F.lit("O"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("event_id"),
        # receipt time: the order date, with the order key as microseconds so that two
        # events of one offer received the same day stay distinct and ordered
        F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey"))
        .alias("arrival"),
        F.to_json(F.struct(payload.alias("payload"))).alias("raw"))


def item_files(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    return (li.select(F.concat(F.lit("items/supplier-"), F.col("l_suppkey").cast("string"), F.lit(".csv"))
                    .alias("list_key"), F.col("l_partkey").cast("string").alias("c0"))
            .distinct().withColumn("c1", F.lit(None).cast("string")))


def store_files(spark, d) -> DataFrame:
    s = table(spark, d, "supplier")
    return s.select(F.concat(F.lit("stores/nation-"), F.col("s_nationkey").cast("string"), F.lit(".csv"))
                    .alias("list_key"), F.col("s_suppkey").cast("string").alias("c0"),
                    F.lit(None).cast("string").alias("c1"))


def catalogue(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    return (p.groupBy("p_brand", "p_size")
            .agg(F.sort_array(F.collect_list("p_partkey")).alias("ITEM_ID_ARRAY"))
            .select(F.col("p_brand").alias("PROD_ID"), F.col("p_size").alias("MDSE_CATG_CD"),
                    F.lit(0).alias("MDSE_SUB_CATG_CD"), "ITEM_ID_ARRAY"))


def site_directory(spark, d) -> DataFrame:
    s = table(spark, d, "supplier")
    n = table(spark, d, "nation")
    x = s.join(n, s["s_nationkey"] == n["n_nationkey"], "left")
    return x.select(
        F.col("s_suppkey").alias("id"),
        F.struct(F.expr("CASE WHEN s_nationkey = 1 THEN 'PR' WHEN s_nationkey = 6 THEN NULL "
                        "ELSE n_name END").alias("state")).alias("address"),
        (F.col("s_acctbal") >= 0).alias("isActive"),
        F.expr("CASE WHEN s_nationkey = 3 THEN 'EXPRESS' WHEN s_nationkey IN (4, 5) THEN NULL "
               "ELSE 'REGULAR' END").alias("clubType"))


def stored_offers(spark, d) -> DataFrame:
    """Offers stored before the batch: customers with a balance over 5000."""
    c = table(spark, d, "customer").filter(F.col("c_acctbal") > 5000)
    return c.select(
        F.col("c_custkey").alias("offer_id"), F.lit("LIVE").alias("status"),
        F.lit(None).cast("timestamp_ntz").alias("start_datetime"),
        F.lit(None).cast("timestamp_ntz").alias("end_datetime"),
        F.lit(None).cast("timestamp_ntz").alias("event_timestamp"),
        F.lit("CST").alias("time_zone"),
        F.expr("CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN 'TETRIS' "
               "WHEN c_mktsegment = 'BUILDING' THEN CASE WHEN c_nationkey = 7 THEN 'TETRIS' ELSE 'TIO' END "
               "ELSE 'BROADREACH' END").alias("offer_source"),
        F.lit(None).cast("string").alias("discount_type"),
        F.lit(None).cast("double").alias("discount_value"),
        F.array(F.lit("CLUB")).alias("applicable_channel"),
        F.lit(None).cast("array<bigint>").alias("club_list"),
        F.lit("members/old.csv").alias("member_list_location"),
        F.lit(None).cast("array<string>").alias("membership_type"),
        F.lit("").alias("item_list_location"),
        F.lit(None).cast("array<string>").alias("labels"),
        F.lit("").alias("offer_set_id"), F.lit(None).cast("bigint").alias("campaign_id"),
        F.lit("").alias("campaign_name"), F.lit("").alias("member_list_name"))


def stored_offer_items(spark, d) -> DataFrame:
    """Items stored before the batch: parts of lines shipped before 1996, per customer."""
    li = table(spark, d, "lineitem").filter(F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return (li.join(o, li["l_orderkey"] == o["o_orderkey"])
            .select(F.col("l_partkey").alias("item_number"), F.lit("ELIGIBLE_ITEM").alias("item_type"),
                    F.col("o_custkey").alias("offer_id"), F.lit("").alias("product_id")))


def stored_site_overrides(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem").filter(F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return (li.join(o, li["l_orderkey"] == o["o_orderkey"])
            .select(F.col("l_suppkey").alias("club_number"),
                    F.col("l_shipdate").cast("timestamp_ntz").alias("start_datetime"),
                    F.col("l_shipdate").cast("timestamp_ntz").alias("end_datetime"),
                    F.lit("CST").alias("time_zone"), F.col("o_custkey").alias("offer_id")))


def member_files_two_rounds(spark, d) -> DataFrame:
    """Member files plus, per key, a narrower file of the click and view events."""
    e = table(spark, d, "events")
    half = e.filter(F.col("event_type").isin("click", "view")).select(
        F.expr("'members/half-' || cast(event_id % 20 as string) || '.csv'").alias("list_key"),
        F.col("user_id").cast("string").alias("c0"),
        F.col("value").cast("string").alias("c1"))
    return member_files(spark, d).unionByName(half)


def list_events_two_rounds_raw(spark, d) -> DataFrame:
    """Two member-list events per file key: the full file at the key's first event time,
    then the narrower file at its last event time."""
    e = table(spark, d, "events")
    g = e.groupBy((F.col("event_id") % 20).alias("k")).agg(F.min("ts").alias("t1"), F.max("ts").alias("t2"))

    def ev(tag, ts, prefix):
        raw = F.concat(F.lit('{"offerIdList":['), F.col("k").cast("string"), F.lit('],"memberBigListLocation":"'),
                       F.lit(prefix), F.col("k").cast("string"), F.lit('.csv"}'))
        return g.select(F.concat(F.lit("L"), F.col("k").cast("string"), F.lit(tag)).alias("event_id"),
                        F.col(ts).cast("timestamp").alias("arrival"), raw.alias("raw"))
    return ev("a", "t1", "members/list-").unionByName(ev("b", "t2", "members/half-"))


def mixed_list_events_raw(spark, d) -> DataFrame:
    """Member-list events between the offer events: one per low-priority order in status P,
    half a day after it, for the offer of its customer and one of twenty shared offers; some
    name a file that does not exist."""
    o = table(spark, d, "orders").filter("o_orderpriority = '5-LOW' AND o_orderstatus = 'P'")
    k = F.col("o_orderkey") % 20
    raw = F.concat(F.lit('{"offerIdList":["'), F.col("o_custkey").cast("string"), F.lit('","'),
                   (k + 1).cast("string"), F.lit('"],"memberBigListLocation":"members/'),
                   F.when(k == 13, F.lit("absent")).otherwise(F.concat(F.lit("list-"), k.cast("string"))),
                   F.lit('.csv"}'))
    return o.select(
        F.concat(F.lit("M"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("event_id"),
        F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey")
                           + 43_200_000_000).alias("arrival"), raw.alias("raw"))


def landed_member_files(spark, d) -> str:
    """Folder of the member files as text: lists of ranking offers with a header, its columns
    turned round, the others with neither header nor second column.  A list has several part
    files, each with the header, as many as the shuffle partitions ask for."""
    from promoflow.session import checkpoint_dir
    path = f"{checkpoint_dir(spark).rstrip('/')}/landing/member-files-{uuid.uuid4().hex}"
    k = F.regexp_extract("list_key", r"([0-9]+)", 1).cast("int")
    none = F.lit("")
    rows = member_files(spark, d).select(F.element_at(F.split("list_key", "/"), -1).alias("members"), F.when(
        k % 3 == 1, F.concat_ws(",", F.coalesce("c1", none), F.coalesce("c0", none))).otherwise(F.coalesce("c0", none)).alias("value"), (k % 3 == 1).alias("ranked"))
    parts = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // 5)  # of 20 lists: four to a task
    rows = rows.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(parts)))
    heads = rows.filter("ranked").select("members", F.lit('"Propensity", MembershipNumber').alias("value"), "ranked", "part").distinct()
    rows.unionByName(heads).repartition("members", "part").drop("ranked", "part").write.partitionBy("members").text(path)
    return path


def member_lists(spark, d) -> DataFrame:
    """(list_key) of the member files that exist."""
    return member_files(spark, d).select("list_key").distinct()


def available_lists(spark, d) -> DataFrame:
    """(list_key) of the list files that exist: one item file per supplier (possibly
    empty) and one store file per nation."""
    s = table(spark, d, "supplier").select(
        F.concat(F.lit("items/supplier-"), F.col("s_suppkey").cast("string"), F.lit(".csv")).alias("list_key"))
    n = table(spark, d, "nation").select(
        F.concat(F.lit("stores/nation-"), F.col("n_nationkey").cast("string"), F.lit(".csv")).alias("list_key"))
    return s.unionByName(n)


# ---------------------------------------------------------------------------
# Damaged inputs: one order in forty breaks one rule
# ---------------------------------------------------------------------------
_WHOLE_EVENT = """{"payload":{"eventTimeStamp":"2024-03-01T10:00:00.123Z","status":"LIVE","promotionNumber":"ID",
"startDate":"2024-03-01","endDate":"2024-03-31","startTime":"00:00:00","endTime":"23:59:59","timeZone":"CST",
"channels":["CLUB"],"labels":["weekly"],"membershipType":["PLUS"],
"awardList":[{"awardType":"DISCOUNT_ITEM_PRICE","value":"5","discountMethod":"DOLLAR_OFF","itemRefId":["1"]}],
"memberDetails":{"memberListCount":1,"membersPayload":[{"memberType":"biglist","memberList":[],"memberBigListURL":"m.csv"}]},
"itemDetails":{"itemListCount":1,"itemsPayload":[{"itemType":"ELIGIBLE_ITEMS","itemListType":"list","itemList":["1001"],"refId":1}]},
"clubDetails":{"clubListCount":1,"clubsPayload":[{"clubType":"list","bigListName":"x","clubList":["7"],"clubInclusion":true}],
"clubOverride":[]}}}""".replace("\n", "")

#: Rules that break when a piece of the whole event is put in place of another, by o_orderkey % 40.
FAULTS = [
    (("V1:eventTimeStamp",), "2024-03-01T10:00:00.123Z", ""),
    (("V1:status", "V3"), '"LIVE"', "null"),
    (("V1:promotionNumber",), '"ID"', '"12x"'),
    (("V1:startDate",), '"startDate":"2024-03-01",', ""),
    (("V1:endDate",), "2024-03-31", ""),
    (("V1:startTime",), "00:00:00\"", "\""),
    (("V1:endTime",), '"23:59:59"', "null"),
    (("V1:timeZone",), '"timeZone":"CST",', ""),
    (("V2:channels",), '["CLUB"]', '"CLUB"'),
    (("V2:labels",), '["weekly"]', "null"),
    (("V2:membershipType",), '["PLUS"]', "[null]"),
    (("V3",), "LIVE", "DRAFT"),
    (("V4",), '["weekly"]', '["tetris","tio"]'),
    (("V5",), '"value":"5"', '"value":null'),
    (("V5",), '"itemRefId":["1"]', '"itemRefId":"1"'),
    (("V6",), "DOLLAR_OFF", "BOGO"),
    (("V7",), '"memberType":"biglist"', '"memberType":"file"'),
    (("V7",), '"membersPayload":[', '"membersPayload":7,"x":['),
    (("V8",), '"memberListCount":1', '"memberListCount":"many"'),
    (("V9",), '"refId":1', '"refId":"one"'),
    (("V9",), '["1001"]', "[]"),
    (("V10",), '"itemListCount":1', '"itemListCount":[1]'),
    (("V10",), '"itemDetails":{', '"itemDetails":"oops","x":{'),
    (("V11",), '"clubType":"list"', '"clubType":"List"'),
    (("V11",), '"clubInclusion":true', '"clubInclusion":null'),
    (("V12",), '"clubListCount":1', '"clubListCount":"x"'),
    (("V12",), '"clubDetails":{', '"clubDetails":[1],"x":{'),
]
#: The same for member-list events, from the residues after those.
LIST_FAULTS = ['{"offerIdList":["x"],"memberBigListLocation":"m.csv"}', '{"offerIdList":[1]}',
               '{"offerIdList":null,"memberBigListLocation":"m.csv"}', '{"offerIdList":[1,null],"memberBigListLocation":"m.csv"}']


def faulty_events_raw(spark, d) -> DataFrame:
    """(event_id, arrival, raw): one event an order, whole or with one fault."""
    o = table(spark, d, "orders")
    r = F.col("o_orderkey") % 40
    whole = F.replace(F.lit(_WHOLE_EVENT), F.lit('"ID"'), F.concat(F.lit('"'), F.col("o_custkey").cast("string"), F.lit('"')))
    raw = F.when(r < 0, whole)
    for i, (_, old, new) in enumerate(FAULTS):
        source = F.lit(_WHOLE_EVENT) if old == '"ID"' else whole
        raw = raw.when(r == i, F.replace(source, F.lit(old), F.lit(new)))
    for i, text in enumerate(LIST_FAULTS):
        raw = raw.when(r == len(FAULTS) + i, F.lit(text))
    return o.select(F.concat(F.lit("F"), F.col("o_orderkey").cast("string")).alias("event_id"),
                    F.col("o_orderdate").cast("timestamp").alias("arrival"), raw.otherwise(whole).alias("raw"))


def store_files_with_faults(spark, d) -> DataFrame:
    """The store files, one of which has a line that is no store id."""
    return store_files(spark, d).unionByName(spark.createDataFrame([("stores/nation-24.csv", "13x", None)], "list_key string, c0 string, c1 string"))


def item_files_with_faults(spark, d) -> DataFrame:
    """The item files, one of which has a line that is no item number."""
    return item_files(spark, d).unionByName(spark.createDataFrame([("items/supplier-7.csv", "A-100", None)], "list_key string, c0 string, c1 string"))
