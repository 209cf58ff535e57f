"""Registered queries: each takes (spark, table_dir) and returns a DataFrame.

Every query reads the driver's test tables through ``promoflow.testbed`` and runs the
engine's own operators over the whole of them.  Output columns are flat and named to
match the oracle SQL in ``promoflow.oracle_sql`` (arrays are rendered as sorted text,
timestamps as text).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promoflow import testbed as TB
from promoflow.operators import audience as A
from promoflow.operators import gates as G
from promoflow.operators import items as I
from promoflow.operators import offers as O
from promoflow.operators import sites as ST
from promoflow.operators import validate as V
from promoflow.operators.audit import current_status, failure_report
from promoflow.operators.serve import chunk_changes, item_chunks, member_entries, sink_batches
from promoflow.plans.audit_batch import audit_rows, failures, list_event_outcomes
from promoflow.plans.intake import run_intake
from promoflow.plans.list_batch import look_up_list_batch, member_view_changes, plan_list_batch
from promoflow.plans.mixed_batch import plan_mixed_batch
from promoflow.plans.offer_batch import check_offer_batch, offer_serving_view, plan_offer_batch
from promoflow.settings import CARD_COLUMN, DEFAULT_CONFIG
from promoflow.sources.biglists import list_manifest, read_list_lines
from promoflow.operators.joins import kept
from promoflow.operators.snapshot import upsert
from promoflow.schemas import OFFER_ITEMS, OFFERS, SITE_OVERRIDES
from promoflow.streaming.apply_stream import TABLES, Lookups, Stored, run_apply_stream
from promoflow.sources.lookups import read_catalogue, read_member_cards, read_sites
from promoflow.streaming.failure_stream import read_failure_report, run_failure_report_stream
from promoflow.streaming.intake_stream import run_dedup_stream, run_intake_stream, scratch_root
from promoflow.sources.events import decode_events, list_event_rows, route_event_kind

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------------------
# Audience domain
# ---------------------------------------------------------------------------
def _list_batch(spark, d):
    good, _ = decode_events(TB.list_events_raw(spark, d))
    _, lists = route_event_kind(good)
    return plan_list_batch(lists, TB.list_offers(spark, d), TB.member_offers(spark, d),
                           TB.member_files(spark, d), TB.cards(spark, d),
                           available_lists=TB.member_lists(spark, d))


@query("active_member_cards")
def q_active_member_cards(spark, d):
    return A.active_member_cards(TB.cards(spark, d))


@query("biglist_scan")
def q_biglist_scan(spark, d):
    """Member files given their layout by the source of the events that read them."""
    good, _ = decode_events(TB.list_events_raw(spark, d))
    pairs = A.explode_list_events(list_event_rows(good))
    looked = A.offers_for_list_events(pairs, TB.list_offers(spark, d))
    srcs = (looked.filter("found").select(F.col("location").alias("list_key"),
                                          F.col("event_source").alias("offer_source")).distinct())
    return A.member_rows_by_source(TB.member_files(spark, d), srcs)


@query("apply_landed_member_files")
def q_apply_landed_member_files(spark, d):
    """The stored audience after a batch whose member files are read from the shared folder,
    each by its event's source: by the names of its header, or as one unnamed column."""
    lines = read_list_lines(spark, TB.landed_member_files(spark, d))
    lines = lines.withColumn("list_key", F.regexp_replace("list_key", "^members=", "members/"))
    good, _ = decode_events(TB.list_events_raw(spark, d))
    _, lists = route_event_kind(good)
    b = plan_list_batch(lists, TB.list_offers(spark, d), TB.member_offers(spark, d), lines, TB.cards(spark, d),
                        available_lists=list_manifest(lines, CARD_COLUMN))
    return b.member_offers


@query("resolve_members")
def q_resolve_members(spark, d):
    """Every member file read as a one-column (card number) list."""
    rows = TB.member_files(spark, d).select("list_key", F.col("c0").alias("membership_id"),
                                            F.lit(None).cast("double").alias("propensity"))
    res = A.resolve_members(rows, A.active_member_cards(TB.cards(spark, d)))
    return res.select("list_key", "membership_uuid", "membership_id")


@query("resolve_members_ranked")
def q_resolve_members_ranked(spark, d):
    """Every member file read as (card number, propensity); best card per member."""
    rows = TB.member_files(spark, d).select("list_key", F.col("c0").alias("membership_id"),
                                            F.col("c1").try_cast("double").alias("propensity"))
    return A.resolve_members(rows, A.active_member_cards(TB.cards(spark, d)))


@query("offers_for_list_event")
def q_offers_for_list_event(spark, d):
    b = _list_batch(spark, d)
    return b.looked.select("event_id", "pos", "offer_id_text", "offer_id", "found",
                           "offer_source", "stored_location", "event_source")


@query("unprocessed_offer_ids")
def q_unprocessed_offer_ids(spark, d):
    return A.unprocessed_offer_ids(_list_batch(spark, d).looked)


@query("effective_list_events")
def q_effective_list_events(spark, d):
    b = _list_batch(spark, d)
    return b.effective.select("event_id", "offer_id", "location", "prev_location", "effective",
                              F.col("round").cast("bigint").alias("round"))


@query("audience_delta")
def q_audience_delta(spark, d):
    return _list_batch(spark, d).delta.select("offer_id", "membership_uuid", "action")


@query("delta_counts")
def q_delta_counts(spark, d):
    return A.delta_counts(_list_batch(spark, d).delta)


@query("apply_audience_delta")
def q_apply_audience_delta(spark, d):
    return _list_batch(spark, d).member_offers


@query("changed_members")
def q_changed_members(spark, d):
    return A.changed_members(_list_batch(spark, d).delta)


@query("member_view_upserts")
def q_member_view_upserts(spark, d):
    """Entries of the member view that the batch changes, kept up from its changes alone."""
    view = kept(member_entries(TB.member_offers(spark, d)), "member-view")
    ups, _ = member_view_changes(_list_batch(spark, d), view)
    return ups.select("membership_uuid", F.array_join("offer_ids", ",").alias("offer_ids"))


@query("member_view_deletes")
def q_member_view_deletes(spark, d):
    """Members of the whole stored audience whom the batch leaves without any offer."""
    view = kept(member_entries(TB.member_offers(spark, d)), "member-view")
    _, dels = member_view_changes(_list_batch(spark, d), view)
    return dels.filter(F.col("membership_uuid").isNotNull())  # a row without a member has no entry


@query("update_list_location")
def q_update_list_location(spark, d):
    return _list_batch(spark, d).offers.select("offer_id", "offer_source", "member_list_location")


# ---------------------------------------------------------------------------
# Offer domain
# ---------------------------------------------------------------------------
AS_OF_UTC = "1999-06-01 00:00:00"


def _n(c):
    """Element count with NULL arrays counted as empty."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(c))


def _ts_text(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _raw_batch(spark, d, with_junk: bool = False) -> DataFrame:
    """Offer events and member-list events (and, for the dead-letter check, documents)."""
    raw = TB.offer_events_raw(spark, d).unionByName(TB.list_events_raw(spark, d))
    if with_junk:
        docs = TB.table(spark, d, "documents").select(
            F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("event_id"),
            F.lit("2024-01-01 00:00:00").cast("timestamp").alias("arrival"),
            F.col("text").alias("raw"))
        raw = raw.unionByName(docs)
    return raw


def _offer_events(spark, d, trimmed: bool = True) -> DataFrame:
    good, _ = decode_events(TB.offer_events_raw(spark, d), keep_raw=False)
    offers, _ = route_event_kind(good)
    offers = G.route_source(offers)
    return G.trim_awards(offers) if trimmed else offers


def _intake(spark, d):
    return run_intake(_raw_batch(spark, d), keep_raw=False)


def _offer_batch(spark, d):
    it = _intake(spark, d)
    ready = it.offers.filter(F.col("status") == DEFAULT_CONFIG.status_processing)
    return plan_offer_batch(ready, TB.stored_offers(spark, d), TB.stored_offer_items(spark, d),
                            TB.stored_site_overrides(spark, d), TB.site_directory(spark, d),
                            TB.store_files(spark, d), TB.item_files(spark, d), TB.catalogue(spark, d),
                            available_lists=TB.available_lists(spark, d))


@query("decode_events")
def q_decode_events(spark, d):
    good, _ = decode_events(_raw_batch(spark, d), keep_raw=False)
    return good.select(
        "event_id", "kind",
        F.col("e.payload.promotionNumber").alias("promotion_number"),
        F.col("e.payload.status").alias("offer_status"),
        _n("e.payload.awardList").alias("n_awards"),
        _n("e.payload.itemDetails.itemsPayload").alias("n_item_payloads"),
        _n("e.offerIdList").alias("n_offer_ids"))


@query("dead_letter_events")
def q_dead_letter_events(spark, d):
    _, bad = decode_events(_raw_batch(spark, d, with_junk=True))
    return bad.select("event_id")


@query("route_event_kind")
def q_route_event_kind(spark, d):
    good, _ = decode_events(_raw_batch(spark, d), keep_raw=False)
    offers, lists = route_event_kind(good)
    return (offers.select("event_id", F.lit("offer").alias("kind"))
            .unionByName(lists.select("event_id", F.lit("list").alias("kind"))))


@query("route_source")
def q_route_source(spark, d):
    return _offer_events(spark, d, trimmed=False).select("event_id", "offer_source", "source_label")


@query("gate_events")
def q_gate_events(spark, d):
    return G.gate(_offer_events(spark, d, trimmed=False)).select("event_id", "gate_status", "gate_reason")


@query("trim_awards")
def q_trim_awards(spark, d):
    events = _offer_events(spark, d, trimmed=False)
    before = events.select("event_id", _n("e.payload.awardList").alias("n_before"))
    after = G.trim_awards(events).select(
        "event_id", _n("awards").alias("n_after"),
        F.array_join(F.get(F.col("awards"), 0)["itemRefId"], ",").alias("first_refs"))
    return before.join(after, "event_id")


@query("validate_events")
def q_validate_events(spark, d):
    good, _ = decode_events(_raw_batch(spark, d), keep_raw=False)
    offers, lists = route_event_kind(good)
    v_off = V.validate_offers(G.trim_awards(offers))
    v_lst = V.validate_lists(lists)
    return V.error_rows(v_off).unionByName(V.error_rows(v_lst))


@query("validate_faulty_events")
def q_validate_faulty_events(spark, d):
    """Events most of which break one rule each: every rule, nulls, absent keys, wrong types."""
    good, _ = decode_events(TB.faulty_events_raw(spark, d), keep_raw=False)
    offers, lists = route_event_kind(good)
    return V.error_rows(V.validate_offers(G.trim_awards(offers))).unionByName(V.error_rows(V.validate_lists(lists)))


@query("validation_summary")
def q_validation_summary(spark, d):
    rules = q_validate_events(spark, d).unionByName(q_validate_faulty_events(spark, d))
    return rules.groupBy("rule").agg(F.count("*").alias("n_events"))


@query("list_faults")
def q_list_faults(spark, d):
    """Events that name a file with a value that is no whole number."""
    faults = O.list_faults(_offer_events(spark, d), None, TB.item_files_with_faults(spark, d), TB.store_files_with_faults(spark, d))
    return faults.select("event_id", "missing_list", "fault")


@query("intake_outcomes")
def q_intake_outcomes(spark, d):
    return _intake(spark, d).outcomes.select("event_id", "kind", "oid", "source_label", "status", "reason")


@query("event_time_normalise")
def q_event_time_normalise(spark, d):
    return O.normalise_times(_offer_events(spark, d)).select(
        "event_id", "start_text", "end_text", "event_time_text", "zone")


def _projected(spark, d, clubs=lambda rows: rows):
    ev = O.normalise_times(_offer_events(spark, d))
    ev, lists = ST.club_combinations(ev, TB.site_directory(spark, d), TB.store_files(spark, d))
    return ST.attach_club_lists(clubs(O.project_offers(ev)), clubs(lists))


def _offer_text(df):
    return df.select(
        "event_id", "offer_id", "status",
        _ts_text(F.col("start_datetime")).alias("start_datetime"),
        _ts_text(F.col("end_datetime")).alias("end_datetime"),
        _ts_text(F.col("event_timestamp")).alias("event_timestamp"),
        "time_zone", "offer_source", "discount_type", "discount_value",
        F.array_join("applicable_channel", ",").alias("applicable_channel"),
        "club_list", "member_list_location",
        F.array_join("membership_type", ",").alias("membership_type"),
        "item_list_location",
        F.array_join("labels", ",").alias("labels"),
        "offer_set_id", "campaign_id", "campaign_name", "member_list_name")


@query("offer_projection")
def q_offer_projection(spark, d):
    return _offer_text(_projected(spark, d, ST.as_text))


@query("expired_offers")
def q_expired_offers(spark, d):
    return O.expired_offers(_projected(spark, d), AS_OF_UTC).select("event_id", "offer_id", "is_expired")


@query("offer_items_inline")
def q_offer_items_inline(spark, d):
    return I.inline_items(I.referenced_payloads(_offer_events(spark, d))).select(
        "event_id", "offer_id", "item_number", "item_type")


@query("item_type_mapping")
def q_item_type_mapping(spark, d):
    ev = _offer_events(spark, d)
    ip = ev.select(F.explode("e.payload.itemDetails.itemsPayload").alias("ip"))
    return (ip.select(F.col("ip.itemType").alias("payload_item_type"),
                      I.item_type_mapping(F.col("ip.itemType")).alias("item_type"))
            .groupBy("payload_item_type", "item_type").agg(F.count("*").alias("n_payloads")))


@query("offer_items_biglist")
def q_offer_items_biglist(spark, d):
    pl = I.referenced_payloads(_offer_events(spark, d))
    return I.biglist_items(pl, TB.item_files(spark, d)).select(
        "event_id", "offer_id", "item_number", "item_type")


@query("offer_items_all")
def q_offer_items_all(spark, d):
    return I.offer_items(_offer_events(spark, d), TB.item_files(spark, d), TB.catalogue(spark, d))


@query("excluded_items")
def q_excluded_items(spark, d):
    return I.excluded_items(TB.catalogue(spark, d), DEFAULT_CONFIG.excluded_category)


def _landed_lookup(spark, name: str, df) -> str:
    path = f"{scratch_root(spark, 'lookup')}/{name}"
    df.write.parquet(path)
    return path


@query("catalogue_scan")
def q_catalogue_scan(spark, d):
    """The excluded items read from a stored catalogue, of which only the category's rows and
    two of its columns are scanned."""
    c = TB.catalogue(spark, d).withColumns({"PROD_NM": F.concat(F.lit("product "), "PROD_ID"), "MDSE_CATG_CD": F.col("MDSE_CATG_CD").cast("int")})
    path = _landed_lookup(spark, "catalogue", c)
    return I.excluded_items(read_catalogue(spark, path, DEFAULT_CONFIG.excluded_category), DEFAULT_CONFIG.excluded_category)


@query("member_card_scan")
def q_member_card_scan(spark, d):
    path = _landed_lookup(spark, "cards", TB.cards(spark, d).withColumn("holderName", F.concat(F.lit("holder "), "cardNumber")))
    return A.active_member_cards(read_member_cards(spark, path))


@query("site_scan")
def q_site_scan(spark, d):
    sites = TB.site_directory(spark, d).withColumn("address", F.struct(
        F.lit("1 Main St").alias("street"), F.lit("Town").alias("city"), F.col("address.state").alias("state"), F.lit("0").alias("postalCode")))
    return ST.active_sites(read_sites(spark, _landed_lookup(spark, "stores", sites)))


@query("exclude_items")
def q_exclude_items(spark, d):
    """Every ordered part as a candidate item, minus the excluded category."""
    li = TB.table(spark, d, "lineitem").select("l_orderkey", F.col("l_partkey").alias("item_number"))
    return I.exclude_items(li, TB.catalogue(spark, d), DEFAULT_CONFIG.excluded_category)


@query("site_overrides")
def q_site_overrides(spark, d):
    ov = ST.site_overrides(_offer_events(spark, d))
    return ov.select("event_id", "offer_id", "club_number",
                     _ts_text(F.col("start_datetime")).alias("start_datetime"),
                     _ts_text(F.col("end_datetime")).alias("end_datetime"), "time_zone")


@query("active_sites")
def q_active_sites(spark, d):
    return ST.active_sites(TB.site_directory(spark, d))


@query("standard_site_lists")
def q_standard_site_lists(spark, d):
    return ST.standard_site_lists(ST.active_sites(TB.site_directory(spark, d)))


@query("complement_site_list")
def q_complement_site_list(spark, d):
    return ST.complement_site_list(_offer_events(spark, d), TB.site_directory(spark, d), TB.store_files(spark, d))


@query("event_site_sets")
def q_event_site_sets(spark, d):
    """Which interned set of stores each store payload is."""
    rows, _ = ST.event_sets(_offer_events(spark, d), TB.site_directory(spark, d), TB.store_files(spark, d))
    return rows


@query("site_sets")
def q_site_sets(spark, d):
    """The stores of every set that the events of the batch use, each set once."""
    _, stores = ST.event_sets(_offer_events(spark, d), TB.site_directory(spark, d), TB.store_files(spark, d))
    return stores


@query("resolve_sites")
def q_resolve_sites(spark, d):
    return ST.resolve_sites(_offer_events(spark, d), TB.site_directory(spark, d), TB.store_files(spark, d))


@query("source_conflicts")
def q_source_conflicts(spark, d):
    return _offer_batch(spark, d).checked.select("event_id", "offer_id", "stored_source", "fixed_source",
                                                 "conflict", "message")


@query("latest_offer_event")
def q_latest_offer_event(spark, d):
    return _offer_batch(spark, d).applied.select("offer_id", "event_id")


@query("upsert_offers")
def q_upsert_offers(spark, d):
    b = _offer_batch(spark, d)
    new = ST.attach_club_lists(ST.as_text(b.narrow), ST.as_text(b.club_lists))
    o = upsert(ST.as_text(TB.stored_offers(spark, d)), new.drop("event_id", "arrival"), ["offer_id"])
    return o.select("offer_id", "status", "offer_source", "time_zone", "discount_type", "discount_value",
                    "club_list", "member_list_location",
                    "item_list_location", _ts_text(F.col("start_datetime")).alias("start_datetime"))


@query("replace_offer_items")
def q_replace_offer_items(spark, d):
    return _offer_batch(spark, d).offer_items


@query("replace_site_overrides")
def q_replace_site_overrides(spark, d):
    ov = _offer_batch(spark, d).site_overrides
    return ov.select("club_number", _ts_text(F.col("start_datetime")).alias("start_datetime"),
                     _ts_text(F.col("end_datetime")).alias("end_datetime"), "time_zone", "offer_id")


def _stored(spark, root, offers, items, overrides, audience, buckets=16) -> Stored:
    s = Stored(spark, root, buckets)
    s.seed(offers, items, overrides, audience)
    return s


@query("replace_bucketed_items")
def q_replace_bucketed_items(spark, d):
    """The stored items of tables partitioned by offer bucket, after a batch that read and
    rewrote the buckets of its offers, published twice as after a failure."""
    s = _stored(spark, scratch_root(spark, "bucketed"), TB.stored_offers(spark, d), TB.stored_offer_items(spark, d),
                TB.stored_site_overrides(spark, d), TB.member_offers(spark, d))
    it = _intake(spark, d)
    ready = it.offers.filter(F.col("status") == DEFAULT_CONFIG.status_processing)
    touched = s.tables.touched(ready.select(F.col("e.payload.promotionNumber").try_cast("bigint").alias("offer_id")))
    offers, items, overrides, audience = (s.tables.rows(n, touched) for n in TABLES)
    b = plan_offer_batch(ready, offers, items, overrides, TB.site_directory(spark, d), TB.store_files(spark, d),
                         TB.item_files(spark, d), TB.catalogue(spark, d), available_lists=TB.available_lists(spark, d))
    s.tables.apply(0, touched, {"offers": b.offers, "offer_items": b.offer_items, "site_overrides": b.site_overrides,
                                "member_offers": audience, "offer_view_items": s.tables.rows("offer_view_items", touched)})
    s.tables.publish(0)
    return s.read("offer_items")


#: Items of a chunk in the queries of the offer view, small enough that offers split.
CHUNK = 50


@query("offer_serving_view")
def q_offer_serving_view(spark, d):
    b = _offer_batch(spark, d)
    b = replace(b, narrow=ST.as_text(b.narrow), club_lists=ST.as_text(b.club_lists))
    rows, chunks = offer_serving_view(b, CHUNK)
    at = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    shown = F.transform("site_overrides", lambda o: F.concat_ws(
        "|", o["club_number"].cast("string"), F.coalesce(at(o["start_datetime"]), F.lit("-")),
        F.coalesce(at(o["end_datetime"]), F.lit("-")), o["time_zone"]))
    fields = F.concat_ws(";", "status", "offer_source", "time_zone", "member_list_location", F.array_join("labels", ","),
                         F.coalesce("club_list", F.lit("")),
                         F.coalesce(F.array_join(shown, ","), F.lit("")))
    head = rows.select("offer_id", F.lit("OFFER").alias("item_type"), F.lit("").alias("chunk"), fields.alias("items"))
    body = chunks.select("offer_id", "item_type", "chunk", F.array_join("items", ",").alias("items"))
    return head.unionByName(body)


@query("offer_view_growth")
def q_offer_view_growth(spark, d):
    """What the batch changes in stored item chunks: chunks that are new or hold other items,
    and chunks that are gone, because they have split, grown together or lost their items."""
    b = _offer_batch(spark, d)
    stored = kept(item_chunks(TB.stored_offer_items(spark, d), CHUNK), "chunks")
    ups, dels = chunk_changes(stored, kept(item_chunks(b.items_new, CHUNK), "chunks"), b.applied)
    return (ups.select(F.lit("upsert").alias("change"), "offer_id", "item_type", "chunk", F.array_join("items", ",").alias("items"))
            .unionByName(dels.select(F.lit("delete").alias("change"), "offer_id", "item_type", "chunk", F.lit("").alias("items"))))


# ---------------------------------------------------------------------------
# Audit trail, output batching
# ---------------------------------------------------------------------------
def _audited_batch(spark, d):
    """(intake, audit rows) of one whole batch: outcomes are planned, stored rows are not."""
    it = run_intake(_raw_batch(spark, d))
    ready = lambda events: events.filter(F.col("status") == DEFAULT_CONFIG.status_processing)
    _, _, done = check_offer_batch(ready(it.offers), TB.stored_offers(spark, d), TB.item_files(spark, d),
                                   TB.store_files(spark, d), available_lists=TB.available_lists(spark, d))
    looked = look_up_list_batch(ready(it.lists), TB.list_offers(spark, d), TB.member_lists(spark, d))
    return it, audit_rows(it, done, list_event_outcomes(looked))


@query("audit_log")
def q_audit_log(spark, d):
    _, audit = _audited_batch(spark, d)
    return audit.filter(F.col("seq") == 0).select(
        "ouid", "oid", "status", "comments", _ts_text(F.col("received_date")).alias("received_date"))


@query("audit_current_status")
def q_audit_current_status(spark, d):
    _, audit = _audited_batch(spark, d)
    return current_status(audit).select("ouid", "oid", "status", "comments")


@query("failure_report")
def q_failure_report(spark, d):
    it, audit = _audited_batch(spark, d)
    rep = failure_report(failures(it, current_status(audit)))
    return rep.select("failure_class", "source_label", F.date_format("day", "yyyy-MM-dd").alias("day"),
                      "n_failed")


@query("sink_batches")
def q_sink_batches(spark, d):
    """The new stored audience numbered into output batches of at most 25,000 rows: how many
    rows came out, how many of them distinct, and whether every batch keeps the size."""
    b = _list_batch(spark, d)
    size = DEFAULT_CONFIG.sink_batch_size
    rows = sink_batches(b.member_offers, size).groupBy("offer_id", "membership_uuid", "batch_partition", "batch_no").count()
    batches = rows.groupBy("batch_partition", "batch_no").agg(
        F.sum("count").alias("n"), F.count("*").alias("distinct_rows"))
    return batches.agg(F.sum("n").alias("n_rows"), F.sum("distinct_rows").alias("n_distinct"),
                       (F.max("n") <= size).alias("within_size"))


# ---------------------------------------------------------------------------
# Streaming
# ---------------------------------------------------------------------------
#: Text of one landed file, at most and about.
_FILE_CHARS = 128 << 20


def _files_for(raw: DataFrame, least: int) -> int:
    """Files to land the texts of ``raw`` in: ``least`` for small ones, then as many as they fill."""
    chars = raw.agg(F.sum(F.length("raw").cast("bigint")).alias("n")).first()["n"] or 0
    return max(least, -(-chars // _FILE_CHARS))


def _land(spark, d, root: str, copies: int = 1, files: int = 8) -> tuple[str, int]:
    """Write the raw batch as event files into a landing folder (what a connector does): at
    least about ``files`` of them, without moving the texts between tasks.  Returns the folder
    and how many files there are."""
    raw = _raw_batch(spark, d)
    once = raw
    for _ in range(copies - 1):
        raw = raw.unionByName(once)
    path = f"{root}/landing"
    n = _files_for(raw, files)
    raw.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", max(1, raw.count() // n)).parquet(path)
    return path, len(spark.read.parquet(path).inputFiles())


@query("stream_event_intake")
def q_stream_event_intake(spark, d):
    """Intake run as a stream over the landed events, several micro-batches."""
    root = scratch_root(spark, "stream-intake")
    landing, files = _land(spark, d, root)
    run_intake_stream(spark, landing, f"{root}/out", f"{root}/checkpoint", max_files_per_trigger=-(-files // 4))
    out = spark.read.parquet(f"{root}/out/outcomes")
    return out.select("event_id", "kind", "oid", "source_label", "status", "reason")


@query("stream_dedup")
def q_stream_dedup(spark, d):
    """Every event landed twice (re-delivery); the stream keeps one copy of each."""
    root = scratch_root(spark, "stream-dedup")
    landing, _ = _land(spark, d, root, copies=2)
    run_dedup_stream(spark, landing, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out/events").select("event_id")


@query("stream_dead_letters")
def q_stream_dead_letters(spark, d):
    """What the intake stream puts aside, with the reason: texts that are no event."""
    root = scratch_root(spark, "stream-dead")
    per_batch = _land_chronological(_raw_batch(spark, d, with_junk=True), f"{root}/landing")
    run_intake_stream(spark, f"{root}/landing", f"{root}/out", f"{root}/checkpoint", max_files_per_trigger=per_batch)
    return spark.read.parquet(f"{root}/out/dead_letters").select("event_id", "dead", F.length("raw").alias("n_chars"))


@query("stream_failure_report")
def q_stream_failure_report(spark, d):
    """Failures of the intake and dead letters, counted by a stream over what the intake
    stream writes: class, source and day."""
    root = scratch_root(spark, "stream-failures")
    per_batch = _land_chronological(_raw_batch(spark, d, with_junk=True), f"{root}/landing")
    run_intake_stream(spark, f"{root}/landing", f"{root}/out", f"{root}/checkpoint", max_files_per_trigger=per_batch)
    run_failure_report_stream(spark, f"{root}/out/failures", f"{root}/out", f"{root}/report-checkpoint")
    rep = read_failure_report(spark, f"{root}/out")
    return rep.select("failure_class", "source_label", F.date_format("day", "yyyy-MM-dd").alias("day"), "n_failed")


def _land_chronological(raw: DataFrame, landing: str, chunks: int = 3, files_per_chunk: int = 4) -> int:
    """Land events in chronological chunks, written one after the other (connector order).

    Returns the number of files per chunk, to be used as ``maxFilesPerTrigger`` so that
    each chunk becomes one micro-batch: at least ``files_per_chunk``, more for texts that
    fill more.  The chunk bounds are two rough quantiles of the arrival time (a handful of
    numbers to the driver).
    """
    us = F.unix_micros("arrival")
    files_per_chunk = max(files_per_chunk, -(-_files_for(raw, 1) // chunks))
    qs = raw.select(us.alias("us")).approxQuantile("us", [i / chunks for i in range(1, chunks)], 0.01)
    lows = [None] + qs
    highs = qs + [None]
    for lo, hi in zip(lows, highs):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (us > lo)
        if hi is not None:
            cond = cond & (us <= hi)
        raw.filter(cond).repartition(files_per_chunk).write.mode("append").option("compression", "zstd").parquet(landing)
    return files_per_chunk


def _lookups(spark, d):
    return Lookups(TB.site_directory(spark, d), TB.store_files(spark, d), TB.item_files(spark, d), TB.catalogue(spark, d),
                   TB.member_files(spark, d), TB.cards(spark, d), TB.member_lists(spark, d), TB.available_lists(spark, d))


def _streamed(spark, d, name: str, raw, files_per_chunk: int, *state):
    """Land ``raw`` in three chronological chunks and apply them as three micro-batches."""
    root = scratch_root(spark, name)
    per_batch = _land_chronological(raw, f"{root}/landing", files_per_chunk=files_per_chunk)
    stored = _stored(spark, f"{root}/tables", *state)
    run_apply_stream(spark, f"{root}/landing", stored, _lookups(spark, d), f"{root}/out", f"{root}/checkpoint",
                     max_files_per_trigger=per_batch)
    return stored, f"{root}/out"


@query("stream_apply_offers")
def q_stream_apply_offers(spark, d):
    """Offer events applied to bucketed tables over several micro-batches, in arrival order;
    the final offers table equals the one-batch result (upsert_offers)."""
    stored, _ = _streamed(spark, d, "stream-apply", TB.offer_events_raw(spark, d), 4, *_mixed_state(spark, d))
    return stored.read("offers").select(
        "offer_id", "status", "offer_source", "time_zone", "discount_type", "discount_value",
        F.array_join("club_list", ",").alias("club_list"), "member_list_location",
        "item_list_location", _ts_text(F.col("start_datetime")).alias("start_datetime"))


@query("stream_apply_lists")
def q_stream_apply_lists(spark, d):
    """Member-list events applied to bucketed tables over several micro-batches; the final
    stored audience equals the one-batch result (apply_audience_delta)."""
    empty = lambda schema: spark.createDataFrame([], schema)
    offers = empty(OFFERS).unionByName(TB.list_offers(spark, d), allowMissingColumns=True)
    stored, _ = _streamed(spark, d, "stream-lists", TB.list_events_raw(spark, d), 1, offers, empty(OFFER_ITEMS),
                          empty(SITE_OVERRIDES), TB.member_offers(spark, d))
    return stored.read("member_offers").select(*_AUDIENCE)


@query("apply_audience_rounds")
def q_apply_audience_rounds(spark, d):
    """Two effective member-list events for most offers in one batch: applied in rounds in
    arrival order; rows kept through both rounds keep their stored values."""
    good, _ = decode_events(TB.list_events_two_rounds_raw(spark, d))
    _, lists = route_event_kind(good)
    b = plan_list_batch(lists, TB.list_offers(spark, d), TB.member_offers(spark, d),
                        TB.member_files_two_rounds(spark, d), TB.cards(spark, d),
                        available_lists=TB.member_files_two_rounds(spark, d).select("list_key"))
    return b.member_offers.select("offer_id", "membership_uuid", "membership_id", "propensity")


# ---------------------------------------------------------------------------
# Both kinds of event on one offers table
# ---------------------------------------------------------------------------
def _mixed_raw(spark, d):
    return TB.offer_events_raw(spark, d).unionByName(TB.mixed_list_events_raw(spark, d))


def _mixed_state(spark, d):
    return (TB.stored_offers(spark, d), TB.stored_offer_items(spark, d), TB.stored_site_overrides(spark, d),
            TB.member_offers(spark, d))


def _mixed_batch(spark, d):
    it = run_intake(_mixed_raw(spark, d), keep_raw=False)
    offers, lists = (e.filter(F.col("status") == DEFAULT_CONFIG.status_processing) for e in (it.offers, it.lists))
    return plan_mixed_batch(offers, lists, *_mixed_state(spark, d), TB.site_directory(spark, d),
                            TB.store_files(spark, d), TB.item_files(spark, d), TB.catalogue(spark, d),
                            TB.member_files(spark, d), TB.cards(spark, d), TB.available_lists(spark, d),
                            TB.member_lists(spark, d))


_AUDIENCE = ["offer_id", "membership_uuid", "membership_id", "propensity"]


@query("apply_mixed_batch")
def q_apply_mixed_batch(spark, d):
    """The stored audience after offer events and member-list events in arrival order."""
    return _mixed_batch(spark, d).member_offers.select(*_AUDIENCE)


@query("apply_mixed_offers")
def q_apply_mixed_offers(spark, d):
    """The stored offers after both kinds of event: source, and the list location that the
    last event of either kind left."""
    return _mixed_batch(spark, d).offers.select("offer_id", "status", "offer_source", "member_list_location")


@query("mixed_list_outcomes")
def q_mixed_list_outcomes(spark, d):
    """How each member-list event between the offer events ended, missing files included."""
    return _mixed_batch(spark, d).list_outcomes


@query("stream_apply_mixed")
def q_stream_apply_mixed(spark, d):
    """Events of both kinds applied to one set of bucketed tables over several micro-batches;
    the final stored audience equals the one-batch result (apply_mixed_batch)."""
    stored, _ = _streamed(spark, d, "stream-mixed", _mixed_raw(spark, d), 4, *_mixed_state(spark, d))
    return stored.read("member_offers").select(*_AUDIENCE)
