"""Oracle SQL (DuckDB dialect) for every registered query with a SQL form.

Each statement re-derives the engine inputs from the base tables with the same
expressions as ``promoflow.testbed`` and then computes the expected result in flat SQL,
independently of the engine's code.
"""

from __future__ import annotations

from promoflow.testbed import FAULTS, LIST_FAULTS

ORACLE: dict[str, str] = {}


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------------------
# Audience domain: inputs
# ---------------------------------------------------------------------------
CARDS = """cards AS (
  SELECT CAST(c_custkey AS VARCHAR) AS cardNumber,
         'U' || CAST(c_custkey // 2 AS VARCHAR) AS membershipId,
         CASE WHEN c_acctbal < 0 THEN 'N' ELSE 'Y' END AS current_ind,
         'Y' AS card_current_ind,
         CASE c_mktsegment WHEN 'MACHINERY' THEN ' ACTIVE ' WHEN 'BUILDING' THEN 'PICKUP'
              WHEN 'AUTOMOBILE' THEN 'EXPIRED ' WHEN 'FURNITURE' THEN 'SUSPENDED'
              ELSE 'ACTIVE' END AS cardStatus,
         CASE WHEN c_nationkey = 24 THEN 'AFFILIATE' ELSE 'MEMBERSHIPACCOUNT' END AS cardType
  FROM customer)"""

ACTIVE_CARDS = """active_cards AS (
  SELECT cardNumber, membershipId FROM cards
  WHERE current_ind = 'Y' AND card_current_ind = 'Y'
    AND trim(cardStatus) IN ('ACTIVE', 'PICKUP', 'EXPIRED') AND cardType = 'MEMBERSHIPACCOUNT')"""

MEMBER_FILES = """member_files AS (
  SELECT 'members/list-' || CAST(event_id % 20 AS VARCHAR) || '.csv' AS list_key,
         CAST(user_id AS VARCHAR) AS c0, value AS c1_value
  FROM events)"""

LIST_OFFERS = """list_offers AS (
  SELECT offer_id,
         CASE offer_id % 3 WHEN 0 THEN 'BROADREACH' WHEN 1 THEN 'TETRIS' ELSE 'TIO' END AS offer_source,
         CASE WHEN offer_id % 5 = 4 THEN 'members/list-' || CAST(offer_id AS VARCHAR) || '.csv'
              ELSE 'members/list-' || CAST(offer_id AS VARCHAR) || '-prev.csv' END AS member_list_location
  FROM (SELECT DISTINCT o_orderkey % 20 AS offer_id FROM orders))"""

STORED_AUDIENCE = """stored AS (
  SELECT o_orderkey % 20 AS offer_id, 'U' || CAST(o_custkey // 2 AS VARCHAR) AS membership_uuid,
         MIN(CAST(o_custkey AS VARCHAR)) AS membership_id,
         ROUND(MAX(o_totalprice) / 100000, 4) AS propensity
  FROM orders GROUP BY 1, 2)"""

LIST_EVENTS = """list_events AS (
  SELECT 'L' || CAST(k AS VARCHAR) AS event_id, first_ts AS arrival, k,
         'members/list-' || CAST(k AS VARCHAR) || '.csv' AS location
  FROM (SELECT event_id % 20 AS k, MIN(ts) AS first_ts FROM events GROUP BY 1))"""

PAIRS = """pairs AS (
  SELECT event_id, arrival, location, 0 AS pos, CAST(k AS VARCHAR) AS offer_id_text, k AS offer_id FROM list_events
  UNION ALL
  SELECT event_id, arrival, location, 1, CAST(k + 100 AS VARCHAR), k + 100 FROM list_events)"""

LOOKED = """personalised AS (
  SELECT offer_id, offer_source, member_list_location AS stored_location
  FROM list_offers WHERE offer_source <> 'BROADREACH'),
looked0 AS (
  SELECT p.*, o.offer_source, o.stored_location, o.offer_source IS NOT NULL AS found
  FROM pairs p LEFT JOIN personalised o USING (offer_id)),
ev_src AS (
  SELECT event_id, arg_min(offer_source, pos) AS event_source
  FROM looked0 WHERE found GROUP BY event_id),
looked AS (SELECT l.*, s.event_source FROM looked0 l LEFT JOIN ev_src s USING (event_id))"""

EFFECTIVE = """found_pairs AS (SELECT DISTINCT ON (event_id, offer_id) * FROM looked WHERE found),
eff0 AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY offer_id ORDER BY arrival, event_id) = 1
                 THEN stored_location
                 ELSE lag(location) OVER (PARTITION BY offer_id ORDER BY arrival, event_id) END AS prev_location
  FROM found_pairs),
eff1 AS (SELECT *, location IS DISTINCT FROM prev_location AS effective FROM eff0),
eff AS (
  SELECT *, CASE WHEN effective THEN row_number() OVER (PARTITION BY offer_id, effective ORDER BY arrival, event_id) END AS round
  FROM eff1)"""

DELTA = """tgt AS (SELECT offer_id, location AS list_key, event_source AS offer_source FROM eff WHERE effective AND round = 1),
rows_by_src AS (
  SELECT f.list_key, s.offer_source, f.c0 AS membership_id,
         CASE WHEN lower(s.offer_source) = 'tetris' THEN f.c1_value END AS propensity
  FROM member_files f JOIN (SELECT DISTINCT list_key, offer_source FROM tgt) s USING (list_key)),
resolved AS (
  SELECT list_key, offer_source, membership_uuid, membership_id, propensity FROM (
    SELECT r.list_key, r.offer_source, c.membershipId AS membership_uuid, r.membership_id, r.propensity,
           row_number() OVER (PARTITION BY r.list_key, r.offer_source, c.membershipId
                              ORDER BY r.propensity DESC NULLS LAST, r.membership_id) AS rn
    FROM rows_by_src r JOIN active_cards c ON c.cardNumber = r.membership_id) WHERE rn = 1),
new_aud AS (
  SELECT t.offer_id, m.membership_uuid, m.membership_id, m.propensity
  FROM tgt t JOIN resolved m USING (list_key, offer_source)),
old_aud AS (SELECT * FROM stored WHERE offer_id IN (SELECT offer_id FROM tgt)),
delta AS (
  SELECT offer_id, membership_uuid, 'add' AS action FROM (
    SELECT offer_id, membership_uuid FROM new_aud EXCEPT SELECT offer_id, membership_uuid FROM old_aud)
  UNION ALL
  SELECT offer_id, membership_uuid, 'delete' AS action FROM (
    SELECT offer_id, membership_uuid FROM old_aud EXCEPT SELECT offer_id, membership_uuid FROM new_aud)),
new_stored AS (
  SELECT offer_id, membership_uuid, membership_id, propensity FROM stored s
  WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.action = 'delete'
                    AND d.offer_id = s.offer_id AND d.membership_uuid = s.membership_uuid)
  UNION ALL
  SELECT n.offer_id, n.membership_uuid, n.membership_id, n.propensity FROM new_aud n
  JOIN delta d ON d.action = 'add' AND d.offer_id = n.offer_id AND d.membership_uuid = n.membership_uuid)"""

AUDIENCE_BASE = [CARDS, ACTIVE_CARDS, MEMBER_FILES, LIST_OFFERS, STORED_AUDIENCE, LIST_EVENTS, PAIRS,
                 LOOKED, EFFECTIVE, DELTA]

ORACLE["active_member_cards"] = _with(CARDS, ACTIVE_CARDS) + "SELECT cardNumber, membershipId FROM active_cards"

ORACLE["biglist_scan"] = _with(*AUDIENCE_BASE[:8]) + """
SELECT f.list_key, s.offer_source, f.c0 AS membership_id,
       CASE WHEN lower(s.offer_source) = 'tetris' THEN f.c1_value END AS propensity
FROM member_files f
JOIN (SELECT DISTINCT location AS list_key, event_source AS offer_source FROM looked WHERE found) s
USING (list_key)"""

ORACLE["resolve_members"] = _with(CARDS, ACTIVE_CARDS, MEMBER_FILES) + """
SELECT f.list_key, c.membershipId AS membership_uuid, MIN(f.c0) AS membership_id
FROM member_files f JOIN active_cards c ON c.cardNumber = f.c0
GROUP BY f.list_key, c.membershipId"""

ORACLE["resolve_members_ranked"] = _with(CARDS, ACTIVE_CARDS, MEMBER_FILES) + """
SELECT list_key, membership_uuid, membership_id, propensity FROM (
  SELECT f.list_key, c.membershipId AS membership_uuid, f.c0 AS membership_id, f.c1_value AS propensity,
         row_number() OVER (PARTITION BY f.list_key, c.membershipId
                            ORDER BY f.c1_value DESC NULLS LAST, f.c0) AS rn
  FROM member_files f JOIN active_cards c ON c.cardNumber = f.c0) WHERE rn = 1"""

ORACLE["offers_for_list_event"] = _with(*AUDIENCE_BASE[:8]) + """
SELECT event_id, CAST(pos AS INTEGER) AS pos, offer_id_text, offer_id, found, offer_source,
       stored_location, event_source FROM looked"""

ORACLE["unprocessed_offer_ids"] = _with(*AUDIENCE_BASE[:8]) + """
SELECT event_id, CAST(pos AS INTEGER) AS pos, offer_id_text FROM looked WHERE NOT found"""

ORACLE["effective_list_events"] = _with(*AUDIENCE_BASE[:9]) + """
SELECT event_id, offer_id, location, prev_location, effective, CAST(round AS BIGINT) AS round FROM eff"""

_AUD = _with(*AUDIENCE_BASE)

ORACLE["audience_delta"] = _AUD + "SELECT offer_id, membership_uuid, action FROM delta"

ORACLE["delta_counts"] = _AUD + """
SELECT offer_id, COUNT(*) FILTER (WHERE action = 'add') AS n_add,
       COUNT(*) FILTER (WHERE action = 'delete') AS n_delete
FROM delta GROUP BY offer_id"""

ORACLE["apply_audience_delta"] = _AUD + "SELECT * FROM new_stored"

# Output batches are numbered per partition; what holds at any partitioning is compared.
ORACLE["sink_batches"] = _AUD + """
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT (offer_id, membership_uuid)) AS n_distinct, TRUE AS within_size
FROM new_stored"""

ORACLE["changed_members"] = _AUD + "SELECT DISTINCT membership_uuid FROM delta"

ORACLE["member_view_upserts"] = _AUD + """
SELECT membership_uuid, string_agg(CAST(offer_id AS VARCHAR), ',' ORDER BY offer_id) AS offer_ids
FROM (SELECT DISTINCT membership_uuid, offer_id FROM new_stored
      WHERE membership_uuid IN (SELECT membership_uuid FROM delta))
GROUP BY membership_uuid"""

ORACLE["member_view_deletes"] = _AUD + """
SELECT DISTINCT membership_uuid FROM delta
WHERE membership_uuid NOT IN (SELECT membership_uuid FROM new_stored)"""

ORACLE["update_list_location"] = _AUD + """,
last_loc AS (
  SELECT offer_id, location FROM (
    SELECT offer_id, location, row_number() OVER (PARTITION BY offer_id ORDER BY arrival DESC, event_id DESC) AS rn
    FROM eff) WHERE rn = 1)
SELECT o.offer_id, o.offer_source, COALESCE(l.location, o.member_list_location) AS member_list_location
FROM list_offers o LEFT JOIN last_loc l USING (offer_id)"""


# ---------------------------------------------------------------------------
# Offer domain: inputs and intake
# ---------------------------------------------------------------------------
LINES = """li AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, l_tax, l_returnflag,
         l_linestatus, l_shipdate,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
                            l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS line_pos,
         l_returnflag <> 'R' AS kept,
         CASE WHEN l_discount = 0 AND l_tax = 0 THEN ''
              ELSE CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR) END AS award_value,
         CASE WHEN l_quantity = 50 THEN 'BOGO' WHEN l_linestatus = 'O' THEN 'DOLLAR_OFF'
              ELSE 'PERCENTAGE_OFF' END AS discount_method,
         CASE WHEN l_quantity > 48 THEN 'BONUS_ITEMS' WHEN l_linestatus = 'O' THEN 'DISCOUNTED_ITEMS'
              ELSE 'ELIGIBLE_ITEMS' END AS payload_item_type,
         CASE WHEN l_returnflag = 'A' THEN 'biglist' WHEN l_tax = 0.08 AND l_discount = 0.1 THEN 'List'
              ELSE 'list' END AS list_type_raw,
         CASE WHEN l_returnflag = 'A' THEN 'items/supplier-' || CAST(l_suppkey AS VARCHAR) || '.csv' END AS item_url
  FROM lineitem),
lagg AS (
  SELECT l_orderkey, COUNT(*) AS n_lines, COUNT(*) FILTER (WHERE kept) AS n_kept,
         MIN(l_linenumber) FILTER (WHERE kept) AS k0,
         BOOL_OR(kept AND award_value = '') AS v5,
         BOOL_OR(kept AND discount_method NOT IN ('DOLLAR_OFF', 'PERCENTAGE_OFF')) AS v6,
         BOOL_OR(list_type_raw NOT IN ('list', 'biglist')) AS v9,
         string_agg(discount_method, ',' ORDER BY line_pos) FILTER (WHERE kept) AS discount_type,
         MAX(award_value) FILTER (WHERE kept) AS one_value,
         string_agg(item_url, ',' ORDER BY line_pos) AS item_list_location
  FROM li GROUP BY l_orderkey)"""

EVENTS = """ev0 AS (
  SELECT 'O' || lpad(CAST(o.o_orderkey AS VARCHAR), 12, '0') AS event_id,
         make_timestamp(epoch_us(o.o_orderdate) + o.o_orderkey) AS arrival,
         o.o_orderkey, o.o_custkey AS offer_id, o.o_orderstatus, o.o_orderpriority, o.o_orderdate,
         c.c_nationkey, c.c_mktsegment,
         CASE c.c_mktsegment WHEN 'MACHINERY' THEN 'TETRIS' WHEN 'BUILDING' THEN 'TIO'
              WHEN 'FURNITURE' THEN 'TETRIS' ELSE 'BROADREACH' END AS offer_source,
         CASE c.c_mktsegment WHEN 'MACHINERY' THEN 'tetris,weekly' WHEN 'BUILDING' THEN 'tio'
              WHEN 'AUTOMOBILE' THEN 'seasonal,JOIN'
              WHEN 'FURNITURE' THEN CASE WHEN c.c_nationkey < 5 THEN 'tetris,tio' ELSE 'tetris' END
              ELSE '' END AS labels,
         CASE WHEN o.o_orderstatus = 'P' AND o.o_orderpriority = '5-LOW' THEN 'DRAFT'
              WHEN o.o_orderstatus = 'F' THEN 'PUBLISHED' WHEN o.o_orderstatus = 'O' THEN 'LIVE'
              ELSE 'DISABLED' END AS status,
         o.o_orderpriority <> '5-LOW' AS has_members,
         CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' AND o.o_orderstatus = 'P' THEN 2 ELSE 1 END AS member_count,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'EST' WHEN '2-HIGH' THEN 'CDT' WHEN '3-MEDIUM' THEN 'PST'
              WHEN '4-NOT SPECIFIED' THEN 'MST' ELSE 'CST' END AS time_zone,
         CASE o.o_orderstatus WHEN 'O' THEN 'D2H' WHEN 'F' THEN 'CLUB,D2H' ELSE 'CLUB' END AS channels,
         COALESCE(a.n_lines, 0) AS n_lines, COALESCE(a.n_kept, 0) AS n_kept, a.k0,
         COALESCE(a.v5, false) AS v5, COALESCE(a.v6, false) AS v6, COALESCE(a.v9, false) AS v9,
         COALESCE(a.discount_type, '') AS discount_type, a.one_value,
         COALESCE(a.item_list_location, '') AS item_list_location,
         'members/list-' || CAST(o.o_orderkey % 20 AS VARCHAR) || '.csv' AS member_url
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN lagg a ON a.l_orderkey = o.o_orderkey),
ev AS (
  SELECT *, lower(offer_source) AS source_label,
         offer_source <> 'BROADREACH' AND NOT has_members AS g1,
         has_members AND member_count <> 1 AS g2,
         c_mktsegment = 'AUTOMOBILE' AS g3,
         n_kept = 0 AS g4,
         concat_ws('; ', CASE WHEN status NOT IN ('PUBLISHED', 'DISABLED', 'LIVE') THEN 'V3' END,
                   CASE WHEN labels = 'tetris,tio' THEN 'V4' END,
                   CASE WHEN v5 THEN 'V5' END, CASE WHEN v6 THEN 'V6' END, CASE WHEN v9 THEN 'V9' END,
                   CASE WHEN has_members AND o_orderpriority = '1-URGENT' AND n_lines = 0 THEN 'V11' END) AS errs
  FROM ev0),
outcome AS (
  SELECT *,
         CASE WHEN g1 OR g2 OR g3 OR g4 THEN 'SKIPPED' WHEN errs <> '' THEN 'FAILED' ELSE 'PROCESSING' END AS status_out,
         CASE WHEN g1 THEN 'Personalized offer missing memberDetails'
              WHEN g2 THEN 'Received an offer with memberListCount not equal to 1, skipping this offer'
              WHEN g3 THEN 'Received an offer with at least one unwanted label, skipping this offer'
              WHEN g4 THEN 'Received an offer without award of type DISCOUNT_ITEM_PRICE, skipping this offer'
              WHEN errs <> '' THEN errs END AS reason
  FROM ev)"""

SITES = """sites AS (
  SELECT DISTINCT s_suppkey AS club_id,
         CASE WHEN s_nationkey = 1 THEN 'PR' WHEN s_nationkey = 6 THEN NULL ELSE n_name END AS state
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
  WHERE s_acctbal >= 0 AND (s_nationkey IN (4, 5) OR s_nationkey <> 3)),
std AS (
  SELECT 'ALL' AS list_name, club_id FROM sites
  UNION ALL SELECT 'STANDARD CLUBS - PUERTO RICO ONLY', club_id FROM sites WHERE state = 'PR'
  UNION ALL SELECT 'STANDARD CLUBS - US EXCLUDING PUERTO RICO', club_id FROM sites WHERE state <> 'PR'),
resolved AS (
  SELECT e.event_id, e.offer_id, l.l_suppkey AS club_id
  FROM ev e JOIN (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) l ON l.l_orderkey = e.o_orderkey
  WHERE e.o_orderpriority = '1-URGENT'
  UNION ALL
  SELECT e.event_id, e.offer_id, s.s_suppkey FROM ev e JOIN supplier s ON s.s_nationkey = e.c_nationkey
  WHERE e.o_orderpriority = '2-HIGH' OR (e.o_orderpriority = '3-MEDIUM' AND e.o_orderstatus <> 'F')
  UNION ALL
  SELECT e.event_id, e.offer_id, st.club_id FROM ev e JOIN std st ON st.list_name = 'ALL'
  WHERE e.o_orderpriority = '3-MEDIUM' AND e.o_orderstatus = 'F'
    AND NOT EXISTS (SELECT 1 FROM supplier s2 WHERE s2.s_nationkey = e.c_nationkey AND s2.s_suppkey = st.club_id)
  UNION ALL
  SELECT e.event_id, e.offer_id, st.club_id FROM ev e JOIN std st
    ON st.list_name = CASE e.o_orderstatus WHEN 'F' THEN 'ALL' WHEN 'O' THEN 'STANDARD CLUBS - PUERTO RICO ONLY'
                          ELSE 'STANDARD CLUBS - US EXCLUDING PUERTO RICO' END
  WHERE e.o_orderpriority = '4-NOT SPECIFIED'
  UNION ALL
  SELECT e.event_id, e.offer_id, 6279 FROM ev e WHERE e.o_orderpriority = '5-LOW' AND e.o_orderstatus = 'O'),
club_text AS (
  SELECT e.event_id,
         CASE WHEN e.has_members OR e.o_orderstatus = 'O'
              THEN COALESCE((SELECT string_agg(CAST(r.club_id AS VARCHAR), ',' ORDER BY r.club_id)
                             FROM resolved r WHERE r.event_id = e.event_id), '') END AS club_list
  FROM ev e)"""

PROJECTION = """proj AS (
  SELECT e.event_id, e.offer_id, e.status,
         strftime(e.o_orderdate, '%Y-%m-%d') || ' 00:00:00' AS start_datetime,
         strftime(e.o_orderdate + INTERVAL 90 DAY, '%Y-%m-%d') || ' 23:59:59' AS end_datetime,
         strftime(e.o_orderdate, '%Y-%m-%d') || ' 00:00:00' AS event_timestamp,
         e.time_zone, e.offer_source, e.discount_type,
         CASE WHEN e.n_kept = 1 THEN TRY_CAST(e.one_value AS DOUBLE) END AS discount_value,
         e.channels AS applicable_channel, ct.club_list,
         CASE WHEN e.has_members THEN e.member_url ELSE '' END AS member_list_location,
         'PLUS,CLUB' AS membership_type, e.item_list_location, e.labels,
         '' AS offer_set_id, CAST(NULL AS BIGINT) AS campaign_id, '' AS campaign_name, '' AS member_list_name
  FROM ev e JOIN club_text ct USING (event_id))"""

ITEMS = """ref_lines AS (
  SELECT e.event_id, e.offer_id, l.*,
         CASE l.payload_item_type WHEN 'DISCOUNTED_ITEMS' THEN 'DISCOUNTED_ITEM'
              WHEN 'ELIGIBLE_ITEMS' THEN 'ELIGIBLE_ITEM' END AS item_type
  FROM ev e JOIN li l ON l.l_orderkey = e.o_orderkey WHERE l.l_linenumber IN (e.k0, e.k0 + 1)),
inline_items AS (
  SELECT event_id, offer_id, l_partkey AS item_number, item_type FROM ref_lines
  WHERE lower(list_type_raw) = 'list' AND item_type IS NOT NULL),
item_files AS (
  SELECT DISTINCT 'items/supplier-' || CAST(l_suppkey AS VARCHAR) || '.csv' AS list_key, l_partkey AS item_number
  FROM lineitem),
big_items AS (
  SELECT t.event_id, t.offer_id, f.item_number, t.item_type FROM ref_lines t
  JOIN item_files f ON f.list_key = t.item_url
  WHERE lower(t.list_type_raw) <> 'list' AND t.item_type IS NOT NULL),
excluded AS (SELECT DISTINCT p_partkey AS item_number FROM part WHERE p_size = 50),
all_items AS (
  SELECT * FROM (SELECT * FROM inline_items UNION ALL SELECT * FROM big_items) x
  WHERE item_number NOT IN (SELECT item_number FROM excluded))"""

OVERRIDES = """ov AS (
  SELECT e.event_id, e.offer_id, l.l_suppkey AS club_number,
         CASE l.l_returnflag WHEN 'A' THEN strftime(l.l_shipdate, '%Y-%m-%d') || ' 08:00:00'
              WHEN 'N' THEN strftime(l.l_shipdate, '%Y-%m-%d') || ' 00:00:00' END AS start_datetime,
         strftime(l.l_shipdate + INTERVAL 30 DAY, '%Y-%m-%d')
           || CASE WHEN l.l_quantity < 10 THEN ' 23:59:59' ELSE ' 21:30:00' END AS end_datetime,
         CASE WHEN l.l_returnflag = 'R' THEN 'EST' ELSE 'CST' END AS time_zone
  FROM ev e JOIN lineitem l ON l.l_orderkey = e.o_orderkey
  WHERE e.has_members AND l.l_linestatus = 'F')"""

APPLY = """stored_offers AS (
  SELECT c_custkey AS offer_id,
         CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN 'TETRIS'
              WHEN c_mktsegment = 'BUILDING' THEN CASE WHEN c_nationkey = 7 THEN 'TETRIS' ELSE 'TIO' END
              ELSE 'BROADREACH' END AS offer_source
  FROM customer WHERE c_acctbal > 5000),
ready AS (SELECT * FROM outcome WHERE status_out = 'PROCESSING'),
checked0 AS (
  SELECT r.event_id, r.arrival, r.offer_id, r.offer_source, s.offer_source AS stored_source,
         COALESCE(s.offer_source, first_value(r.offer_source) OVER (
           PARTITION BY r.offer_id ORDER BY r.arrival, r.event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS fixed_source
  FROM ready r LEFT JOIN stored_offers s USING (offer_id)),
checked AS (
  SELECT *, offer_source IS DISTINCT FROM fixed_source AS conflict,
         CASE WHEN offer_source IS DISTINCT FROM fixed_source
              THEN 'Invalid update payload. Offer source ' || fixed_source || ' of offer '
                   || CAST(offer_id AS VARCHAR) || ' cannot be updated once created.' END AS message
  FROM checked0),
applied AS (
  SELECT offer_id, event_id FROM (
    SELECT offer_id, event_id, row_number() OVER (PARTITION BY offer_id ORDER BY arrival DESC, event_id DESC) AS rn
    FROM checked WHERE NOT conflict) WHERE rn = 1),
stored_items AS (
  SELECT l.l_partkey AS item_number, 'ELIGIBLE_ITEM' AS item_type, o.o_custkey AS offer_id, '' AS product_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_shipdate < TIMESTAMP '1996-01-01'),
stored_ov AS (
  SELECT l.l_suppkey AS club_number, strftime(l.l_shipdate, '%Y-%m-%d %H:%M:%S') AS start_datetime,
         strftime(l.l_shipdate, '%Y-%m-%d %H:%M:%S') AS end_datetime, 'CST' AS time_zone, o.o_custkey AS offer_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_shipdate < TIMESTAMP '1996-01-01')"""

OFFER_BASE = [LINES, EVENTS]
_OFF = _with(*OFFER_BASE)

ORACLE["decode_events"] = _with(*AUDIENCE_BASE[:6], *OFFER_BASE) + """
SELECT event_id, 'offer' AS kind, CAST(offer_id AS VARCHAR) AS promotion_number, status AS offer_status,
       n_lines AS n_awards, n_lines AS n_item_payloads, 0 AS n_offer_ids FROM ev
UNION ALL
SELECT event_id, 'list', NULL, NULL, 0, 0, 2 FROM list_events"""

ORACLE["dead_letter_events"] = """
SELECT 'D' || CAST(doc_id AS VARCHAR) AS event_id FROM documents
WHERE NOT COALESCE(CASE WHEN json_valid(text) THEN json_type(text) = 'OBJECT' END, false)"""

ORACLE["route_event_kind"] = _with(*AUDIENCE_BASE[:6], *OFFER_BASE) + """
SELECT event_id, 'offer' AS kind FROM ev UNION ALL SELECT event_id, 'list' FROM list_events"""

ORACLE["route_source"] = _OFF + "SELECT event_id, offer_source, source_label FROM ev"

ORACLE["gate_events"] = _OFF + """
SELECT event_id,
       CASE WHEN g1 OR g2 OR g3 OR g4 THEN 'SKIPPED' END AS gate_status,
       CASE WHEN status_out = 'SKIPPED' THEN reason END AS gate_reason
FROM outcome"""

ORACLE["trim_awards"] = _OFF + """
SELECT event_id, n_lines AS n_before, n_kept AS n_after,
       CASE WHEN n_kept > 0 THEN CAST(k0 AS VARCHAR) || ',' || CAST(k0 + 1 AS VARCHAR) END AS first_refs
FROM ev"""

_VAL = _OFF + """,
errs AS (
  SELECT event_id, 'V3' AS rule FROM ev WHERE status NOT IN ('PUBLISHED', 'DISABLED', 'LIVE')
  UNION ALL SELECT event_id, 'V4' FROM ev WHERE labels = 'tetris,tio'
  UNION ALL SELECT event_id, 'V5' FROM ev WHERE v5
  UNION ALL SELECT event_id, 'V6' FROM ev WHERE v6
  UNION ALL SELECT event_id, 'V9' FROM ev WHERE v9
  UNION ALL SELECT event_id, 'V11' FROM ev WHERE has_members AND o_orderpriority = '1-URGENT' AND n_lines = 0)
"""

ORACLE["validate_events"] = _VAL + "SELECT event_id, rule FROM errs"

_FAULTS = "VALUES " + ", ".join(
    [f"({i}, '{rule}')" for i, (rules, _, _) in enumerate(FAULTS) for rule in rules]
    + [f"({len(FAULTS) + i}, 'V13')" for i in range(len(LIST_FAULTS))])

ORACLE["validate_faulty_events"] = f"""
SELECT 'F' || CAST(o_orderkey AS VARCHAR) AS event_id, rule
FROM orders JOIN ({_FAULTS}) AS f(r, rule) ON o_orderkey % 40 = r"""

ORACLE["validation_summary"] = _VAL + f"""
SELECT rule, COUNT(*) AS n_events
FROM (SELECT event_id, rule FROM errs UNION ALL {ORACLE["validate_faulty_events"]}) GROUP BY rule"""

ORACLE["intake_outcomes"] = _with(*AUDIENCE_BASE[:6], *OFFER_BASE) + """
SELECT event_id, 'offer' AS kind, CAST(offer_id AS VARCHAR) AS oid, source_label, status_out AS status, reason
FROM outcome
UNION ALL
SELECT event_id, 'list', CAST(k AS VARCHAR), '', 'PROCESSING', NULL FROM list_events"""

ORACLE["event_time_normalise"] = _OFF + """
SELECT event_id, strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00' AS start_text,
       strftime(o_orderdate + INTERVAL 90 DAY, '%Y-%m-%d') || ' 23:59:59' AS end_text,
       strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00' AS event_time_text, time_zone AS zone
FROM ev"""

_PROJ = _with(*OFFER_BASE, SITES, PROJECTION)

ORACLE["offer_projection"] = _PROJ + "SELECT * FROM proj"

ORACLE["expired_offers"] = _PROJ + """
SELECT event_id, offer_id,
       timezone(CASE time_zone WHEN 'EST' THEN 'US/Eastern' WHEN 'CDT' THEN 'US/Central'
                     WHEN 'PST' THEN 'US/Pacific' WHEN 'MST' THEN 'US/Mountain' WHEN 'CST' THEN 'US/Central' END,
                TIMESTAMPTZ '1999-06-01 00:00:00+00') > CAST(end_datetime AS TIMESTAMP) AS is_expired
FROM proj"""

_ITEMS = _with(*OFFER_BASE, ITEMS)

ORACLE["list_faults"] = _ITEMS + """
SELECT event_id, CAST(NULL AS VARCHAR) AS missing_list, min(list_key) || ' holds a value that is no whole number' AS fault
FROM (SELECT event_id, item_url AS list_key FROM ref_lines WHERE lower(list_type_raw) <> 'list'
      UNION ALL
      SELECT event_id, 'stores/nation-' || CAST(c_nationkey AS VARCHAR) || '.csv' FROM ev
      WHERE o_orderpriority IN ('2-HIGH', '3-MEDIUM'))
WHERE list_key IN ('items/supplier-7.csv', 'stores/nation-24.csv') GROUP BY event_id"""

ORACLE["offer_items_inline"] = _ITEMS + "SELECT event_id, offer_id, item_number, item_type FROM inline_items"

ORACLE["item_type_mapping"] = _ITEMS + """
SELECT payload_item_type,
       CASE payload_item_type WHEN 'DISCOUNTED_ITEMS' THEN 'DISCOUNTED_ITEM'
            WHEN 'ELIGIBLE_ITEMS' THEN 'ELIGIBLE_ITEM' END AS item_type,
       COUNT(*) AS n_payloads
FROM li WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY 1, 2"""

ORACLE["offer_items_biglist"] = _ITEMS + "SELECT event_id, offer_id, item_number, item_type FROM big_items"

ORACLE["offer_items_all"] = _ITEMS + """
SELECT event_id, item_number, item_type, offer_id, '' AS product_id FROM all_items"""

ORACLE["excluded_items"] = "SELECT DISTINCT p_partkey AS item_number FROM part WHERE p_size = 50"

ORACLE["exclude_items"] = """
SELECT l_orderkey, l_partkey AS item_number FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size = 50)"""

ORACLE["site_overrides"] = _with(*OFFER_BASE, OVERRIDES) + """
SELECT event_id, offer_id, club_number, start_datetime, end_datetime, time_zone FROM ov"""

ORACLE["active_sites"] = _with(SITES.split(",\nstd AS")[0]) + "SELECT club_id, state FROM sites"

ORACLE["standard_site_lists"] = _with(*SITES.split(",\nresolved AS")[:1]) + "SELECT list_name, club_id FROM std"

ORACLE["complement_site_list"] = _with(*OFFER_BASE, SITES) + """
SELECT e.event_id, e.offer_id, st.club_id FROM ev e JOIN std st ON st.list_name = 'ALL'
WHERE e.has_members AND e.o_orderpriority = '3-MEDIUM' AND e.o_orderstatus = 'F'
  AND NOT EXISTS (SELECT 1 FROM supplier s2 WHERE s2.s_nationkey = e.c_nationkey AND s2.s_suppkey = st.club_id)"""

_SETS = """,
sent AS (
  SELECT DISTINCT event_id, offer_id, club_id FROM resolved),
set_of AS (
  SELECT e.event_id, e.offer_id,
         sha256(coalesce(string_agg(CAST(s.club_id AS VARCHAR), ',' ORDER BY s.club_id), '')) AS set_id, COUNT(s.club_id) AS n_clubs
  FROM ev e LEFT JOIN sent s USING (event_id)
  WHERE e.has_members OR e.o_orderstatus = 'O' GROUP BY e.event_id, e.offer_id)
"""

ORACLE["event_site_sets"] = _with(*OFFER_BASE, SITES) + _SETS + """
SELECT event_id, offer_id, CAST(0 AS INTEGER) AS pos, set_id, CAST(n_clubs AS INTEGER) AS n_clubs FROM set_of"""

ORACLE["site_sets"] = _with(*OFFER_BASE, SITES) + _SETS + """
SELECT DISTINCT o.set_id, s.club_id FROM set_of o JOIN sent s USING (event_id)"""

ORACLE["resolve_sites"] = _with(*OFFER_BASE, SITES) + "SELECT event_id, offer_id, club_id FROM resolved"

_APPLY = _with(*OFFER_BASE, SITES, PROJECTION, ITEMS, OVERRIDES, APPLY)

ORACLE["source_conflicts"] = _APPLY + """
SELECT event_id, offer_id, stored_source, fixed_source, conflict, message FROM checked"""

ORACLE["latest_offer_event"] = _APPLY + "SELECT offer_id, event_id FROM applied"

ORACLE["upsert_offers"] = _APPLY + """
SELECT offer_id, 'LIVE' AS status, offer_source, 'CST' AS time_zone, CAST(NULL AS VARCHAR) AS discount_type,
       CAST(NULL AS DOUBLE) AS discount_value, CAST(NULL AS VARCHAR) AS club_list,
       'members/old.csv' AS member_list_location, '' AS item_list_location, CAST(NULL AS VARCHAR) AS start_datetime
FROM stored_offers WHERE offer_id NOT IN (SELECT offer_id FROM applied)
UNION ALL
SELECT p.offer_id, p.status, p.offer_source, p.time_zone, p.discount_type, p.discount_value, p.club_list,
       p.member_list_location, p.item_list_location, p.start_datetime
FROM proj p JOIN applied a USING (event_id)"""

ORACLE["replace_offer_items"] = _APPLY + """
SELECT * FROM stored_items WHERE offer_id NOT IN (SELECT offer_id FROM applied)
UNION ALL
SELECT i.item_number, i.item_type, i.offer_id, '' FROM all_items i JOIN applied a USING (event_id)"""

ORACLE["replace_site_overrides"] = _APPLY + """
SELECT * FROM stored_ov WHERE offer_id NOT IN (SELECT offer_id FROM applied)
UNION ALL
SELECT o.club_number, o.start_datetime, o.end_datetime, o.time_zone, o.offer_id
FROM ov o JOIN applied a USING (event_id)"""

ORACLE["replace_bucketed_items"] = ORACLE["replace_offer_items"]


def _chunks(name: str, items: str) -> str:
    """CTEs of the item chunks of ``items`` (offer_id, item_type, item_number): prefixes of hash
    bits, at most 50 items each, as {name} (offer_id, item_type, chunk, items)."""
    return f"""{name}_b AS (
  SELECT DISTINCT offer_id, item_type, item_number,
         lpad(bin(CAST('0x' || substr(md5(CAST(item_number AS VARCHAR)), 1, 8) AS BIGINT)), 32, '0') AS bits FROM ({items})),
{name}_n AS (
  SELECT offer_id, item_type, CASE WHEN count(*) <= 50 THEN 0
         ELSE least(32, CAST(ceil(log2(count(*) / 50.0)) AS INTEGER) + 6) END AS deepest
  FROM {name}_b GROUP BY 1, 2),
{name}_l AS (
  SELECT b.*, n.deepest, unnest(range(n.deepest + 1)) AS level FROM {name}_b b JOIN {name}_n n USING (offer_id, item_type)),
{name}_f AS (
  SELECT offer_id, item_type, level, left(bits, CAST(level AS INTEGER)) AS node FROM {name}_l
  GROUP BY 1, 2, 3, 4 HAVING count(*) <= 50),
{name}_d AS (
  SELECT l.offer_id, l.item_type, l.item_number, any_value(l.bits) AS bits,
         coalesce(min(l.level) FILTER (f.node IS NOT NULL), any_value(l.deepest)) AS depth
  FROM {name}_l l LEFT JOIN {name}_f f ON f.offer_id = l.offer_id AND f.item_type = l.item_type AND f.level = l.level
       AND f.node = left(l.bits, CAST(l.level AS INTEGER))
  GROUP BY 1, 2, 3),
{name} AS (
  SELECT offer_id, item_type, left(bits, CAST(depth AS INTEGER)) AS chunk,
         string_agg(CAST(item_number AS VARCHAR), ',' ORDER BY item_number) AS items
  FROM {name}_d GROUP BY 1, 2, 3)"""


_NEW_ITEMS = "SELECT a.offer_id, i.item_type, i.item_number FROM all_items i JOIN applied a USING (event_id)"

ORACLE["offer_serving_view"] = _APPLY + ", " + _chunks("chunked", _NEW_ITEMS) + """
SELECT a.offer_id, 'OFFER' AS item_type, '' AS chunk,
       concat_ws(';', p.status, p.offer_source, p.time_zone, p.member_list_location, p.labels, coalesce(p.club_list, ''),
                 coalesce((SELECT string_agg(concat_ws('|', CAST(o.club_number AS VARCHAR), coalesce(o.start_datetime, '-'),
                                                      coalesce(o.end_datetime, '-'), o.time_zone), ','
                                  ORDER BY o.club_number, o.start_datetime NULLS FIRST, o.end_datetime NULLS FIRST, o.time_zone)
                           FROM ov o WHERE o.event_id = a.event_id), '')) AS items
FROM applied a JOIN proj p USING (event_id)
UNION ALL SELECT offer_id, item_type, chunk, items FROM chunked"""

ORACLE["offer_view_growth"] = (
    _APPLY + ", " + _chunks("chunked", _NEW_ITEMS) + ", "
    + _chunks("was", "SELECT offer_id, item_type, item_number FROM stored_items") + """
SELECT 'upsert' AS change, c.offer_id, c.item_type, c.chunk, c.items
FROM chunked c LEFT JOIN was w USING (offer_id, item_type, chunk) WHERE c.items IS DISTINCT FROM w.items
UNION ALL
SELECT 'delete', w.offer_id, w.item_type, w.chunk, ''
FROM was w WHERE w.offer_id IN (SELECT offer_id FROM applied)
  AND NOT EXISTS (SELECT 1 FROM chunked c WHERE c.offer_id = w.offer_id AND c.item_type = w.item_type AND c.chunk = w.chunk)""")


# ---------------------------------------------------------------------------
# Audit trail
# ---------------------------------------------------------------------------
AUDIT = """audit_in AS (
  SELECT event_id, arrival, CAST(offer_id AS VARCHAR) AS oid, source_label, status_out, reason FROM outcome
  UNION ALL
  SELECT event_id, arrival, CAST(k AS VARCHAR), '', 'PROCESSING', NULL FROM list_events),
list_done AS (
  SELECT l.event_id,
         CASE WHEN l.k % 3 = 0 THEN 'FAILED' ELSE 'PROCESSED' END AS status,
         CASE WHEN l.k % 3 = 0 THEN 'The offers to update do not exist'
              ELSE 'Memeberlist updated successfully of offer_ids : [' || CAST(l.k AS VARCHAR)
                   || ']. Ignored processing [' || CAST(l.k + 100 AS VARCHAR) || '].' END AS comments
  FROM list_events l),
offer_done AS (
  SELECT event_id, 'PROCESSED' AS status,
         COALESCE(message, 'Offer ' || CAST(offer_id AS VARCHAR) || ' updated successfully.') AS comments
  FROM checked),
current_st AS (
  SELECT a.oid || '_' || strftime(a.arrival, '%Y-%m-%d_%H:%M:%S.%f') AS ouid, a.oid, a.source_label, a.arrival,
         COALESCE(o.status, l.status, a.status_out) AS status,
         COALESCE(o.comments, l.comments, a.reason, '') AS comments
  FROM audit_in a LEFT JOIN offer_done o USING (event_id) LEFT JOIN list_done l USING (event_id))"""

_AUDIT = _with(*AUDIENCE_BASE[:6], *OFFER_BASE, SITES, PROJECTION, ITEMS, OVERRIDES, APPLY, AUDIT)

ORACLE["audit_log"] = _AUDIT + """
SELECT oid || '_' || strftime(arrival, '%Y-%m-%d_%H:%M:%S.%f') AS ouid, oid, 'RECEIVED' AS status, '' AS comments,
       strftime(arrival, '%Y-%m-%d %H:%M:%S') AS received_date
FROM audit_in"""

ORACLE["audit_current_status"] = _AUDIT + "SELECT ouid, oid, status, comments FROM current_st"

ORACLE["failure_report"] = _AUDIT + """
SELECT CASE WHEN comments LIKE 'V%' THEN 'PayloadError' ELSE 'Error' END AS failure_class, source_label,
       strftime(arrival, '%Y-%m-%d') AS day, COUNT(*) AS n_failed
FROM current_st WHERE status = 'FAILED' GROUP BY 1, 2, 3"""


# ---------------------------------------------------------------------------
# Streaming: same results as the batch forms
# ---------------------------------------------------------------------------
ORACLE["stream_event_intake"] = ORACLE["intake_outcomes"]

ORACLE["stream_dedup"] = _with(*AUDIENCE_BASE[:6], *OFFER_BASE) + """
SELECT event_id FROM ev UNION ALL SELECT event_id FROM list_events"""

_JUNK = "NOT COALESCE(CASE WHEN json_valid(text) THEN json_type(text) = 'OBJECT' END, false)"

ORACLE["stream_dead_letters"] = f"""
SELECT 'D' || CAST(doc_id AS VARCHAR) AS event_id, 'not one JSON object' AS dead, CAST(length(text) AS INTEGER) AS n_chars
FROM documents WHERE {_JUNK}"""

ORACLE["stream_failure_report"] = _OFF + f"""
SELECT 'PayloadError' AS failure_class, source_label, strftime(arrival, '%Y-%m-%d') AS day, COUNT(*) AS n_failed
FROM outcome WHERE status_out = 'FAILED' GROUP BY 1, 2, 3
UNION ALL
SELECT 'Error', '', '2024-01-01', COUNT(*) FROM documents WHERE {_JUNK}"""

ORACLE["catalogue_scan"] = ORACLE["excluded_items"]
ORACLE["member_card_scan"] = ORACLE["active_member_cards"]
ORACLE["site_scan"] = ORACLE["active_sites"]

ORACLE["stream_apply_offers"] = ORACLE["upsert_offers"]

ORACLE["stream_apply_lists"] = ORACLE["apply_audience_delta"]


# ---------------------------------------------------------------------------
# Two rounds of member-list events in one batch
# ---------------------------------------------------------------------------
ROUNDS = """files2 AS (
  SELECT list_key, c0, c1_value FROM member_files
  UNION ALL
  SELECT 'members/half-' || CAST(event_id % 20 AS VARCHAR) || '.csv', CAST(user_id AS VARCHAR), value
  FROM events WHERE event_type IN ('click', 'view')),
ev2 AS (
  SELECT 'L' || CAST(k AS VARCHAR) || 'a' AS event_id, t1 AS arrival, k,
         'members/list-' || CAST(k AS VARCHAR) || '.csv' AS location FROM (
    SELECT event_id % 20 AS k, MIN(ts) AS t1 FROM events GROUP BY 1)
  UNION ALL
  SELECT 'L' || CAST(k AS VARCHAR) || 'b', t2, k, 'members/half-' || CAST(k AS VARCHAR) || '.csv' FROM (
    SELECT event_id % 20 AS k, MAX(ts) AS t2 FROM events GROUP BY 1)),
eff2a AS (
  SELECT e.event_id, e.arrival, e.location, o.offer_id, o.offer_source AS event_source,
         CASE WHEN row_number() OVER (PARTITION BY o.offer_id ORDER BY e.arrival, e.event_id) = 1
              THEN o.member_list_location
              ELSE lag(e.location) OVER (PARTITION BY o.offer_id ORDER BY e.arrival, e.event_id) END AS prev_location
  FROM ev2 e JOIN list_offers o ON o.offer_id = e.k WHERE o.offer_source <> 'BROADREACH'),
eff2 AS (
  SELECT *, row_number() OVER (PARTITION BY offer_id ORDER BY arrival, event_id) AS round
  FROM eff2a WHERE location IS DISTINCT FROM prev_location),
res2 AS (
  SELECT list_key, offer_source, membership_uuid, membership_id, propensity FROM (
    SELECT f.list_key, s.offer_source, c.membershipId AS membership_uuid, f.c0 AS membership_id,
           CASE WHEN lower(s.offer_source) = 'tetris' THEN f.c1_value END AS propensity,
           row_number() OVER (PARTITION BY f.list_key, s.offer_source, c.membershipId
                              ORDER BY CASE WHEN lower(s.offer_source) = 'tetris' THEN f.c1_value END DESC NULLS LAST,
                                       f.c0) AS rn
    FROM files2 f JOIN (SELECT DISTINCT location AS list_key, event_source AS offer_source FROM eff2) s
      USING (list_key)
    JOIN active_cards c ON c.cardNumber = f.c0) WHERE rn = 1),
new1 AS (
  SELECT t.offer_id, m.membership_uuid, m.membership_id, m.propensity
  FROM eff2 t JOIN res2 m ON m.list_key = t.location AND m.offer_source = t.event_source WHERE t.round = 1),
after1 AS (
  SELECT s.* FROM stored s WHERE s.offer_id NOT IN (SELECT offer_id FROM eff2 WHERE round = 1)
  UNION ALL
  SELECT s.* FROM stored s JOIN new1 n USING (offer_id, membership_uuid)
  UNION ALL
  SELECT n.* FROM new1 n WHERE NOT EXISTS (
    SELECT 1 FROM stored s WHERE s.offer_id = n.offer_id AND s.membership_uuid = n.membership_uuid)),
new2 AS (
  SELECT t.offer_id, m.membership_uuid, m.membership_id, m.propensity
  FROM eff2 t JOIN res2 m ON m.list_key = t.location AND m.offer_source = t.event_source WHERE t.round = 2),
after2 AS (
  SELECT a.* FROM after1 a WHERE a.offer_id NOT IN (SELECT offer_id FROM eff2 WHERE round = 2)
  UNION ALL
  SELECT a.* FROM after1 a JOIN new2 n USING (offer_id, membership_uuid)
  UNION ALL
  SELECT n.* FROM new2 n WHERE NOT EXISTS (
    SELECT 1 FROM after1 a WHERE a.offer_id = n.offer_id AND a.membership_uuid = n.membership_uuid))"""

ORACLE["apply_audience_rounds"] = _with(CARDS, ACTIVE_CARDS, MEMBER_FILES, LIST_OFFERS, STORED_AUDIENCE, ROUNDS) + """
SELECT offer_id, membership_uuid, membership_id, propensity FROM after2"""


# ---------------------------------------------------------------------------
# Both kinds of event on one offers table
# ---------------------------------------------------------------------------
MIXED = """mixed_events AS (
  SELECT 'M' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS event_id, o_custkey, o_orderkey % 20 AS k,
         o_orderdate + to_microseconds(o_orderkey + 43200000000) AS arrival,
         CASE WHEN o_orderkey % 20 = 13 THEN 'members/absent.csv'
              ELSE 'members/list-' || CAST(o_orderkey % 20 AS VARCHAR) || '.csv' END AS location
  FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'P'),
mixed_pairs AS (
  SELECT event_id, arrival, location, k, 0 AS pos, o_custkey AS offer_id FROM mixed_events
  UNION ALL SELECT event_id, arrival, location, k, 1, k + 1 FROM mixed_events),
usable AS (
  SELECT c.offer_id, c.arrival, c.event_id, c.offer_source, p.member_list_location AS location
  FROM checked c JOIN proj p USING (event_id) WHERE NOT c.conflict),
mixed_known AS (
  SELECT p.*, coalesce(s.offer_source, (SELECT min_by(u.offer_source, (u.arrival, u.event_id)) FROM usable u
                 WHERE u.offer_id = p.offer_id AND (u.arrival, u.event_id) < (p.arrival, p.event_id))) AS offer_source
  FROM mixed_pairs p LEFT JOIN stored_offers s USING (offer_id)),
mixed_found AS (
  SELECT *, coalesce(offer_source, 'BROADREACH') <> 'BROADREACH' AS found FROM mixed_known),
mixed_src AS (SELECT event_id, arg_min(offer_source, pos) AS event_source FROM mixed_found WHERE found GROUP BY 1),
mixed_steps AS (
  SELECT offer_id, TIMESTAMP '0001-01-01' AS arrival, '' AS event_id, 0 AS pos, 'members/old.csv' AS location,
         'stored' AS what FROM stored_offers
  UNION ALL SELECT offer_id, arrival, event_id, 0, location, 'offer' FROM usable
  UNION ALL SELECT offer_id, arrival, event_id, pos, location, 'list' FROM mixed_found
  WHERE found AND location <> 'members/absent.csv'),
mixed_order AS (
  SELECT *, lag(location) OVER (PARTITION BY offer_id ORDER BY arrival, event_id, pos) AS before_it,
         row_number() OVER (PARTITION BY offer_id ORDER BY arrival DESC, event_id DESC, pos DESC) AS from_end
  FROM mixed_steps),
mixed_eff AS (
  SELECT o.offer_id, o.location, s.event_source,
         row_number() OVER (PARTITION BY offer_id ORDER BY arrival, event_id, pos) AS round
  FROM mixed_order o JOIN mixed_src s USING (event_id)
  WHERE what = 'list' AND location IS DISTINCT FROM before_it),
mixed_members AS (
  SELECT s.list_key, s.event_source, c.membershipId AS membership_uuid,
         min((CASE WHEN s.event_source = 'TETRIS' THEN -f.c1_value ELSE 0 END, f.c0)) AS best
  FROM (SELECT DISTINCT location AS list_key, event_source FROM mixed_eff) s
  JOIN member_files f USING (list_key) JOIN active_cards c ON c.cardNumber = f.c0
  GROUP BY 1, 2, 3),
mixed_present AS (
  SELECT s.offer_id, s.membership_uuid, 0 AS round, s.membership_id, s.propensity
  FROM stored s WHERE s.offer_id IN (SELECT offer_id FROM mixed_eff)
  UNION ALL
  SELECT e.offer_id, m.membership_uuid, e.round, m.best[2],
         CASE WHEN e.event_source = 'TETRIS' THEN -m.best[1] END
  FROM mixed_eff e JOIN mixed_members m ON m.list_key = e.location AND m.event_source = e.event_source),
mixed_runs AS (
  SELECT *, round - row_number() OVER (PARTITION BY offer_id, membership_uuid ORDER BY round) AS run FROM mixed_present),
mixed_spells AS (
  SELECT offer_id, membership_uuid, max(round) AS to_round,
         arg_min(membership_id, round) AS membership_id, min_by(struct_pack(p := propensity), round).p AS propensity
  FROM mixed_runs GROUP BY offer_id, membership_uuid, run),
mixed_last AS (SELECT offer_id, max(round) AS last_round FROM mixed_eff GROUP BY 1)"""

_MIXED = _with(CARDS, ACTIVE_CARDS, MEMBER_FILES, STORED_AUDIENCE, *OFFER_BASE, SITES, PROJECTION, ITEMS, OVERRIDES,
               APPLY, MIXED)

ORACLE["apply_mixed_batch"] = _MIXED + """
SELECT offer_id, membership_uuid, membership_id, propensity FROM stored
WHERE offer_id NOT IN (SELECT offer_id FROM mixed_eff)
UNION ALL
SELECT s.offer_id, s.membership_uuid, s.membership_id, s.propensity
FROM mixed_spells s JOIN mixed_last l USING (offer_id) WHERE s.to_round = l.last_round"""

ORACLE["apply_mixed_offers"] = _MIXED + """, rows_after AS (
SELECT offer_id, 'LIVE' AS status, offer_source FROM stored_offers WHERE offer_id NOT IN (SELECT offer_id FROM applied)
UNION ALL SELECT p.offer_id, p.status, p.offer_source FROM proj p JOIN applied a USING (event_id))
SELECT r.offer_id, r.status, r.offer_source, m.location AS member_list_location
FROM rows_after r JOIN mixed_order m ON m.offer_id = r.offer_id AND m.from_end = 1"""

ORACLE["mixed_list_outcomes"] = _MIXED + """
SELECT event_id,
       CASE WHEN bool_or(found) AND any_value(k) <> 13 THEN 'PROCESSED' ELSE 'FAILED' END AS status,
       CASE WHEN NOT bool_or(found) THEN 'The offers to update do not exist'
            WHEN any_value(k) = 13 THEN 'blob: members/absent.csv could not be read'
            ELSE 'Memeberlist updated successfully of offer_ids : ['
                 || coalesce(string_agg(CAST(offer_id AS VARCHAR), ', ' ORDER BY pos) FILTER (found), '')
                 || ']. Ignored processing ['
                 || coalesce(string_agg(CAST(offer_id AS VARCHAR), ', ' ORDER BY pos) FILTER (NOT found), '') || '].' END AS comments,
       CASE WHEN NOT bool_or(found) THEN 'Error' WHEN any_value(k) = 13 THEN 'BlobReadError' END AS failure_class
FROM mixed_found GROUP BY event_id"""


ORACLE["stream_apply_mixed"] = ORACLE["apply_mixed_batch"]
ORACLE["apply_landed_member_files"] = ORACLE["apply_audience_delta"]
