"""Offer rows, items, stores, overrides, expiry, conflicts (FIXTURES offer/items/stores/override/expiry)."""

from datetime import datetime

from conftest import base_payload, offer, raw_df
from pyspark.sql import functions as F

from promoflow.operators import items as I
from promoflow.operators import offers as O
from promoflow.operators import sites as ST
from promoflow.plans.intake import run_intake
from promoflow.plans.offer_batch import plan_offer_batch
from promoflow.schemas import OFFERS, OFFER_ITEMS, SITE_OVERRIDES


def ready(spark, items):
    it = run_intake(raw_df(spark, items))
    return it.offers.filter(F.col("status") == "PROCESSING")


def trimmed(spark, items):
    """Decoded, trimmed events whatever their validation outcome (operator-level tests)."""
    return run_intake(raw_df(spark, items)).offers


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def catalogue(spark, excluded=()):
    return spark.createDataFrame([("P1", 50, 0, list(excluded)), ("P2", 10, 0, [1001])],
                                 "PROD_ID string, MDSE_CATG_CD int, MDSE_SUB_CATG_CD int, ITEM_ID_ARRAY array<bigint>")


def directory(spark):
    rows = [(1, "TX", True, "REGULAR"), (2, "PR", True, None), (3, None, True, "REGULAR"),
            (4, "TX", False, "REGULAR"), (5, "CA", True, "EXPRESS")]
    return spark.createDataFrame([(i, (s,), a, t) for i, s, a, t in rows],
                                 "id bigint, address struct<state:string>, isActive boolean, clubType string")


def rows(spark, data):
    return spark.createDataFrame(data, "list_key string, c0 string, c1 string")


def project(spark, payload):
    ev = O.normalise_times(ready(spark, [("e", offer(payload))]))
    return O.project_offers(ST.with_club_lists(ev, directory(spark), rows(spark, []))).first()


def test_two_awards_join_types_and_null_value(spark):
    aw = [{"awardType": "DISCOUNT_ITEM_PRICE", "value": "5", "discountMethod": "DOLLAR_OFF", "itemRefId": ["1"]},
          {"awardType": "DISCOUNT_ITEM_PRICE", "value": "10", "discountMethod": "PERCENTAGE_OFF"}]
    r = project(spark, base_payload(awardList=aw))
    assert r["discount_type"] == "DOLLAR_OFF,PERCENTAGE_OFF"
    assert r["discount_value"] is None
    r1 = project(spark, base_payload())
    assert r1["discount_value"] == 5.0


def test_no_big_list_urls_give_empty_locations(spark):
    r = project(spark, base_payload())
    assert r["member_list_location"] == "" and r["item_list_location"] == ""


def test_event_time_cut_to_seconds(spark):
    r = project(spark, base_payload())
    assert r["event_timestamp"] == datetime(2024, 3, 1, 10, 0, 0)
    assert r["start_datetime"] == datetime(2024, 3, 1, 0, 0, 0)
    assert r["end_datetime"] == datetime(2024, 3, 31, 23, 59, 59)
    assert r["club_list"] == [7, 8]


def test_items_only_for_first_award_refs_and_types(spark):
    idt = {"itemListCount": 4, "itemsPayload": [
        {"itemType": "DISCOUNTED_ITEMS", "itemListType": "list", "itemList": ["1001", "1002"], "refId": 1},
        {"itemType": "ELIGIBLE_ITEMS", "itemListType": "LIST", "itemList": ["1002"], "refId": 1},
        {"itemType": "OTHER_ITEMS", "itemListType": "list", "itemList": ["1003"], "refId": 1},
        {"itemType": "ELIGIBLE_ITEMS", "itemListType": "list", "itemList": ["1004"], "refId": 2}]}
    ev = trimmed(spark, [("e", offer(base_payload(itemDetails=idt)))])
    got = sorted((r["item_number"], r["item_type"]) for r in
                 I.offer_items(ev, rows(spark, []), catalogue(spark, [1001])).collect())
    # 1001 excluded (category 50); 1002 twice (two payloads); 1003 unknown type; 1004 not referenced
    assert got == [(1002, "DISCOUNTED_ITEM"), (1002, "ELIGIBLE_ITEM")]


def test_items_from_big_list_files(spark):
    idt = {"itemListCount": 1, "itemsPayload": [
        {"itemType": "ELIGIBLE_ITEMS", "itemListType": "biglist", "itemList": [], "itemBigListURL": "i.csv",
         "refId": 1}]}
    ev = ready(spark, [("e", offer(base_payload(itemDetails=idt)))])
    files = rows(spark, [("i.csv", "2001", "0.5"), ("i.csv", "2002", None), ("j.csv", "2003", None)])
    got = sorted(r["item_number"] for r in I.offer_items(ev, files, catalogue(spark)).collect())
    assert got == [2001, 2002]


def test_store_lists_big_list_inclusion_and_exclusion(spark):
    cd_in = {"clubListCount": 1, "clubsPayload": [{"clubType": "biglist", "bigListName": "b", "clubList": [],
                                                   "clubBigListURL": "s.csv", "clubInclusion": True}]}
    cd_ex = {"clubListCount": 1, "clubsPayload": [{"clubType": "biglist", "bigListName": "b", "clubList": [],
                                                   "clubBigListURL": "s.csv", "clubInclusion": False}]}
    ev = ready(spark, [("in", offer(base_payload(clubDetails=cd_in))), ("ex", offer(base_payload(clubDetails=cd_ex)))])
    got = ST.resolve_sites(ev, directory(spark), rows(spark, [("s.csv", "1", None), ("s.csv", "9", None)]))
    by = {}
    for r in got.collect():
        by.setdefault(r["event_id"], set()).add(r["club_id"])
    assert by["in"] == {1, 9}
    assert by["ex"] == {2, 3}          # active regular stores 1, 2, 3 minus the file


def test_standard_lists_and_null_state(spark):
    def cd(name):
        return {"clubListCount": 1, "clubsPayload": [{"clubType": "Standard", "bigListName": name, "clubList": [],
                                                      "clubInclusion": True}]}
    ev = ready(spark, [("all", offer(base_payload(clubDetails=cd("ALL")))),
                       ("pr", offer(base_payload(clubDetails=cd("STANDARD CLUBS - PUERTO RICO ONLY")))),
                       ("us", offer(base_payload(clubDetails=cd("STANDARD CLUBS - US EXCLUDING PUERTO RICO"))))])
    by = {}
    for r in ST.resolve_sites(ev, directory(spark), rows(spark, [])).collect():
        by.setdefault(r["event_id"], set()).add(r["club_id"])
    assert by == {"all": {1, 2, 3}, "pr": {2}, "us": {1}}


def test_online_only_default_store(spark):
    ev = ready(spark, [("d2h", offer(base_payload(channels=["D2H"], clubDetails=...))),
                       ("both", offer(base_payload(channels=["D2H", "CLUB"], clubDetails=...)))])
    got = [(r["event_id"], r["club_id"]) for r in ST.resolve_sites(ev, directory(spark), rows(spark, [])).collect()]
    assert got == [("d2h", 6279)]
    cl = {r["event_id"]: r["club_list"] for r in ST.with_club_lists(ev, directory(spark), rows(spark, [])).collect()}
    assert cl == {"d2h": [6279], "both": None}


def test_store_sets_are_bitmaps_interned_by_content(spark):
    """Ids over several bitmaps, zero, negative and repeated ones; lists of one content share
    their set, whatever form they come in; a store in two payloads is twice in the list."""
    def cd(*payloads):
        return {"clubListCount": 1, "clubsPayload": [
            {"bigListName": "b", "clubList": [], "clubInclusion": True, **p} for p in payloads]}
    ids = [1, 7, 8, 9, 31, 32, 33, 32_767, 32_768, 32_769, 65_536, 65_537, 1_000_000, 0, -1, -32_768]
    files = [("s.csv", str(i), None) for i in ids * 2] + [("one.csv", "2", None), ("none.csv", "77", None)]
    ev = ready(spark, [
        ("file", offer(base_payload(clubDetails=cd({"clubType": "biglist", "clubBigListURL": "s.csv"})))),
        ("list", offer(base_payload(clubDetails=cd({"clubType": "list", "clubList": [str(i) for i in ids] + ["7"]})))),
        ("out", offer(base_payload(clubDetails=cd({"clubType": "biglist", "clubBigListURL": "one.csv", "clubInclusion": False})))),
        ("all", offer(base_payload(clubDetails=cd({"clubType": "Standard", "bigListName": "ALL"})))),
        ("less", offer(base_payload(clubDetails=cd({"clubType": "biglist", "clubBigListURL": "none.csv", "clubInclusion": False})))),
        ("two", offer(base_payload(clubDetails=cd({"clubType": "list", "clubList": ["3", "1"]}, {"clubType": "list", "clubList": ["1"]}))))])
    sets, stores = ST.event_sets(ev, directory(spark), rows(spark, files))
    set_of = {(r["event_id"], r["pos"]): r["set_id"] for r in sets.collect()}
    members = {}
    for r in stores.collect():
        members.setdefault(r["set_id"], []).append(r["club_id"])
    assert sorted(members[set_of["file", 0]]) == sorted(ids) and set_of["file", 0] == set_of["list", 0]
    assert sorted(members[set_of["out", 0]]) == [1, 3] and set_of["all", 0] == set_of["less", 0]
    lists = {r["event_id"]: r["club_list"] for r in ST.with_club_lists(ev, directory(spark), rows(spark, files)).collect()}
    assert lists["two"] == [1, 1, 3] and lists["out"] == [1, 3] and lists["file"] == sorted(ids)
    assert {(r["event_id"], r["club_id"]) for r in ST.complement_site_list(ev, directory(spark), rows(spark, files)).collect()} == {
        ("out", 1), ("out", 3), ("less", 1), ("less", 2), ("less", 3)}


def test_override_times_default_and_missing_details(spark):
    cd = {"clubListCount": 1, "clubsPayload": [{"clubType": "list", "bigListName": "x", "clubList": ["7"],
                                                "clubInclusion": True}],
          "clubOverride": [{"clubNumber": "7", "startDate": "2024-03-02", "startTime": "",
                            "endDate": "2024-03-03", "endTime": "abc", "timeZone": "EST"}]}
    ev = ready(spark, [("e", offer(base_payload(clubDetails=cd))), ("n", offer(base_payload(clubDetails=...)))])
    got = ST.site_overrides(ev).collect()
    assert len(got) == 1
    assert got[0]["start_datetime"] == datetime(2024, 3, 2, 0, 0, 0)
    assert got[0]["end_datetime"] == datetime(2024, 3, 3, 23, 59, 59)


def test_expiry_end_exactly_now_is_not_expired(spark):
    df = spark.createDataFrame([(1, datetime(2024, 3, 1, 12, 0, 0), "CST")],
                               "offer_id bigint, end_datetime timestamp_ntz, time_zone string")
    # 18:00:00.7 UTC is 12:00:00.7 in US/Central; cut to seconds it equals the end
    r = O.expired_offers(df, F.lit("2024-03-01 18:00:00.7").cast("timestamp")).first()
    assert r["is_expired"] is False
    r2 = O.expired_offers(df, F.lit("2024-03-01 18:00:01").cast("timestamp")).first()
    assert r2["is_expired"] is True


def test_source_conflict_and_latest_event_wins(spark):
    md = {"memberListCount": 1, "membersPayload": [{"memberType": "biglist", "memberList": [],
                                                     "memberBigListURL": "m.csv"}]}
    evs = [("e1", offer(base_payload(promotionNumber="101", status="LIVE"))),
           ("e2", offer(base_payload(promotionNumber="101", status="DISABLED"))),
           ("e3", offer(base_payload(promotionNumber="202", labels=["tio"], memberDetails=md)))]
    stored = spark.createDataFrame([(202, "TETRIS")], "offer_id bigint, offer_source string")
    stored = stored.select(*[F.col(c) if c in ("offer_id", "offer_source") else F.lit(None).cast(t).alias(c)
                             for c, t in [(f.name, f.dataType.simpleString()) for f in OFFERS.fields]])
    b = plan_offer_batch(ready(spark, evs), stored, empty(spark, OFFER_ITEMS), empty(spark, SITE_OVERRIDES),
                         directory(spark), rows(spark, []), rows(spark, []), catalogue(spark))
    offers = {r["offer_id"]: r for r in b.offers.collect()}
    assert offers[101]["status"] == "DISABLED"          # later event stored
    assert offers[202]["offer_source"] == "TETRIS"      # conflicting event changed nothing
    msgs = {r["event_id"]: r["comments"] for r in b.outcomes.collect()}
    assert msgs["e3"].startswith("Invalid update payload. Offer source TETRIS of offer 202")
    assert msgs["e2"] == "Offer 101 updated successfully."
    items = sorted((r["offer_id"], r["item_number"]) for r in b.offer_items.collect())
    assert items == [(101, 1001), (101, 1002)]


def test_missing_big_list_file_fails_the_event_and_changes_nothing(spark):
    idt = {"itemListCount": 1, "itemsPayload": [
        {"itemType": "ELIGIBLE_ITEMS", "itemListType": "biglist", "itemList": [], "itemBigListURL": "gone.csv",
         "refId": 1}]}
    evs = [("e1", offer(base_payload(promotionNumber="101"))),
           ("e2", offer(base_payload(promotionNumber="101", status="LIVE", itemDetails=idt)))]
    stored = empty(spark, OFFERS)
    available = spark.createDataFrame([("i.csv",)], "list_key string")
    b = plan_offer_batch(ready(spark, evs), stored, empty(spark, OFFER_ITEMS), empty(spark, SITE_OVERRIDES),
                         directory(spark), rows(spark, []), rows(spark, []), catalogue(spark),
                         available_lists=available)
    out = {r["event_id"]: (r["status"], r["comments"]) for r in b.outcomes.collect()}
    assert out["e2"] == ("FAILED", "blob: gone.csv could not be read")
    assert out["e1"] == ("PROCESSED", "Offer 101 updated successfully.")
    assert [r["status"] for r in b.offers.collect()] == ["PUBLISHED"]   # e1 stands


def faulty(spark, cases, store_file=(), item_file=()):
    evs = [(f"e{i}", offer(base_payload(promotionNumber=str(i), **c))) for i, c in enumerate(cases)]
    there = spark.createDataFrame([("s.csv",), ("i.csv",)], "list_key string")
    b = plan_offer_batch(ready(spark, evs), empty(spark, OFFERS), empty(spark, OFFER_ITEMS), empty(spark, SITE_OVERRIDES), directory(spark),
                         rows(spark, [("s.csv", v, None) for v in store_file]), rows(spark, [("i.csv", v, None) for v in item_file]),
                         catalogue(spark), available_lists=there)
    out = {r["event_id"]: (r["status"], r["comments"], r["failure_class"]) for r in b.outcomes.collect()}
    return [out[f"e{i}"] for i in range(len(cases))], sorted(r["offer_id"] for r in b.offers.collect())


def test_values_that_are_no_ids_fail_their_event(spark):
    store = lambda **p: {"clubListCount": 1, "clubsPayload": [{"clubType": "biglist", "bigListName": "b", "clubList": [],
                                                               "clubBigListURL": "s.csv", "clubInclusion": True, **p}]}
    item = lambda **p: {"itemListCount": 1, "itemsPayload": [{"itemType": "ELIGIBLE_ITEMS", "itemListType": "biglist",
                                                              "itemList": [], "itemBigListURL": "i.csv", "refId": 1, **p}]}
    cases = [dict(clubDetails=store()), dict(clubDetails=store(clubInclusion=False)),
             dict(clubDetails=store(clubType="list", clubList=["7", "8x"])), dict(itemDetails=item()),
             dict(itemDetails=item(itemListType="list", itemList=["1001", "A-2"])), dict(itemDetails=item(refId=9)), {}]
    out, stored = faulty(spark, cases, ["1", "13x"], ["1001", None])
    said = lambda what: ("FAILED", f"{what} holds a value that is no whole number", "Error")
    assert out[:5] == [said("s.csv"), said("s.csv"), said("clubList"), said("i.csv"), said("itemList")]
    assert [o[0] for o in out[5:]] == ["PROCESSED"] * 2 and stored == [5, 6]  # a payload no award refers to is not read
    out, stored = faulty(spark, cases[:2], ["1", " 13 "])
    assert [o[0] for o in out] == ["PROCESSED"] * 2 and stored == [0, 1]


def test_null_store_parts_fail_and_absent_ones_take_the_online_store(spark):
    d2h = {"channels": ["D2H"]}
    cases = [{**d2h, "clubDetails": None}, {**d2h, "clubDetails": {"clubListCount": 1, "clubsPayload": None}},
             {**d2h, "clubDetails": {"clubListCount": 1}}, {**d2h, "clubDetails": ...}]
    out, stored = faulty(spark, cases)
    assert [o[:2] for o in out[:2]] == [("FAILED", "payload.clubDetails is null"), ("FAILED", "payload.clubDetails.clubsPayload is null")]
    assert stored == [2, 3]


def test_list_files_lists_non_empty_files(spark, tmp_path):
    from promoflow.sources.biglists import list_files
    (tmp_path / "items").mkdir()
    (tmp_path / "items" / "a.csv").write_text("1\n")
    (tmp_path / "items" / "empty.csv").write_text("")
    got = sorted(r[0] for r in list_files(spark, str(tmp_path)).collect())
    assert got == ["items/a.csv"]          # zero-length files are skipped by file scans


def test_item_and_store_files_are_read_by_source_and_header(spark, tmp_path):
    """Ranking offers read item files by the name of their column, the others one unnamed
    column; a file without the name fails ranking events only; one file serves both sources."""
    from promoflow.settings import ITEM_COLUMN
    from promoflow.sources.biglists import list_manifest, read_list_lines
    for name, text in {"i/ranked.csv": "Propensity,ItemNumber\n0.5,2001\n0.1,2002\n", "i/plain.csv": "2003\n2004\n", "s/a.csv": "1\n9\n"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    lines = read_list_lines(spark, str(tmp_path))
    md = {"memberListCount": 1, "membersPayload": [{"memberType": "biglist", "memberList": [], "memberBigListURL": "m.csv"}]}
    item = lambda f: {"itemListCount": 1, "itemsPayload": [{"itemType": "ELIGIBLE_ITEMS", "itemListType": "biglist", "itemList": [],
                                                            "itemBigListURL": f, "refId": 1}]}
    store = {"clubListCount": 1, "clubsPayload": [{"clubType": "biglist", "bigListName": "b", "clubList": [], "clubBigListURL": "s/a.csv",
                                                   "clubInclusion": True}]}
    tetris = {"labels": ["tetris"], "memberDetails": md, "clubDetails": store}
    evs = [("e0", offer(base_payload(promotionNumber="10", itemDetails=item("i/ranked.csv"), **tetris))),
           ("e1", offer(base_payload(promotionNumber="11", itemDetails=item("i/plain.csv"), **tetris))),
           ("e2", offer(base_payload(promotionNumber="12", itemDetails=item("i/plain.csv")))),
           ("e3", offer(base_payload(promotionNumber="13", itemDetails=item("i/ranked.csv"))))]
    b = plan_offer_batch(ready(spark, evs), empty(spark, OFFERS), empty(spark, OFFER_ITEMS), empty(spark, SITE_OVERRIDES), directory(spark),
                         lines.filter("list_key like 's/%'"), lines.filter("list_key like 'i/%'"), catalogue(spark),
                         available_lists=list_manifest(lines, ITEM_COLUMN))
    out = {r["event_id"]: (r["status"], r["failure_class"]) for r in b.outcomes.collect()}
    assert out == {"e0": ("PROCESSED", None), "e1": ("FAILED", "BlobReadError"), "e2": ("PROCESSED", None), "e3": ("FAILED", "Error")}
    assert sorted((r["offer_id"], r["item_number"]) for r in b.offer_items.collect()) == [(10, 2001), (10, 2002), (12, 2003), (12, 2004)]
    assert {r["offer_id"]: r["club_list"] for r in b.offers.collect()}[10] == [1, 9]
