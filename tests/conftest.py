import json
import os
import sys
import tempfile
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from promoflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", app="promoflow-tests", shuffle_partitions=8)
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="promoflow-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()


T0 = datetime(2024, 3, 1, 10, 0, 0)


def base_payload(**over):
    """A valid default-source offer event payload; keyword arguments replace fields
    (a value of ``...`` removes the key)."""
    p = {
        "eventTimeStamp": "2024-03-01T10:00:00.123Z", "status": "PUBLISHED", "promotionNumber": "101",
        "startDate": "2024-03-01", "endDate": "2024-03-31", "startTime": "00:00:00", "endTime": "23:59:59",
        "timeZone": "CST", "channels": ["CLUB"], "labels": [], "membershipType": ["PLUS"],
        "awardList": [{"awardType": "DISCOUNT_ITEM_PRICE", "value": "5", "discountMethod": "DOLLAR_OFF",
                       "itemRefId": ["1"]}],
        "itemDetails": {"itemListCount": 1, "itemsPayload": [
            {"itemType": "DISCOUNTED_ITEMS", "itemListType": "list", "itemList": ["1001", "1002"], "refId": 1}]},
        "clubDetails": {"clubListCount": 1, "clubsPayload": [
            {"clubType": "list", "bigListName": "x", "clubList": ["7", "8"], "clubInclusion": True}],
            "clubOverride": []},
    }
    for k, v in over.items():
        if v is ...:
            p.pop(k, None)
        else:
            p[k] = v
    return p


def raw_df(spark, items):
    """items: list of (event_id, payload-dict or raw text); arrival in list order."""
    rows = []
    for i, (eid, body) in enumerate(items):
        text = body if isinstance(body, str) else json.dumps(body)
        rows.append((eid, T0 + timedelta(seconds=i), text))
    return spark.createDataFrame(rows, "event_id string, arrival timestamp, raw string")


def offer(payload):
    return {"payload": payload}
