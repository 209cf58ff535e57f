"""Constants and tunables of the engine.

Two kinds of values live here:

* Fixed values: literals the behaviour being reproduced spells out (award type,
  source labels, excluded category, online store, zone default, list names, card and
  store predicates, the time-of-day pattern, messages).  They are listed plainly below.
* Tunables with neutral defaults: values the original code reads from a constants module
  whose contents are not known (status names, discount methods, item types, the label
  block list).  Defaults are the constant *names*; override them through ``EngineConfig``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the behaviour being reproduced)
# ---------------------------------------------------------------------------
AWARD_TYPE_KEPT = "DISCOUNT_ITEM_PRICE"

LABEL_TETRIS = "tetris"
LABEL_TIO = "tio"

# Source names as stored on offers; audit and gates use the lower-case label form.
SOURCE_TETRIS = "TETRIS"
SOURCE_TIO = "TIO"
SOURCE_BROADREACH = "BROADREACH"

EXCLUDED_CATEGORY = 50
ONLINE_ONLY_CHANNELS = ("D2H",)
ONLINE_SITE_ID = 6279
DEFAULT_TIME_ZONE = "CST"
DEFAULT_START_TIME = "00:00:00"
DEFAULT_END_TIME = "23:59:59"
TIME_OF_DAY_PATTERN = r"^(?:(?:([01]?\d|2[0-3]):)?([0-5]?\d):)?([0-5]?\d)$"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

STANDARD_LIST_ALL = "ALL"
STANDARD_LIST_PR_ONLY = "STANDARD CLUBS - PUERTO RICO ONLY"
STANDARD_LIST_US_EXCLUDING_PR = "STANDARD CLUBS - US EXCLUDING PUERTO RICO"
PUERTO_RICO_STATE = "PR"

CLUB_TYPES = ("list", "biglist", "Standard")
ITEM_LIST_TYPES = ("list", "biglist")
MEMBER_TYPES = ("list", "biglist")

CARD_CURRENT_FLAG = "Y"
CARD_STATUSES = ("ACTIVE", "PICKUP", "EXPIRED")
CARD_TYPE = "MEMBERSHIPACCOUNT"

# Columns of item and member files that are read by name.
ITEM_COLUMN = "ItemNumber"
CARD_COLUMN = "MembershipNumber"
PROPENSITY_COLUMN = "Propensity"
SITE_TYPE_REGULAR = "REGULAR"

ZONE_REGIONS = {
    "CST": "US/Central", "CDT": "US/Central",
    "EST": "US/Eastern", "EDT": "US/Eastern",
    "MST": "US/Mountain", "MDT": "US/Mountain",
    "PST": "US/Pacific", "PDT": "US/Pacific",
}

SINK_BATCH_SIZE = 25000

REASON_MISSING_MEMBERS = "Personalized offer missing memberDetails"
REASON_MEMBER_LIST_COUNT = "Received an offer with memberListCount not equal to 1, skipping this offer"
REASON_BLOCKED_LABEL = "Received an offer with at least one unwanted label, skipping this offer"
REASON_NO_AWARD = "Received an offer without award of type DISCOUNT_ITEM_PRICE, skipping this offer"
REASON_NO_OFFERS = "The offers to update do not exist"
SOURCE_CONFLICT_FORMAT = "Invalid update payload. Offer source %s of offer %s cannot be updated once created."
OFFER_DONE_FORMAT = "Offer %s updated successfully."
LIST_DONE_FORMAT = "Memeberlist updated successfully of offer_ids : [%s]. Ignored processing [%s]."

# Messages of our own for events that cannot be applied.
BAD_VALUE_FORMAT = "%s holds a value that is no whole number"
NULL_PART_FORMAT = "%s is null"

# Failure classes of the failure report.
CLASS_PAYLOAD = "PayloadError"
CLASS_BLOB = "BlobReadError"
CLASS_OTHER = "Error"

# Label constant names of the block list (39 entries), in their original order.
BLOCKED_LABEL_NAMES = (
    "JOIN", "PAID_TRIAL", "FREE_TRIAL", "VOUCHER", "SPONSORED", "JOIN_NO_ADDONS",
    "JOIN_NO_UPGRADE", "RENEW", "UPGRADE", "NILPICK", "FREEOSK", "CREDIT", "SIF", "RAF",
    "PURPOSE_MEMBERSHIP", "JOIN_REJOINERS_OK", "JOIN_NO_BUSINESS", "MILITARY", "NURSE",
    "FIRST_RESPONDER", "TEACHER", "GOVERNMENT", "MEDICAL_PROVIDER", "STUDENT", "GOVASSIST",
    "SENIOR", "HOSPITAL", "ALUM", "ACQ_AFFILIATE", "ACQ_AFFINITY_AUDIENCES",
    "ACQ_BIG_PROMOTION", "ACQ_GENERAL_ACQUISITION", "ACQ_PAID_SEARCH_DISPLAY",
    "ACQ_PARTNERSHIP", "ACQ_SOCIAL_NON_DISCOUNTED", "ACQ_EBG", "ACQ_GROUPON", "ACQ_VALPACK",
    "ACQ_SIF",
)


# ---------------------------------------------------------------------------
# Tunables whose real values are configuration
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class EngineConfig:
    status_received: str = "RECEIVED"
    status_skipped: str = "SKIPPED"
    status_failed: str = "FAILED"
    status_processing: str = "PROCESSING"
    status_processed: str = "PROCESSED"

    offer_statuses: tuple = ("PUBLISHED", "DISABLED", "LIVE")
    item_discount_award: str = AWARD_TYPE_KEPT
    discount_methods: tuple = ("DOLLAR_OFF", "PERCENTAGE_OFF")

    # payload item type -> stored item type; other types are dropped
    discounted_items: str = "DISCOUNTED_ITEMS"
    eligible_items: str = "ELIGIBLE_ITEMS"
    discounted_item: str = "DISCOUNTED_ITEM"
    eligible_item: str = "ELIGIBLE_ITEM"

    blocked_labels: tuple = field(default=BLOCKED_LABEL_NAMES)
    excluded_category: int = EXCLUDED_CATEGORY
    online_site_id: int = ONLINE_SITE_ID
    default_time_zone: str = DEFAULT_TIME_ZONE
    sink_batch_size: int = SINK_BATCH_SIZE


DEFAULT_CONFIG = EngineConfig()
