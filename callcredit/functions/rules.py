"""Business rules and the fixed values they use.

Every value under "FIXED VALUES" must equal the source job's value for the
results to agree; they are listed plainly and in the source's order.
``Rules`` bundles the dated parameters so tests can shift them into the
range of the test data while production keeps the defaults.
"""

from __future__ import annotations

import dataclasses
import datetime as dt

# ============================== FIXED VALUES ==============================
# Days excluded from the connected-call ranking.
EXCLUDED_DAYS = (
    "2021-01-01", "2021-02-09", "2021-02-10", "2021-02-11", "2021-02-12",
    "2021-02-13", "2021-02-14", "2021-02-15", "2021-02-16", "2021-02-17",
    "2021-02-18", "2021-04-30", "2021-05-01", "2022-01-29", "2022-01-30",
    "2022-02-06",
)
# Agent channels counted for connected calls, and for usage pushes.
CONNECT_CHANNELS = ("CLX", "ACLX", "CCX", "CCXP")
USAGE_CHANNELS = ("CCX", "CCXP")
# Custom-data patterns of the first call-rule period.
EARLY_CALL_PATTERNS = ("%ProAct%", "%TLS%", "%Pred%")
LATE_CALL_LIST_PATTERN = "%SAS%"
INBOUND = "Inbound"
OUTBOUND = "Outbound"
QUALIFYING_HANGUPS = ("Agent", "Client")
MIN_CALL_SECONDS = 15

# Dispositions.
NONE_DISPOSITION = "none"
SENDING_LEAD = "Sending Lead"
APPOINTMENT = "Schedule_Appointment_with_SA"
SIGN_AGREED = ("Push Sign - Client Agrees", "Sign Agree", "Client agrees")
USE_AGREED = ("Push Use - Client Agrees", "Use Agree", "Client agrees")
SIGN_SUCCESSFUL = "sign successful"

# Loan product mapping, first match wins.
LOAN_PRODUCT_MAP = (
    ("%CLXMCB%", "CLXCB"),
    ("%CLW%", "CLW"),
    ("%CLXSA%", "CLW"),
    ("%CLX%", "CLX"),
)
APPOINTMENT_PRODUCTS = ("CLWND", "CLWAD")
LEAD_PRODUCTS = ("CLX", "CCX")
CARD_PRODUCT = "CCX"
APPOINTMENT_PRODUCT = "CLW"

# Campaign task lists.
TASK_LOAD_TYPE = "TLS"
USAGE_LIST_PATTERNS = ("%USAGE%PUSH", "%ACTIVATE%PUSH")
BNPL_LIST_PATTERN = "%TLS_HPL_USAGE%"
EXCLUDED_LIST_TYPE = "GAMI_TRX_LESS500K"
EXCLUDED_LIST_NAME = "ATM USAGE PUSH"
NULL_LIST_TYPE = "xxx"

# Outbound call lists and call labels.
FIRST_CALL_LIST = "SAS_TLS_OUTBOUND_CCX_USAGE_PUSH"
RTDM_CALLBACK_LIST = "SAS_RTDM_TLS_OUTBOUND_CCX_USAGE_PUSH_CALLBACK"
PUSH_CHANNEL = "CCXP"
SKIPPED_INTERACTION_TYPE = 3
FIRST_CALL = "1st call"
CALLBACK_RTDM = "Call back RTDM"
CALLBACK_PERSONAL = "Call back Personal"
BACKFILL_RECORD_TYPES = (("campaign", "Campaign Callback"),
                         ("personal", "Personal Callback"))
BACKFILL_DEFAULT_RECORD_TYPE = "General"

# Contracts.
SENTINEL_DATE = "3000-01-01"
CARD_CONTRACT_PATTERN = "CC%"
BNPL_CONTRACT_PATTERN = "BNPL%"
CANCELLED = "Cancelled"
LIVE_STATUSES = ("Active", "Signed", "Finished")
SIGN_TEAMS = ("QS_Internal", "External Service")

# Card transactions.
WITHDRAWAL = "WITHDRAWAL"
BNPL_TXN_TYPE = "1711699"
BNPL_REJECTED_STATUS = "n"
# Merchants that count as a usage transaction from the cut-over on
# (matched on the upper-cased acceptor name).
MERCHANT_PATTERNS = (
    "%FOODY%", "%SHOPEE%", "%LAZADA%", "%TIKI%", "%SENDO%", "%GRAB%",
    "%BE GROUP%", "%BAE%MIN%", "%ZALOPAY%", "%MOMO%", "%GOOGLE%",
    "%APPLE.COM/BILL%", "%NETFLIX%", "%TRAVELOKA%", "%AGODA%", "%BOOKING%COM%",
)
# Carve-outs: pattern -> condition that must also hold.
MERCHANT_NOT_LIKE = {"%SENDO%": "%SENDONGA%"}
MERCHANT_NOT_EQUAL = {"%BE GROUP%": "CNBENTRECTYKAYGROUP"}

# Bonus outputs.
BEFORE_FIRST_PUSH = "BOD1_BF_1st_push"
NO_PUSH = "BOD1"
CAMPAIGN_ID_PREFIX = "CCX_USAGE_PUSH_"
ROSTER_PRODUCT = "CCX"
ROSTER_TEAM_PATTERN = "Ex%"
BNPL_PRODUCT = "BNPL"
OTHER_PRODUCT = "OTHER"
VIRTUAL_CARD_TYPE = "VCC"
# ==========================================================================


def _d(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


@dataclasses.dataclass(frozen=True)
class Rules:
    """Dated parameters of the job (defaults are the production values)."""

    excluded_days: tuple[str, ...] = EXCLUDED_DAYS
    call_rule_start: dt.datetime = _d("2019-10-01")      # first call-rule period start
    call_rule_switch: dt.datetime = _d("2019-10-09")     # second period start
    gap_start: dt.datetime = _d("2023-03-16")            # lost call data, re-sent manually
    gap_end: dt.datetime = _d("2023-03-21")
    usage_lookback_days: int = 7
    usage_cutover: dt.datetime = _d("2022-10-01")        # merchant and count rule
    promo_start: dt.datetime = _d("2021-12-01")
    promo_end: dt.datetime = _d("2022-02-28")
    promo_amount: int = 200000
    usage_amount: int = 500000
    usage_count: int = 3
    earliest_sign: dt.datetime = _d("2020-08-01")
    card_sign_after: dt.datetime = _d("2022-03-31")
    keep_months: tuple[str, ...] = ("2019-09",)          # never replaced in M1
    attribution_days: int = 7                            # v_num of the lead and sign marts
    lead_lookback_days: int = 75
    callback_days: int = 4
    campaign_days: int = 8
    bnpl_window_days: int = 8
    task_comm_days: int = 20
    task_created_days: int = 30
    appointment_days: int = 8
    signup_band_days: int = 7
    signup_extra_days: int = 24
    no_push_bonus_days: int = 45

    def replace(self, **kw) -> "Rules":
        return dataclasses.replace(self, **kw)


DEFAULT_RULES = Rules()

# Shifted parameters that move the dated rules into the range of the test data.
TEST_RULES = Rules(
    excluded_days=("2024-01-06", "2024-01-07"),
    call_rule_start=_d("2024-01-05"),
    call_rule_switch=_d("2024-01-12"),
    usage_lookback_days=30,
    promo_start=_d("2024-01-10"),
    promo_end=_d("2024-01-20"),
)
TEST_AS_OF = _d("2024-01-31 12:00:00")

# The merchant rule's second test run moves the cut-over into the test data.
TEST_CUTOVER = _d("2024-01-20")
TEST_BACKFILL_RULES = TEST_RULES.replace(gap_start=_d("2024-01-16"), gap_end=_d("2024-01-21"))
TEST_CUTOVER_RULES = TEST_RULES.replace(usage_cutover=TEST_CUTOVER)
