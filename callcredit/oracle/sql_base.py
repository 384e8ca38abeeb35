"""Building blocks of the DuckDB oracle queries.

Dates are computed in SQL, and rules are written once here and used by name, so
nothing of the library's own logic is shared with what it checks.
"""

from __future__ import annotations

import datetime as dt

NEVER = "TIMESTAMP '3000-01-01'"

# ============================== FIXED VALUES ==============================
AGREED_SIGN = "('Push Sign - Client Agrees', 'Sign Agree', 'Client agrees')"
AGREED_USE = "('Push Use - Client Agrees', 'Use Agree', 'Client agrees')"
FIRST_LIST = "'SAS_TLS_OUTBOUND_CCX_USAGE_PUSH'"
CALLBACK_LIST = "'SAS_RTDM_TLS_OUTBOUND_CCX_USAGE_PUSH_CALLBACK'"
# Merchants that count, and what a name like the pattern may not be like.
MERCHANTS = """merchants(pattern, unless) AS (VALUES
  ('%FOODY%', ''), ('%SHOPEE%', ''), ('%LAZADA%', ''), ('%TIKI%', ''), ('%SENDO%', '%SENDONGA%'), ('%GRAB%', ''),
  ('%BE GROUP%', 'CNBENTRECTYKAYGROUP'), ('%BAE%MIN%', ''), ('%ZALOPAY%', ''), ('%MOMO%', ''), ('%GOOGLE%', ''),
  ('%APPLE.COM/BILL%', ''), ('%NETFLIX%', ''), ('%TRAVELOKA%', ''), ('%AGODA%', ''), ('%BOOKING%COM%', ''))"""
# Loan product codes, the first pattern that fits names the product.
PRODUCTS = """products(place, pattern, product) AS (VALUES
  (1, '%CLXMCB%', 'CLXCB'), (2, '%CLW%', 'CLW'), (3, '%CLXSA%', 'CLW'), (4, '%CLX%', 'CLX'))"""
# ==========================================================================

# What a call came to, given a row of call_disp.
OUTCOME = "if(response_result_2 = 'none', code_disposition, response_result_2)"


def listed(merchant: str) -> str:
    """Whether a merchant counts, over the ``merchants`` relation."""
    return f"EXISTS (FROM merchants WHERE upper({merchant}) LIKE pattern AND upper({merchant}) NOT LIKE unless)"


def ts(value) -> str:
    return f"TIMESTAMP '{value.isoformat(sep=' ') if isinstance(value, dt.datetime) else value}'"


def day(value, back: int = 0) -> str:
    """Midnight of the day ``back`` days before the day of ``value``."""
    return f"(date_trunc('day', {ts(value)}) - INTERVAL {back} DAY)"


def month(value, back: int = 0, days: int = 0) -> str:
    """Start of the month ``back`` months before that of ``value``, less ``days``."""
    return f"(date_trunc('month', {ts(value)}) - INTERVAL {back} MONTH - INTERVAL {days} DAY)"


def month_name(value, back: int = 0) -> str:
    return f"strftime({month(value, back)}, '%Y-%m')"


def latest(keys: str, by: str, *ties: str) -> str:
    """Keeps the last row by ``by`` of each key (null counts as last), then by the ties."""
    order = ", ".join([f"{by} DESC NULLS FIRST", *[f"{t} DESC NULLS LAST" for t in ties]])
    return f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"


def ascending(*columns: str) -> str:
    return ", ".join(f"{c} ASC NULLS LAST" for c in columns)
