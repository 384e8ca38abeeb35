"""Column expressions for the job's filters, labels and flags.

All are built-in Spark expressions (whole-stage codegen, no Python per row).
Oracle semantics kept where they differ from Spark: ``''`` is NULL, ``nvl``
is ``coalesce``, ``decode`` compares NULL-safely, CASE without ELSE is NULL.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules as R
from .dates import day_start, plus_days, ts_lit


def any_of(conds) -> Column:
    conds = list(conds)
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def null_string() -> Column:
    """Oracle ``''``: a typed NULL string."""
    return F.lit(None).cast("string")


# F8 rolling-window predicates ------------------------------------------------
def since(c: Column, bound) -> Column:
    return c >= ts_lit(bound)


# F9 excluded days --------------------------------------------------------------
def not_on_days(c: Column, days) -> Column:
    """``trunc(c) != d`` for every listed day (NULL c is dropped)."""
    if not days:
        return c.isNotNull()
    return ~F.to_date(c).isin([dt.date.fromisoformat(d) for d in days])


# F10 data gap ------------------------------------------------------------------
def outside(c: Column, start, end) -> Column:
    return (c < ts_lit(start)) | (c >= ts_lit(end))


def inside(c: Column, start, end) -> Column:
    return (c >= ts_lit(start)) & (c < ts_lit(end))


# F11 qualified call -----------------------------------------------------------
def qualified_call(durations: Column, off_by: Column) -> Column:
    return ((durations >= R.MIN_CALL_SECONDS) | off_by.isin(*R.QUALIFYING_HANGUPS)) & (durations > 0)


# F12 dated call-category rule ---------------------------------------------------
def counted_call(ts: Column, call_type: Column, custom_data: Column, list_name: Column,
                 rules: R.Rules) -> Column:
    start, switch = ts_lit(rules.call_rule_start), ts_lit(rules.call_rule_switch)
    inbound = call_type == R.INBOUND
    early = ts.between(start, switch) & (inbound | any_of(custom_data.like(p) for p in R.EARLY_CALL_PATTERNS))
    late = (ts >= switch) & (inbound | list_name.like(R.LATE_CALL_LIST_PATTERN))
    return early | late


# F13 / F14 effective disposition ---------------------------------------------------
def effective_disposition(result: Column, code: Column) -> Column:
    """``decode(result, 'none', code, result)``: NULL result stays NULL."""
    return F.when(result == R.NONE_DISPOSITION, code).otherwise(result)


def signed_disposition(result: Column, code: Column) -> Column:
    """``lower(nvl(code, result))`` (the code takes precedence here)."""
    return F.lower(F.coalesce(code, result))


# F15 null-safe inequality ---------------------------------------------------------
def ne_or_null(c: Column, value: str, filler: str = R.NULL_LIST_TYPE) -> Column:
    return F.coalesce(c, F.lit(filler)) != value


# F16 sentinel dates --------------------------------------------------------------
def null_if_sentinel(c: Column) -> Column:
    return F.when(c == ts_lit(R.SENTINEL_DATE), F.lit(None)).otherwise(c)


def sentinel_if_null(c: Column) -> Column:
    return F.coalesce(c, ts_lit(R.SENTINEL_DATE))


# F17 loan product mapping -----------------------------------------------------------
def map_loan_product(code: Column) -> Column:
    expr = None
    for pattern, product in R.LOAN_PRODUCT_MAP:
        expr = (F.when(code.like(pattern), product) if expr is None
                else expr.when(code.like(pattern), product))
    return expr


# F18 product type of an active contract ----------------------------------------------
def card_product_type(prod_gr: Column) -> Column:
    return (F.when(prod_gr == R.CARD_PRODUCT, R.CARD_PRODUCT)
            .when(prod_gr.like("%VC%"), R.VIRTUAL_CARD_TYPE)
            .otherwise(R.OTHER_PRODUCT))


def bnpl_product_type(prod_gr: Column) -> Column:
    return F.when(prod_gr.like(R.BNPL_CONTRACT_PATTERN), R.BNPL_PRODUCT).otherwise(R.OTHER_PRODUCT)


# F19 merchant whitelist --------------------------------------------------------------
def whitelisted_merchant(merchant: Column) -> Column:
    m = F.upper(merchant)
    conds = []
    for p in R.MERCHANT_PATTERNS:
        cond = m.like(p)
        if p in R.MERCHANT_NOT_LIKE:
            cond = cond & ~m.like(R.MERCHANT_NOT_LIKE[p])
        if p in R.MERCHANT_NOT_EQUAL:
            cond = cond & (m != R.MERCHANT_NOT_EQUAL[p])
        conds.append(cond)
    return any_of(conds)


def counted_usage_time(ts: Column, merchant: Column, cutover) -> Column:
    """The transaction time when it counts as usage, else NULL.

    Before the cut-over every transaction counts; from it on only whitelisted
    merchants do.
    """
    cut = ts_lit(cutover)
    return F.when(ts < cut, ts).when((ts >= cut) & whitelisted_merchant(merchant), ts)


# F20 / F21 usage flags ----------------------------------------------------------------
def usage_flag(promo_product: Column, start: Column, amount: Column, count: Column,
               rules: R.Rules) -> Column:
    promo = promo_product & start.between(ts_lit(rules.promo_start), ts_lit(rules.promo_end)) \
        & (amount >= rules.promo_amount)
    regular = (amount >= rules.usage_amount) | \
        ((start >= ts_lit(rules.usage_cutover)) & (count >= rules.usage_count))
    return F.when(promo, 1).when(regular, 1).cast("int")


def bnpl_usage_flag(amount: Column, count: Column, rules: R.Rules) -> Column:
    return F.when(amount >= rules.usage_amount, 1).when(count >= rules.usage_count, 1).cast("int")


# F22 call labels ------------------------------------------------------------------------
def first_call_label(call_list: Column) -> Column:
    return F.when(call_list == R.FIRST_CALL_LIST, R.FIRST_CALL)


def callback_label(comm_id: Column, call_list: Column) -> Column:
    return (F.when(comm_id.isNotNull() & (call_list == R.RTDM_CALLBACK_LIST), R.CALLBACK_RTDM)
            .when(comm_id.isNull(), R.CALLBACK_PERSONAL))


# F23 backfill labels ----------------------------------------------------------------------
def backfill_record_type(call_back_type: Column) -> Column:
    expr = None
    for value, label in R.BACKFILL_RECORD_TYPES:
        expr = F.when(call_back_type == value, label) if expr is None else expr.when(call_back_type == value, label)
    return expr.otherwise(R.BACKFILL_DEFAULT_RECORD_TYPE)


def backfill_call_list(call_back_list: Column) -> Column:
    return F.when(call_back_list.isNull(), R.FIRST_CALL_LIST).otherwise(call_back_list)


# F26 campaign-list filters ------------------------------------------------------------------
def listed_task(load_type: Column, list_type: Column, list_name: Column, patterns) -> Column:
    return ((load_type == R.TASK_LOAD_TYPE)
            & any_of(list_name.like(p) for p in patterns)
            & ne_or_null(list_type, R.EXCLUDED_LIST_TYPE)
            & (list_name != R.EXCLUDED_LIST_NAME))


# F30 outbound push calls ---------------------------------------------------------------------
def outbound_push_call(interaction_type: Column, disposition: Column, username: Column,
                       channel: Column, call_type: Column) -> Column:
    return ((interaction_type != R.SKIPPED_INTERACTION_TYPE) & disposition.isNotNull()
            & username.isNotNull() & (channel == R.PUSH_CHANNEL) & (call_type == R.OUTBOUND))


# X15 id prefix ---------------------------------------------------------------------------------
def id_prefix(text: Column) -> Column:
    """``substr(x, 0, instr(x, '.') - 1)``: text before the first dot, NULL when
    there is no dot or nothing before it (Oracle's empty string is NULL)."""
    pos = F.instr(text, ".")
    return F.when(pos > 1, F.substring(text, F.lit(1), pos - 1))


# X18 Oracle concatenation (NULL as empty) -------------------------------------------------------
def oracle_concat(*parts: Column) -> Column:
    return F.concat_ws("", *parts)


def next_days(c: Column, n: int) -> Column:
    """``trunc(c) + n``."""
    return plus_days(day_start(c), n)
