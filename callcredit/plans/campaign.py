"""Campaign bonus list (card rows from M11, BNPL rows from M15)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import rules as R
from ..functions.dates import month_text, months_back_start, ts_lit
from ..operators.sets import union_all
from ..operators.windows import sequence_ids

OUTPUT = ["cuid", "camp_id", "camp_start_date", "push_user", "push_date", "bonus_amt_trans", "contract_code",
          "inserted_date", "bonus_mth", "product_gr", "num_transaction"]


def _numbered(df: DataFrame, count_col: str, user: F.Column, product: str, as_of) -> DataFrame:
    order = [F.col(c).asc_nulls_last() for c in
             ("date_campaign_start", "time_of_call_start", "call_id", "contract_code", "cuid", "username",
              "total_amount", count_col)]
    seq = sequence_ids(df, ["bonus_mth"], order, "_seq")
    camp_id = P.oracle_concat(F.lit(R.CAMPAIGN_ID_PREFIX), F.regexp_replace("bonus_mth", "-", "_"),
                              F.lit("_"), F.col("_seq").cast("string"))
    return seq.select(F.col("cuid").cast("string").alias("cuid"), camp_id.alias("camp_id"),
                      F.col("date_campaign_start").alias("camp_start_date"), user.alias("push_user"),
                      F.col("time_of_call_start").alias("push_date"),
                      F.col("total_amount").alias("bonus_amt_trans"), "contract_code",
                      ts_lit(as_of).alias("inserted_date"), "bonus_mth", F.lit(product).alias("product_gr"),
                      F.col(count_col).alias("num_transaction"))


def _payable(as_of) -> F.Column:
    since = month_text(months_back_start(as_of, 2))
    return (F.col("bonus_mth") >= since) & F.col("username").isNotNull() & (F.col("flag_usage") == 1)


def card_bonus(usage_bonus_df: DataFrame, as_of) -> DataFrame:
    """Flagged card rows of the last two months with per-month campaign ids."""
    return _numbered(usage_bonus_df.where(_payable(as_of)), "num_transaction", F.col("username"), R.CARD_PRODUCT, as_of)


def bnpl_bonus(bnpl_bonus_df: DataFrame, as_of) -> DataFrame:
    """Flagged BNPL rows, in the same layout."""
    return _numbered(bnpl_bonus_df.where(_payable(as_of)), "total_transaction", F.lower("username"), R.BNPL_PRODUCT, as_of)


def campaign_bonus(usage_bonus_df: DataFrame, bnpl_bonus_df: DataFrame, as_of,
                   rules: R.Rules = R.DEFAULT_RULES) -> DataFrame:
    """Card and BNPL rows together.

    They are numbered separately (both restart at 1 per month and share the id
    prefix, as in the source); the key is (product_gr, camp_id).
    """
    return union_all(card_bonus(usage_bonus_df, as_of), bnpl_bonus(bnpl_bonus_df, as_of))
