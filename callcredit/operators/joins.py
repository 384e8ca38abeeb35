"""Join operators of the job.

Every join of the job has an equality key; time ranges are residual
conditions. Three shapes are provided:

* ``validity_join``: events against an effective-dated dimension (agents).
  The dimension is small; the planner broadcasts it when its measured size is
  under the broadcast threshold, otherwise a sort-merge join is used.
* ``band_join``: equality key plus a time band. When the band has a fixed
  width the range side is expanded into day buckets and the day becomes part
  of the join key, so a hot client is split by day instead of pairing all of
  its rows in one task. Open-ended bands use the plain key (AQE splits skewed
  partitions).
* ``contract_accounts`` / ``card_transactions``: contract -> card account ->
  transaction chain, filtered on the transaction side before the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import plus_days, ts_lit

BUCKET = "_day_bucket"


def within_validity(ts: Column, valid_from: Column, valid_to: Column, as_of) -> Column:
    """``ts >= from and ts < nvl(to, as_of) + 1 day`` (validity end inclusive by day)."""
    return (ts >= valid_from) & (ts < plus_days(F.coalesce(valid_to, ts_lit(as_of)), 1))


def validity_join(events: DataFrame, dim: DataFrame, key_cond: Column, ts: Column,
                  valid_from: Column, valid_to: Column, as_of, how: str = "inner") -> DataFrame:
    """Point-in-validity join. Overlapping validity rows multiply matches
    exactly as in the source job."""
    return events.join(dim, key_cond & within_validity(ts, valid_from, valid_to, as_of), how)


def day_buckets(low: Column, high: Column) -> Column:
    """Array of the calendar days from ``low`` to ``high`` (NULL when empty)."""
    lo, hi = F.to_date(low), F.to_date(high)
    return F.when(lo <= hi, F.sequence(lo, hi))


def band_join(left: DataFrame, right: DataFrame, cond: Column, how: str = "inner", *,
              point: Column | None = None, low: Column | None = None,
              high: Column | None = None, point_side: str = "left") -> DataFrame:
    """Equality-plus-band join.

    ``cond`` is the exact condition (keys and band). With ``point``/``low``/
    ``high`` the band is also bucketed by day: the range side (``low``..``high``
    are its columns) is exploded into the days it covers, the point side gets
    the day of ``point`` and the day is added to the equality key. The caller
    passes bounds whose width is fixed, so the expansion is a small constant.
    Each point lies in one day, so an outer join preserving the point side
    stays exact.
    """
    if point is None:
        return left.join(right, cond, how)
    if point_side == "left":
        pts = left.withColumn(BUCKET + "_p", F.to_date(point))
        rng = right.withColumn(BUCKET + "_r", F.explode(day_buckets(low, high)))
        out = pts.join(rng, cond & (F.col(BUCKET + "_p") == F.col(BUCKET + "_r")), how)
    else:
        if how not in ("inner",):
            raise ValueError("bucketed band join preserves only the point side")
        rng = left.withColumn(BUCKET + "_r", F.explode(day_buckets(low, high)))
        pts = right.withColumn(BUCKET + "_p", F.to_date(point))
        out = rng.join(pts, cond & (F.col(BUCKET + "_p") == F.col(BUCKET + "_r")), how)
    return out.drop(BUCKET + "_p", BUCKET + "_r")


def contract_accounts(df: DataFrame, contract_col: str, contract_dim: DataFrame,
                      card_account: DataFrame) -> DataFrame:
    """Attach ``skp_card_account`` through contract -> account (inner, J12/J13)."""
    cd = contract_dim.select("skp_contract", "text_contract_number")
    ca = card_account.select("skp_card_account", F.col("skp_contract").alias("_acc_contract"))
    return (df.join(cd, F.col(contract_col) == F.col("text_contract_number"))
              .join(ca, F.col("skp_contract") == F.col("_acc_contract"))
              .drop("skp_contract", "text_contract_number", "_acc_contract"))


def card_transactions(accounts: DataFrame, txns: DataFrame, cond: Column, **bucket) -> DataFrame:
    """Transactions of the attached card accounts satisfying ``cond`` (inner).

    The transaction table is the unbounded fact side: it is never broadcast
    (``merge`` hint), so the join shuffles both sides on the account (and day)
    and AQE splits a hot account.
    """
    t = txns.withColumnRenamed("skp_card_account", "_txn_account").hint("merge")
    return band_join(accounts, t, (F.col("skp_card_account") == F.col("_txn_account")) & cond,
                     "inner", **bucket).drop("_txn_account")


def exclude_flagged(df: DataFrame, flagged: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` with no flagged row of the same key (NOT EXISTS)."""
    return df.join(flagged.select(F.col(on).alias("_flag_key")).distinct(),
                   F.col(on) == F.col("_flag_key"), "left_anti")


def restrict_to(df: DataFrame, roster: DataFrame, left_key: Column, right_key: str) -> DataFrame:
    """Keep rows whose key is on the (distinct) roster."""
    r = roster.select(F.col(right_key).alias("_roster_key"))
    return df.join(r, left_key == F.col("_roster_key"), "left_semi")


def validity_overlaps(dim: DataFrame, key: str, valid_from: str, valid_to: str, as_of) -> DataFrame:
    """Q6 data check: validity rows that overlap an earlier row of the same key.

    A row covers ``[from, nvl(to, as_of) + 1 day)``. Rows are ordered by start
    per key and each is compared with the latest end of the rows before it,
    so no pairs are formed. Returns the overlapping rows with that end.
    """
    from pyspark.sql import Window
    end = plus_days(F.coalesce(F.col(valid_to), ts_lit(as_of)), 1)
    w = (Window.partitionBy(key)
         .orderBy(F.col(valid_from).asc_nulls_first(), end.asc_nulls_first())
         .rowsBetween(Window.unboundedPreceding, -1))
    marked = dim.withColumn("previous_end", F.max(end).over(w))
    return marked.where(F.col("previous_end") > F.col(valid_from))


def card_chain(df: DataFrame, contract_col: str, contract_dim: DataFrame, card_account: DataFrame,
               txns: DataFrame, cond: Column, how: str = "inner", **bucket) -> DataFrame:
    """Contract -> card account -> transaction, ``inner`` or ``left``.

    With ``left`` every row of ``df`` survives (NULL transaction columns when
    nothing matches) and ``cond`` stays in the ON clause, as in the source.
    The transaction side is never broadcast. Day buckets apply to ``inner``
    only (a preserved range side must not be expanded).
    """
    if how == "inner":
        return card_transactions(contract_accounts(df, contract_col, contract_dim, card_account), txns, cond,
                                 **bucket)
    if how != "left" or bucket:
        raise ValueError("card_chain supports how='inner' (optionally bucketed) or how='left'")
    cd = contract_dim.select(F.col("skp_contract").alias("_cd_contract"), "text_contract_number")
    ca = card_account.select("skp_card_account", F.col("skp_contract").alias("_acc_contract"))
    t = txns.withColumnRenamed("skp_card_account", "_txn_account").hint("merge")
    out = (df.join(cd, F.col(contract_col) == F.col("text_contract_number"), "left")
             .join(ca, F.col("_cd_contract") == F.col("_acc_contract"), "left")
             .join(t, (F.col("skp_card_account") == F.col("_txn_account")) & cond, "left"))
    return out.drop("_cd_contract", "text_contract_number", "_acc_contract", "_txn_account")
