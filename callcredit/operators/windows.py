"""Per-group selection and numbering.

``latest_per``/``earliest_per`` pick one row per key with an aggregate over an
ordered struct (partial aggregation before every shuffle, skew-safe).
``sequence_ids`` numbers rows inside a group without gathering the group:
rows are range-partitioned in the requested order and stored with their slice
and position; the per-slice offsets are summed with a small window and joined
back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _pick(df: DataFrame, keys, by: str, ties, latest: bool, first: str | None) -> DataFrame:
    """One row per key chosen by an ordered struct, as an aggregate.

    ``max``/``min`` over ``struct(order..., payload...)`` is planned as a
    partial aggregate before the shuffle, and stays partial when AQE splits a
    skewed join below it, so a hot key arrives pre-reduced instead of whole.
    Struct comparison puts NULL fields first, so explicit NULL flags give the
    source database's order: descending with NULL first, ascending with NULL
    last; tie-breakers keep NULL last in both directions.
    """
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    if latest:  # max: NULL by first, ties descending NULL last
        order = [F.col(by).isNull().alias("_n"), F.col(by).alias("_o")] + \
                [F.col(t).alias(f"_t{i}") for i, t in enumerate(ties)]
        agg = F.max
    else:       # min: by ascending NULL last, ties ascending NULL last
        order = [F.col(by).isNull().alias("_n"), F.col(by).alias("_o")]
        for i, t in enumerate(ties):
            order += [F.col(t).isNull().alias(f"_tn{i}"), F.col(t).alias(f"_t{i}")]
        agg = F.min
    pick = agg(F.struct(*order, *[F.col(c).alias(c) for c in payload])).alias("_pick")
    extra = [F.min(by).alias(first)] if first else []
    out = df.groupBy(*keys).agg(pick, *extra)
    return out.select(*keys, *[F.col(f"_pick.{c}").alias(c) for c in payload], *([first] if first else []))


def latest_per(df: DataFrame, keys, by: str, ties=(), first: str | None = None) -> DataFrame:
    """Latest row per key (W1-W3, W5): ``by`` descending with NULL first (the
    source database's descending order), then the tie-breakers descending.

    ``first`` adds ``min(by) over (partition by keys)`` under that name (W6),
    from the same aggregate.
    """
    return _pick(df, keys, by, ties, latest=True, first=first)


def earliest_per(df: DataFrame, keys, by: str, ties=()) -> DataFrame:
    """Earliest row per key (W4): ``by`` ascending with NULL last, then ties ascending."""
    return _pick(df, keys, by, ties, latest=False, first=None)


def first_in_group(df: DataFrame, keys: list[str], col: str, name: str,
                   source: DataFrame | None = None) -> DataFrame:
    """``min(col) over (partition by keys)`` as a new column.

    Computed as a partial aggregate (one row per key per task) joined back on
    the key, NULL-safe so a NULL key forms its own group as in a window.
    ``source`` is the frame the minimum is taken over (default ``df``).
    """
    agg = (source if source is not None else df).groupBy(*keys).agg(F.min(col).alias(name))
    agg = agg.select(*[F.col(k).alias(f"_g_{k}") for k in keys], name)
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_g_{k}"))
        cond = c if cond is None else cond & c
    return df.join(agg, cond, "left").drop(*[f"_g_{k}" for k in keys])


def next_event(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], left_ts: str, right_ts: str, carry=()) -> DataFrame:
    """Each row of ``left`` with the first row of ``right`` after it (J15 + W4):
    of the same key, ``right_ts`` later than ``left_ts``, the least by the
    ``carry`` columns (NULL last) if several have that time. Rows without one are
    dropped. ``keys`` are (left, right) column names.

    Both sides become one stream of events a key, read once from the latest to
    the earliest with the next right event at hand, so the cost is linear in a
    key's events; no pairs are formed. Right rows of one time are merged before
    the shuffle. Rows with a NULL key or time match nothing.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    own, other = [F.col(a) for a, _ in keys], [F.col(b) for _, b in keys]
    for c in [*own, F.col(left_ts)]:
        left = left.where(c.isNotNull())
    for c in [*other, F.col(right_ts)]:
        right = right.where(c.isNotNull())
    nulls_last = [x for c in carry for x in (F.col(c).isNull().alias(f"_n_{c}"), F.col(c).alias(c))]
    payload = [c for c in left.columns if c not in {a for a, _ in keys} | {left_ts}]
    events = right.groupBy(*[c.alias(n) for c, n in zip(other, names, strict=True)], F.col(right_ts).alias("_ts")).agg(
        F.min(F.struct(F.col(right_ts).alias(right_ts), *nulls_last)).alias("_event"))
    rows = left.select(*[c.alias(n) for c, n in zip(own, names, strict=True)], F.col(left_ts).alias("_ts"),
                       F.struct(F.lit(1).alias("_left"), *payload).alias("_row"))
    stream = events.unionByName(rows, allowMissingColumns=True)
    # Latest first; a right event of the same time comes after the left rows, so they don't see it.
    seen = Window.partitionBy(*names).orderBy(F.desc("_ts"), F.col("_event").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = stream.withColumn("_next", F.last("_event", ignorenulls=True).over(seen)).where(F.col("_row").isNotNull() & F.col("_next").isNotNull())
    return met.select(
        *[F.col(n).alias(a) for n, (a, _) in zip(names, keys, strict=True)], F.col("_ts").alias(left_ts),
        *[F.col(f"_row.{c}").alias(c) for c in payload], F.col(f"_next.{right_ts}").alias(right_ts), *[F.col(f"_next.{c}").alias(c) for c in carry])


def later_within_days(df: DataFrame, key: str, ts: str, days: int, name: str) -> DataFrame:
    """For every instant of a key: how many rows of the key are later and before
    the ``days``-th day after the instant's day begins (J10), as (key, ts, name).

    The limit is a midnight, so these are the rest of the instant's own day and
    the whole days after it: a day's total less a running count, and sums of day
    totals. Rows of an instant are counted before the shuffle, a running count
    goes over the instants of one key and day, and no pairs are formed.
    """
    instants = (
        df.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).groupBy(key, ts).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_day", F.to_date(ts)))
    totals = instants.groupBy(key, "_day").agg(F.sum("_n").alias("_total"))
    ahead = (
        totals.select(F.col(key).alias("_a"), F.explode(F.transform(F.sequence(F.lit(1), F.lit(days - 1)), lambda i: F.date_sub("_day", i))).alias("_d"), "_total")
        .groupBy("_a", "_d").agg(F.sum("_total").alias("_ahead")) if days > 1 else None)
    whole = Window.partitionBy(key, "_day")
    upto = whole.orderBy(ts).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rest = instants.withColumn("_rest", F.sum("_n").over(whole) - F.sum("_n").over(upto))
    if ahead is None:
        return rest.select(key, ts, F.col("_rest").alias(name))
    joined = rest.join(ahead, (F.col(key) == F.col("_a")) & (F.col("_day") == F.col("_d")), "left")
    return joined.select(key, ts, (F.col("_rest") + F.coalesce("_ahead", F.lit(0))).alias(name))


def sequence_ids(df: DataFrame, keys: list[str], order: list[Column], name: str, slices: int | None = None) -> DataFrame:
    """``row_number() over (partition by keys order by order)``, distributed.

    ``order`` must be a total order (append tie-breakers) so the numbering is
    deterministic. Rows are range-partitioned into ``slices`` (default: the
    session's shuffle partitions) and stored with their slice and position in
    the shared checkpoint folder; counts and numbers both come from the stored
    rows, so they agree whatever the optimiser does with either. The offsets
    have at most ``slices + groups`` rows, as each slice holds a contiguous
    range; whether they are broadcast is decided by their size.
    """
    spark = df.sparkSession
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = [*[k.asc_nulls_first() for k in _cols(keys)], *order]
    ensure_checkpoint_dir(spark)
    tagged = (df.repartitionByRange(n, *ranged).sortWithinPartitions(*ranged)
                .withColumn("_slice", F.spark_partition_id())
                .withColumn("_pos", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    counts = tagged.groupBy("_slice", *keys).agg(F.count(F.lit(1)).alias("_n"),
                                                F.min("_pos").alias("_first"))
    w = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    offsets = offsets.select(F.col("_slice").alias("_o_slice"),
                             *[F.col(k).alias(f"_o_{k}") for k in keys], "_offset", "_first")
    cond = F.col("_slice") == F.col("_o_slice")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    return (tagged.join(offsets, cond)
                  .withColumn(name, (F.col("_offset") + F.col("_pos") - F.col("_first") + 1).cast("int"))
                  .drop("_slice", "_pos", "_o_slice", "_offset", "_first", *[f"_o_{k}" for k in keys]))
