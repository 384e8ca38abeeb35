"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

A row's shard follows from its key and the number of shards alone, without a
ring table. When one shard is appended, a row either stays or moves into the
new shard, and about 1/(n+1) of the rows move.

Everything here is DataFrame expressions. The 64-bit generator of the paper is
written with 32-bit halves, because multiplication of longs may not overflow.

Defined results: a null text counts as an empty one (size 16, checksum 0); a
row without a doc_id uses its text checksum as key; equal rows get the same
shard and neighbouring slots; an empty table gives no rows; other columns of
the input are not carried, so their names cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callcredit.llm.storage import documents

SHARDS = 40
ROW_OVERHEAD = 16
ROWS_PER_TASK = 50_000

MULTIPLIER = 2862933555777941757
_LOW = 0xFFFFFFFF


def _product_low(x: Column, factor: int) -> Column:
    """(x * factor) mod 2**32 for x < 2**32."""
    low, high = x.bitwiseAND(0xFFFF), F.shiftright(x, 16)
    return (low * F.lit(factor) + F.shiftleft(high * F.lit(factor & 0xFFFF), 16)).bitwiseAND(_LOW)


def _next(high: Column, low: Column) -> tuple[Column, Column]:
    """Halves of ``key * MULTIPLIER + 1`` mod 2**64."""
    c_high, c_low = MULTIPLIER >> 32, MULTIPLIER & _LOW
    first = low.bitwiseAND(0xFFFF) * F.lit(c_low)
    second = F.shiftright(low, 16) * F.lit(c_low)
    mid = first + F.shiftleft(second.bitwiseAND(_LOW), 16) + F.lit(1)
    carried = F.shiftright(mid, 32) + F.shiftleft(F.shiftright(second, 32), 16)
    new_high = (carried + _product_low(high, c_low) + _product_low(low, c_high)).bitwiseAND(_LOW)
    return new_high, mid.bitwiseAND(_LOW)


def jump_hash_pair(key: Column, shards: int) -> Column:
    """struct(shard, grown): the bucket of ``key`` (long) among ``shards`` and
    among ``shards + 1`` buckets, from one run of the generator."""
    if shards < 1:
        raise ValueError("shards must be positive")

    def step(s: Column, _: Column) -> Column:
        high, low = _next(s["high"], s["low"])
        jump = F.floor((s["jump"] + 1).cast("double") * (F.lit(2.0 ** 31) / (F.shiftright(high, 1) + 1).cast("double")))
        moved = F.struct(
            high.alias("high"), low.alias("low"), jump.cast("long").alias("jump"), s["jump"].alias("grown"),
            F.when(s["jump"] < shards, s["jump"]).otherwise(s["shard"]).alias("shard"))
        return F.when(s["jump"] <= shards, moved).otherwise(s)

    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("high"), key.bitwiseAND(_LOW).alias("low"),
        F.lit(0).cast("long").alias("jump"), F.lit(0).cast("long").alias("grown"),
        F.lit(0).cast("long").alias("shard"))
    # The bucket only ever grows, so shards + 1 steps reach past the last one.
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(shards + 1)), start, step,
        lambda s: F.struct(s["shard"].cast("int").alias("shard"), s["grown"].cast("int").alias("grown")))


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                    rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    Slots number a shard's rows from 0 without gaps. They come from counts of
    (shard, part) pairs and a numbering inside each part, a hash of the key, so no
    task holds a whole shard unless rows share a key; the number of parts follows
    the row count.
    """
    parts = max(1, math.ceil(docs.count() / (shards * rows_per_task)))
    text = F.coalesce(F.col(text_col), F.lit(""))
    crc = F.crc32(F.encode(text, "UTF-8"))
    rows = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"), crc.alias("text_crc32"))
        .withColumn("_key", F.coalesce("doc_id", "text_crc32"))
        .withColumn("_bucket", jump_hash_pair(F.col("_key"), shards))
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("_bucket.shard").alias("shard"),
                F.col("_bucket.grown").alias("grown_shard"),
                # Hashed, as ids may go in steps of any size.
                (F.conv(F.substring(F.md5(F.col("_key").cast("string")), 1, 8), 16, 10).cast("long") % parts).alias("_part")))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("shard", "_part").agg(F.count("*").alias("_n"))
        .select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    inside = Window.partitionBy("shard", "_part").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("_slot", F.row_number().over(inside).cast("long") - 1)
        .join(offsets, ["shard", "_part"])
        .select("doc_id", "size", "text_crc32", "law", "shard", (F.col("_offset") + F.col("_slot")).alias("slot"), "grown_shard"))


def op4_jump_shards(spark, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir))


QUERIES = {"op4_jump_shards": op4_jump_shards}

# 128-bit integers stand in for the generator's 64-bit wrap; the checksum is
# the bytewise CRC-32 over a table made by its rule.
ORACLE_SQL = {"op4_jump_shards": f"""
WITH RECURSIVE
bits(v, c, k) AS (
    SELECT range, range, 0 FROM range(256)
    UNION ALL
    SELECT v, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY v) AS t FROM bits WHERE k = 8),
hexed AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (
    SELECT doc_id, length(h) // 2 + {ROW_OVERHEAD} AS size,
           xor(4294967295, list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2),
                   lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
               lambda crc, byte: xor(t[(xor(crc, byte) & 255) + 1], crc >> 8))) AS text_crc32
    FROM hexed, crc_table),
keyed AS (SELECT *, row_number() OVER () AS rid, coalesce(doc_id, text_crc32) AS k FROM sized),
jumps(rid, state, b, j) AS (
    SELECT rid, ((k::HUGEINT + 18446744073709551616) % 18446744073709551616), -1::BIGINT, 0::BIGINT FROM keyed
    UNION ALL
    SELECT rid, s, j, floor((j + 1)::DOUBLE * (2147483648.0::DOUBLE / ((s // 8589934592) + 1)::DOUBLE))::BIGINT
    FROM (SELECT rid, j, (state * {MULTIPLIER} + 1) % 18446744073709551616 AS s FROM jumps WHERE j <= {SHARDS})),
placed AS (
    SELECT rid, max(b) FILTER (b < {SHARDS}) AS shard, max(b) AS grown FROM jumps GROUP BY rid),
parted AS (
    SELECT doc_id, size, text_crc32, shard, grown,
           ('0x' || substr(md5(k::VARCHAR), 1, 8))::BIGINT % greatest(1, ceil((SELECT count(*) FROM documents) / ({SHARDS} * {ROWS_PER_TASK}.0)))::BIGINT AS part
    FROM keyed JOIN placed USING (rid))
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY part, doc_id, text_crc32, size) - 1 AS slot,
       grown::INTEGER AS grown_shard
FROM parted
"""}
