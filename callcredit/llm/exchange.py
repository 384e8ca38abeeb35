"""Distinct texts in chunks, and questions about hashes asked across chunks.

A corpus is stored once as a table of its distinct texts, bucketed by chunk: a
chunk is some megabytes of whole texts, so its words can be hashed by numpy in
one task. To learn which hashes occur elsewhere, every chunk sends its distinct
hashes, sorted and cut by range into buckets; a bucket's task joins what all
chunks sent and answers each chunk with the hashes that pass a rule. Answers
are brought together with the stored texts by chunk, for which the bucketed
table needs no further shuffle.

A frequent hash is sent once a chunk, however often it occurs there, and equal
texts are one row, so no key makes a task large. The number of chunks and
buckets follows the corpus. Hashes are shortened to HASH_SPARE bits more than
it takes to number the corpus's words, so about one hash in 2**HASH_SPARE may
be answered wrongly as occurring elsewhere; users of an answer check it.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callcredit.llm.storage import texts_in_small_batches
from callcredit.session import ensure_checkpoint_dir

CHUNK_BYTES = 8 << 20
ROWS_PER_BATCH = 500
HASH_SPARE = 13
MAX_TABLE_BUCKETS = 50_000


@dataclass(frozen=True)
class Corpus:
    """Stored texts (chunk, key, text) and the sizes derived from them."""

    texts: DataFrame
    chunks: int
    bits: int
    table: str = ""

    def discard(self) -> None:
        """Deletes the stored texts; only results staged before can be used on."""
        spark = self.texts.sparkSession
        spark.sql(f"DROP TABLE {self.table}")
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/{self.table}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_key(column):
    """Identity of a text; null counts as empty."""
    return F.md5(F.coalesce(column, F.lit("")))


def _new_of_task(batches):
    seen: set[str] = set()
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_PER_BATCH):
            part = batch.slice(at, ROWS_PER_BATCH)
            fresh = [k not in seen and not seen.add(k) for k in part.column("key").to_pylist()]
            yield part.filter(pa.array(fresh, pa.bool_()))


def store_texts(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> Corpus:
    """The distinct texts of ``docs``, as a bucketed table in the shared folder."""
    chunks, bits = _chunking(docs, chunk_bytes)
    keyed = docs.select(F.coalesce("text", F.lit("")).alias("text")).select(
        F.pmod(F.xxhash64("text"), F.lit(chunks).cast("long")).cast("int").alias("chunk"), F.md5("text").alias("key"), "text")
    texts, table = stored(keyed.mapInArrow(_new_of_task, keyed.schema), "chunk", chunks, lambda df: df.distinct())
    return Corpus(texts, chunks, bits, table)


def store_rows(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> Corpus:
    """The rows of ``docs`` (with a text column) dealt evenly to chunks."""
    chunks, bits = _chunking(docs, chunk_bytes)
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(chunks).cast("long")).cast("int")
    texts, table = stored(docs.select(dealt.alias("chunk"), *docs.columns), "chunk", chunks)
    return Corpus(texts, chunks, bits, table)


def _chunking(docs: DataFrame, chunk_bytes: int) -> tuple[int, int]:
    texts_in_small_batches(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    # A word takes two bytes at least, with the space behind it.
    return max(1, math.ceil(total / chunk_bytes)), min(58, max(1, math.ceil(math.log2(total + 2)) - 1) + HASH_SPARE)


def stored(rows: DataFrame, key: str, values: int, then: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, str]:
    """``rows`` as a table bucketed by ``key``, in the shared folder, and its name."""
    spark, name, buckets = rows.sparkSession, f"{key}_{uuid.uuid4().hex}", min(values, MAX_TABLE_BUCKETS)
    (then(rows.repartition(buckets, key)).write.bucketBy(buckets, key).option("compression", "zstd")
     .option("path", f"{ensure_checkpoint_dir(spark)}/{name}").saveAsTable(name))
    return spark.read.table(name), name


def pack(values: np.ndarray) -> bytes:
    """Sorted 64-bit values: the first, then byte planes of the differences."""
    if not len(values):
        return b""
    steps = np.diff(values)
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    planes = np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8).T[:width])
    return int(values[0]).to_bytes(8, "little") + bytes([width]) + planes.tobytes()


def unpack(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, np.uint64)
    first, width = int.from_bytes(blob[:8], "little"), blob[8]
    planes = np.frombuffer(blob, np.uint8, offset=9).reshape(width, -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, :width] = planes.T
    return np.cumsum(np.append(np.uint64(first), steps.view("<u8").ravel().astype(np.uint64)), dtype=np.uint64)


def short(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes >> np.uint64(64 - bits)


def distinct_flagged(keys: np.ndarray, flags: np.ndarray | None = None) -> np.ndarray:
    """Distinct keys, sorted, as key << 2 | flags: 1 for a key that occurs twice
    or more here, 2 if any occurrence has the flag."""
    if not len(keys):
        return np.zeros(0, np.uint64)
    both = np.sort(keys << np.uint64(1) | (flags.astype(np.uint64) if flags is not None else np.uint64(0)))
    value = both >> np.uint64(1)
    at = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    last = np.append(at[1:], len(value)) - 1
    return value[at] << np.uint64(2) | (both[last] & np.uint64(1)) << np.uint64(1) | (last > at).astype(np.uint64)


def _send(chunk: int, values: np.ndarray, bits: int, buckets: int) -> pa.Table:
    edges = np.array([(b << bits) // buckets << 2 for b in range(buckets + 1)], np.uint64)
    cuts = np.searchsorted(values, edges)
    filled = np.flatnonzero(np.diff(cuts))
    return pa.table({"bucket": pa.array(filled, pa.int32()), "chunk": pa.array(np.full(len(filled), chunk), pa.int32()),
                     "blob": pa.array([pack(values[cuts[b]:cuts[b + 1]]) for b in filled], pa.binary())})


def _answer(sent: pa.Table, rule: Callable) -> pa.Table:
    """For each chunk its hashes that pass ``rule(times, flagged)``, as
    hash << 4 | log2 of the times they were seen (15 at most)."""
    chunks, blobs = sent.column("chunk").to_numpy(), [unpack(x.as_py()) for x in sent.column("blob")]
    every = np.sort(np.concatenate(blobs))
    value, flags = every >> np.uint64(2), every & np.uint64(3)
    at = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    times = np.add.reduceat(1 + (flags & np.uint64(1)).astype(np.int64), at)
    passed = rule(times, np.bitwise_or.reduceat(flags, at) > 1)
    hits = value[at][passed]
    level = np.minimum(np.log2(times[passed]), 15).astype(np.uint64)
    out = []
    for blob in blobs:
        own = blob >> np.uint64(2)
        place = np.minimum(np.searchsorted(hits, own), max(0, len(hits) - 1))
        same = hits[place] == own if len(hits) else np.zeros(len(own), bool)
        out.append(pack(own[same] << np.uint64(4) | level[place[same]]) if same.any() else b"")
    return pa.table({"chunk": pa.array(chunks, pa.int32()), "bucket": sent.column("bucket"), "blob": pa.array(out, pa.binary())})


def answers(sent: DataFrame, rule: Callable) -> DataFrame:
    """(chunk, bucket, blob) answers to what ``send`` functions returned."""
    return sent.groupBy("bucket").applyInArrow(lambda t: _answer(t, rule), "chunk int, bucket int, blob binary").where(F.length("blob") > 0)


SENT = "bucket int, chunk int, blob binary"


def ask(corpus: Corpus, hashes: Callable[[pa.Table], np.ndarray], rule: Callable) -> DataFrame:
    """Answers about ``hashes(texts of a chunk)``, which are as distinct_flagged."""
    bits, buckets = corpus.bits, corpus.chunks

    def run(table: pa.Table) -> pa.Table:
        return _send(table.column("chunk")[0].as_py(), hashes(table), bits, buckets)

    return answers(corpus.texts.groupBy("chunk").applyInArrow(run, SENT), rule)


def ask_again(corpus: Corpus, known: DataFrame, hashes: Callable[[pa.Table, Answers], np.ndarray], rule: Callable) -> DataFrame:
    """As ``ask``, with hashes that depend on earlier answers."""
    bits, buckets = corpus.bits, corpus.chunks

    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _send(0, np.zeros(0, np.uint64), bits, buckets)
        return _send(texts.column("chunk")[0].as_py(), hashes(texts, Answers(received(known))), bits, buckets)

    sent = corpus.texts.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(run, SENT)
    return answers(sent, rule)


def with_answers(corpus: Corpus, known: DataFrame, rows: Callable[[pa.Table, Answers], pa.Table], schema: str) -> DataFrame:
    """``rows(texts of a chunk, its answers)`` of every chunk."""

    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        return rows(texts, Answers(received(known)))

    return corpus.texts.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(run, schema)


def received(known: pa.Table) -> np.ndarray:
    """All answers of a chunk, sorted."""
    order = np.argsort(known.column("bucket").to_numpy(), kind="stable")
    blobs = known.column("blob")
    return np.concatenate([np.zeros(0, np.uint64), *[unpack(blobs[int(i)].as_py()) for i in order]])


class Places:
    """Finds values among sorted distinct keys: one look into a hash table that
    keeps one key a slot, then a binary search for those not met there."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.bits = keys, (4 * len(keys) + 256).bit_length()
        self.slot = np.zeros(1 << self.bits, np.int32)
        self.slot[self._hash(keys)] = np.arange(len(keys), dtype=np.int32)

    def _hash(self, values: np.ndarray) -> np.ndarray:
        return (values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def of(self, values: np.ndarray) -> np.ndarray:
        """Places of the values; of a value that isn't a key, any place."""
        at = self.slot[self._hash(values)]
        missed = np.flatnonzero(self.keys[at] != values)
        at[missed] = np.minimum(np.searchsorted(self.keys, values[missed]), len(self.keys) - 1)
        return at


class Answers:
    """A chunk's answers, for ``level_of``."""

    def __init__(self, values: np.ndarray):
        self.level = (values & np.uint64(15)).astype(np.int8)
        self.places = Places(values >> np.uint64(4)) if len(values) else None

    def level_of(self, keys: np.ndarray) -> np.ndarray:
        """log2 of the times each key was seen, -1 for keys without an answer."""
        if self.places is None:
            return np.full(len(keys), -1, np.int8)
        at = self.places.of(keys)
        return np.where(self.places.keys[at] == keys, self.level[at], np.int8(-1))
