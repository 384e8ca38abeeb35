"""Quality scores from random-indexing word vectors and a small network.

Word vectors (Kanerva, Kristoferson and Holst, 2000). A token is a run of
letters and digits, or of other signs, in a word. Its hash gives it a sparse
random vector of NONZERO entries of 1 or -1 among DIMS, and one of BUCKETS rows
of a table. All tokens of all texts add the random vectors of their neighbours,
up to WINDOW tokens away, to their row; rows are then scaled to length 1. The
table's size is fixed by those two parameters (BUCKETS * DIMS numbers, 4 MB),
so every word of a corpus of any size has its row, shared with others that hash
to it. A task sends the rows it has touched, in blocks, and the blocks' tasks
add them up as they stream in, in whole numbers, so order doesn't matter.

A text is pooled to the mean and the spread of its tokens' rows, and how alike
(by dot product) the rows of neighbours LAGS tokens apart are. A network of two
layers, fitted with numpy on at most FIT_ROWS labelled rows (by a hash of
the id, outside the held-out fold), gives a logit, which one temperature fitted
on every CALIBRATES-th row of the sample turns into a probability.

Sizes. The driver holds the table, the sample's pooled vectors (FIT_ROWS * WIDTH
numbers) and the network; all are bounded by parameters, and broadcast.
Counting and scoring run over all rows, whole texts, some megabytes at a time.

Defined results: null, empty and wordless texts are pooled to zeros and scored
as such; a row without doc_id is not held out, and never learned from; of
several labels of an id the highest counts, of several texts the one with the
greatest pooled vector; without labels of both kinds every score is the share
of label 1, or 0.5; repeated rows score alike; empty tables give no rows; other
columns never clash, as only doc_id, text and quality are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callcredit.llm.storage import documents, staged, texts_in_small_batches
from callcredit.llm.words import SPACE, Words, mixed, pieces, segment_hashes

DIMS = 32
BUCKETS_LOG2 = 15
BLOCK_ROWS = 512
NONZERO = 4
WINDOW = 2
LAGS = (1, 2)
TOKENS_AT_ONCE = 1 << 16
FIT_ROWS = 20_000
CALIBRATES = 5
HIDDEN = 24
STEPS = 400
RATE = 0.02
DECAY = 1e-3
SEED = 13
FOLDS = 4
HELD_OUT_FOLD = 2
GOOD = 0.7

SIGN = np.ones(256, np.uint8)
SIGN[SPACE] = 0
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    SIGN[_low:_high + 1] = 2

BUCKETS = 1 << BUCKETS_LOG2
WIDTH = 2 * DIMS + len(LAGS)
ADDED = "block int, rows binary, sums binary"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def tokens(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of every token, in order."""
    kind = SIGN[words.buf]
    edge = np.zeros(len(kind) + 1, bool)
    edge[words.offsets] = True
    changes = np.flatnonzero(edge | np.append(True, np.append(kind[1:] != kind[:-1], True))[:len(kind) + 1]) if len(kind) else np.zeros(1, np.int64)
    starts, ends = changes[:-1], changes[1:]
    solid = kind[starts] > 0
    starts, ends = starts[solid], ends[solid]
    return np.searchsorted(words.offsets, starts, "right") - 1, segment_hashes(words.buf, starts, ends)


def bucket_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKETS_LOG2)).astype(np.int64)


def random_vectors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of each hash's random vector."""
    drawn = mixed(hashes[:, None] + np.arange(1, NONZERO + 1, dtype=np.uint64)[None, :])
    return (drawn % np.uint64(DIMS)).astype(np.int64), 1 - 2 * (drawn >> np.uint64(63)).astype(np.int32)


def add_contexts(table: np.ndarray, words: Words) -> None:
    """Adds every token's neighbours to its row of ``table``."""
    row, hashes = tokens(words)
    if not len(hashes):
        return
    known, which = np.unique(hashes, return_inverse=True)
    place, sign = (x[which] for x in random_vectors(known))
    base = bucket_of(hashes) * DIMS
    flat = table.reshape(-1)
    for away in range(1, WINDOW + 1):
        near = np.flatnonzero(row[:-away] == row[away:])
        for one, other in ((near, near + away), (near + away, near)):
            np.add.at(flat, (base[one][:, None] + place[other]).ravel(), sign[other].ravel())


def _added_by_task(batches) -> Iterator[pa.RecordBatch]:
    table = np.zeros((BUCKETS, DIMS), np.int32)
    for batch in batches:
        for _, _, words in pieces(batch.column("text")):
            add_contexts(table, words)
    for block in range(BUCKETS // BLOCK_ROWS):
        part = table[block * BLOCK_ROWS:(block + 1) * BLOCK_ROWS]
        rows = np.flatnonzero(part.any(axis=1))
        if len(rows):
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([block], pa.int32()), "rows": pa.array([rows.astype(np.uint16).tobytes()], pa.binary()),
                "sums": pa.array([part[rows].tobytes()], pa.binary())})


def _added_up(batches) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, rows, part in zip(*[batch.column(c).to_pylist() for c in ("block", "rows", "sums")], strict=True):
            held = sums.setdefault(block, np.zeros((BLOCK_ROWS, DIMS), np.int64))
            rows = np.frombuffer(rows, np.uint16)
            held[rows] += np.frombuffer(part, np.int32).reshape(len(rows), DIMS)
    for block, held in sums.items():
        yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "sums": pa.array([held.tobytes()], pa.binary())})


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The table of word vectors of all texts, rows of length 1 (or 0)."""
    texts_in_small_batches(docs.sparkSession)
    added = docs.select("text").mapInArrow(_added_by_task, ADDED).repartition(BUCKETS // BLOCK_ROWS, "block")
    table = np.zeros((BUCKETS, DIMS))
    # At most BUCKETS / BLOCK_ROWS rows of BLOCK_ROWS * DIMS numbers.
    for row in added.mapInArrow(_added_up, "block int, sums binary").collect():
        table[row["block"] * BLOCK_ROWS:(row["block"] + 1) * BLOCK_ROWS] = np.frombuffer(row["sums"], np.int64).reshape(BLOCK_ROWS, DIMS)
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def _pooled_text(vectors: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Mean and spread of the rows ``buckets``, and how alike neighbours are,
    taken TOKENS_AT_ONCE at a time."""
    n = len(buckets)
    total, squares, alike = np.zeros(DIMS), np.zeros(DIMS), np.zeros(len(LAGS))
    for at in range(0, n, TOKENS_AT_ONCE):
        rows = vectors[buckets[at:at + TOKENS_AT_ONCE + max(LAGS)]]
        here = rows[:TOKENS_AT_ONCE]
        total += np.ones(len(here), np.float32) @ here
        squares += np.einsum("ij,ij->j", here, here)
        for k, lag in enumerate(LAGS):
            first = here[:max(0, len(rows) - lag)]
            alike[k] += np.einsum("ij,ij->", first, rows[lag:lag + len(first)])
    mean = total / n
    return np.concatenate([mean, np.sqrt(np.maximum(squares / n - mean * mean, 0)), alike / np.maximum(n - np.array(LAGS), 1)])


def pooled(vectors: np.ndarray, words: Words) -> np.ndarray:
    """The pooled vector of each text; zeros without tokens."""
    row, hashes = tokens(words)
    out = np.zeros((words.rows, WIDTH))
    buckets = bucket_of(hashes)
    at = np.flatnonzero(np.append(True, row[1:] != row[:-1])[:len(row)])
    for i, j in zip(at.tolist(), np.append(at, len(row))[1:].tolist(), strict=True):
        out[row[i]] = _pooled_text(vectors, buckets[i:j])
    return out


def _pooled_rows(docs: DataFrame, vectors, carry: list[str], kind: str, of) -> DataFrame:
    """``carry`` columns and what ``of`` makes of the pooled texts."""
    texts_in_small_batches(docs.sparkSession)
    schema = ", ".join([*[f"{c} {docs.schema[c].dataType.simpleString()}" for c in carry], kind])
    name = kind.split()[0]

    def run(batches):
        for batch in batches:
            for at, end, words in pieces(batch.column("text")):
                columns = [batch.column(c).slice(at, end - at) for c in carry]
                yield pa.RecordBatch.from_arrays([*columns, of(pooled(vectors.value, words))], [*carry, name])

    return docs.select(*carry, "text").mapInArrow(run, schema)


class Network:
    """tanh layer and logit, over inputs scaled as in the sample."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = SEED):
        draw = np.random.default_rng(seed)
        self.centre, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        width = x.shape[1]
        self.layers = [draw.normal(0, width ** -0.5, (width, HIDDEN)), np.zeros(HIDDEN), draw.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
        self.temperature = 1.0
        self._fit((x - self.centre) / self.scale, y)

    def _fit(self, x: np.ndarray, y: np.ndarray) -> None:
        first, second = [np.zeros_like(w) for w in self.layers], [np.zeros_like(w) for w in self.layers]
        for step in range(1, STEPS + 1):
            a, b, c, d = self.layers
            hidden = np.tanh(x @ a + b)
            miss = (_logistic(hidden @ c + d) - y) / len(y)
            back = np.outer(miss, c) * (1 - hidden ** 2)
            slopes = [x.T @ back + DECAY * a, back.sum(axis=0), hidden.T @ miss + DECAY * c, miss.sum(keepdims=True)]
            for w, m, v, g in zip(self.layers, first, second, slopes, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        return np.tanh(((x - self.centre) / self.scale) @ a + b) @ c + d

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature with the least log loss on rows not fitted on. Targets
        are smoothed by one row of either kind, so a sample without a miss doesn't
        make every score 0 or 1."""
        z, ones = self.logits(x), y.sum()
        aim = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (len(y) - ones + 2))
        tried = np.exp(np.linspace(np.log(0.25), np.log(50.0), 300))
        loss = [np.mean(np.logaddexp(0, z / t) - aim * z / t) for t in tried]
        self.temperature = float(tried[int(np.argmin(loss))])

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.logits(x) / self.temperature)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def learn(docs: DataFrame, labels: DataFrame, vectors, fit_rows: int = FIT_ROWS):
    """The network of a sample of labelled rows, or the share of label 1."""
    sample = staged(
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows))
    labelled = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "text")
    rows = _pooled_rows(labelled, vectors, ["doc_id", "quality"], "x array<double>", lambda x: pa.array(list(x), pa.list_(pa.float64())))
    # One row an id, so at most fit_rows come to the driver.
    found = rows.groupBy("doc_id", "quality").agg(F.max("x").alias("x")).orderBy(F.xxhash64("doc_id"), "doc_id").toPandas()
    y = found.quality.to_numpy(float)
    x = np.array(found.x.tolist(), float).reshape(len(y), WIDTH)
    calibrates = np.arange(len(y)) % CALIBRATES == 0
    if len(set(y[~calibrates])) < 2:
        return float(y.mean()) if len(y) else 0.5
    network = Network(x[~calibrates], y[~calibrates])
    network.calibrate(x[calibrates], y[calibrates])
    return network


def quality_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    vectors = docs.sparkSession.sparkContext.broadcast(word_vectors(docs))
    model = learn(docs, labels, vectors, fit_rows)
    if isinstance(model, float):
        scored = docs.select("doc_id", F.lit(model).alias("score"))
    else:
        scored = _pooled_rows(docs, vectors, ["doc_id"], "score double", lambda x: pa.array(model.scores(x), pa.float64()))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op13_quality_network(spark, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality_scores(documents(spark, sf_dir), labels)


QUERIES = {"op13_quality_network": op13_quality_network}
ORACLE_SQL: dict[str, str] = {}
