"""Embedding near-duplicates by iterative quantisation.

A rotation is learned that makes the signs of the rotated coordinates a good
binary code (Gong and Lazebnik, 2011): on a sample of at most ``FIT_ROWS``
vectors, signs and the best rotation for them are found in turn. Several
rotations from different starts give several codes. Codes are cut into
``KEY_BITS``-bit keys, each a hash table of its own (Norouzi, Punjani and Fleet,
2012); vectors that share a key in any table are compared by the cosine of the
original vectors in double precision. Two vectors with cosine 0.98 differ in
6.4 % of their bits, so they miss each other in all of 12 tables of 16 bits with
a chance under 1 %.

Only vectors of equal label and length are compared. Equal vectors are one, with
their number. A table entry with many vectors is cut into blocks that are
compared two by two, in tasks of bounded size; a pair counts in the first table
where it meets, so link numbers need no list of pairs, and a block sends one
link a vector, to its least one reached in the block.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and vectors without label, have no links and are their own
component; ties and repeated rows link as equal vectors do; a row without
vec_id counts as a vector; an empty table gives no rows; other columns are not
carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callcredit.llm.components import components
from callcredit.llm.storage import staged

COSINE = 0.98
FIT_ROWS = 20_000
ROUNDS = 30
ROTATIONS = 3
KEY_BITS = 16
BLOCK = 512
ROWS_PER_TASK = 8192
SEED = 11


def fit_rotations(sample: np.ndarray, rotations: int = ROTATIONS, rounds: int = ROUNDS, seed: int = SEED) -> tuple[np.ndarray, list[np.ndarray]]:
    """Mean and rotation matrices learned from unit vectors, one a row."""
    mean = sample.mean(0)
    x = sample - mean
    _, axes = np.linalg.eigh(x.T @ x)
    v = x @ axes
    rng = np.random.default_rng(seed)
    found = []
    for _ in range(rotations):
        r, _ = np.linalg.qr(rng.standard_normal((v.shape[1], v.shape[1])))
        for _ in range(rounds):
            code = np.where(v @ r >= 0, 1.0, -1.0)
            u, _, w = np.linalg.svd(code.T @ v)
            r = (u @ w).T
        found.append(axes @ r)
    return mean, found


def code_keys(unit: np.ndarray, mean: np.ndarray, rotations: list[np.ndarray]) -> np.ndarray:
    """Keys of every vector in every table."""
    keys = []
    for r in rotations:
        signs = (unit - mean) @ r >= 0
        for at in range(0, signs.shape[1], KEY_BITS):
            part = signs[:, at:at + KEY_BITS]
            keys.append(part @ (1 << np.arange(part.shape[1])))
    return np.stack(keys, 1).astype(np.int32)


def _units(column: pa.Array, width: int) -> np.ndarray:
    """Unit vectors, filled with zeros to ``width``."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(column), width))
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    # The largest component first: squares of tiny or huge ones stay in range.
    out /= np.abs(out).max(1, keepdims=True)
    return out / np.sqrt((out * out).sum(1, keepdims=True))


def _compare(table: pa.Table, width: int, least_cosine: float) -> pa.Table:
    """Link numbers and, per block, the least vector reached, of one task's entries."""
    unit = _units(table.column("vector").combine_chunks() if isinstance(table.column("vector"), pa.ChunkedArray) else table.column("vector"), width)
    rep = np.array(table.column("rep").to_pylist(), object)
    copies = table.column("copies").to_numpy()
    keys = np.array(table.column("keys").to_pylist(), np.int32).reshape(len(rep), -1)
    slot, left, right, block = (table.column(c).to_numpy() for c in ("slot", "low", "high", "block"))
    entry = np.array(table.column("entry").to_pylist(), object)
    order = np.lexsort((block, right, left, entry.astype(str)))
    new = [i for i in range(len(order)) if i == 0 or (entry[order[i]], left[order[i]], right[order[i]]) != (entry[order[i - 1]], left[order[i - 1]], right[order[i - 1]])]
    out: dict[str, list] = {"rep": [], "links": [], "reached": []}
    for a, b in zip(new, [*new[1:], len(order)], strict=True):
        _compare_entry(order[a:b], unit, rep, copies, keys, slot, left, right, block, least_cosine, out)
    return pa.table({"rep": pa.array(out["rep"], pa.string()), "links": pa.array(out["links"], pa.int64()), "reached": pa.array(out["reached"], pa.string())})


def _compare_entry(at, unit, rep, copies, keys, slot, left, right, block, least_cosine, out) -> None:
    t = int(slot[at[0]])
    within = left[at[0]] == right[at[0]]
    near = unit[at] @ unit[at].T >= least_cosine
    np.fill_diagonal(near, False)
    if not within:  # only pairs across the two blocks; those inside have a task of their own
        near &= block[at][:, None] != block[at][None, :]
    if not near.any():
        return
    x, y = np.nonzero(near)
    own = (keys[at[x], :t] != keys[at[y], :t]).all(1)
    links = np.bincount(x[own], copies[at[y[own]]], len(at)).astype(np.int64)
    name = np.argsort(np.argsort(rep[at].astype(str)))
    label = name.copy()
    while True:
        least = label.copy()
        np.minimum.at(least, x, label[y])
        if (least == label).all():
            break
        label = least
    by_name = rep[at][np.argsort(name)]
    for i in np.flatnonzero(near.any(1)):
        out["rep"].append(rep[at[i]])
        out["links"].append(int(links[i]))
        out["reached"].append(by_name[label[i]])


def near_duplicates(vectors: DataFrame, least_cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of (vec_id, embedding, label) rows."""
    spark = vectors.sparkSession
    v = F.col("vector")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"), F.col("embedding").cast("array<double>").alias("vector")
    ).withColumn("rep", F.when(F.col("label").isNotNull() & whole, F.concat(F.hex(F.xxhash64("label", "vector")), F.hex(F.hash("vector", "label")))))
    valid = rows.where("rep is not null")
    distinct = staged(valid.groupBy("rep", "label", "vector").agg(F.count("*").alias("copies")))
    width = distinct.agg(F.max(F.size("vector")).alias("w")).first()["w"]
    if width is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    sample = distinct.select("vector").orderBy(F.xxhash64("rep")).limit(FIT_ROWS).toArrow()
    model = spark.sparkContext.broadcast(fit_rotations(_units(sample.column("vector").combine_chunks(), width)))
    entries = staged(_entries(distinct, model, width))
    groups = max(1, -(-entries.count() // ROWS_PER_TASK))
    found = staged(
        entries.withColumn("task", F.pmod(F.xxhash64("entry", "low", "high"), F.lit(groups).cast("long")))
        .groupBy("task").applyInArrow(lambda t: _compare(t, width, least_cosine), "rep string, links long, reached string"))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("rep").alias("a"), F.col("reached").alias("b")), "a", "b")
    reps = (
        distinct.select("rep", "copies").join(links, "rep", "left")
        .join(parts.withColumnRenamed("node", "rep"), "rep", "left")
        .select(F.col("rep").alias("_rep"), F.coalesce("component", "rep").alias("_component"),
                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("_links")))
    joined = rows.select("vec_id", "rep").join(reps, F.col("rep") == F.col("_rep"), "left")
    least = joined.where("_component is not null").groupBy("_component").agg(F.min("vec_id").alias("_least")).withColumnRenamed("_component", "_c")
    return (
        joined.join(least, F.col("_component") == F.col("_c"), "left")
        .select("vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("_least", "vec_id").alias("component_id"))
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def _entries(distinct: DataFrame, model, width: int) -> DataFrame:
    """Table entries with two vectors or more, cut into pairs of blocks: one row
    a vector and pair of blocks it takes part in."""

    def run(batches):
        mean, rotations = model.value
        for batch in batches:
            keys = code_keys(_units(batch.column("vector"), width), mean, rotations)
            offsets = np.arange(len(keys) + 1) * keys.shape[1]
            listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys.ravel(), pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, listed], [*batch.schema.names, "keys"])

    label = distinct.schema["label"].dataType.simpleString()
    coded = distinct.select("rep", "label", "vector", "copies").mapInArrow(
        run, f"rep string, label {label}, vector array<double>, copies long, keys array<int>")
    placed = coded.select("*", F.posexplode("keys").alias("slot", "key")).withColumn(
        "entry", F.concat_ws("/", F.col("label").cast("string"), F.size("vector"), "slot", "key"))
    counts = placed.groupBy("entry").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.count("*").alias("n")).where("n > 1")
    own = F.pmod(F.xxhash64("rep", "slot"), F.col("blocks").cast("long")).cast("int")
    return (
        placed.join(counts, "entry").withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("entry", "slot", "rep", "vector", "copies", "keys", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")))


def op3_quantised_vectors(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op3_quantised_vectors": op3_quantised_vectors}
# Compares all vectors of a label.
ORACLE_SQL = {"op3_quantised_vectors": f"""
WITH RECURSIVE valid AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
link AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}),
reach(a, b) AS (SELECT vec_id, vec_id FROM valid UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN n USING (vec_id)
"""}
