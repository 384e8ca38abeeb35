"""Language-model scores by context-tree weighting.

A text is its words in lower case, each followed by a space, and an end byte.
Every byte is eight binary decisions; each decision has a context tree over the
bytes before it, with a Krichevsky-Trofimov estimate at every node (Willems,
Shtarkov and Tjalkens, 1995). The weighted probability of a node mixes its own
estimate with the product of its children's, half and half, so a text is priced
by all depths from 0 to DEPTH at once, by how well each did in training. A
context never seen in training adds nothing: its parent's estimate stands in.

Training and scoring work on distinct (context, byte) grams:

* every chunk of rows sends its distinct grams with their training counts;
  counts are summed by gram;
* the trees are weighted bottom-up in groups of grams with the same two last
  bytes, and above them over sums of at most 256 * 255 rows, the only data that
  comes to the driver;
* each gram's code length goes back to the chunks that hold the gram, where it
  is summed by row.

All of it follows the input; nothing is pruned. The base score, from counts of
whole words, is exchanged the same way.

Defined results: a null or empty text is its end byte; a row without doc_id
trains; repeated rows count and score alike; without training rows every bit
costs one half; empty tables give no rows; other columns are not carried.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callcredit.llm.exchange import CHUNK_BYTES, Corpus, Places, pack, store_rows, stored, unpack
from callcredit.llm.repeats import _column
from callcredit.llm.storage import documents, staged
from callcredit.llm.words import Words, mixed, pieces

DEPTH = 5
FOLDS = 5
HELD_OUT_FOLD = 1
END = 0x0A
GRAMS, WORDS = "g", "w"
NUMBER = {GRAMS: "<f4", WORDS: "<f8"}  # code lengths, counts
SENT = "kind string, bucket int, chunk int, keys binary, counts binary"
REPLY = "kind string, chunk int, bucket int, keys binary, numbers binary"


def _stream(words: Words, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grams of all bytes to code, row by row, the row of each, and bytes a row.
    From the highest byte down a gram is the byte before, the one before that,
    and so on, and last the byte coded; before a text lie end bytes."""
    sizes = words.ends - words.starts + 1
    row_bytes = np.bincount(words.row, sizes, words.rows).astype(np.int64) + 1
    row_end = np.cumsum(row_bytes + depth)
    line = np.full(int(row_end[-1]) if words.rows else 0, END, np.uint8)
    to = np.cumsum(sizes) - sizes + words.row * (depth + 1) + depth
    inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.repeat(to, sizes) + inside
    last = inside == np.repeat(sizes - 1, sizes)
    line[at[last]] = 0x20
    line[at[~last]] = words.buf[(np.repeat(words.starts, sizes) + inside)[~last]]
    coded = np.ones(len(line), bool)
    front = row_end - row_bytes - depth
    for d in range(depth):
        coded[front + d] = False
    wide = line.astype(np.uint64)
    grams = wide[depth:].copy()
    for d in range(1, depth + 1):
        grams |= wide[depth - d:len(wide) - d] << np.uint64(8 * (depth + 1 - d))
    return grams[coded[depth:]], np.repeat(np.arange(words.rows), row_bytes), row_bytes


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values = np.sort(values)
    at = np.flatnonzero(np.append(True, values[1:] != values[:-1])[:len(values)])
    return values[at], np.diff(np.append(at, len(values)))


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, n = np.concatenate([np.zeros(0, np.uint64), *keys]), np.concatenate([np.zeros(0, np.int64), *counts])
    found, back = np.unique(every, return_inverse=True)
    return found, np.bincount(back, n, len(found)).astype(np.int64)


def _word_keys(words: Words) -> np.ndarray:
    return words.hashes() >> np.uint64(4)


def _tell(table: pa.Table, buckets: int, depth: int) -> pa.Table:
    """Distinct grams and words of a chunk with their training counts, by bucket."""
    train = table.column("trains").to_numpy(zero_copy_only=False)
    keys = {GRAMS: [], WORDS: []}
    counts = {GRAMS: [], WORDS: []}
    for at, end, words in pieces(_column(table), lower=True):
        grams, row, _ = _stream(words, depth)
        for kind, values, rows in ((GRAMS, grams, row), (WORDS, _word_keys(words), words.row)):
            known, _ = _counted(values)
            trained, n = _counted(values[train[at:end][rows]])
            keys[kind] += [known, trained]
            counts[kind] += [np.zeros(len(known), np.int64), n]
    chunk = table.column("chunk")[0].as_py()
    out = []
    for kind in (GRAMS, WORDS):
        found, n = _summed(keys[kind], counts[kind])
        bucket = (mixed(found) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in range(buckets):
            own = order[cuts[b]:cuts[b + 1]]
            if len(own):
                out.append({"kind": kind, "bucket": b, "chunk": chunk, "keys": pack(found[own]), "counts": n[own].astype("<u4").tobytes()})
    return pa.Table.from_pylist(out, pa.schema([("kind", pa.string()), ("bucket", pa.int32()), ("chunk", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]))


def _received(sent: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
    return [unpack(x.as_py()) for x in sent.column("keys")], [np.frombuffer(x.as_py(), "<u4").astype(np.int64) for x in sent.column("counts")]


def _totals(sent: pa.Table) -> pa.Table:
    keys, n = _summed(*_received(sent))
    return pa.table({"key": pa.array(keys.view(np.int64), pa.int64()), "n": pa.array(n, pa.int64())})


def _reply(kind: str, sent: pa.Table, keys: np.ndarray, numbers: np.ndarray) -> pa.Table:
    """Each chunk's keys with their numbers; ``keys`` are sorted."""
    blobs = [unpack(x.as_py()) for x in sent.column("keys")]
    found = [numbers[np.searchsorted(keys, b)].astype(NUMBER[kind]).tobytes() for b in blobs]
    return pa.table({"kind": pa.array([kind] * len(blobs), pa.string()), "chunk": sent.column("chunk"), "bucket": sent.column("bucket"),
                     "keys": sent.column("keys"), "numbers": pa.array(found, pa.binary())})


# --- the trees -------------------------------------------------------------

def _log_gamma_half(n: np.ndarray) -> np.ndarray:
    """log of 1/2 * 3/2 * ... * (n - 1/2), for counts of any size."""
    top = np.minimum(n, 255)
    table = np.append(0.0, np.cumsum(np.log(np.arange(255) + 0.5)))
    x = n + 0.5
    series = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x ** 3) - 0.5 * math.log(math.pi)
    return np.where(n <= 255, table[top], series)


def _log_factorial(n: np.ndarray) -> np.ndarray:
    top = np.minimum(n, 255)
    table = np.append(0.0, np.cumsum(np.log(np.arange(1, 256))))
    x = n + 1.0
    series = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x ** 3)
    return np.where(n <= 255, table[top], series)


def _kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return _log_gamma_half(n0) + _log_gamma_half(n1) - _log_factorial(n0 + n1)


def _estimate(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return (n1 + 0.5) / (n0 + n1 + 1)


class _Level:
    """Nodes of one depth and bit: sorted (context, bit prefix) keys."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, bit: int):
        """``keys`` are sorted (context, byte) keys with their counts."""
        sym = keys & np.uint64(255)
        node = keys >> np.uint64(8) << np.uint64(8) | np.uint64(1 << bit) | sym >> np.uint64(8 - bit)
        begins = np.append(True, node[1:] != node[:-1])[:len(node)]
        at = np.flatnonzero(begins)
        self.keys, self.of = node[at], np.cumsum(begins) - 1
        ones = (sym >> np.uint64(7 - bit) & np.uint64(1)).astype(np.int64)
        self.n1 = np.add.reduceat(n * ones, at) if len(at) else np.zeros(0, np.int64)
        self.n0 = (np.add.reduceat(n, at) if len(at) else np.zeros(0, np.int64)) - self.n1
        self.own = _kt(self.n0, self.n1)
        self.weighted, self.stop = self.own, None

    def weigh(self, below: np.ndarray) -> None:
        """Mixes the own estimate with the children's product (its log)."""
        self.weighted = np.logaddexp(self.own, below) - math.log(2)
        self.stop = 1 / (1 + np.exp(np.clip(below - self.own, -700, 700)))


def _shorter(keys: np.ndarray) -> np.ndarray:
    """(context, byte or bit prefix) keys without the furthest context byte."""
    return keys >> np.uint64(16) << np.uint64(8) | keys & np.uint64(255)


def _subtrees(keys: np.ndarray, n: np.ndarray, depth: int) -> tuple[list[list[_Level]], list[np.ndarray]]:
    """Weighted levels[d - 2][bit] for the depths d from 2 to ``depth``, and for
    each depth the place of every gram among its (context, byte) keys."""
    tables, places = [(keys, n)], [np.arange(len(keys))]
    for _ in range(depth - 2):
        upper, back = np.unique(_shorter(tables[-1][0]), return_inverse=True)
        tables.append((upper, np.bincount(back, tables[-1][1], len(upper)).astype(np.int64)))
        places.append(back[places[-1]])
    levels: list[list[_Level]] = []
    for k, m in tables:
        own = [_Level(k, m, bit) for bit in range(8)]
        if levels:
            for bit in range(8):
                child = levels[-1][bit]
                into = np.searchsorted(own[bit].keys, _shorter(child.keys))
                own[bit].weigh(np.bincount(into, child.weighted, len(own[bit].keys)))
        levels.append(own)
    return levels[::-1], places[::-1]


def _roots(table: pa.Table, depth: int) -> pa.Table:
    """Sums over a group's depth-2 nodes by last byte and bit prefix."""
    keys, n = _sorted_grams(table)
    levels, _ = _subtrees(keys, n, depth)
    parts = [(_shorter(x.keys), x.n0, x.n1, x.weighted) for x in levels[0]]
    key, n0, n1, w = (np.concatenate(x) for x in zip(*parts, strict=True))
    found, back = np.unique(key, return_inverse=True)
    return pa.table({"node": pa.array(found.astype(np.int64)), "n0": pa.array(np.bincount(back, n0).astype(np.int64)),
                     "n1": pa.array(np.bincount(back, n1).astype(np.int64)), "below": pa.array(np.bincount(back, w))})


def _sorted_grams(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys, n = table.column("key").to_numpy().view(np.uint64), table.column("n").to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


def _top(node: np.ndarray, n0: np.ndarray, n1: np.ndarray, below: np.ndarray) -> dict[str, np.ndarray]:
    """Estimates and stopping weights of all nodes of depths 0 and 1, by bit
    prefix and by last byte and bit prefix; nan for nodes never seen."""
    p1, stop1 = np.full(1 << 16, np.nan), np.full(1 << 16, np.nan)
    own = _kt(n0, n1)
    seen = n0 + n1 > 0
    p1[node[seen]] = _estimate(n0, n1)[seen]
    stop1[node[seen]] = (1 / (1 + np.exp(np.clip(below - own, -700, 700))))[seen]
    weighted = np.logaddexp(own, below) - math.log(2)
    prefix = node & 255
    m0, m1, w = np.bincount(prefix, n0, 256), np.bincount(prefix, n1, 256), np.bincount(prefix, weighted, 256)
    p0, stop0 = np.full(256, np.nan), np.full(256, np.nan)
    seen = m0 + m1 > 0
    p0[seen] = _estimate(m0, m1)[seen]
    stop0[seen] = (1 / (1 + np.exp(np.clip(w - _kt(m0.astype(np.int64), m1.astype(np.int64)), -700, 700))))[seen]
    return {"p0": p0, "stop0": stop0, "p1": p1, "stop1": stop1}


def _mix(p: np.ndarray, stop: np.ndarray, below: np.ndarray) -> np.ndarray:
    """A node's prediction from its estimate and its child's; nan: never seen."""
    return np.where(np.isnan(below), p, stop * p + (1 - stop) * below)


def _priced(keys: np.ndarray, n: np.ndarray, top: dict[str, np.ndarray], depth: int) -> np.ndarray:
    """log10 probability of each gram's byte in its context."""
    levels, places = _subtrees(keys, n, depth)
    total = np.zeros(len(keys))
    sym = keys & np.uint64(255)
    byte = (keys >> np.uint64(8 * depth)).astype(np.int64)
    for bit in range(8):
        below = np.full(len(keys), np.nan)
        for own, place in zip([x[bit] for x in levels[::-1]], places[::-1], strict=True):
            at = own.of[place]
            many = (own.n0 + own.n1)[at]
            p = np.where(many > 0, _estimate(own.n0, own.n1)[at], np.nan)
            below = p if own.stop is None else _mix(p, own.stop[at], below)
        prefix = (1 << bit) | (sym >> np.uint64(8 - bit)).astype(np.int64)
        below = _mix(top["p1"][byte << 8 | prefix], top["stop1"][byte << 8 | prefix], below)
        below = _mix(top["p0"][prefix], top["stop0"][prefix], below)
        one = np.where(np.isnan(below), 0.5, below)
        total += np.log10(np.where(sym >> np.uint64(7 - bit) & np.uint64(1), one, 1 - one))
    return total


# --- scoring ---------------------------------------------------------------

def _score(table: pa.Table, replies: pa.Table, depth: int, n_tokens: int, vocabulary: int, ends: int) -> pa.Table:
    kinds = np.array(replies.column("kind").to_pylist(), object)

    def of(kind: str) -> tuple[Places, np.ndarray]:
        at = np.flatnonzero(kinds == kind)
        keys = [unpack(replies.column("keys")[int(i)].as_py()) for i in at]
        numbers = [np.frombuffer(replies.column("numbers")[int(i)].as_py(), NUMBER[kind]).astype(np.float64) for i in at]
        keys, numbers = np.concatenate([np.zeros(0, np.uint64), *keys]), np.concatenate([np.zeros(0), *numbers])
        order = np.argsort(keys)
        return Places(keys[order]), numbers[order]

    grams, prices = of(GRAMS)
    vocab, counts = of(WORDS)
    below = n_tokens + 0.5 * (vocabulary + 1)
    out: dict[str, list] = {k: [] for k in ("n_tokens", "n_known", "base_score", "score", "n_bytes")}
    for _, _, words in pieces(_column(table), lower=True) if table.num_rows else ():
        values, row, row_bytes = _stream(words, depth)
        c = counts[vocab.of(_word_keys(words))] if len(counts) else np.zeros(0)
        out["n_tokens"].append(words.count + 1)
        out["n_known"].append(np.bincount(words.row, c > 0, words.rows).astype(np.int64) + (ends > 0))
        out["base_score"].append(np.bincount(words.row, np.log10((c + 0.5) / below), words.rows) + math.log10((ends + 0.5) / below))
        out["score"].append(np.bincount(row, prices[grams.of(values)], words.rows))
        out["n_bytes"].append(row_bytes)
    joined = {k: np.concatenate(v) if v else np.zeros(0) for k, v in out.items()}
    longs = ("n_tokens", "n_known", "n_bytes")
    return pa.table({"doc_id": table.column("doc_id") if table.num_rows else pa.array([], pa.int64()),
                     "trains": table.column("trains") if table.num_rows else pa.array([], pa.bool_()),
                     **{k: pa.array(v.astype(np.int64 if k in longs else np.float64)) for k, v in joined.items()}})


def lm_scores(rows: DataFrame, depth: int = DEPTH, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Scores of (doc_id, trains, text) rows by the model of those that train."""
    if not 2 <= depth <= 6:
        raise ValueError("depth must be 2 to 6")
    spark = rows.sparkSession
    corpus: Corpus = store_rows(rows, chunk_bytes)
    buckets = corpus.chunks
    sent, _ = stored(corpus.texts.groupBy("chunk").applyInArrow(lambda t: _tell(t, buckets, depth), SENT), "bucket", buckets)
    grams = sent.where(F.col("kind") == GRAMS)
    words = sent.where(F.col("kind") == WORDS)
    totals = staged(grams.groupBy("bucket").applyInArrow(_totals, "key long, n long"))
    group = F.shiftright("key", 8 * (depth - 1)).alias("last_two")
    roots = totals.groupBy(group).applyInArrow(lambda t: _roots(t, depth), "node long, n0 long, n1 long, below double") \
        .groupBy("node").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("below").alias("below")).toPandas()
    top = spark.sparkContext.broadcast(_top(*[roots[c].to_numpy() for c in ("node", "n0", "n1", "below")]))

    def price(t: pa.Table) -> pa.Table:
        keys, n = _sorted_grams(t)
        bucket = (mixed(keys) % np.uint64(buckets)).astype(np.int32)
        return pa.table({"bucket": pa.array(bucket), "key": pa.array(keys.view(np.int64)), "price": pa.array(_priced(keys, n, top.value, depth))})

    prices = totals.groupBy(group).applyInArrow(price, "bucket int, key long, price double")

    def reply_prices(asked: pa.Table, known: pa.Table) -> pa.Table:
        keys = known.column("key").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        return _reply(GRAMS, asked, keys[order], known.column("price").to_numpy()[order])

    def reply_counts(asked: pa.Table) -> pa.Table:
        return _reply(WORDS, asked, *_summed(*_received(asked)))

    replies = grams.groupBy("bucket").cogroup(prices.groupBy("bucket")).applyInArrow(reply_prices, REPLY).unionByName(
        words.groupBy("bucket").applyInArrow(reply_counts, REPLY))
    known = words.groupBy("bucket").applyInArrow(_totals, "key long, n long").agg(
        F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    ends = corpus.texts.where("trains").count()
    n_tokens, vocabulary = (known["n"] or 0) + ends, (known["v"] or 0) + (ends > 0)
    scored = corpus.texts.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        lambda t, r: _score(t, r, depth, n_tokens, vocabulary, ends),
        "doc_id long, trains boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long")
    return scored.withColumn("train_tokens", F.lit(n_tokens).cast("long")).withColumn(
        "bits_per_byte", -F.col("score") * math.log2(10) / F.col("n_bytes"))


def op2_context_tree(spark, sf_dir: str) -> DataFrame:
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS, F.lit(0))
    rows = documents(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), (fold != HELD_OUT_FOLD).alias("trains"), "text")
    return lm_scores(rows).select(
        "doc_id", (~F.col("trains")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


QUERIES = {"op2_context_tree": op2_context_tree}
ORACLE_SQL: dict[str, str] = {}
