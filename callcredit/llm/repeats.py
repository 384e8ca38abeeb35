"""Substring dedup by fixed-block anchors.

Every run of WINDOW equal words holds one of the non-overlapping BLOCK-word
blocks of each text it is in, since 2 * BLOCK - 1 <= WINDOW. The hashes of
these reference blocks are indexed and probed with every rolling window of
BLOCK words of every text; hits show where a repeat may be. Around hits, all
windows of WINDOW words are then compared over the corpus by their full hashes,
and runs of repeated windows are the maximal exact repeats. Words are compared
as they are; judgement is on the input, so all copies of a repeat go.

Equal texts are one row, whose windows all repeat if two documents have it.
Both questions go through ``exchange``: a window is sent once a chunk, so one
that a third of all documents share costs one entry a chunk.

Defined results: null, empty and short texts lose nothing; a text that repeats
a passage inside itself loses all of its copies; repeated rows are copies of
each other; an empty table gives no rows; added columns replace input columns
of their names, others stay.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callcredit.llm.exchange import (
    Answers,
    Corpus,
    ask,
    ask_again,
    distinct_flagged,
    short,
    store_texts,
    text_key,
    with_answers,
)
from callcredit.llm.storage import documents
from callcredit.llm.words import Words, pieces, window_hashes

WINDOW = 35
BLOCK = 18
FULL_BITS = 58


def _column(table: pa.Table, name: str = "text") -> pa.Array:
    column = table.column(name).cast(pa.large_string()).combine_chunks()
    return column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)


class _Hashed:
    """Words of a chunk's texts with their hashes, piece by piece joined."""

    def __init__(self, table: pa.Table):
        rows, hashes = [], []
        for at, _, words in pieces(_column(table)):
            rows.append(words.row + at)
            hashes.append(words.hashes())
        self.row = np.concatenate([np.zeros(0, np.int64), *rows])
        self.hash = np.concatenate([np.zeros(0, np.uint64), *hashes])
        self.first = np.searchsorted(self.row, np.arange(table.num_rows + 1))

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every window of k words inside a text, and its first word."""
        if len(self.hash) < k:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.row[:len(self.row) - k + 1] == self.row[k - 1:])
        return window_hashes(self.hash, k)[at], at


def _probes(table: pa.Table, bits: int, block: int) -> np.ndarray:
    words = _Hashed(table)
    keys, at = words.windows(block)
    return distinct_flagged(short(keys, bits), (at - words.first[words.row[at]]) % block == 0)


def _candidates(words: _Hashed, hits: Answers, bits: int, window: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Full hashes and first words of the windows that hold a hit."""
    keys, at = words.windows(block)
    hit = np.zeros(len(words.hash) + 1, np.int64)
    hit[at[hits.level_of(short(keys, bits)) >= 0]] = 1
    before = np.append(0, np.cumsum(hit))
    keys, at = words.windows(window)
    near = before[at + window - block + 1] > before[at]
    return keys[near], at[near]


def _seen_twice(times: np.ndarray, flagged: np.ndarray) -> np.ndarray:
    return times > 1


def _block_seen_twice(times: np.ndarray, flagged: np.ndarray) -> np.ndarray:
    return (times > 1) & flagged


def repeated_spans(corpus: Corpus, window: int = WINDOW) -> DataFrame:
    """(key, n_words, n_removed, spans, kept) of every stored text: the maximal
    repeats as [first word, end word) and the other words joined by one space."""
    block, bits = (window + 1) // 2, corpus.bits
    full = Corpus(corpus.texts, corpus.chunks, FULL_BITS)
    hits = ask(corpus, lambda t: _probes(t, bits, block), _block_seen_twice)

    def exact(table: pa.Table, known: Answers) -> np.ndarray:
        keys, _ = _candidates(_Hashed(table), known, bits, window, block)
        return distinct_flagged(short(keys, FULL_BITS))

    repeats = ask_again(full, hits, exact, _seen_twice)

    def cut(table: pa.Table, known: Answers) -> pa.Table:
        out: dict[str, list] = {"key": table.column("key").to_pylist() if table.num_rows else [], "n_words": [], "n_removed": [], "spans": [], "kept": []}
        for _, _, words in pieces(_column(table)) if table.num_rows else ():
            _cut_piece(words, known, window, out)
        return pa.table({"key": pa.array(out["key"], pa.string()), "n_words": pa.array(out["n_words"], pa.int64()),
                         "n_removed": pa.array(out["n_removed"], pa.int64()),
                         "spans": pa.array(out["spans"], pa.list_(pa.list_(pa.int64()))),
                         "kept": pa.array(out["kept"], pa.binary()).cast(pa.string())})

    return with_answers(full, repeats, cut, "key string, n_words long, n_removed long, spans array<array<long>>, kept string")


def _cut_piece(words: Words, known: Answers, window: int, out: dict[str, list]) -> None:
    keys, at = words.windows(words.hashes(), window)
    hit = at[known.level_of(short(keys, FULL_BITS)) >= 0]
    step = np.zeros(len(words.starts) + 1, np.int64)
    step[hit] += 1
    np.add.at(step, hit + window, -1)
    gone = np.cumsum(step)[:-1] > 0
    edge = np.append(True, words.row[1:] != words.row[:-1])[:len(gone)]
    begins = np.flatnonzero(gone & (edge | ~np.append(False, gone[:-1])[:len(gone)]))
    removed = np.append(0, np.cumsum(gone))
    # Kept words move up, each followed by a space, in one pass over the piece.
    stay = ~gone
    starts, sizes = words.starts[stay], (words.ends - words.starts)[stay]
    to = np.cumsum(sizes + 1) - sizes - 1
    line = np.full(int(sizes.sum()) + len(sizes), 0x20, np.uint8)
    inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    line[np.repeat(to, sizes) + inside] = words.buf[np.repeat(starts, sizes) + inside]
    line = line.tobytes()
    ends = np.append(to, len(line))
    kept_before = np.append(0, np.cumsum(stay))
    for r in range(words.rows):
        a, b = int(words.first[r]), int(words.first[r + 1])
        spans = []
        for s in begins[np.searchsorted(begins, a):np.searchsorted(begins, b)].tolist() if removed[b] > removed[a] else ():
            more = np.flatnonzero(~gone[s:b])
            spans.append([s - a, int(more[0]) + s - a if len(more) else b - a])
        out["n_words"].append(b - a)
        out["n_removed"].append(int(removed[b] - removed[a]))
        out["spans"].append(spans)
        out["kept"].append(line[ends[kept_before[a]]:max(int(ends[kept_before[a]]), int(ends[kept_before[b]]) - 1)])


def removal(docs: DataFrame, window: int = WINDOW, of_kept: Callable[[Column], Column] = lambda c: c, of_gone: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """``docs`` with their text key (``_key``), and per key the words removed
    and ``of_kept(kept text)``, which is ``of_gone`` (an empty text) of texts
    that two rows have and that have a window: they lose everything."""
    of_gone = F.lit("") if of_gone is None else of_gone
    found = repeated_spans(store_texts(docs), window).withColumn("kept", of_kept(F.col("kept")))
    keyed = docs.withColumn("_key", text_key(F.col("text")))
    twice = keyed.groupBy("_key").agg(F.count("*").alias("_copies"))
    all_gone = (F.col("_copies") > 1) & (F.col("n_words") >= window)
    results = found.join(twice, F.col("key") == F.col("_key")).select(
        "_key", "n_words",
        F.when(all_gone, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(all_gone, F.array(F.array(F.lit(0).cast("long"), F.col("n_words")))).otherwise(F.col("spans")).alias("spans"),
        F.when(all_gone, of_gone).otherwise(F.col("kept")).alias("kept"))
    return keyed, results


def op8_block_anchors(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed, results = removal(docs, of_kept=lambda c: F.sha2(c, 256), of_gone=F.sha2(F.lit(""), 256))
    digests = results.select("_key", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))
    return keyed.select("doc_id", "_key").join(digests, "_key").drop("_key")


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with their columns; texts that hold repeats become their kept
    words joined by one space, and n_chars, if there, is counted again."""
    packed = docs.select(F.struct(*docs.columns).alias("_row"), "text")  # whatever the columns are named
    keyed, results = removal(packed, window, of_kept=lambda c: F.when(F.col("n_removed") > 0, c))
    changed = results.where("n_removed > 0").select("_key", F.col("kept").alias("_kept"))
    cells = {c: F.col(f"_row.{c}") for c in docs.columns} | {"text": F.coalesce("_kept", "_row.text")}
    if "n_chars" in cells:
        n_chars = F.char_length("_kept").cast(docs.schema["n_chars"].dataType)
        cells["n_chars"] = F.when(F.col("_kept").isNotNull(), n_chars).otherwise(F.col("_row.n_chars"))
    return keyed.select("_key", "_row").join(changed, "_key", "left").select([cells[c].alias(c) for c in docs.columns])


QUERIES = {"op8_block_anchors": op8_block_anchors}
# Compares every window as a list of words.
ORACLE_SQL = {"op8_block_anchors": f"""
WITH doc AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT rid, unnest(range(1, len(w) - {WINDOW} + 2)) AS i FROM doc WHERE len(w) >= {WINDOW}),
hashed AS (SELECT rid, i, md5(array_to_string(w[i:i + {WINDOW} - 1], ' ')) AS g FROM win JOIN doc USING (rid)),
twice AS (SELECT g FROM hashed GROUP BY g HAVING count(*) > 1),
gone AS (
    SELECT DISTINCT rid, j FROM (SELECT rid, unnest(range(i, i + {WINDOW})) AS j FROM hashed WHERE g IN (SELECT g FROM twice))),
kept AS (
    SELECT rid, string_agg(word, ' ' ORDER BY j) AS line
    FROM (SELECT rid, unnest(range(1, len(w) + 1)) AS j, unnest(w) AS word FROM doc) ANTI JOIN gone USING (rid, j) GROUP BY rid),
cut AS (SELECT rid, count(*) AS n_removed FROM gone GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(line, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (rid) LEFT JOIN cut USING (rid)
"""}
