"""Quality rules of documents, judged again for whole hosts.

Every text is measured: words, characters in words, symbols, repeated lines
and words in repeated 8-word windows. Four rules may fail: too few words, too
many repeated words, too many symbols a word, too many repeated lines. Failures
are summed by host (the source), and each rule's rate is shrunk towards the
corpus by a beta prior fitted to the hosts by moments, less the noise of small
hosts: a host with few rows needs more evidence. A host whose shrunk rate passes ``max_rate`` for any rule
is rejected with all its documents; other documents stay unless they failed
the base rules (words, repeated words) themselves.

Rows cross to Python in Arrow batches for measuring; the rest is DataFrame
work. Sums are made before the shuffle, so a hot host costs one row a task.
The prior is two numbers a rule. Defined results: a null, empty or wordless
text has zeros everywhere and fails the base rules; null is a host of its own;
repeated rows count each; empty tables give no rows; other columns are not
carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callcredit.llm.storage import documents, staged, texts_in_small_batches
from callcredit.llm.words import Words, per_row, pieces, segment_hashes

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
MAX_HOST_RATE = 0.5
RULES = ("short", "repeats", "symbols", "lines")

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True

MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


def _later_copies(keys: np.ndarray) -> np.ndarray:
    """True where a key equals an earlier one."""
    _, first = np.unique(keys, return_index=True)
    later = np.ones(len(keys), bool)
    later[first] = False
    return later


def _repeated_lines(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those of them equal to an earlier line, by row."""
    breaks = np.flatnonzero(words.buf == 0x0A)
    starts = np.union1d(words.offsets[:-1], breaks + 1)
    starts = starts[starts < len(words.buf)]
    ends = np.minimum(np.append(starts[1:], len(words.buf)), np.append(breaks, len(words.buf))[np.searchsorted(breaks, starts)])
    worded = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[worded], ends[worded]
    row = np.searchsorted(words.offsets, starts, "right") - 1
    lines = segment_hashes(words.buf, starts, ends)
    later = _later_copies(_of_row(lines, row))
    return per_row(np.ones(len(row)), row, words.rows), per_row(later, row, words.rows)


def _of_row(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    return hashes ^ (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _repeated_words(words: Words, k: int) -> np.ndarray:
    """Words in k-word windows that the text has twice or more, by row."""
    keys, at = words.windows(words.hashes(), k)
    _, same, times = np.unique(_of_row(keys, words.row[at]), return_inverse=True, return_counts=True)
    hit = at[times[same] > 1]
    cover = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + k, -1)
    return per_row(np.cumsum(cover)[:-1] > 0, words.row, words.rows)


def _measure(words: Words) -> list[np.ndarray]:
    row_of_byte = lambda mask: np.diff(np.append(0, np.cumsum(mask))[words.offsets])
    n_lines, n_dup = _repeated_lines(words)
    return [words.count, row_of_byte(words.inside & ((words.buf & 0xC0) != 0x80)), row_of_byte(SYMBOL[words.buf]),
            n_lines, n_dup, _repeated_words(words, WINDOW)]


def measures(docs: DataFrame, host_col: str = "source") -> DataFrame:
    """doc_id, host and the measures of every text."""
    names = [x.split()[0] for x in MEASURES.split(", ")]

    texts_in_small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            parts = [_measure(w) for _, _, w in pieces(batch.column("text"))]
            found = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0)] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("host"), *[pa.array(x, pa.int64()) for x in found]], ["doc_id", "host", *names])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"), "text") \
        .mapInArrow(run, f"doc_id long, host string, {MEASURES}")


def rule_failures(measured: DataFrame) -> DataFrame:
    n = F.col("n_words")
    return measured.withColumns({
        "short": n < MIN_WORDS,
        "repeats": F.col("n_repeat_words") * 100 > n * MAX_REPEAT_PERCENT,
        "symbols": F.col("n_symbols") * 100 > n * MAX_SYMBOL_PERCENT,
        "lines": F.col("n_dup_lines") * 100 > F.col("n_lines") * MAX_DUP_LINE_PERCENT})


def beta_prior(hosts: DataFrame, rule: str) -> tuple[float, float]:
    """Prior failures and passes of a rule, by the moments of the hosts' rates.

    Rates of hosts that are all alike spread too, as each is a mean of few rows;
    that sampling noise is taken off, and only what is left tells hosts apart.
    """
    one = hosts.agg(F.try_divide(F.sum(rule), F.sum("n")).alias("m"), F.count("*").alias("k"), F.sum("n").alias("n")).first()
    mean = one["m"]
    if mean is None:
        return 1.0, 1.0
    gap = F.col(rule) / F.col("n") - mean
    spread = hosts.agg((F.sum(F.col("n") * gap * gap) / F.sum("n")).alias("v")).first()["v"]
    spread -= mean * (1 - mean) * (one["k"] - 1) / one["n"]
    strength = min(max(mean * (1 - mean) / spread - 1, 1.0), 1e6) if spread > 0 else 1e6
    return mean * strength, (1 - mean) * strength


def host_verdicts(failures: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(host, n, a shrunk rate per rule, host_kept)."""
    hosts = staged(failures.groupBy("host").agg(F.count("*").alias("n"), *[F.sum(F.col(r).cast("long")).alias(r) for r in RULES]))
    rates = {}
    for rule in RULES:
        a, b = beta_prior(hosts, rule)
        rates[f"{rule}_rate"] = (F.col(rule) + a) / (F.col("n") + a + b)
    judged = hosts.withColumns(rates)
    return judged.select("host", "n", *rates, (F.greatest(*rates) <= max_rate).alias("host_kept"))


def judge_documents(docs: DataFrame, max_rate: float = MAX_HOST_RATE, host_col: str = "source") -> DataFrame:
    """The measures of every document, base_failed, kept and the host's rates."""
    failures = rule_failures(staged(measures(docs, host_col)))
    hosts = host_verdicts(failures, max_rate).withColumnRenamed("host", "_host")
    base = F.col("short") | F.col("repeats")
    return (
        failures.join(hosts, F.col("host").eqNullSafe(F.col("_host")))
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                base.alias("base_failed"), (~base & F.col("host_kept")).alias("kept"), "n_lines", "host_kept"))


def op10_host_rules(spark, sf_dir: str) -> DataFrame:
    return judge_documents(documents(spark, sf_dir))


QUERIES = {"op10_host_rules": op10_host_rules}

_RATE_SQL = "({r} + m_{r} * s_{r}) / (n + s_{r})"
ORACLE_SQL = {"op10_host_rules": f"""
WITH doc AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS body FROM documents),
split AS (SELECT *, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') AS w FROM doc),
word AS (SELECT rid, unnest(range(len(w))) AS i, unnest(w) AS word FROM split),
win AS (
    SELECT rid, i, list(word) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS g FROM word),
twice AS (SELECT rid, i FROM win WHERE len(g) = {WINDOW} QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
rep AS (
    SELECT rid, count(*) AS n_repeat_words
    FROM (SELECT DISTINCT rid, unnest(range(i, i + {WINDOW})) FROM twice) GROUP BY rid),
line AS (
    SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT rid, unnest(string_split(body, chr(10))) AS line FROM doc)
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
measure AS (
    SELECT rid, doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
           length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
           coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
    FROM split LEFT JOIN rep USING (rid) LEFT JOIN line USING (rid)),
failed AS (
    SELECT *, (n_words < {MIN_WORDS})::INT AS short, (n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT})::INT AS repeats,
           (n_symbols * 100 > n_words * {MAX_SYMBOL_PERCENT})::INT AS symbols,
           (n_dup_lines * 100 > n_lines * {MAX_DUP_LINE_PERCENT})::INT AS lines FROM measure),
host AS (SELECT source, count(*) AS n, {', '.join(f'sum({r}) AS {r}' for r in RULES)} FROM failed GROUP BY source),
mean AS (SELECT {', '.join(f'sum({r}) / sum(n) AS m_{r}' for r in RULES)} FROM host),
spread AS (
    SELECT {', '.join(f'any_value(m_{r}) AS m_{r}, sum(n * ({r} / n - m_{r}) ** 2) / sum(n) - any_value(m_{r}) * (1 - any_value(m_{r})) * (count(*) - 1) / sum(n) AS v_{r}' for r in RULES)}
    FROM host, mean),
prior AS (
    SELECT {', '.join(f'm_{r}, CASE WHEN v_{r} > 0 THEN least(greatest(m_{r} * (1 - m_{r}) / v_{r} - 1, 1), 1e6) ELSE 1e6 END AS s_{r}' for r in RULES)}
    FROM spread),
verdict AS (
    SELECT source, greatest({', '.join(_RATE_SQL.format(r=r) for r in RULES)}) <= {MAX_HOST_RATE} AS host_kept FROM host, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short + repeats > 0 AS base_failed,
       short + repeats = 0 AND host_kept AS kept, n_lines, host_kept
FROM failed JOIN verdict ON failed.source IS NOT DISTINCT FROM verdict.source
"""}
