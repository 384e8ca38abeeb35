"""Mixing sources to target weights by Sainte-Lague apportionment.

A source's words, laid out document by document in a seeded order, are cut into
equal blocks that fit the source: a 1/FINENESS of it, at most BLOCK_WORDS and at
least one word. Its target in blocks are its votes. The house has as many seats
as all votes together, and Sainte-Lague gives each seat, one block, to the
source with the highest quotient votes / (2k + 1), k being the seats it already
has. The method is house-monotone, so the seats of the first output shards are
those of a smaller house, and a shard's quota of a source is the difference of
two running numbers.

A source's quota is then taken in one go around the source, from a block chosen
by the seed: the seeded order makes that a random choice of documents, whole but
for the first and the last one. A quota of more than the source goes around
again. So the words taken are the quota's, MOST times the source's at most, and
every word of the run has its place in an output shard.

All of it is DataFrame expressions. No task holds a source or all sources:
places in the seeded order come from sums of (source, hash prefix) groups and a
window inside each group; sources are ranked, and contested seats placed, by
numbering range-partitioned slices; the level of the targets comes from a few
sums. Rows with equal id and text share a group.

Defined results: a null or wordless text has size 0 and is taken 0 times; null
is a source of its own, last in order; repeated rows have places of their own;
a text of any length is one row; empty tables give no rows; other input columns
never clash, as all working columns start with an underscore and carried columns
are packed in one struct.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callcredit.llm.storage import documents, staged
from callcredit.operators.windows import sequence_ids

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 64
FINENESS = 64
VOTES = 1024  # votes are counted in such parts of a block
MIX_SHARDS = 8
SEED = 17
ROWS_PER_GROUP = 20_000

WORD = r"[^\x20\x09-\x0D]+"


def _source_targets(sizes: DataFrame, weights, share: float, most: int) -> DataFrame:
    """(_source, _rank, _source_size, _target): targets by weight, stopped at
    ``most`` times a source's size with the excess reshared by weight."""
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    ranked = staged(
        sequence_ids(sizes, [], [F.col("_source").asc_nulls_last()], "_rank")
        .withColumn("_weight", w)
        .withColumn("_cap", (F.col("_source_size") * most).cast("double")))
    total = float(ranked.agg(F.sum("_source_size")).first()[0] or 0) * share
    # What is left for the sources that aren't full, a unit of weight. It only
    # rises while sources fill up, so this ends.
    level, full = None, F.lit(False)
    while True:
        caps, open_weight = ranked.agg(F.sum(F.when(full, F.col("_cap"))), F.sum(F.when(~full, F.col("_weight")))).first()
        if not open_weight:
            level = math.inf
            break
        now = (total - (caps or 0.0)) / open_weight
        if now == level:
            break
        level, full = now, F.col("_cap") < F.col("_weight") * now
    return ranked.select("_source", "_rank", "_source_size", F.least("_cap", F.lit(level) * F.col("_weight")).alias("_target"))


def block_quotas(targets: DataFrame, block_words: int = BLOCK_WORDS, shards: int = MIX_SHARDS) -> DataFrame:
    """(_rank, _block, _seats): the words of a source's blocks, and its
    Sainte-Lague seats in the first, the first two, ... output shards together.

    Only contested seats are ranked. With S sources, a divisor that gives
    H - S/2 - 1 (H + S/2 + 1) seats by exact shares gives every source no more
    (no fewer) seats than it gets among H, so about 2 S quotients lie between.
    """
    voting = staged(
        targets.where(F.col("_target") > 0)
        .withColumn("_block", F.greatest(F.least(F.expr(f"_source_size div {FINENESS}"), F.lit(block_words)), F.lit(1)).cast("long"))
        .withColumn("_votes", F.floor(F.col("_target") * VOTES / F.col("_block")).cast("long"))
        .select("_rank", "_block", "_votes"))
    sums = voting.agg(F.sum("_votes").alias("votes"), F.count("*").alias("sources")).first()
    votes, slack = sums["votes"] or 0, sums["sources"] / 2 + 1
    houses = [votes // VOTES * k // shards for k in range(1, shards + 1)]
    share = F.col("_votes") / F.lit(max(1, votes))
    held = (
        voting.withColumn("_shard", F.explode(F.sequence(F.lit(1), F.lit(shards))))
        .withColumn("_house", F.element_at(F.array(*[F.lit(h).cast("long") for h in houses]), F.col("_shard")))
        .withColumn("_high", F.ceil((F.col("_house") + slack) * share + 0.5).cast("long"))
        .withColumn("_low", F.greatest(F.floor((F.col("_house") - slack) * share - 0.5).cast("long"), F.lit(0))))
    held = staged(held)
    safe = {r["_shard"]: r["n"] for r in held.groupBy("_shard").agg(F.sum("_low").alias("n")).collect()}  # one row a shard
    contested = F.element_at(F.array(*[F.lit(h - safe.get(k + 1, 0)).cast("long") for k, h in enumerate(houses)]), F.col("_shard"))
    quotients = (
        held.select("_shard", "_rank", "_votes", F.explode(F.expr("sequence(_low, _high - 1)")).alias("_k"))
        .withColumn("_quotient", F.col("_votes") / (F.col("_k") * 2 + 1)))
    placed = sequence_ids(quotients, ["_shard"], [F.desc("_quotient"), F.asc("_rank"), F.asc("_k")], "_place")
    won = placed.where(F.col("_place") <= contested).groupBy("_shard", "_rank").agg(F.count("*").alias("_won"))
    seats = held.join(won, ["_shard", "_rank"], "left").withColumn("_n", F.col("_low") + F.coalesce("_won", F.lit(0)))
    of_shard = F.array_sort(F.collect_list(F.struct("_shard", "_n")))  # one element a shard
    return seats.groupBy("_rank", "_block").agg(F.transform(of_shard, lambda x: x["_n"]).alias("_seats"))


def _met(low: Column, high: Column, start: Column, end: Column) -> Column:
    """Words of [low, high) that lie in [start, end)."""
    return F.greatest(F.least(high, end) - F.greatest(low, start), F.lit(0).cast("long"))


def _words_in_shard(shard: Column) -> Column:
    """Words of a document that the run puts into the output shard.

    Counted from the run's start, a document lies at [_at, _at + size), and the
    part beyond the source's end at its beginning; once more in every round."""
    start = F.coalesce(F.get("_ends", shard - 2), F.lit(0).cast("long"))
    end, n = F.element_at("_ends", shard), F.col("_source_size")

    def in_round(turn: Column) -> Column:
        low, first = turn * n, F.col("_at") + F.col("size")
        return _met(low + F.col("_at"), low + F.least(first, n), start, end) + _met(low, low + F.greatest(first - n, F.lit(0)), start, end)

    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.col("_rounds")), F.lit(0).cast("long"), lambda total, turn: total + in_round(turn))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, block_words: int = BLOCK_WORDS,
        seed: int = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken and its
    words in each output shard (``shard_words``); where the document lies in the
    run (``_at``), the words of the run (``_run``) and columns of ``carry`` in
    ``_carried``."""
    digits = max(2, math.ceil(math.log(max(1, docs.count()) / ROWS_PER_GROUP, 16)))
    rows = docs.select(
        F.col("doc_id").alias("doc_id"), F.col("source").alias("_source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce("text", F.lit(""))))).alias("_order"),
        F.struct(*[F.col(c) for c in carry] or [F.lit(0)]).alias("_carried"),
    ).withColumn("_group", F.substring("_order", 1, digits))
    groups = staged(rows.groupBy("_source", "_group").agg(F.sum("size").alias("_group_size")))
    targets = staged(_source_targets(groups.groupBy("_source").agg(F.sum("_group_size").alias("_source_size")), weights, share, most))
    quotas = block_quotas(targets, block_words, MIX_SHARDS)
    blocks = F.greatest(F.expr("_source_size div _block"), F.lit(1))
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/"), F.col("_rank").cast("string"))), 1, 8), 16, 10).cast("long")
    sources = staged(
        targets.join(quotas, "_rank", "left")
        .withColumn("_start", F.pmod(drawn, blocks) * F.col("_block"))
        .withColumn("_ends", F.transform("_seats", lambda n: F.least(n * F.col("_block"), F.col("_source_size") * most)))
        .drop("_seats", "_block"))
    before = Window.partitionBy("_source").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    places = (
        groups.withColumn("_offset", F.coalesce(F.sum("_group_size").over(before), F.lit(0)))
        .select(F.col("_source").alias("_s"), F.col("_group").alias("_g"), "_offset")
        .join(sources, F.col("_s").eqNullSafe(F.col("_source"))).drop("_source"))
    earlier = Window.partitionBy("_source", "_group").orderBy("_order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        rows.withColumn("_inside", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
        .join(places, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_group") == F.col("_g")))
        .withColumn("_at", F.when(F.col("size") > 0, F.pmod(F.col("_offset") + F.col("_inside") - F.col("_start"), F.col("_source_size"))))
        .withColumn("_run", F.element_at("_ends", -1))
        .withColumn("_rounds", F.lit(most - 1).cast("long")))
    words = F.when(F.col("_at").isNotNull(), F.transform(F.sequence(F.lit(1), F.lit(MIX_SHARDS)), _words_in_shard)).otherwise(
        F.array_repeat(F.lit(0).cast("long"), MIX_SHARDS))
    return placed.withColumn("_words", words).select(
        "doc_id", "size", F.col("_source_size").cast("long").alias("source_size"), F.col("_target").alias("target"),
        F.aggregate("_words", F.lit(0).cast("long"), lambda total, n: total + n).alias("taken"),
        F.array_join(F.col("_words").cast("array<string>"), ",").alias("shard_words"), "_carried", "_at", "_run")


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: one row per document and
    round that takes any of its words. A round that takes all of them keeps the
    text as it is; otherwise the taken words are joined by one space."""
    columns = [c for c in docs.columns]
    most = options.get("most", MOST)
    n, zero = F.col("source_size"), F.lit(0).cast("long")
    # In a round, the run takes the words up to _upto from its start: of a
    # document that lies across the source's end, the end comes first in the text.
    taken = (
        mix(docs, block_words=block_words, seed=seed, carry=tuple(columns), **options).where("taken > 0")
        .withColumn("_turn", F.explode(F.sequence(zero, F.lit(most - 1).cast("long"))))
        .withColumn("_upto", F.greatest(F.least(F.col("_run") - F.col("_turn") * n, n), zero))
        .withColumn("_front", F.least(F.col("size"), n - F.col("_at")))
        .withColumn("_n1", F.greatest(F.least(F.col("_front"), F.col("_upto") - F.col("_at")), zero))
        .withColumn("_n2", F.least(F.col("size") - F.col("_front"), F.col("_upto")))
        .where(F.col("_n1") + F.col("_n2") > 0))
    cut = F.col("_n1") + F.col("_n2") < F.col("size")
    words = F.regexp_extract_all(F.col("_carried.text"), F.lit(WORD), F.lit(0))

    def part(at: Column, count: Column) -> Column:
        return F.slice(F.col("_words"), (at + 1).cast("int"), count.cast("int"))

    pieces = F.array_join(F.concat(part(zero, F.col("_n1")), part(F.col("_front"), F.col("_n2"))), " ")
    cells = {c: F.col(f"_carried.{c}") for c in columns} | {"text": F.col("_text")}
    if "n_chars" in cells:
        cells["n_chars"] = F.char_length("_text").cast(docs.schema["n_chars"].dataType)
    return (taken.withColumn("_words", F.when(cut, words))
            .withColumn("_text", F.when(cut, pieces).otherwise(F.col("_carried.text"))).select([cells[c].alias(c) for c in columns]))


def op5_source_mix(spark, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "shard_words")


QUERIES = {"op5_source_mix": op5_source_mix}

# Awards every seat in order of quotients, and lays documents and shards out
# word by word from the run's start.
ORACLE_SQL = {"op5_source_mix": f"""
WITH sized AS (
    SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
           md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))) AS ord
    FROM documents),
src AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) AS rk,
           CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN {WEIGHTS[0]} WHEN 1 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END AS w
    FROM sized GROUP BY source),
lev AS (
    SELECT *, {MOST} * source_size::DOUBLE AS cap, {MOST} * source_size::DOUBLE / w AS ratio,
           (sum(source_size) OVER ())::DOUBLE * {SHARE} AS total FROM src),
lev2 AS (
    SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY ratio, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(w) OVER (ORDER BY ratio, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lam FROM lev),
target AS (
    SELECT *, floor(target * {VOTES} / block)::BIGINT AS votes FROM (
        SELECT source, rk, source_size, greatest(least(source_size // {FINENESS}, {BLOCK_WORDS}), 1) AS block,
               least(cap, (SELECT arg_min(lam, (ratio, rk)) FROM lev2 WHERE lam <= ratio) * w) AS target
        FROM lev2)),
awards AS (
    SELECT rk, row_number() OVER (ORDER BY votes / (2 * k + 1) DESC, rk, k) AS place
    FROM (SELECT rk, votes, unnest(range(2 * (votes // {VOTES}) + 50)) AS k FROM target WHERE target > 0)),
shards AS (SELECT j, ((SELECT sum(votes) FROM target WHERE target > 0)::BIGINT // {VOTES}) * j // {MIX_SHARDS} AS house FROM range(1, {MIX_SHARDS} + 1) t(j)),
seats AS (SELECT t.rk, j, count(a.place) AS n FROM target t CROSS JOIN shards LEFT JOIN awards a ON a.rk = t.rk AND a.place <= house GROUP BY ALL),
runs AS (
    SELECT t.*, (('0x' || substr(md5('{SEED}/' || rk), 1, 8))::BIGINT % greatest(source_size // block, 1)) * block AS start,
           (SELECT list(least(n * block, {MOST} * source_size) ORDER BY j) FROM seats s WHERE s.rk = t.rk) AS ends
    FROM target t),
laid AS (
    SELECT r, d.doc_id, d.size, p.source_size, p.target, start, list_prepend(0, ends) AS ends,
           coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.ord, d.doc_id, d.size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a
    FROM sized d JOIN runs p ON d.source IS NOT DISTINCT FROM p.source),
spans AS (
    -- the document before and after the run's start, in each round
    SELECT r, turn * source_size + (CASE WHEN half = 0 THEN greatest(a, start) - start ELSE a + source_size - start END) AS low,
           greatest(CASE WHEN half = 0 THEN a + size - greatest(a, start) ELSE least(a + size, start) - a END, 0) AS n, ends
    FROM laid, range({MOST}) t(turn), range(2) h(half) WHERE size > 0),
cells AS (
    SELECT r, j, sum(greatest(least(low + n, ends[j + 1]) - greatest(low, ends[j]), 0)) AS words
    FROM spans, range(1, {MIX_SHARDS} + 1) t(j) WHERE n > 0 GROUP BY ALL),
given AS (SELECT r, sum(words)::BIGINT AS taken, string_agg(words::BIGINT::VARCHAR, ',' ORDER BY j) AS shard_words FROM cells GROUP BY r)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken,
       coalesce(shard_words, '{",".join("0" * MIX_SHARDS)}') AS shard_words
FROM laid LEFT JOIN given USING (r)
"""}
