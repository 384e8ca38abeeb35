"""Source divergence audit: how the wording of each source departs from its language.

One ``bytes.translate`` a text lowers A-Z and blanks every other ASCII byte
that isn't a letter, ``bytes.split`` cuts the terms, and a ``Counter`` a
document gives occurrences and document counts. A task adds its documents up
until it holds HELD_TERMS terms, then hands the counts to Spark, so memory
follows that bound and the longest text.

A language keeps the V terms that MIN_DOCS of its documents have. Every group
(language, source), and the whole language, gives a kept term with c
occurrences the share p = 1 + floor(SCALE * (c + 2) / (N + 2 * V)) of its N
kept occurrences. Two shares differ by f(p, q) = floor((p - q)^2 / (p + q)),
and two sources by the sum of f over all kept terms, in whole numbers.

The sum over terms is sparse: a term that a group lacks has the group's share
p0 of c = 0. So, with the terms of a and of b,

    sum = A(a, b) + A(b, a) + (V - |a| - |b|) * f(p0a, p0b)
          + sum over shared terms of f(pa, pb) - f(pa, p0b) - f(p0a, pb) + f(p0a, p0b),
    A(a, b) = sum over terms of a of f(pa, p0b),

where A needs only how often each share occurs in a. Shared terms meet on
(language, term) once for two sources, and are added up before any shuffle;
the pairs of sources of a language are the result asked for.

Defined results: null text, lang and source count as ''; a text without terms
still makes its group; a language without kept terms has pairs of value 0 and
no terms; repeated rows count as often as they occur; ties rank by item in
UTF-8 order; a text of any length is one row of its task; empty tables give no
rows; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callcredit.llm.storage import documents, staged, texts_in_small_batches

MIN_DOCS = 10
SCALE = 1_000_000_000
TOP_TERMS = 10
HELD_TERMS = 200_000
ROWS_PER_BATCH = 20_000

TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
COUNTED = "lang string, source string, term string, n long, docs long"


def terms_of(text: bytes) -> Counter:
    """Occurrences of each term of one document."""
    return Counter(text.translate(TERM_BYTES).split())


def _handed_over(found: dict[tuple[str, str], tuple[Counter, Counter]]):
    for (lang, source), (times, docs) in found.items():
        terms = list(times)
        for at in range(0, len(terms), ROWS_PER_BATCH):
            part = terms[at:at + ROWS_PER_BATCH]
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(part), pa.string()), "source": pa.array([source] * len(part), pa.string()),
                "term": pa.array(part, pa.binary()).cast(pa.string()),
                "n": pa.array([times[t] for t in part], pa.int64()), "docs": pa.array([docs[t] for t in part], pa.int64())})


def _count_terms(batches):
    found: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        for lang, source, text in zip(batch.column("lang"), batch.column("source"), texts, strict=True):
            key = (lang.as_py(), source.as_py())
            if key not in found:
                # The empty term, which no text has, stands for the group itself.
                found[key] = (Counter({b"": 0}), Counter())
            times, docs = found[key]
            before = len(times)
            terms = terms_of(text.as_py())
            times.update(terms)
            docs.update(terms.keys())
            held += len(times) - before
            if held >= HELD_TERMS:
                yield from _handed_over(found)
                found, held = {}, 0
    yield from _handed_over(found)


def counted_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with the term;
    every (lang, source) has the term '' with zeros."""
    texts_in_small_batches(docs.sparkSession)
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return named.mapInArrow(_count_terms, COUNTED).groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), exact for any long count."""
    above = (count + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.when(kept > 0, F.call_function("div", above, (total + 2 * kept).cast("decimal(20,0)")) + 1)


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _ranked(rows: DataFrame) -> Column:
    return F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): the distance of every source to
    each other source of its language, and its ``top`` terms above the language."""
    of_term = Window.partitionBy("lang", "term")
    kept = staged(
        counted_terms(docs)
        .select("*", F.sum("docs").over(of_term).alias("_docs"), F.sum("n").over(of_term).alias("lang_n"),
                (F.min("source").over(of_term) == F.col("source")).cast("long").alias("once"))
        .where((F.col("_docs") >= min_docs) | (F.col("term") == "")).drop("_docs", "docs"))
    is_term = (F.col("term") != "").cast("long")
    of_lang = Window.partitionBy("lang")
    groups = (
        kept.groupBy("lang", "source").agg(
            F.sum("n").alias("total"), F.sum(is_term).alias("terms"), F.sum(is_term * F.col("once")).alias("_kept"),
            F.sum(F.col("once") * F.col("lang_n")).alias("_n"))
        .select("lang", "source", "total", "terms", F.sum("_kept").over(of_lang).alias("kept"), F.sum("_n").over(of_lang).alias("lang_total"))
        .withColumn("p0", _share(F.lit(0), F.col("total"), F.col("kept"))))
    groups = staged(groups)
    cells = (
        kept.where(F.col("term") != "").join(groups, ["lang", "source"])
        .withColumn("p", _share(F.col("n"), F.col("total"), F.col("kept")))
        .withColumn("q", _share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))))
    return _pairs(cells, groups).unionByName(_terms(cells, top))


def _pairs(cells: DataFrame, groups: DataFrame) -> DataFrame:
    left = groups.select("lang", F.col("source").alias("a"), F.col("p0").alias("p0a"), F.col("terms").alias("na"), "kept")
    right = groups.select(F.col("lang").alias("_lang"), F.col("source").alias("b"), F.col("p0").alias("p0b"), F.col("terms").alias("nb"))
    pairs = left.join(right, (F.col("lang") == F.col("_lang")) & (F.col("a") != F.col("b"))).drop("_lang")
    least, most = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    # A(a, b) and A(b, a), from how often each share occurs in a source.
    shares = cells.groupBy("lang", F.col("source").alias("a"), "p").agg(F.count("*").alias("times"))
    alone = pairs.join(shares, ["lang", "a"]).select(
        "lang", least, most, (F.col("times") * _apart(F.col("p"), F.col("p0b"))).alias("value"))
    x = cells.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa"), F.col("p0").alias("p0a"))
    y = cells.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"), F.col("p0").alias("p0b"))
    pa_, pb, p0a, p0b = (F.col(c) for c in ("pa", "pb", "p0a", "p0b"))
    shared = x.join(y, ["lang", "term"]).where(F.col("a") < F.col("b")).select(
        "lang", "a", "b", (_apart(pa_, pb) - _apart(pa_, p0b) - _apart(p0a, pb) + _apart(p0a, p0b)).alias("value"))
    neither = pairs.where(F.col("a") < F.col("b")).select(
        "lang", "a", "b", F.coalesce((F.col("kept") - F.col("na") - F.col("nb")) * _apart(p0a, p0b), F.lit(0)).alias("value"))
    # Sums of each kind before the union, so that all are added up in their own tasks first.
    parts = [d.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")) for d in (alone, shared, neither)]
    total = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    way = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    both = total.select("lang", way.alias("way"), "value").select("lang", "way.source", "way.item", "value")
    return both.select("lang", "source", F.lit("pair").alias("part"), "item", F.col("value").cast("long").alias("value"), _ranked(both).alias("rank"))


def _terms(cells: DataFrame, top: int) -> DataFrame:
    above = cells.where(F.col("p") > F.col("q")).select(
        "lang", "source", F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).cast("long").alias("value"))
    ranked = above.withColumn("rank", _ranked(above)).where(F.col("rank") <= top)
    return ranked.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")


def op11_source_divergence(spark, sf_dir: str) -> DataFrame:
    return source_divergence(documents(spark, sf_dir))


QUERIES = {"op11_source_divergence": op11_source_divergence}

# Dense: every group meets every kept term of its language.
ORACLE_SQL = {"op11_source_divergence": rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
words AS (
    SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCS}),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grid AS (
    SELECT g.lang, g.source, k.term, v, count(w.term) AS c
    FROM (SELECT DISTINCT lang, source FROM docs) g JOIN kept k USING (lang) JOIN sizes USING (lang)
    LEFT JOIN words w ON w.lang = g.lang AND w.source = g.source AND w.term = k.term
    GROUP BY ALL),
shared AS (
    SELECT lang, source, term, c, sum(c) OVER (PARTITION BY lang, source) AS n, v,
           sum(c) OVER (PARTITION BY lang, term) AS lc, sum(c) OVER (PARTITION BY lang) AS ln FROM grid),
shares AS (
    SELECT lang, source, term, c,
           1 + ({SCALE}::HUGEINT * (c + 2)) // (n + 2 * v)::HUGEINT AS p, 1 + ({SCALE}::HUGEINT * (lc + 2)) // (ln + 2 * v)::HUGEINT AS q FROM shared),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0) AS value
    FROM (SELECT DISTINCT lang, source FROM docs) a
    JOIN (SELECT DISTINCT lang, source FROM docs) b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    GROUP BY ALL),
parts AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM parts QUALIFY part = 'pair' OR rank <= {TOP_TERMS}
"""}
