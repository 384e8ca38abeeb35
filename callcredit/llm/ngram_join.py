"""N-gram Jaccard join: blocks of a sparse matrix product.

Documents are rows, five-word shingles columns of an incidence matrix A. Links
are the cells of A * A' whose overlap reaches the bound that a Jaccard of
``PERCENT`` sets for the two row sizes. Cells below that bound are discarded as
early as sizes allow:

* Blocks of columns (``exchange``) count in how many texts a shingle occurs. A
  text linked to another shares at least the given share of its shingles, so a
  text with more shingles of its own has no link and leaves.
* A row looks for partners in the columns of a prefix only, from its rarest
  shingle on, so long that linked rows share one (Chaudhuri, Ganti and Kaushik,
  2006). Columns with the same rows count once.
* Two rows of sizes a and b whose shingles shared with anyone number s and t
  overlap in min(s, t) at most, which must reach the bound for a and b. The
  same holds for the sum of these minima over CLASSES classes of shingles.

Within a column, rows are first multiplied with the most central one only (the
one with the fewest shingles of its own); what links is joined to components.
Then rows outside the column's largest component are multiplied with the rows
of other components. So a group of near copies costs rows in proportion to its
size, not its square, and no link between components is missed.

Of columns of at most SMALL rows, the pairs still possible are intersected one
by one. Longer columns are dealt out in blocks of BLOCK rows, in order of size,
and a pair of blocks whose sizes allow a link is multiplied in one task
(``overlaps``): overlap counts of all its row pairs are added up over the
columns that both blocks have, columns with many rows 64 at a time as bits, the
others pair by pair of their few rows, and compared with the bound.
That is exact, needs BLOCK * BLOCK counts and two blocks' sets, and costs some
nanoseconds a pair, but still every pair of blocks: rows that share a column and
never link have no shorter exact way here.

Texts with equal shingle sets are one row. Defined results: a text without
words (null, empty) has 0 shingles and no links, its component is its own
doc_id; a very long text is one row with a long set, whole; ties and repeated
rows share a component; rows without doc_id take the least doc_id of their
component, if any; empty tables give no rows; other columns are not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callcredit.llm.components import components
from callcredit.llm.exchange import Answers, Corpus, ask, distinct_flagged, short, store_texts, text_key, with_answers
from callcredit.llm.repeats import _column
from callcredit.llm.storage import documents, staged
from callcredit.llm.words import Words, mixed, pieces
from callcredit.operators.windows import sequence_ids

SHINGLE = 5
PERCENT = 80
CLASSES = 64
SMALL = 48
BLOCK = 512
DENSE_PAIRS = 512


def _shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles of texts, by row and hash; a text
    with fewer than n words has its word sequence as the only one."""
    h = words.hashes()
    keys, at = words.windows(h, n)
    found, rows = [keys], [words.row[at]]
    for few in range(1, n):
        keys, at = words.windows(h, few)
        only = words.count[words.row[at]] == few
        found.append(mixed(keys[only] + np.uint64(few)))
        rows.append(words.row[at][only])
    hashes, row = np.concatenate(found), np.concatenate(rows)
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1]))[:len(row)]
    return row[new], hashes[new]


def _sent(table: pa.Table, bits: int, n: int) -> np.ndarray:
    found = [short(_shingles(words, n)[1], bits) for _, _, words in pieces(_column(table), lower=True)]
    return distinct_flagged(np.concatenate([np.zeros(0, np.uint64), *found]))


def _rows(table: pa.Table, known: Answers, bits: int, n: int, percent: int) -> pa.Table:
    """Of each text its size; of texts that can have links also the shared
    shingles' number, in all and by class, the set, and the shared part of the
    prefix."""
    keys = table.column("key").to_pylist() if table.num_rows else []
    size, shared, sets, prefixes, classes = [], [], [], [], []
    for _, _, words in pieces(_column(table), lower=True) if table.num_rows else ():
        row, hashes = _shingles(words, n)
        level = known.level_of(short(hashes, bits))
        first = np.searchsorted(row, np.arange(words.rows + 1))
        common = np.append(0, np.cumsum(level >= 0))
        for r in range(words.rows):
            a, b = int(first[r]), int(first[r + 1])
            many, kept = b - a, int(common[b] - common[a])
            size.append(many)
            shared.append(kept)
            if not many or kept * 100 < many * percent:
                sets.append(None)
                prefixes.append(None)
                classes.append(None)
                continue
            own, rank = hashes[a:b].view(np.int64), level[a:b]
            order = np.lexsort((own, rank))
            long = many - -(-percent * many // 100) + 1
            sets.append(own)
            prefixes.append(own[order[many - kept:long]])
            classes.append(np.bincount(own[rank >= 0] & (CLASSES - 1), minlength=CLASSES).astype(np.int32))
    longs = pa.list_(pa.int64())
    return pa.table({"key": pa.array(keys, pa.string()), "size": pa.array(size, pa.int64()), "shared": pa.array(shared, pa.int64()),
                     "set": pa.array(sets, longs), "prefix": pa.array(prefixes, longs), "classes": pa.array(classes, pa.list_(pa.int32()))})


def shingle_rows(corpus: Corpus, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(key, size, shared, set, prefix, classes) of every stored text."""
    bits = corpus.bits
    known = ask(corpus, lambda t: _sent(t, bits, n), lambda times, flagged: times > 1)
    return with_answers(corpus, known, lambda t, k: _rows(t, k, bits, n, percent),
                        "key string, size long, shared long, set array<long>, prefix array<long>, classes array<int>")


def _can_overlap(x: str, y: str, percent: int, most: Column | None = None) -> Column:
    """The bound on rows x and y by their sizes and the most they may share."""
    most = F.least(F.col(f"{x}.shared"), F.col(f"{y}.shared")) if most is None else most
    return most * 100 >= (F.col(f"{x}.size") + F.col(f"{y}.size") - most) * percent


def _linked(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full overlap reaches the bound."""
    sets = rows.select("key", "set")
    both = (
        pairs.join(sets.select(F.col("key").alias("a"), F.col("set").alias("x")), "a")
        .join(sets.select(F.col("key").alias("b"), F.col("set").alias("y")), "b")
        .select("a", "b", F.size("x").alias("m"), F.size("y").alias("n"), F.size(F.array_intersect("x", "y")).alias("overlap")))
    return both.where(F.col("overlap") * 100 >= (F.col("m") + F.col("n") - F.col("overlap")) * percent).select("a", "b")


def _central_pairs(cells: DataFrame, percent: int) -> DataFrame:
    """Each row of a column with the column's most central row."""
    me = F.struct(((F.col("size") - F.col("shared")) / F.col("size")).alias("own"), "key", "size", "shared")
    centre = cells.groupBy("column").agg(F.min(me).alias("c"), F.count("*").alias("n")).where("n > 1")
    return (
        cells.join(centre, "column").where(F.col("key") != F.col("c.key"))
        .select(F.struct("key", "size", "shared").alias("x"), F.col("c").alias("y"))
        .where(_can_overlap("x", "y", percent))
        .select(F.col("x.key").alias("a"), F.col("y.key").alias("b")).distinct())


def _mixed_columns(cells: DataFrame) -> DataFrame:
    """(column, n, largest): columns whose rows are of several components, the
    least of those with the same rows, and the component with the most rows."""
    counts = cells.groupBy("column", "component").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("key")).alias("x"), F.sum(F.xxhash64(F.lit(1), "key").cast("decimal(20,0)")).alias("s"))
    columns = counts.groupBy("column").agg(
        F.max(F.struct("n", "component"))["component"].alias("largest"), F.count("*").alias("k"), F.sum("n").alias("n"),
        F.bit_xor("x").alias("x"), F.sum("s").alias("s"))
    return columns.where("k > 1").groupBy("n", "x", "s").agg(F.min(F.struct("column", "largest")).alias("c")).select("c.column", "n", "c.largest")


def _cross_pairs(cells: DataFrame, columns: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that meet in a short column, each from the
    first column of both prefixes or its equal, if the overlap is still possible there."""
    mixed_cells = cells.join(columns, "column").join(rows.select("key", "prefix", "classes"), "key")
    me = F.struct("key", "size", "shared", "component", "classes")
    few = mixed_cells.where(F.col("component") != F.col("largest")).select("column", "largest", me.alias("x"))
    every = mixed_cells.select("column", me.alias("y"))
    once = (F.col("y.component") == F.col("largest")) | (F.col("x.key") < F.col("y.key"))
    by_class = F.aggregate(F.zip_with("x.classes", "y.classes", lambda m, n: F.least(m, n)), F.lit(0), lambda total, n: total + n)
    return (
        few.join(every, "column")
        .where((F.col("x.component") != F.col("y.component")) & once & _can_overlap("x", "y", percent)
               & _can_overlap("x", "y", percent, by_class))
        .select(F.col("x.key").alias("a"), F.col("y.key").alias("b")).distinct())


def overlaps(sets_x: list[np.ndarray], sets_y: list[np.ndarray]) -> np.ndarray:
    """The product of two blocks: shared columns of every row of x and of y."""
    x, y = np.concatenate(sets_x), np.concatenate(sets_y)
    row_x, row_y = (np.repeat(np.arange(len(s)), [len(r) for r in s]) for s in (sets_x, sets_y))
    total = np.zeros((len(sets_x), len(sets_y)), np.int32)
    both = np.intersect1d(x, y)
    if not len(both):
        return total

    def of_both(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Column, row, and rows a column of the cells in columns of both blocks, by column."""
        at = np.minimum(np.searchsorted(both, values), len(both) - 1)
        kept = both[at] == values
        at, rows = at[kept], rows[kept]
        order = np.argsort(at, kind="stable")
        return at[order], rows[order], np.bincount(at, minlength=len(both))

    (cx, rx, nx), (cy, ry, ny) = of_both(x, row_x), of_both(y, row_y)
    dense = nx * ny >= DENSE_PAIRS
    slabs = np.flatnonzero(dense)
    for at in range(0, len(slabs), 64):
        part = slabs[at:at + 64]
        bit = np.zeros(len(both), np.uint64)
        bit[part] = np.uint64(1) << np.arange(len(part), dtype=np.uint64)
        words = []
        for c, r, n in ((cx, rx, len(sets_x)), (cy, ry, len(sets_y))):
            word = np.zeros(n, np.uint64)
            np.bitwise_or.at(word, r, bit[c])
            words.append(word)
        total += np.bitwise_count(words[0][:, None] & words[1][None, :])
    # A cell of x meets all cells of y in its column, which lie together.
    light = ~dense[cx]
    times = ny[cx[light]]
    first = (np.cumsum(ny) - ny)[cx[light]]
    step = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    np.add.at(total.reshape(-1), np.repeat(rx[light], times) * len(sets_y) + ry[np.repeat(first, times) + step], 1)
    return total


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    found = pa.concat_arrays(column.chunks)
    values, ends = found.values.to_numpy(zero_copy_only=False), found.offsets.to_numpy()
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _block_links(table: pa.Table, percent: int) -> pa.Table:
    """One link (a, b) for any two components with a linked pair of rows in a pair of blocks."""
    sides = [table.filter(pc.equal(table.column("side"), side)) for side in (0, 1)]
    a, b = [], []
    if all(s.num_rows for s in sides):
        sets = [_lists(s.column("set")) for s in sides]
        size = [s.column("size").to_numpy() for s in sides]
        names = sorted({*sides[0].column("component").to_pylist(), *sides[1].column("component").to_pylist()})
        number = {c: i for i, c in enumerate(names)}
        part = [np.array([number[c] for c in s.column("component").to_pylist()]) for s in sides]
        # overlap * 100 >= (m + n - overlap) * percent
        shared = overlaps(*sets)
        i, j = np.nonzero(shared >= (size[0].min() + size[1].min()) * percent // (100 + percent))
        linked = shared[i, j].astype(np.int64) * (100 + percent) >= (size[0][i] + size[1][j]) * percent
        i, j = i[linked], j[linked]
        apart = part[0][i] != part[1][j]
        i, j = i[apart], j[apart]
        one = np.unique(part[0][i] * len(names) + part[1][j], return_index=True)[1]
        a = [sides[0].column("key")[int(k)].as_py() for k in i[one]]
        b = [sides[1].column("key")[int(k)].as_py() for k in j[one]]
    return pa.table({"a": pa.array(a, pa.string()), "b": pa.array(b, pa.string())})


def _blocks(cells: DataFrame, side: int) -> DataFrame:
    """``cells`` with their block of BLOCK rows of a column, in order of size."""
    numbered = sequence_ids(cells, ["column"], [F.asc("size"), F.asc("key")], "n")
    return numbered.select("column", "key", "size", "component", F.lit(side).alias("side"), F.expr(f"(n - 1) div {BLOCK}").alias("block"))


def _product_links(cells: DataFrame, columns: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Links between different components whose rows meet in a long column."""
    cells = cells.select("column", "key", "size", "component").join(columns, "column")
    every = staged(_blocks(cells.drop("largest"), 1))
    few = staged(_blocks(cells.where(F.col("component") != F.col("largest")).drop("largest"), 0))

    def ranges(blocks: DataFrame, name: str) -> DataFrame:
        return blocks.groupBy("column", F.col("block").alias(name)).agg(F.min("size").alias(f"{name}_least"), F.max("size").alias(f"{name}_most"))

    # Rows of sizes m <= n overlap in m at most, so m * 100 must reach n * percent.
    pairs = staged(ranges(few, "x").join(ranges(every, "y"), "column").where(
        (F.col("x_most") * 100 >= F.col("y_least") * percent) & (F.col("y_most") * 100 >= F.col("x_least") * percent)).select("column", "x", "y"))
    # Pairs of blocks are few bytes and much work: they are dealt to all tasks.
    tasks = max(1, min(pairs.count(), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    members = few.join(pairs.withColumnRenamed("x", "block"), ["column", "block"]).withColumnRenamed("block", "x").unionByName(
        every.join(pairs.withColumnRenamed("y", "block"), ["column", "block"]).withColumnRenamed("block", "y"))
    return members.join(rows.select("key", "set"), "key").repartition(tasks, "column", "x", "y").groupBy("column", "x", "y").applyInArrow(
        lambda table: _block_links(table, percent), "a string, b string")


def linked_components(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(key, component) of stored texts that have links; component is a key."""
    sets = rows.where("set is not null").withColumn("same", F.sha2(F.array_join(F.col("set").cast("array<string>"), ","), 256))
    equal = sets.groupBy("same").agg(F.min("key").alias("first"))
    placed = staged(sets.join(equal, "same").select("key", "first", "size", "shared", "set", "prefix", "classes"))
    apart = placed.where("key = first")
    cells = apart.select("key", "size", "shared", F.explode("prefix").alias("column"))
    links = staged(_linked(_central_pairs(cells, percent), apart, percent))
    found = components(links, "a", "b")
    labelled = staged(cells.join(found.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key")))
    columns = staged(_mixed_columns(labelled))
    short_columns, long_columns = columns.where(F.col("n") <= SMALL).drop("n"), columns.where(F.col("n") > SMALL).drop("n")
    late = staged(_linked(_cross_pairs(labelled, short_columns, apart, percent), apart, percent))
    if not long_columns.isEmpty():
        late = late.unionByName(staged(_product_links(labelled, long_columns, apart, percent)))
    copies = placed.where("key != first").select(F.col("key").alias("a"), F.col("first").alias("b"))
    return components(links.unionByName(late).unionByName(copies), "a", "b").withColumnRenamed("node", "key")


def text_classes(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(_key, _size, _class) of every distinct text: texts of a class reach each
    other by links. Wordless texts have a null class."""
    corpus = store_texts(docs)
    rows = staged(shingle_rows(corpus, n, percent))
    corpus.discard()
    found = linked_components(rows, percent).withColumnRenamed("key", "k")
    sizes = rows.select(F.col("key").alias("_key"), F.col("size").alias("_size"))
    return sizes.join(found, F.col("_key") == F.col("k"), "left").select(
        "_key", "_size", F.when(F.col("_size") > 0, F.coalesce("component", "_key")).alias("_class"))


def one_of_class(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The row with the least doc_id of every class of near copies, and all
    wordless rows, with the columns of ``docs``."""
    classes = staged(text_classes(docs, n, percent))
    key = text_key(F.col("text")).alias("_key")
    ids = docs.select(F.col("doc_id").alias("_id"), key).join(classes, "_key")
    first = F.min_by(F.struct("_id", "_key"), F.struct(F.col("_id").isNull(), "_id", "_key"))
    best = ids.where("_class is not null").groupBy("_class").agg(first.alias("w")).select("w._id", "w._key", F.lit(True).alias("_one"))
    kept = best.unionByName(ids.where("_class is null").select("_id", "_key", F.lit(False).alias("_one")).distinct())
    kept = kept.select(F.col("_id").alias("_i"), F.col("_key").alias("_k"), "_one")
    packed = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_id"), key)
    same = F.row_number().over(Window.partitionBy("_key", "_id").orderBy(F.lit(0)))
    return (
        packed.join(kept, (F.col("_key") == F.col("_k")) & F.col("_id").eqNullSafe(F.col("_i")))
        .withColumn("_same", same).where((F.col("_same") == 1) | ~F.col("_one")).select("_row.*"))


def op1_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    classed = docs.select("doc_id", text_key(F.col("text")).alias("_key")).join(staged(text_classes(docs)), "_key")
    least = classed.where("_class is not null").groupBy("_class").agg(F.min("doc_id").alias("least")).withColumnRenamed("_class", "_c")
    return classed.join(least, F.col("_class") == F.col("_c"), "left").select(
        "doc_id", F.col("_size").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


QUERIES = {"op1_ngram_jaccard": op1_ngram_jaccard}
# Joins all shingles with all shingles and follows links to a fixed point.
ORACLE_SQL = {"op1_ngram_jaccard": f"""
WITH RECURSIVE doc AS (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
gram AS (
    SELECT DISTINCT rid, doc_id, array_to_string(w[i:i + {SHINGLE - 1}], ' ') AS g
    FROM (SELECT rid, doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 1}, least(len(w), 1)) + 1)) AS i FROM doc)),
sized AS (SELECT rid, any_value(doc_id) AS doc_id, count(*) AS n FROM gram GROUP BY rid),
overlap AS (SELECT a.rid AS a, b.rid AS b, count(*) AS k FROM gram a JOIN gram b USING (g) WHERE a.rid <> b.rid GROUP BY a.rid, b.rid),
link AS (
    SELECT a, b FROM overlap JOIN sized x ON x.rid = a JOIN sized y ON y.rid = b
    WHERE 100 * k >= {PERCENT} * (x.n + y.n - k)),
reach(a, b) AS (SELECT rid, rid FROM sized UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
least AS (SELECT a AS rid, min(s.doc_id) AS component_id FROM reach JOIN sized s ON s.rid = reach.b GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM doc LEFT JOIN (SELECT rid, n FROM sized) USING (rid) LEFT JOIN least USING (rid)
"""}
