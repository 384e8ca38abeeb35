"""Conversation prefix trie: shared openings of conversations, and what they save.

A turn is a token of fixed width: the MD5 of its role and text, then its number
of words. A conversation is the string of its tokens, so a prefix of d turns is
a prefix of the string, and conversations that share it lie together in sorted
order. Distinct sequences are dealt to shards by range. A shard numbers its
distinct tokens (its dictionary of turn ids) and builds a ternary search tree:
the children of a trie node are a binary tree over turn ids, kept balanced
because the sorted sequences go in by medians, the middle one first. A node is
made after its parent, so one pass over the nodes backwards adds up children,
leaves and savings.

Only nodes on the way to the first or the last sequence of a shard can occur in
other shards too. Such boundary nodes hold what hangs directly below them, and
are merged on the digest of their prefix. What lies below them is added up over
the ways of all shards: each merged node belongs to the first way that it is on,
a way's own nodes are its last ones, and a node's subtree is made of its own
way's nodes from it on, and all own nodes of the other ways through it. That
table has two ways a shard, none longer than the longest conversation.

The ids of the conversations that end at a node are hashed in order. Equal
sequences are brought together in pieces of PIECE_IDS neighbouring ids, and the
pieces stream through the hash, so a sequence that a third of all conversations
share needs no more memory than another. A conversation's tokens are one string
(TOKEN bytes a turn); the number of shards follows the number of turns.

Defined results: rows without conv_id are no conversation; rows without turn
come first; rows of equal turn go by the MD5 of role and text, and equal rows
stay separate turns; null role or text is empty; a text of any length is one
token; a conversation rebuilt without turns is a member of the root only; an
empty table gives no rows; other columns are not read, so their names cannot
clash.
"""

from __future__ import annotations

import hashlib
import math
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callcredit.llm.storage import staged, texts_in_small_batches

GROUP = 20
HEADS = 4
DIGEST = 32
TOKEN = DIGEST + 8
PIECE_IDS_LOG2 = 10
TURNS_PER_SHARD = 200_000
ROWS_PER_BATCH = 20_000
WORD = r"[^\x20\x09-\x0D]+"
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODES = ("shard int, node long, depth long, conv_id long, parent_conv_id long, hangs_on long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, words long, ends string, key string, parent_key string, on_first boolean, on_last boolean")


def rebuilt_sequences(conversations: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """(conv_id, turns): every conversation, its first turns replaced by those
    of the first conversation of its group, as a string of tokens."""
    conv = F.col("conv_id").cast("long")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    token = F.concat(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)),
                     F.lpad(F.hex(F.regexp_count(text, F.lit(WORD)).cast("long")), TOKEN - DIGEST, "0"))
    turns = conversations.where(conv.isNotNull()).select(
        (conv - conv % group).alias("base"), conv.alias("conv_id"), F.struct(F.col("turn").alias("turn"), token.alias("token")).alias("t"))
    # One shuffle: the conversations of a group, group of them at most, stay together.
    own = (
        turns.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
        .select("base", "conv_id", F.array_join(F.transform("t", lambda t: t["token"]), "").alias("own")))
    head = F.max(F.when(F.col("conv_id") == F.col("base"), F.expr(f"substring(own, 1, {TOKEN * (heads - 1)})"))).over(Window.partitionBy("base"))
    return (
        own.withColumn("head", F.coalesce(head, F.lit("")))
        .withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int"))
        .select("conv_id", F.expr(f"concat(substring(head, 1, {TOKEN} * h), substring(own, {TOKEN} * h + 1))").alias("turns")))


class SearchTree:
    """A trie whose nodes find their children by a binary tree of turn ids.

    Node 0 is the root. ``first`` is a node's topmost child; ``less`` and
    ``more`` are its neighbours in the tree of its parent's children.
    """

    def __init__(self) -> None:
        self.turn, self.parent, self.depth = [-1], [-1], [0]
        self.first, self.less, self.more = [-1], [-1], [-1]
        self.members, self.least = [0], [None]
        self.ends: dict[int, str] = {}

    def _new(self, turn: int, parent: int) -> int:
        for column, value in ((self.turn, turn), (self.parent, parent), (self.depth, self.depth[parent] + 1), (self.first, -1),
                              (self.less, -1), (self.more, -1), (self.members, 0), (self.least, None)):
            column.append(value)
        return len(self.turn) - 1

    def _child(self, parent: int, turn: int) -> int:
        at = self.first[parent]
        if at < 0:
            self.first[parent] = at = self._new(turn, parent)
            return at
        while self.turn[at] != turn:
            side = self.less if turn < self.turn[at] else self.more
            if side[at] < 0:
                side[at] = at = self._new(turn, parent)
                return at
            at = side[at]
        return at

    def add(self, turns: list[int], members: int, least: int, ends: str) -> list[int]:
        """Puts in a sequence of turn ids; returns its nodes from the root on."""
        way = [0]
        for turn in turns:
            way.append(self._child(way[-1], turn))
        for node in way:
            self.members[node] += members
            self.least[node] = least if self.least[node] is None else min(least, self.least[node])
        self.ends[way[-1]] = ends
        return way


def medians(n: int):
    """0 to n - 1, the middle one of every range before its halves."""
    ranges = deque([(0, n)])
    while ranges:
        low, high = ranges.popleft()
        if low < high:
            middle = (low + high) // 2
            yield middle
            ranges.append((low, middle))
            ranges.append((middle + 1, high))


def _distinct(batches):
    """(turns, members, least id, digest of the ids) of sorted pieces of sequences."""
    now, digest, members, least = None, None, 0, 0
    for batch in batches:
        for turns, ids, n, low in zip(*[batch.column(c).to_pylist() for c in ("turns", "ids", "n", "least")], strict=True):
            if turns != now:
                if now is not None:
                    yield now, members, least, digest.hexdigest()
                now, digest, members, least = turns, hashlib.sha256(), 0, low
            else:
                digest.update(b",")
            digest.update(ids.encode())
            members, least = members + n, min(least, low)
    if now is not None:
        yield now, members, least, digest.hexdigest()


def _shard_nodes(batches):
    """The nodes of one shard's search tree, as NODES."""
    rows = list(_distinct(batches))
    if not rows:
        return
    tokens, ids = np.unique(np.frombuffer("".join(r[0] for r in rows).encode(), f"S{TOKEN}"), return_inverse=True)
    ids = ids.tolist()
    sizes = [len(r[0]) // TOKEN for r in rows]
    starts = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    words = [int(t[DIGEST:], 16) for t in tokens.tolist()]
    tree, edges = SearchTree(), {}
    for i in medians(len(rows)):
        way = tree.add(ids[starts[i]:starts[i] + sizes[i]], *rows[i][1:])
        if i in (0, len(rows) - 1):
            edges[i] = way
    on_first, on_last = set(edges[0]), set(edges[len(rows) - 1])
    keys: dict[int, tuple[str, str | None]] = {}
    for i, way in edges.items():
        digest, above = hashlib.md5(), None
        for depth, node in enumerate(way):
            if depth:
                digest.update(rows[i][0][(depth - 1) * TOKEN:depth * TOKEN].encode())
            keys[node] = (digest.hexdigest(), above)
            above = digest.hexdigest()
    n = len(tree.turn)
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    for node in range(n - 1, -1, -1):
        if node in keys:
            continue
        up = tree.parent[node]
        leaves[node] += not children[node]
        saved[node] += (tree.members[node] - 1) * words[tree.turn[node]]
        children[up] += 1
        leaves[up] += leaves[node]
        saved[up] += saved[node]
    shard = TaskContext.get().partitionId()
    for at in range(0, n, ROWS_PER_BATCH):
        part = range(at, min(n, at + ROWS_PER_BATCH))
        up = [tree.parent[x] for x in part]
        columns = {
            "shard": [shard] * len(part), "node": list(part), "depth": tree.depth[at:part.stop], "conv_id": tree.least[at:part.stop],
            "parent_conv_id": [None if u < 0 else tree.least[u] for u in up], "hangs_on": [u if u in keys and x not in keys else None for x, u in zip(part, up, strict=True)],
            "n_convs": tree.members[at:part.stop], "n_children": children[at:part.stop], "n_leaves": leaves[at:part.stop],
            "saved_tokens": saved[at:part.stop], "words": [words[t] if t >= 0 else 0 for t in tree.turn[at:part.stop]],
            "ends": [tree.ends.get(x) for x in part], "key": [keys.get(x, (None, None))[0] for x in part],
            "parent_key": [keys.get(x, (None, None))[1] for x in part], "on_first": [x in on_first for x in part], "on_last": [x in on_last for x in part]}
        kinds = {"shard": pa.int32(), "ends": pa.string(), "key": pa.string(), "parent_key": pa.string(), "on_first": pa.bool_(), "on_last": pa.bool_()}
        yield pa.RecordBatch.from_pydict({c: pa.array(v, kinds.get(c, pa.int64())) for c, v in columns.items()})


OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def prefix_trie(sequences: DataFrame, turns_per_shard: int = TURNS_PER_SHARD) -> DataFrame:
    """One row per distinct prefix of the ``turns`` of (conv_id, turns) rows."""
    texts_in_small_batches(sequences.sparkSession)
    pieces = staged(
        sequences.groupBy("turns", F.shiftright("conv_id", PIECE_IDS_LOG2).alias("piece"))
        .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"),
             F.count("*").alias("n"), F.min("conv_id").alias("least")))
    turns = pieces.agg(F.sum(F.length("turns") + TOKEN)).first()[0] or 0
    shards = max(1, math.ceil(turns / TOKEN / turns_per_shard))
    nodes = staged(pieces.repartitionByRange(shards, "turns").sortWithinPartitions("turns", "piece").mapInArrow(_shard_nodes, NODES))
    edge = nodes.where(F.col("key").isNotNull())
    merged = _merged(edge)
    final_edge = merged.select(*OUT, "ends")
    inner = nodes.where(F.col("key").isNull())
    # Nodes right below a boundary node take its id from the merged one, found by shard and node.
    tops = edge.join(merged.select("key", F.col("conv_id").alias("top")), "key").select("shard", F.col("node").alias("hangs_on"), "top")
    hanging = (
        inner.where(F.col("hangs_on").isNotNull()).join(tops, ["shard", "hangs_on"])
        .withColumn("parent_conv_id", F.col("top")).select(*OUT, "ends"))
    found = final_edge.unionByName(hanging).unionByName(inner.where(F.col("hangs_on").isNull()).select(*OUT, "ends"))
    return found.select(*OUT, F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))


def _merged(edge: DataFrame) -> DataFrame:
    """Boundary nodes of all shards, one row a prefix, with their whole subtrees."""
    way = F.col("shard").cast("long") * 2
    one = edge.withColumn("way", F.when(F.col("on_first"), way).otherwise(way + 1)).groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("inner"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"),
        F.max("words").alias("words"), F.max("ends").alias("ends"), F.min("way").alias("owner"))
    one = staged(one)
    below = one.groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("outer"))
    one = one.join(below, "key", "left").withColumn("n_children", F.col("inner") + F.coalesce("outer", F.lit(0)))
    own = one.select(
        "key", "owner", (F.col("leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    ways = edge.select("key", "depth", F.explode(F.array_compact(F.array(F.when(F.col("on_first"), way), F.when(F.col("on_last"), way + 1)))).alias("way"))
    mine = F.col("owner") == F.col("way")
    on_way = ways.join(own, "key").select(
        "key", "depth", "way", mine.alias("mine"), *[F.when(mine, F.col(c)).otherwise(0).alias(c) for c in ("leaves", "saved")])
    down, whole = Window.partitionBy("way").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("way")
    sums = on_way.select("key", *[F.when(F.col("mine"), F.sum(c).over(down)).otherwise(F.sum(c).over(whole)).alias(c) for c in ("leaves", "saved")])
    subtree = sums.groupBy("key").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    parents = one.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    return staged(
        one.join(subtree, "key").join(parents, "parent_key", "left").select("key", *OUT, "ends"))


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt_sequences(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


QUERIES = {"op12_prefix_trie": op12_prefix_trie}

# Prefixes as strings; a node's ancestors are the prefixes of its smallest member.
ORACLE_SQL = {"op12_prefix_trie": rf"""
WITH RECURSIVE
bits(v, c, k) AS (
    SELECT range, range, 0 FROM range(256)
    UNION ALL
    SELECT v, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY v) AS t FROM bits WHERE k = 8),
turns AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
    SELECT c, n, xor(4294967295, list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(range(length(c::VARCHAR)), lambda i: ascii(substr(c::VARCHAR, i::INT + 1, 1))::BIGINT)),
               lambda crc, byte: xor(t[(xor(crc, byte) & 255) + 1], crc >> 8))) % {HEADS} AS h
    FROM (SELECT c, count(*) AS n FROM turns GROUP BY c), crc_table),
rebuilt AS (
    SELECT v.c, t.k AS d, role, text FROM convs v JOIN turns t ON t.c = v.c - v.c % {GROUP} AND t.k <= v.h
    UNION ALL
    SELECT v.c, t.k - v.h + least(v.h, coalesce(b.n, 0)), role, text
    FROM convs v JOIN turns t ON t.c = v.c AND t.k > v.h LEFT JOIN convs b ON b.c = v.c - v.c % {GROUP}),
prefixes AS (
    SELECT c, 0 AS d, '' AS prefix, 0 AS words FROM convs
    UNION ALL
    SELECT c, d, string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '') OVER (PARTITION BY c ORDER BY d),
           length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) FROM rebuilt),
lengths AS (SELECT c, max(d) AS last FROM prefixes GROUP BY c),
nodes AS (
    SELECT d, prefix, min(c) AS conv, count(*) AS n, (count(*) - 1) * max(words) AS saved,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = last), '')) AS ends
    FROM prefixes JOIN lengths USING (c) GROUP BY d, prefix),
linked AS (
    SELECT n.*, p.prefix AS up, u.conv AS up_conv
    FROM nodes n LEFT JOIN prefixes p ON p.c = n.conv AND p.d = n.d - 1 LEFT JOIN nodes u ON u.d = p.d AND u.prefix = p.prefix),
kids AS (SELECT d - 1 AS d, up AS prefix, count(*) AS k FROM linked WHERE up IS NOT NULL GROUP BY ALL),
subtrees AS (
    SELECT a.d, a.prefix, sum(n.saved) AS saved, count(*) FILTER (k IS NULL) AS leaves
    FROM nodes n LEFT JOIN kids USING (d, prefix) JOIN prefixes a ON a.c = n.conv AND a.d <= n.d
    GROUP BY ALL)
SELECT conv::BIGINT AS conv_id, d::BIGINT AS depth, up_conv::BIGINT AS parent_conv_id, n AS n_convs, coalesce(k, 0) AS n_children,
       leaves AS n_leaves, s.saved::BIGINT AS saved_tokens, ends AS ends_sha256
FROM linked l JOIN subtrees s USING (d, prefix) LEFT JOIN kids USING (d, prefix)
"""}
