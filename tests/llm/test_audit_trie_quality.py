"""Operators 11 to 13, and the source mix and n-gram join on long tails: against
brute force, held-out labels, and on nulls, empty and long texts, ties, repeated
rows, empty tables and columns with clashing names."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from callcredit.llm import divergence, mixing, ngram_join, prefix_trie, quality_net
from callcredit.llm.words import pieces
from tests.conftest import SF_ORACLE
from tests.llm.test_llm import DOCS, LONG, TEXTS, docs_of

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tuples(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


# ---------------------------------------------------------------- 11
ODD_TEXTS = [None, "", " \n", "The THE the", "été ÉTÉ a1b2_c", "ǅ\x00x\x7fy`z{q", "don't [stop]", LONG[:2000]]


def test_terms_are_the_runs_of_letters():
    for text in ODD_TEXTS[1:]:
        assert {k.decode(): n for k, n in divergence.terms_of(text.encode()).items()} == collections.Counter(TERM.findall(text.translate(AZ)))


def audited(rows, min_docs, top):
    """The definition, dense: every group meets every kept term."""
    docs = [(lang or "", source or "", collections.Counter(TERM.findall((text or "").translate(AZ)))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = collections.Counter(t for _, _, c in own for t in c)
        kept = sorted(t for t, n in df.items() if n >= min_docs)

        def shares(which):
            total = sum(c[t] for c in which for t in kept)
            return [1 + 1_000_000_000 * (sum(c[t] for c in which) + 2) // (total + 2 * len(kept)) for t in kept], [sum(c[t] for c in which) for t in kept]

        def apart(p, q):
            return (p - q) * (p - q) // (p + q)

        groups = {s: shares([c for _, x, c in own if x == s]) for s in {x for _, x, _ in own}}
        q = shares([c for _, _, c in own])[0]
        for s, (p, n) in groups.items():
            pairs = sorted(((-sum(map(apart, p, o[0])), other.encode(), other) for other, o in groups.items() if other != s))
            out += [(lang, s, "pair", other, -v, k + 1) for k, (v, _, other) in enumerate(pairs)]
            terms = sorted((-apart(a, b), t.encode(), t) for a, b, c, t in zip(p, q, n, kept, strict=True) if c and a > b)[:top]
            out += [(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(terms)]
    return sorted(out)


def test_divergence_against_the_dense_definition(spark):
    draw = random.Random(11)
    rows = [(draw.choice(["en", "fr", None]), draw.choice(["a", "b", "é", "z", None]),
             draw.choice([None, "", " ".join(draw.choice(["one", "two", "Three", "four4five", "naïve", "x"]) for _ in range(draw.randrange(30)))]))
            for _ in range(150)]
    rows += [("lonely", "a", "only here"), ("empty", "a", None), ("empty", "b", "")] + [("en", "hot", "one " * 50)] * 40
    docs = spark.createDataFrame([(*r, 1, 2, "t") for r in rows], "lang string, source string, text string, n int, p0 int, term string")
    columns = ("lang", "source", "part", "item", "value", "rank")
    for min_docs, top in ((10, 10), (1, 2), (1000, 10)):
        assert tuples(divergence.source_divergence(docs, min_docs, top), *columns) == audited(rows, min_docs, top)


def test_divergence_counts_in_parts(spark, monkeypatch):
    """Tasks that hand over their counts early, and shares beyond 64 bits."""
    monkeypatch.setattr(divergence, "HELD_TERMS", 3)
    monkeypatch.setattr(divergence, "ROWS_PER_BATCH", 2)
    docs = spark.createDataFrame([("en", "a", "x y z w v " * 3), ("en", "b", "x y q")] * 6, "lang string, source string, text string").coalesce(1)
    found = {(r["source"], r["term"]): (r["n"], r["docs"]) for r in divergence.counted_terms(docs).collect()}
    assert found["a", "x"] == (18, 6) and found["b", "q"] == (6, 6) and found["a", ""] == (0, 0)
    big = spark.createDataFrame([(10 ** 15, 10 ** 16, 5)], "c long, n long, v long")
    assert big.select(divergence._share(F.col("c"), F.col("n"), F.col("v")).alias("p")).first()["p"] == 1 + 10 ** 9 * (10 ** 15 + 2) // (10 ** 16 + 10)
    assert divergence.source_divergence(docs.limit(0)).collect() == []


# ---------------------------------------------------------------- 12
def words_in(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def trie_of(rows):
    """The definition over (conv_id, turn, role, text) rows."""
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0), hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), (role, text)))
    own = {c: [t for _, _, t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 4, c - int(np.fmod(c, 20))
        rebuilt[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = collections.defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = collections.Counter(n[:-1] for n in members if n)
    saved, leaves = collections.Counter(), collections.Counter()
    for node, who in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(who) - 1) * (words_in(node[-1][1]) if node else 0)
            leaves[node[:d]] += not children[node]
    return sorted((min(who), len(node), -1 if not node else min(members[node[:-1]]), len(who), children[node], leaves[node], saved[node],
                   hashlib.sha256(",".join(str(c) for c in sorted(who) if rebuilt[c] == node).encode()).hexdigest()) for node, who in members.items())


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, "s") for r in rows], "conv_id long, turn int, role string, text string, key string, depth int, turns string")


def grown(df, shard):
    found = prefix_trie.prefix_trie(prefix_trie.rebuilt_sequences(df), shard)
    return sorted((r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"],
                   r["saved_tokens"], r["ends_sha256"]) for r in found.collect())


def test_trie_against_brute_force_in_one_and_many_shards(spark):
    draw = random.Random(12)
    says = [("user", "hi there"), ("bot", "hello"), ("user", ""), (None, None), ("bot", "a b  c\n d"), ("user", "x " * 40)]
    rows = [(c, t, *draw.choice(says[:2 + t % 5])) for c in [*range(-25, 90, 2), 100, 101, 119, 4095, 4096, 10 ** 12] for t in range(draw.randrange(1, 7))]
    rows += [(c, t, "user", "same for all") for c in range(200, 260) for t in range(4)]  # equal conversations, over two pieces of ids
    rows += [(c, t, "user", "same for all") for c in range(1020, 1030) for t in range(4)]
    rows += [(301, None, "bot", "first"), (301, 0, "user", "second"), (301, 0, "user", "second"), (301, 0, "bot", "tie"), (None, 1, "user", "nobody")]
    df = conversations(spark, rows)
    expected = trie_of(rows)
    for shard in (200_000, 60, 9):
        assert grown(df, shard) == expected, shard


def test_trie_of_odd_tables(spark):
    assert grown(conversations(spark, []), 10) == []
    rows = [(21, 0, "user", "only turn")]  # rebuilt from an absent conversation 20
    assert grown(conversations(spark, rows), 10) == trie_of(rows)
    deep = [(c, t, "user", f"t{t}") for c in (1, 2, 3) for t in range(700)]
    assert grown(conversations(spark, deep), 500) == trie_of(deep)


def test_search_trees_stay_balanced():
    tree = prefix_trie.SearchTree()
    for i in prefix_trie.medians(1023):
        tree.add([i], 1, i, "")
    depth, at = 0, [tree.first[0]]
    while at:
        depth, at = depth + 1, [x for n in at for x in (tree.less[n], tree.more[n]) if x >= 0]
    assert depth == 10 and sorted(prefix_trie.medians(100)) == list(range(100))


# ---------------------------------------------------------------- 13
def test_word_vectors_are_the_sums_of_neighbours(spark):
    texts = ["a b c b", "the&&& cat!! 3x a", "", None, "b"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    table = np.zeros((quality_net.BUCKETS, quality_net.DIMS))
    for text in texts:
        found = re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+|[^\x20\x09-\x0D0-9A-Za-z\x80-\U0010ffff]+", text or "")
        words = next(iter(pieces(pa.array([" ".join(found)]))))[2]
        hashes = quality_net.tokens(words)[1]
        assert len(hashes) == len(found)
        place, sign = quality_net.random_vectors(hashes)
        for i in range(len(found)):
            for j in (i - 2, i - 1, i + 1, i + 2):
                if 0 <= j < len(found):
                    for p, s in zip(place[j], sign[j], strict=True):
                        table[quality_net.bucket_of(hashes[i:i + 1])[0], p] += s
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    assert np.allclose(quality_net.word_vectors(docs), table / np.maximum(norm, 1e-12), atol=1e-6)


def test_pooling_in_parts_is_pooling(monkeypatch):
    draw = np.random.default_rng(1)
    vectors = draw.normal(size=(quality_net.BUCKETS, quality_net.DIMS)).astype(np.float32)
    words = next(iter(pieces(pa.array([LONG[:4000], None, "one", "a b a b a b"]))))[2]
    whole = quality_net.pooled(vectors, words)
    monkeypatch.setattr(quality_net, "TOKENS_AT_ONCE", 7)
    assert np.allclose(quality_net.pooled(vectors, words), whole, atol=1e-4)
    row, hashes = quality_net.tokens(words)
    first = vectors[quality_net.bucket_of(hashes[row == 0])]
    assert np.allclose(whole[0, :quality_net.DIMS], first.mean(axis=0), atol=1e-4) and not whole[1].any()
    assert np.isclose(whole[0, -2], (first[1:] * first[:-1]).sum() / (len(first) - 1), atol=1e-4)


def test_network_learns_what_a_line_cannot_and_is_calibrated():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(3000, 4))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (draw.random(3000) < 0.1)).astype(float)
    net = quality_net.Network(x[:2000], y[:2000])
    true = y[2500:]
    assert ((net.scores(x[2500:]) >= 0.5) == true).mean() > 0.83

    def loss(p):
        p = np.clip(p, 1e-9, 1 - 1e-9)
        return -np.mean(true * np.log(p) + (1 - true) * np.log(1 - p))

    fair = loss(net.scores(x[2500:]))
    net.layers[2], net.layers[3] = net.layers[2] * 6, net.layers[3] * 6  # six times too sure
    assert loss(net.scores(x[2500:])) > 1.5 * fair
    net.calibrate(x[2000:2500], y[2000:2500])
    assert 4 < net.temperature < 9 and loss(net.scores(x[2500:])) < 1.05 * fair
    assert abs(net.scores(x[2500:]).mean() - true.mean()) < 0.05


def test_quality_on_held_out_rows(spark):
    scored = quality_net.op13_quality_network(spark, SF_ORACLE).toPandas()
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet").toPandas()
    assert (scored.held_out == scored.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    out = scored[scored.held_out].merge(labels, on="doc_id")
    bad, good = out[out.quality == 0], out[out.quality == 1]
    assert len(bad) > 10 and (bad.predicted == 0).mean() > 0.8 and (good.predicted == 1).mean() > 0.95
    assert ((scored.score >= 0.7) == (scored.predicted == 1)).all() and scored.score.between(0, 1).all()


def test_quality_learns_from_no_held_out_label_and_handles_odd_rows(spark):
    docs = docs_of(spark).unionByName(spark.createDataFrame(
        [(100 + i, ("good words here " if i % 2 else "$$$ ### %%% ") * 20, None, None, 0, 0, 0, "k", 0) for i in range(60)], DOCS))
    labels = [(100 + i, i % 2) for i in range(60)]
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    learned = spark.createDataFrame([(i, q) for i, q in labels], "doc_id long, quality int")
    twisted = spark.createDataFrame([(i, 1 - q if i in held else q) for i, q in labels] + [(None, 1), (7, None)], "doc_id long, quality int")

    def run(lab):
        return sorted((r["doc_id"] or -1, r["held_out"], r["score"], r["predicted"]) for r in quality_net.quality_scores(docs, lab).collect())

    first = run(learned)
    assert len(first) == docs.count() and first == run(twisted)
    assert all(p == i % 2 for i, _, _, p in first if i >= 100)
    assert len({s for i, _, s, _ in first if i in (4, 5, 6)}) == 1  # null, empty and wordless alike
    none = quality_net.quality_scores(docs, learned.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality_net.quality_scores(docs.limit(0), learned).collect() == []
    one_sided = quality_net.quality_scores(docs, learned.where("quality = 1")).collect()
    assert {r["score"] for r in one_sided} == {1.0}


# ---------------------------------------------------------------- 5
@pytest.mark.parametrize("sizes", [[10] * 300, [200] * 300, [1, 3, 7, 40, 5000, 20_000] * 20, [0, 0, 1]])
def test_every_source_is_taken_to_its_target(spark, sizes):
    """A long tail of small sources: each within one of its blocks of its target."""
    rows = [(i, " ".join(["w"] * n), f"s{i:04d}") for i, size in enumerate(sizes) for n in ([size // 3, size - size // 3] if size > 2 else [size])]
    docs = spark.createDataFrame([(k, t, s) for k, (_, t, s) in enumerate(rows)], "doc_id long, text string, source string")
    found = mixing.mix(docs, carry=("source",)).select("_carried.source", "size", "source_size", "target", "taken", "shard_words").toPandas()
    assert (found.taken <= 2 * found["size"]).all() and (found.shard_words.map(lambda x: sum(map(int, x.split(",")))) == found.taken).all()
    by = found.groupby("source").agg(size=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    block = (by["size"] // mixing.FINENESS).clip(1, mixing.BLOCK_WORDS)
    assert ((by.taken - by.target).abs() <= block + 1e-6).all(), by[(by.taken - by.target).abs() > block]
    # every output shard has its part of every source, to a block
    shards = np.array(found.shard_words.map(lambda x: list(map(int, x.split(",")))).tolist())
    per = found.assign(**{f"j{k}": shards[:, k] for k in range(mixing.MIX_SHARDS)}).groupby("source")[[f"j{k}" for k in range(mixing.MIX_SHARDS)]].sum()
    assert ((per.sub(by.taken / mixing.MIX_SHARDS, axis=0)).abs().le(2 * block + 1, axis=0)).all().all()


def test_mixed_texts_are_runs_of_words(spark):
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(n)), "ab"[i % 2]) for i, n in enumerate([5, 1000, 30, 0, 77, 2, 640])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()}
    texts = collections.defaultdict(list)
    for r in mixing.mixed_documents(docs).collect():
        texts[r["doc_id"]].append(r["text"].split())
    for i, text, _ in rows:
        assert sum(map(len, texts[i])) == taken[i] and len(texts[i]) <= 2
        for part in texts[i]:
            at = [text.split().index(w) for w in part]
            assert at == sorted(at) and sum(b != a + 1 for a, b in zip(at, at[1:])) <= 1  # a run, or the two ends of a document


# ---------------------------------------------------------------- 1
def test_overlaps_of_blocks_against_sets():
    draw = np.random.default_rng(7)
    for columns, n in ((40, 90), (5000, 60), (300, 130)):
        x, y = ([np.unique(draw.integers(0, columns, draw.integers(1, 60))) for _ in range(m)] for m in (n, n // 2))
        expected = [[len(np.intersect1d(a, b)) for b in y] for a in x]
        assert (ngram_join.overlaps(x, y) == expected).all()
    assert (ngram_join.overlaps([np.array([1])], [np.array([2])]) == 0).all()


def template_texts(n, slots=3, values=12):
    draw, out = random.Random(5), set()
    while len(out) < n:
        words = [f"t{i}" for i in range(24)]
        for at in (4, 11, 18)[:slots]:
            words[at] = f"v{at}x{draw.randrange(values)}"
        out.add(" ".join(words))
    return sorted(out)


def test_long_columns_find_the_links_that_pairs_find(spark, monkeypatch):
    """Template texts, some of them with a partner that links only through a long column."""
    texts = template_texts(900)
    texts += [" ".join([*t.split(), "tail", "of", "it"]) for t in texts[::50]] + [" ".join(t.split()[:-1]) for t in texts[7::90]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")

    def classes():
        found = ngram_join.text_classes(docs).groupBy("_class").agg(F.sort_array(F.collect_list("_key")).alias("k")).collect()
        return sorted(tuple(r["k"]) for r in found)

    by_blocks = classes()
    with monkeypatch.context() as patch:
        patch.setattr(ngram_join, "BLOCK", 40)
        assert classes() == by_blocks
        patch.setattr(ngram_join, "SMALL", 10 ** 9)
        assert classes() == by_blocks
    shingles = [{tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    up = list(range(len(texts)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(shingles[i] & shingles[j]) >= 4 * len(shingles[i] | shingles[j]):
                up[max(top(i), top(j))] = min(top(i), top(j))
    assert len(by_blocks) == len({top(i) for i in range(len(texts))}) < len(texts)


def test_no_column_names_or_texts_of_the_input_get_in_the_way(spark):
    docs = docs_of(spark)
    assert len(TEXTS) == mixing.mix(docs).count() == quality_net.quality_scores(docs, spark.createDataFrame([], "doc_id long, quality int")).count()
    assert divergence.source_divergence(docs).where("part = 'pair'").count() == 4 * 3  # null is a source of its own
