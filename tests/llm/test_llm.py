"""Operators of callcredit.llm against SQL, other libraries and brute force,
and on nulls, empty and long texts, ties, repeated rows, empty tables and
columns with the names the operators use."""

import collections
import hashlib
import random
import re
import textwrap
import zlib

import numpy as np
import pytest

import corpus_pipeline
from callcredit.llm import bpe, ctw, host_rules, itq, licences, mixing, ngram_join, registry, repeats, sharding, toxicity
from callcredit.oracle.compare import compare
from tests.conftest import SF_ORACLE, SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
QUERIES, ORACLE = registry.queries(), registry.oracle_sql()
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, _key string, hits long"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
SHARED = " ".join(f"common{i}" for i in range(60))
TEXTS = [
    (1, "one two three four five six seven"), (2, "One two  three four five six seven"), (2, "One two  three four five six seven"),
    (None, None), (4, None), (5, ""), (6, " \t\n"), (7, "word"), (8, "word"), (9, LONG), (10, f"a b {SHARED} c d"),
    (11, f"other {SHARED} words"), (12, "x y " * 40), (13, "été Σας ΑΣ <|endoftext|> don't 123"), (None, "no id here at all but words")]


def docs_of(spark, rows=TEXTS):
    return spark.createDataFrame([(i, t, None, f"s{k % 3}" if k % 4 else None, len(t or ""), k, k, "k", k) for k, (i, t) in enumerate(rows)], DOCS)


def collected(df):
    return [r.asDict() for r in df.collect()]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, oracle_con, name):
    found = compare(QUERIES[name](spark, SF_ORACLE), ORACLE[name], oracle_con)
    assert found["schema_match"] and found["match"], found


def operators(spark, docs):
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    labels = spark.createDataFrame([(1, 0), (7, 1)], "doc_id long, toxic int")
    rows = docs.selectExpr("doc_id", "true AS trains", "text")
    return {
        "shard": lambda: sharding.shard_documents(docs, 4), "mix": lambda: mixing.mix(docs), "mixed": lambda: mixing.mixed_documents(docs),
        "licence": lambda: licences.scan_licences(docs), "hosts": lambda: host_rules.judge_documents(docs),
        "bpe": lambda: bpe.encode_and_decode(docs, bpe.tokenizer_path()), "repeats": lambda: repeats.without_repeats(docs),
        "near": lambda: ngram_join.one_of_class(docs), "ctw": lambda: ctw.lm_scores(rows), "itq": lambda: itq.near_duplicates(vectors),
        "toxic": lambda: toxicity.without_toxic(docs, toxicity.learn(docs, labels))}


def test_empty_tables(spark):
    for name, run in operators(spark, docs_of(spark, [])).items():
        assert run().collect() == [], name


def test_odd_rows(spark):
    docs = docs_of(spark)
    found = {name: collected(run()) for name, run in operators(spark, docs).items() if name != "itq"}
    n = len(TEXTS)
    for name in ("shard", "mix", "licence", "hosts", "bpe", "repeats", "ctw"):
        assert len(found[name]) == n, name
    for name in ("mixed", "repeats", "near", "toxic"):
        assert all(set(r) == set(docs.columns) for r in found[name]), name
    # one row of each class; wordless rows all stay
    assert sorted(r["doc_id"] or 0 for r in found["near"]) == [0, 0, 1, 4, 5, 6, 7, 9, 10, 12, 13]
    # the shared passage goes from both, twins of 7 words are too short to go, a repeat inside a text goes
    kept = {r["doc_id"]: r["text"] for r in found["repeats"]}
    assert (kept[10], kept[11], kept[12]) == ("a b c d", "other words", "")
    assert kept[1] == TEXTS[0][1] and kept[4] is None and kept[9] == LONG
    for shard in {r["shard"] for r in found["shard"]}:
        slots = sorted(r["slot"] for r in found["shard"] if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert all(r["text_crc32"] == zlib.crc32((t or "").encode()) for r, (_, t) in zip(
        sorted(found["shard"], key=lambda r: (r["doc_id"] or 0, r["text_crc32"])),
        sorted(TEXTS, key=lambda x: (x[0] or 0, zlib.crc32((x[1] or "").encode()))), strict=True))
    assert all(r["taken"] <= 2 * r["size"] for r in found["mix"])
    assert {r["n_tokens"] for r in found["ctw"] if r["doc_id"] in (4, 5, 6)} == {1}
    assert all(r["score"] < 0 for r in found["ctw"])


def test_jump_hash_moves_only_into_the_new_shard(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'t' AS text")
    small = {r["doc_id"]: r for r in collected(sharding.shard_documents(docs, 9))}
    large = {r["doc_id"]: r for r in collected(sharding.shard_documents(docs, 10, rows_per_task=50))}
    assert all(small[i]["grown_shard"] == large[i]["shard"] for i in small)
    assert all(large[i]["shard"] in (small[i]["shard"], 9) for i in small)
    assert 200 < sum(large[i]["shard"] == 9 for i in small) < 400


def test_mix_keeps_to_targets(spark):
    rows = collected(QUERIES["op5_source_mix"](spark, SF_ORACLE).join(
        spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "source"), "doc_id"))
    by: dict = {}
    for r in rows:
        by.setdefault(r["source"], [r["target"], 0])[1] += r["taken"]
    assert all(abs(taken - target) <= 2 * mixing.BLOCK_WORDS for target, taken in by.values())


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(bpe.tokenizer_path())
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text").union(
        docs_of(spark).select("doc_id", "text"))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = []
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        expected.append((len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False))))
    found = bpe.token_digests(docs, bpe.tokenizer_path()).select("n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, found)) == sorted(expected)


def test_context_tree_is_a_distribution(spark):
    """The prices of all bytes that can follow a context add up to one."""
    rng = np.random.default_rng(1)
    seen = rng.integers(97, 101, (400, 4)).astype(np.uint64)
    keys = np.unique(sum(seen[:, i] << np.uint64(8 * (3 - i)) for i in range(4)))
    context = keys[5] >> np.uint64(8) << np.uint64(8)
    every = np.union1d(keys, context | np.arange(256, dtype=np.uint64))
    n = np.where(np.isin(every, keys), 3, 0)
    import pyarrow as pa
    roots = ctw._roots(pa.table({"key": every.view(np.int64), "n": n}), 3)
    top = ctw._top(*[roots.column(c).to_numpy() for c in ("node", "n0", "n1", "below")])
    prices = ctw._priced(every, n, top, 3)
    assert abs((10 ** prices[every >> np.uint64(8) << np.uint64(8) == context]).sum() - 1) < 1e-9


def test_context_tree_counts_and_scores(spark):
    rows = collected(ctw.op2_context_tree(spark, SF_SMALL))
    texts = {r["doc_id"]: WORD.findall((r["text"] or "").translate({c: c + 32 for c in range(65, 91)}))
             for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    train = [i for i in texts if zlib.crc32(str(i).encode()) % 5 != 1]
    known = {w for i in train for w in texts[i]}
    assert {r["train_tokens"] for r in rows} == {sum(len(texts[i]) + 1 for i in train)}
    assert all(r["n_tokens"] == len(texts[r["doc_id"]]) + 1 and r["n_known"] == sum(w in known for w in texts[r["doc_id"]]) + 1 for r in rows)
    assert 1 < sum(r["bits_per_byte"] for r in rows) / len(rows) < 4 and all(r["score"] < 0 for r in rows)


def test_toxicity_on_held_out_rows(spark):
    found = toxicity.op9_toxic_segments(spark, SF_ORACLE).join(toxicity.read_labels(spark, SF_ORACLE), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in found]) > 0.9


def test_toxicity_learns_from_all_but_equal_texts_of_a_label(spark):
    near = SHARED + " and an end of its own"
    rows = [(1, SHARED, 0), (2, SHARED, 0), (3, SHARED, 1), (4, near, 0), (5, near, 1), (6, None, 0), (7, "", 0)]
    labelled = spark.createDataFrame([(*r, False) for r in rows], "doc_id long, text string, toxic int, calibrates boolean")
    found = toxicity.one_of_equal_texts(labelled.unionAll(labelled)).collect()
    assert sorted((r["text"] or "", r["toxic"]) for r in found) == [("", 0), (SHARED, 0), (SHARED, 1), (near, 0), (near, 1)]


def test_segments_are_maximal():
    scanner = toxicity.Scanner(np.zeros(0, np.uint64), np.zeros(0), -1.0)
    # scores 4 -1 -1 3 -9 2: the first two hits join, the last stands alone
    assert scanner.segments(np.array([0, 3, 13]), np.array([4.0, 3.0, 2.0])) == [(0, 4, 5.0), (13, 14, 2.0)]


def test_quantised_vectors_find_what_brute_force_finds(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 24))
    near = np.repeat(base[:12], 40, 0) + 0.02 * rng.standard_normal((480, 24))
    vectors = [x.tolist() for x in np.vstack([base, near])]
    rows = [(i, v, i % 2) for i, v in enumerate(vectors)] + [(900, vectors[0], 0), (901, None, 1), (902, [0.0] * 24, 1), (903, vectors[1], None), (904, [float("nan")] * 24, 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = {r["vec_id"]: r for r in collected(itq.near_duplicates(table))}
    ok = [(i, np.float32(v).astype(float), lab) for i, v, lab in rows if v and lab is not None and np.isfinite(v).all() and any(v)]
    total = hit = 0
    for i, v, lab in ok:
        links = sum(lab == m and i != j and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.98 for j, w, m in ok)
        total, hit = total + links, hit + found[i]["n_links"]
        assert found[i]["n_links"] <= links
    assert hit >= 0.9 * total > 0
    assert all(found[i]["n_links"] == 0 and found[i]["kept"] for i in (901, 902, 903, 904))


def test_pipeline_stages_have_effect(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == columns and 0 < out.count() <= docs.count(), name
        docs = spark.createDataFrame(out.collect(), docs.schema)
    final = corpus_pipeline.run(spark, SF_SMALL)
    assert final.where("n_tokens <> size(ids)").count() == 0 and final.count() > 0


def test_mixed_texts_have_the_words_taken(spark):
    docs = docs_of(spark)
    taken = sum(r["taken"] for r in collected(mixing.mix(docs)))
    assert taken == sum(len(WORD.findall(r["text"] or "")) for r in collected(mixing.mixed_documents(docs)))


def best_of_all_runs(text, templates):
    """(dice, licence) of the best of all runs of words, counted one by one."""
    grams, best = licences._bigrams(text), (0.0, 0)
    for i, (_, template) in enumerate(templates):
        known = collections.Counter(licences._bigrams(template))
        for s in range(len(grams)):
            left, shared = known.copy(), 0
            for e in range(s, len(grams)):
                shared, left[grams[e]] = shared + (left[grams[e]] > 0), left[grams[e]] - 1
                if shared * 200 >= (e - s + 1 + known.total()) * licences.PERCENT:
                    best = max(best, (shared * 2 / (e - s + 1 + known.total()), -i))
    return best[0], templates[-best[1]][0] if best[0] else None


def test_licence_runs_wrapped_in_lines_and_whole(spark):
    code = [f"value_{i} = compute(argument_{i}, {i})" for i in range(40)]
    long = [(n, t) for n, t in licences.TEMPLATES if len(t) > 120]
    wrapped = ["\n".join(textwrap.wrap(t, 76) + code) for _, t in long]
    prose = "The tool reads tables. It is small. Released under the MIT License. Issues are welcome on the tracker, as are patches and notes."
    texts = [*wrapped, prose, *["Copyright 2024 Some One\n\n" + t for _, t in licences.FULL_TEXTS]]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in collected(licences.scan_licences(rows))}
    names = [n for n, _ in long] + ["MIT"] + [n for n, _ in licences.FULL_TEXTS]
    assert [(found[i]["licence"], found[i]["n_matches"]) for i in range(len(texts))] == [(n, 1) for n in names]
    assert all(found[i]["dice"] == 1.0 for i in range(len(texts)))


def test_licence_runs_equal_brute_force(spark):
    rng = random.Random(5)
    templates = licences.TEMPLATES[:3] + (("X", "a b a b a b c d a b"), ("Y", "c d a b c d e f"))
    pool = [w for _, t in templates for w in t.split()] + ["a", "b", "c", "d"] * 8
    texts = []
    for _ in range(150):
        parts = [rng.choice(templates)[1].split() if rng.random() < 0.4 else rng.choices(pool, k=rng.randint(1, 9)) for _ in range(4)]
        # no two words alone in a line: only runs are compared here
        texts.append(" ".join(w for p in parts for w in p if rng.random() < 0.93))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in collected(licences.scan_licences(rows, templates=(("none", "zq zr zs zt"),), full_texts=templates)):
        dice, _ = best_of_all_runs(texts[r["doc_id"]], templates)
        # the run that shares most bigrams wins over a better one it overlaps
        assert (r["n_matches"] > 0) == (dice > 0) and r["dice"] <= dice
    alone = templates[3:4]
    for r in collected(licences.scan_licences(rows, templates=(("none", "zq zr zs zt"),), full_texts=alone)):
        known = best_of_all_runs(texts[r["doc_id"]], alone)[0]
        assert (r["n_matches"] > 0) == (known > 0) and r["dice"] <= known
