"""Faults of earlier rounds, each with a test that failed before it was mended."""

import numpy as np
from pyspark.sql import functions as F

from callcredit.llm import host_rules, repeats, sharding, toxicity
from callcredit.llm.storage import documents
from tests.conftest import SF_ORACLE
from tests.llm.test_llm import SHARED


def test_small_hosts_need_more_evidence(spark):
    """400 hosts of one row, a tenth of them failing: no host differs from the
    others by more than chance. Large hosts that do differ are still rejected."""
    one = [(f"h{i}", "short" if i % 10 == 0 else "w " * 30) for i in range(400)]
    failures = spark.createDataFrame([(h, t.startswith("short"), False, False, False) for h, t in one], "host string, short boolean, repeats boolean, symbols boolean, lines boolean")
    verdicts = host_rules.host_verdicts(failures).collect()
    assert len(verdicts) == 400 and all(r["host_kept"] for r in verdicts)
    bad = spark.range(200).select(F.lit("bad").alias("host"), (F.col("id") % 10 > 0).alias("short"), *[F.lit(False).alias(c) for c in ("repeats", "symbols", "lines")])
    good = spark.range(2000).select(F.concat(F.lit("g"), F.col("id") % 20).alias("host"), (F.col("id") % 50 == 0).alias("short"),
                                    *[F.lit(False).alias(c) for c in ("repeats", "symbols", "lines")])
    found = {r["host"]: r["host_kept"] for r in host_rules.host_verdicts(bad.unionByName(good)).collect()}
    assert not found.pop("bad") and all(found.values())


def test_ids_in_steps_are_dealt_to_all_parts(spark):
    """Ids in steps of the number of parts: a part holds no whole shard, and slots have no gaps."""
    docs = spark.range(0, 40_000, 100).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"))
    found = sharding.shard_documents(docs, shards=2, rows_per_task=2).toPandas()
    for _, part in found.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
        # numbered by part first: the ids of neighbouring slots don't rise with them
        ids = part.sort_values("slot").doc_id.to_numpy()
        assert (np.diff(ids) < 0).mean() > 0.2


def test_the_substring_stage_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, f"a b {SHARED} c", "mine", "other", 3), (2, f"x {SHARED} y", "too", None, 4)],
                                 "doc_id long, text string, _key string, _kept string, n_removed int")
    found = {r["doc_id"]: r.asDict() for r in repeats.without_repeats(docs).collect()}
    assert found[1] == {"doc_id": 1, "text": "a b c", "_key": "mine", "_kept": "other", "n_removed": 3}
    assert found[2] == {"doc_id": 2, "text": "x y", "_key": "too", "_kept": None, "n_removed": 4}


def test_toxic_rows_are_found_and_clean_ones_are_not(spark):
    """Recall and precision of label 1 among held-out rows; the constant 0 has neither."""
    docs = documents(spark, SF_ORACLE)
    labels = toxicity.read_labels(spark, SF_ORACLE)
    scored = toxicity.op9_toxic_segments(spark, SF_ORACLE).join(labels, "doc_id").toPandas()
    out = scored[scored.held_out]
    assert out.toxic.sum() > 3
    assert out[out.toxic == 1].predicted.mean() >= 0.6
    assert out[out.predicted == 1].toxic.mean() >= 0.8
    assert docs.count() > 0


def test_calibration_counts_the_passages_of_the_final_threshold(spark):
    """Passages that count are those whose score is significant, each by itself."""
    docs = documents(spark, SF_ORACLE)
    model = toxicity.learn(docs, toxicity.read_labels(spark, SF_ORACLE))
    rows = toxicity.measured(docs, model, ["doc_id"], spans=True).collect()
    assert any(r["passages"] for r in rows)
    for r in rows:
        limit = np.log(model["k"] * max(r["n"], 1) / toxicity.SIGNIFICANT)
        assert r["passages"] == len(r["spans"]) and all(s["score"] >= limit for s in r["spans"])
        assert not r["spans"] or r["best"] == max(s["score"] for s in r["spans"])
