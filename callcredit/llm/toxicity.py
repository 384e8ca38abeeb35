"""Toxic passages as maximal segments of token log-odds.

Learning. Labelled rows of the learning folds, at most ``FIT_ROWS`` of them by
a hash of the id and equal texts of a label once, give counts of tokens (letters of a word,
lower case) and of token beginnings of 4, 5 and 6 bytes, by label. Log-odds
with an informative Dirichlet prior (Monroe, Colaresi and Quinn, 2008) and
their z-scores choose at most ``MODEL_FEATURES`` toxic ones; all other tokens
share one small negative score.

Scoring. Every whole text is scanned once by the algorithm of Ruzzo and Tompa
(1999), which finds all maximal scoring segments in linear time. A segment of
score S in a text of n tokens has the E-value K n exp(-S); K is fitted to clean
texts of the calibration fold, as for local alignments (Karlin and Altschul,
1990). A logistic curve over the best E-value, the number of significant
passages and of toxic tokens, fitted on the same fold, gives the score.

Sizes. The sample and the model are bounded by those two parameters and
broadcast; calibration brings a few numbers a calibration row to the driver,
bounded by ``FIT_ROWS`` too. Counting and scoring run over all rows.

Defined results: null, empty and wordless texts have no passages and the score
of such evidence; a row without doc_id is held out; of several labels of an id
the highest counts; without any labelled rows of both kinds every score is the
share of toxic labels known, or 0; repeated rows score alike; other columns
never clash, as only doc_id, text and toxic are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callcredit.llm.storage import documents, staged, texts_in_small_batches
from callcredit.llm.words import Words, per_row, pieces, segment_hashes

FIT_ROWS = 50_000
MODEL_FEATURES = 20_000
MIN_TOXIC_TEXTS = 3
MIN_Z = 3.5
PRIOR_SHARE = 0.05  # prior tokens a token seen
FOLDS = 5
HELD_OUT_FOLD = 0
CALIBRATION_FOLD = 4
SIGNIFICANT = 0.01
BEGINNINGS = (4, 5, 6)

LETTER = np.zeros(256, bool)
LETTER[ord("a"):ord("z") + 1] = True
LETTER[0x80:] = True


def fold_of(column):
    """crc32 of the id as text, by ``FOLDS``; rows without id are held out."""
    return F.coalesce(F.crc32(column.cast("string")) % FOLDS, F.lit(HELD_OUT_FOLD))


def _tokens(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Row of each token, and an array of its feature hashes per feature kind."""
    letters = np.flatnonzero(LETTER[words.buf])
    if not len(letters):
        return np.zeros(0, np.int64), np.zeros((1 + len(BEGINNINGS), 0), np.uint64)
    first, after = np.searchsorted(letters, words.starts), np.searchsorted(letters, words.ends)
    kept = first < after
    starts, ends = letters[first[kept]], letters[after[kept] - 1] + 1
    kinds = [segment_hashes(words.buf, starts, ends)]
    for n in BEGINNINGS:
        kinds.append(segment_hashes(words.buf, starts, np.minimum(ends, starts + n)) ^ np.uint64(n))
    return words.row[kept], np.array(kinds)


def _count(toxic: np.ndarray, words: Words) -> dict[str, np.ndarray]:
    """Tokens and texts of either label that have each feature."""
    row, kinds = _tokens(words)
    keys = np.concatenate([kinds[0], *[k for k in kinds[1:]]])
    rows = np.tile(row, len(kinds))
    order = np.lexsort((rows, keys))
    keys, rows = keys[order], rows[order]
    label = toxic[rows]
    begins = np.append(True, keys[1:] != keys[:-1])[:len(keys)]
    new_text = begins | np.append(True, rows[1:] != rows[:-1])[:len(keys)]
    at = np.flatnonzero(begins)
    add = lambda x: np.add.reduceat(x.astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
    return {"feature": keys[at].view(np.int64), "y1": add(label == 1), "y0": add(label == 0),
            "d1": add(new_text & (label == 1)), "d0": add(new_text & (label == 0))}


def one_of_equal_texts(labelled: DataFrame) -> DataFrame:
    """(text, toxic, calibrates) rows, equal texts once a label; the least
    doc_id of them stays."""
    keyed = labelled.withColumn("same", F.sha2(F.coalesce("text", F.lit("")), 256))
    one = keyed.groupBy("same", "toxic").agg(F.min("doc_id").alias("doc_id"))
    return keyed.join(F.broadcast(one), ["same", "toxic", "doc_id"]).dropDuplicates(["same", "doc_id"]).select("text", "toxic", "calibrates")


def feature_counts(labelled: DataFrame) -> DataFrame:
    """(feature, y1, y0, d1, d0) of (text, toxic) rows."""

    texts_in_small_batches(labelled.sparkSession)

    def run(batches):
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
            for at, end, words in pieces(batch.column("text"), lower=True):
                yield pa.RecordBatch.from_pydict(_count(toxic[at:end], words))

    counted = labelled.select("text", F.col("toxic").cast("int")).mapInArrow(run, "feature long, y1 long, y0 long, d1 long, d0 long")
    return counted.groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("y1", "y0", "d1", "d0")])


def choose_features(counts: DataFrame, n1: int, n0: int) -> list[tuple[int, float]]:
    """The most toxic features and their log-odds, at most MODEL_FEATURES."""
    prior = (F.col("y1") + F.col("y0")) * PRIOR_SHARE
    tokens = (n1 + n0) * PRIOR_SHARE

    def odds(y, n):
        return F.log((y + prior) / (n + tokens - y - prior))

    delta = odds(F.col("y1"), float(n1)) - odds(F.col("y0"), float(n0))
    spread = F.sqrt(1 / (F.col("d1") + prior) + 1 / (F.col("d0") + prior))
    chosen = (
        counts.where((F.col("d1") >= MIN_TOXIC_TEXTS) & (F.col("y1") < n1))
        .select("feature", delta.alias("delta"), (delta / spread).alias("z"))
        .where(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "feature").limit(MODEL_FEATURES))
    return [(r["feature"], r["delta"]) for r in chosen.select("feature", "delta").collect()]


class Scanner:
    """Finds the maximal segments of texts."""

    def __init__(self, features: np.ndarray, scores: np.ndarray, other: float):
        order = np.argsort(features)
        self.features, self.scores, self.other = features[order], scores[order], other
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[features & np.uint64(0xFFFFF)] = True

    def hits(self, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens with a feature of the model, and their highest scores."""
        score = np.full(kinds.shape[1], -np.inf)
        for keys in kinds if len(self.features) else ():
            at = np.flatnonzero(self.maybe[keys & np.uint64(0xFFFFF)])
            place = np.minimum(np.searchsorted(self.features, keys[at]), len(self.features) - 1)
            same = self.features[place] == keys[at]
            score[at[same]] = np.maximum(score[at[same]], self.scores[place[same]])
        at = np.flatnonzero(score > 0)
        return at, score[at]

    def segments(self, at: np.ndarray, score: np.ndarray) -> list[tuple[int, int, float]]:
        """(first token, end token, score) of all maximal segments of a text
        whose tokens ``at`` have positive scores and all others ``other``."""
        held: list[tuple[float, float, int, int]] = []  # total before, total after, first, end
        total, last = 0.0, -1
        for p, s in zip(at.tolist(), score.tolist(), strict=True):
            total += self.other * (p - last - 1)
            before, after, first = total, total + s, p
            while True:
                j = len(held) - 1
                while j >= 0 and held[j][0] >= before:
                    j -= 1
                if j < 0 or held[j][1] >= after:
                    held.append((before, after, first, p + 1))
                    break
                before, first = held[j][0], held[j][2]
                del held[j:]
            total, last = total + s, p
        return [(first, end, after - before) for before, after, first, end in held]

    def scan(self, words: Words) -> tuple[np.ndarray, np.ndarray, dict[int, list[tuple[int, int, float]]]]:
        """Tokens and toxic tokens of each row, and the segments of rows that have some."""
        row, kinds = _tokens(words)
        n = per_row(np.ones(len(row)), row, words.rows)
        at, score = self.hits(kinds)
        of = row[at]
        begin = np.cumsum(n) - n
        found = {}
        cuts = np.flatnonzero(np.append(True, of[1:] != of[:-1])[:len(of)])
        for i, j in zip(cuts, np.append(cuts, len(of))[1:], strict=True):
            found[int(of[i])] = self.segments(at[i:j] - begin[of[i]], score[i:j])
        return n, per_row(np.ones(len(of)), of, words.rows), found


def _evidence(n: np.ndarray, hits: np.ndarray, best: np.ndarray, passages: np.ndarray, k: float) -> np.ndarray:
    surprise = best - np.log(k * np.maximum(n, 1))
    return np.stack([np.ones(len(n)), np.clip(surprise, -20, 60) / 10, np.minimum(passages, 20), np.log1p(hits)], 1)


def _fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    w = np.zeros(x.shape[1])
    keep = np.append(0.0, np.full(x.shape[1] - 1, ridge))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep) + 1e-9 * np.eye(len(w)), x.T @ (y - p) - keep * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _significant(n: int, k: float) -> float:
    """The least score of a significant passage among n tokens."""
    return float(np.log(k * max(n, 1) / SIGNIFICANT))


def learn(docs: DataFrame, labels: DataFrame) -> dict:
    """The model as plain values, from labelled rows outside the held-out fold."""
    sample = staged(
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold_of(F.col("doc_id")) != HELD_OUT_FOLD))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS))
    labelled = (
        docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
        .withColumn("calibrates", fold_of(F.col("doc_id")) == CALIBRATION_FOLD)
        .select("doc_id", "text", "toxic", "calibrates"))
    labelled = staged(one_of_equal_texts(labelled))
    counts = staged(feature_counts(labelled.where("not calibrates")))
    shares = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = shares.get(1, 0) / max(1, sum(shares.values()))
    model = {"features": np.zeros(0, np.uint64), "scores": np.zeros(0), "other": -0.01, "k": 1.0, "curve": None, "share": float(share)}
    totals = counts.agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0")).first()
    if not totals["y1"] or not totals["y0"]:
        return model
    kinds = 1 + len(BEGINNINGS)
    n1, n0 = totals["y1"] // kinds, totals["y0"] // kinds
    chosen = choose_features(counts, n1, n0)
    model["features"] = np.array([f for f, _ in chosen], np.int64).view(np.uint64)
    model["scores"] = np.array([s for _, s in chosen])
    calibration = labelled.where("calibrates").select("text", "toxic")
    tried = measured(calibration, model, ["toxic"]).select("toxic", "n", "hits").toPandas()
    toxic = tried[tried.toxic == 1]
    model["other"] = float(np.log1p(-min(max((toxic.hits.sum() + 1) / (toxic.n.sum() + 100), 1e-3), 0.5)))
    # A few numbers a calibration row, FIT_ROWS rows at most; texts are scanned again rather than their segments kept.
    tried = measured(calibration, model, ["toxic"]).select("toxic", "n", "best").toPandas()
    clean = tried[tried.toxic == 0]
    if len(clean) == 0 or len(clean) == len(tried):
        return model
    model["k"] = float((len(clean) + 1) / ((np.maximum(clean.n, 1) * np.exp(-clean.best)).sum() + 1))
    tried = measured(calibration, model, ["toxic"]).select("toxic", "n", "hits", "best", "passages").toPandas()
    x = _evidence(tried.n.to_numpy(), tried.hits.to_numpy(), tried.best.to_numpy(), tried.passages.to_numpy(), model["k"])
    model["curve"] = _fit_logistic(x, tried.toxic.to_numpy().astype(float))
    return model


def measured(docs: DataFrame, model: dict, carry: list[str], spans: bool = False) -> DataFrame:
    """``carry`` columns, tokens (n), toxic tokens (hits), best segment score,
    significant passages, and on demand their token spans and scores."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span_type = T.StructType().add("start", "long").add("end", "long").add("score", "double")
    schema = T.StructType([docs.schema[c] for c in carry])
    for name, kind in (("n", "long"), ("hits", "long"), ("best", "double"), ("passages", "long")):
        schema.add(name, kind)
    if spans:
        schema.add("spans", T.ArrayType(span_type))

    texts_in_small_batches(docs.sparkSession)

    def run(batches):
        m = shared.value
        scanner = Scanner(m["features"], m["scores"], m["other"])
        span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
        for batch in batches:
            out: list[tuple] = []
            for _, _, words in pieces(batch.column("text"), lower=True):
                n, hits, found = scanner.scan(words)
                for i in range(words.rows):
                    segments = found.get(i, ())
                    strong = [s for s in segments if s[2] >= _significant(int(n[i]), m["k"])]
                    out.append((int(n[i]), int(hits[i]), max((s[2] for s in segments), default=0.0), len(strong), strong))
            cells = list(zip(*out, strict=True)) or [()] * 5
            columns = [*[batch.column(c) for c in carry], pa.array(cells[0], pa.int64()), pa.array(cells[1], pa.int64()),
                       pa.array(cells[2], pa.float64()), pa.array(cells[3], pa.int64())]
            if spans:
                columns.append(pa.array([[dict(zip(("start", "end", "score"), s, strict=True)) for s in x] for x in cells[4]], pa.list_(span)))
            yield pa.RecordBatch.from_arrays(columns, [*carry, "n", "hits", "best", "passages", *["spans"] * spans])

    return docs.select(*dict.fromkeys([*carry, "text"])).mapInArrow(run, schema)


def toxicity_scores(docs: DataFrame, model: dict, carry: list[str], spans: bool = False) -> DataFrame:
    """``carry`` columns, score, predicted and, on demand, spans."""
    found = measured(docs, model, carry, spans)
    if model["curve"] is None:
        score = F.lit(model["share"])
    else:
        w = [F.lit(float(x)) for x in model["curve"]]
        surprise = F.col("best") - F.log(F.lit(model["k"]) * F.greatest(F.col("n"), F.lit(1)))
        line = (w[0] + w[1] * F.least(F.greatest(surprise, F.lit(-20.0)), F.lit(60.0)) / 10
                + w[2] * F.least("passages", F.lit(20)) + w[3] * F.log1p("hits"))
        score = 1 / (1 + F.exp(-line))
    return found.withColumn("score", score).select(
        *carry, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.col("passages").alias("n_passages"), *["spans"] * spans)


def without_toxic(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, with their columns."""
    packed = docs.select(F.struct(*docs.columns).alias("_row"), "text")
    return toxicity_scores(packed, model, ["_row"]).where("predicted = 0").select("_row.*")


def read_labels(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")


def op9_toxic_segments(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = toxicity_scores(docs, learn(docs, read_labels(spark, sf_dir)), ["doc_id"])
    return scored.select("doc_id", (fold_of(F.col("doc_id")) == HELD_OUT_FOLD).alias("held_out"), "score", "predicted", "n_passages")


QUERIES = {"op9_toxic_segments": op9_toxic_segments}
ORACLE_SQL: dict[str, str] = {}
