"""Importance resampling: keep the documents that look most like the target texts.

Two generative models over hashed word 1- and 2-grams: one of the target texts (documents labelled good), one of all raw texts.
A document's log weight is the sum over its n-grams of log(target probability / raw probability).  The sample is drawn
without replacement by Gumbel top-k: add Gumbel noise to the log weights and keep the k largest.  k is the number of documents
that look clean: those whose log weight per n-gram reaches a cut, fitted where it parts the good from the bad labels best.  For
the fit a text of the target model is weighed as if the model did not have it; else unlabelled clean texts would look worse.

The models are two arrays of ``BUCKETS`` counts, summed over every distinct text, so that the copies of a text neither hide it nor
lift the others; the k-th largest key is found by narrowing a histogram, so no sort and no list of keys leaves the cluster.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.llm.common import hand_back, map_batches, mix, stored, window_hashes, word_hashes

BUCKETS = 10_000
SMOOTHING = 3.0
TARGET_ROWS = 50_000  # good documents the target model is fitted on at most, taken by hash of doc_id
SEED = 7
BINS = 1024
STEPS = 100  # per unit of asinh(1000 x log weight per n-gram): steps of one percent, or of 0.00001 around zero


def features(text: str | None) -> np.ndarray:
    """Bucket of every word and every pair of neighbouring words."""
    words = word_hashes((text or "").encode())
    grams = np.concatenate([mix(words), window_hashes(words, 2)])
    return (grams % np.uint64(BUCKETS)).astype(np.int64)


def bucket_counts(documents: DataFrame) -> DataFrame:
    """(bucket, n) over all distinct texts: counted per task, then summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += np.bincount(features(text.as_py()), minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])
        batch = None
        hand_back()

    return map_batches(documents.select("text").distinct(), run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _dense(counts: DataFrame) -> np.ndarray:
    """At most BUCKETS numbers."""
    out = np.zeros(BUCKETS)
    for row in counts.collect():
        out[row["bucket"]] = row["n"]
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """log(target / raw) per bucket: raw counts are scaled to the target's total, then both are smoothed, so a bucket
    that few texts reach says little either way."""
    scaled = raw * (target.sum() / max(raw.sum(), 1.0))
    return np.log(target + smoothing) - np.log(scaled + smoothing)


def weight_without(grams: np.ndarray, target: np.ndarray, raw: np.ndarray, smoothing: float = SMOOTHING) -> float:
    """Log weight of a text of the target by the target without it."""
    used, n = np.unique(grams, return_counts=True)
    scaled = raw[used] * (max(target.sum() - len(grams), 0.0) / max(raw.sum(), 1.0))
    return float((n * (np.log(np.maximum(target[used] - n, 0.0) + smoothing) - np.log(scaled + smoothing))).sum())


def gumbel(seed: int) -> Column:
    """Gumbel noise from a hash of doc_id: the same row always gets the same noise."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 11).cast("double") + 0.5) * F.lit(2.0**-53)
    return -F.log(-F.log(uniform))


def kth_largest(keys: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value (NULL and NaN left out); None if there are fewer.  Exact, by narrowing a histogram.

    Each round is one scan that counts BINS equal steps of the open range; it ends when the range holds one value."""
    low, high, n = keys.agg(F.min(column), F.max(column), F.count(column)).first()
    if k > n:
        return None
    if k < 1:
        return math.inf
    above = 0  # values over the open range
    value = F.col(column)
    while low < high:
        width = (high - low) / BINS
        if width == 0 or low + width == low:
            break
        step = F.least(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(BINS - 1))
        open_range = keys.where((value >= low) & (value <= high))
        found = {r["step"]: r for r in open_range.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()}
        for s in sorted(found, reverse=True):
            if above + found[s]["n"] >= k:
                low, high = found[s]["low"], found[s]["high"]
                break
            above += found[s]["n"]
    return high


def clean_cut(good: dict[int, int], bad: dict[int, int]) -> int:
    """The step from which on documents count as clean (good, bad: rows by step): the least share of lost good and kept bad
    ones together, and the middle of equals."""
    steps = np.arange(min(*good, *bad), max(*good, *bad) + 2)
    lost, left = (np.concatenate(([0.0], np.cumsum([n.get(int(s), 0) for s in steps[:-1]]) / sum(n.values()))) for n in (good, bad))
    wrong = lost + 1 - left
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    return int(steps[best[len(best) // 2]])


def clean_rows(scored: DataFrame, marked: DataFrame) -> int | None:
    """How many rows of ``scored`` are as clean as the good ones of ``marked``; None if a label has no text to learn from.

    One aggregate: rows by step (labelled ones also by ``unseen``), so the steps bound it, not the corpus."""
    step, unseen = (F.floor(F.asinh(F.col(c) * 1000 / F.greatest("n_grams", F.lit(1))) * STEPS) for c in ("log_weight", "unseen"))
    rows = scored.join(marked, "doc_id", "left").select(step.alias("step"), F.when(F.col("quality").isNotNull(), unseen).alias("unseen"), "quality")
    rows = rows.groupBy("step", "unseen", "quality").agg(F.count("*").alias("n")).collect()
    good, bad = Counter(), Counter()
    for r in rows:
        if r["quality"] is not None:
            (good if r["quality"] else bad)[r["unseen"]] += r["n"]
    if not good or not bad:
        return None
    cut = clean_cut(good, bad)
    return sum(r["n"] for r in rows if r["step"] >= cut)


def resample(
    documents: DataFrame, labels: DataFrame, share: float | None = None, seed: int = SEED, smoothing: float = SMOOTHING
) -> DataFrame:
    """doc_id, log_weight, gumbel_key, kept for every row of ``documents``.

    NULL and empty texts have log weight 0.  Equal rows get equal keys and stand or fall together, so ties at the
    threshold are all kept; rows with a NULL doc_id share one noise.  ``share``: keep this share of all rows instead of as many as
    look clean.  Without any good label the ratio is 0; then, and without any bad one, all documents are kept.  An empty table
    gives no rows; further columns are left out.
    """
    spark = documents.sparkSession
    docs = documents.select("doc_id", "text")
    # labels: one row per document, so the join with the texts never multiplies them
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    marked = marked.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    good = marked.where("quality = 1").count()
    raw = _dense(bucket_counts(docs))
    if good:
        chosen = marked.where("quality = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(TARGET_ROWS).select("doc_id")
        # at most TARGET_ROWS ids (0.4 MB) go to every task; the texts stay where they are
        target = _dense(bucket_counts(docs.join(F.broadcast(chosen), "doc_id", "left_semi")))
        ratio = log_ratio(target, raw, smoothing)
        docs = docs.join(F.broadcast(chosen.withColumn("used", F.lit(True))), "doc_id", "left")
    else:
        ratio = target = np.zeros(BUCKETS)
        docs = docs.withColumn("used", F.lit(None).cast("boolean"))
    models = spark.sparkContext.broadcast((ratio, target, raw))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio, target, raw = models.value
        for batch in batches:
            grams = [features(t.as_py()) for t in batch.column(1)]
            score = [float(ratio[g].sum()) for g in grams]
            unseen = [weight_without(g, target, raw, smoothing) if u.as_py() else w for g, w, u in zip(grams, score, batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score, pa.float64()), pa.array(unseen, pa.float64()), pa.array(map(len, grams), pa.int64())],
                names=["doc_id", "log_weight", "unseen", "n_grams"],
            )
        batch = grams = None
        hand_back()

    scored = map_batches(docs, run, "doc_id long, log_weight double, unseen double, n_grams long")
    scored = scored.withColumn("gumbel_key", F.col("log_weight") + gumbel(seed))
    scored = stored(scored, "weights")
    if share is not None:
        k = round(share * scored.count())
    else:
        k = clean_rows(scored, marked) if good else None
    limit = None if k is None else kth_largest(scored, "gumbel_key", k)
    return scored.drop("unseen", "n_grams").withColumn("kept", F.lit(True) if limit is None else F.col("gumbel_key") >= F.lit(limit))
