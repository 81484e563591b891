"""Exact inner-product top-k: vectors grouped by length, pruned bucket by bucket, then verified.

Vectors become integers (floor of a scaled component).  Candidates are grouped by length (steps of an eighth of an
octave), large groups are split by hash into blocks of a few thousand rows, and each block knows its largest length.
Queries travel in blocks too, with a *running threshold*: the k-th best score a query reached among the longest
candidates.  A block pair is dropped when no query can reach its threshold there.  Inside a pair the local cosine
threshold (threshold / (query length x block's largest length)) decides per query:

* low: *length pruning*, only candidates long enough to reach the threshold at cosine one are kept;
* high: *coordinate pruning*, the candidate's coordinate on the query's largest component must lie in the interval that
  the local cosine allows.

What is left is verified by exact integer products.  Bounds are loosened by a relative 1e-9 so that rounding never drops a
candidate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.common import map_batches, stored
from caseloom.session import ship_package

SCALE = 64
BLOCK = 2048  # candidates in a block on average
QUERIES = 256  # queries in a block on average
STEPS = 8  # length groups per octave
COORDINATE_FROM = 0.5  # local cosine from which coordinate pruning cuts more than length pruning
_SLACK = 1e-9
_BLOCK = "block long, dim int, longest double, ids binary, vectors binary"


def _integers(vectors: DataFrame) -> DataFrame:
    """vec_id, v array<long>, dim, norm of the vectors that take part."""
    usable = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    rows = vectors.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & usable)
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    rows = rows.select("vec_id", v.alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return rows.select("vec_id", "v", F.size("v").alias("dim"), norm.alias("norm"))


def _pack(rows: DataFrame, keys: list[str], sort: bool) -> DataFrame:
    """One row per block: ids and the matrix as bytes, longest vectors first if sorted."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["norm", "vec_id"], ascending=[False, True]) if sort else pdf.sort_values("vec_id")
        matrix = np.array(pdf["v"].tolist(), np.int64).reshape(len(pdf), int(pdf["dim"].iloc[0]))
        return pd.DataFrame(
            {
                "block": [pdf["block"].iloc[0]], "dim": [pdf["dim"].iloc[0]], "longest": [pdf["norm"].max()],
                "ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()], "vectors": [matrix.tobytes()],
            }
        )

    ship_package(rows.sparkSession)
    return rows.groupBy(*keys).applyInPandas(pack, _BLOCK)


def products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact integer inner products (by floating point only where every partial sum is exact)."""
    if not queries.size or not candidates.size:
        return np.zeros((len(queries), len(candidates)), np.int64)
    bound = float(np.abs(queries).max()) * float(np.abs(candidates).max()) * queries.shape[1]
    if bound < 2.0**53:
        return (queries.astype(np.float64) @ candidates.astype(np.float64).T).astype(np.int64)
    return queries @ candidates.T


def survivors(query: np.ndarray, candidates: np.ndarray, lengths: np.ndarray, threshold: float) -> np.ndarray:
    """Rows of a block (sorted by length, longest first) that may reach the threshold; the block's own pruning choice."""
    own = float(np.sqrt((query.astype(np.float64) ** 2).sum()))
    if not np.isfinite(threshold) or threshold <= 0 or own == 0:
        return np.arange(len(candidates)) if threshold <= 0 or not np.isfinite(threshold) else np.empty(0, np.int64)
    needed = threshold / own * (1 - _SLACK)
    local = needed / lengths[0] if lengths[0] else np.inf
    if local > 1:
        return np.empty(0, np.int64)
    long = int(np.searchsorted(-lengths, -needed, side="right"))  # length pruning: a prefix of the block
    if local < COORDINATE_FROM:
        return np.arange(long)
    at = int(np.abs(query).argmax())
    # angles: candidate within acos(local) of the query, so its angle to the axis is the query's give or take that
    axis, reach = np.arccos(np.clip(query[at] / own, -1, 1)), np.arccos(min(1.0, local))
    low, high = np.cos(min(np.pi, axis + reach)) - 1e-7, np.cos(max(0.0, axis - reach)) + 1e-7
    c = candidates[:long, at] / lengths[:long]
    return np.flatnonzero((c >= low) & (c <= high))


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _scan(pairs: DataFrame, k: int) -> DataFrame:
    """The k best candidates of each query in each block pair, none below the query's threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                q_ids = np.frombuffer(row["q_ids"], np.int64)
                candidates = np.frombuffer(row["vectors"], np.int64).reshape(len(ids), row["dim"])
                queries = np.frombuffer(row["q_vectors"], np.int64).reshape(len(q_ids), row["dim"])
                limits = np.frombuffer(row["limits"], np.float64) if row["limits"] else np.full(len(q_ids), -np.inf)
                lengths = np.sqrt((candidates.astype(np.float64) ** 2).sum(1))
                found: tuple[list, list, list] = ([], [], [])
                for i, query in enumerate(queries):
                    rows = survivors(query, candidates, lengths, limits[i])
                    rows = rows[ids[rows] != q_ids[i]]
                    scores = products(query[None], candidates[rows])[0]
                    reach = scores >= limits[i]
                    best, score = _best(ids[rows][reach], scores[reach], k)
                    found[0].append(np.full(len(best), q_ids[i]))
                    found[1].append(best)
                    found[2].append(score)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x) if x else [], pa.int64()) for x in found], names=["query_id", "vec_id", "score"]
                )

    return map_batches(pairs, run, "query_id long, vec_id long, score long")


def _joined(queries: DataFrame, candidates: DataFrame, pairs: DataFrame) -> DataFrame:
    return pairs.join(queries, "q_block").join(candidates.drop("dim", "longest"), "block")


def top_k(vectors: DataFrame, is_query, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows other than the query's own, ties to the smaller vec_id.

    ``is_query`` is a condition on ``vec_id``.  Vectors that are NULL or hold NULL, NaN or infinite components take no part,
    nor do rows without a vec_id; vectors meet only vectors of their own dimension.  Copies of a row (same vec_id) are
    never each other's result, but each copy counts as a candidate for others; a repeated query is answered once.
    Scores must fit in a long.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = stored(_integers(vectors), "integers")
    group = F.floor(F.log2(F.greatest("norm", F.lit(1.0))) * STEPS).cast("int")
    sized = rows.withColumn("group", group)
    groups = sized.groupBy("dim", "group").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / BLOCK))
    # one row per (dimension, length group): 8 per octave of lengths, a few hundred at most for a dimension
    split = sized.join(groups.drop("n"), ["dim", "group"]).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")))
    split = split.withColumn("block", F.xxhash64("dim", "group", "part"))
    candidates = stored(_pack(split, ["dim", "group", "part"], sort=True), "candidates")

    asked = rows.where(is_query).dropDuplicates(["vec_id"])
    shares = asked.groupBy("dim").agg(F.ceil(F.count("*") / QUERIES).alias("parts"))
    asked = asked.join(shares, "dim").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")))
    asked = asked.withColumn("block", F.xxhash64("dim", "part"))
    queries = _pack(asked, ["dim", "part"], sort=False)
    queries = stored(
        queries.select(
            F.col("block").alias("q_block"), "dim", F.col("longest").alias("q_longest"), F.col("ids").alias("q_ids"),
            F.col("vectors").alias("q_vectors"),
        ),
        "queries",
    )

    # thresholds: the k-th best score among the block with the longest candidates of each dimension
    probe = candidates.groupBy("dim").agg(F.max(F.struct("longest", "block"))["block"].alias("block"))
    first = _scan(
        _joined(queries, candidates, queries.select("dim", "q_block").join(probe, "dim").drop("dim")).withColumn(
            "limits", F.lit(None).cast("binary")
        ),
        k,
    )
    reached = first.groupBy("query_id").agg(F.min("score").alias("score"), F.count("*").alias("n"))
    reached = reached.where(F.col("n") >= k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("limit"))

    def limits(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        limit = pdf["limit"].fillna(-np.inf).to_numpy(np.float64)
        need = np.where(limit > 0, limit / np.maximum(pdf["norm"].to_numpy(np.float64), 1e-300), -np.inf)
        return pd.DataFrame({"q_block": [pdf["block"].iloc[0]], "limits": [limit.tobytes()], "need": [float(need.min())]})

    known = asked.select("vec_id", "block", "norm", "dim", "part").join(reached, "vec_id", "left")
    known = known.groupBy("dim", "part").applyInPandas(limits, "q_block long, limits binary, need double")
    queries = stored(queries.join(known, "q_block"), "limited")

    # block pairs that some query needs: its length bound against the block's longest candidate
    heads = queries.select("q_block", "dim", "need").join(candidates.select("block", "dim", "longest"), "dim")
    pairs = heads.where(F.col("longest") >= F.col("need") * (1 - _SLACK)).select("q_block", "block")
    scored = _scan(_joined(queries, candidates, pairs), k)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = scored.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
