"""Ranked lexical search by scanning texts with an Aho-Corasick automaton of all query terms.

There is no index over documents: the query items' distinct terms, each guarded by a blank on both sides, make one automaton, which
goes to the workers; a pass over the texts (separators turned into blanks, A-Z lowered) counts each term's occurrences in
each document, since matches of neighbours may share a blank.  One stored row per document keeps these counts, from which come the
document frequencies, and then the scores: an output of the automaton maps to the items that hold the term, so a task adds a
document's contributions item by item and keeps only its best ``k`` documents per item.  A window picks the best of all tasks.

Items are worked off in blocks of bounded size (``BLOCK_BYTES`` of text, ``BLOCK_ITEMS`` items), each with a pass of its own, so
what is broadcast and what a task holds does not grow with the number of items.

Defined cases: a NULL text has no terms; documents without terms count in nothing; documents with a NULL doc_id are ranked,
after equal scores with an id; repeated documents each hold a rank; rows of one item_id (NULL included) make one item with the
terms of all of them; items without terms give no row; without documents or items the result is empty; only doc_id, text and item_id,
text are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.common import map_batches, stored

BLOCK_BYTES = 2_000_000
BLOCK_ITEMS = 20_000
CELLS = 2_000_000  # document x item cells a task fills at once
RANKED = "item_id long, rank int, doc_id long, score long"

_BLANKS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def blanked(text: str) -> bytes:
    """UTF-8 with every separator as a blank and A-Z lowered, a blank at both ends."""
    return b" " + text.encode("utf-8", "surrogatepass").translate(_BLANKS) + b" "


def terms_of(text: str) -> list[str]:
    return [t.decode("utf-8", "surrogatepass") for t in blanked(text).split()]


def count_terms(line: bytes) -> int:
    """Number of terms of a blanked text."""
    blank = np.frombuffer(line, np.uint8) == 32
    return int(np.count_nonzero(blank[:-1] & ~blank[1:]))


def guarded_automaton(terms: list[str]):
    """Aho-Corasick automaton whose matches are whole terms; its outputs are places in ``terms``."""
    import ahocorasick

    made = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for place, term in enumerate(terms):
        made.add_word(f" {term} ", place)
    made.make_automaton()
    return made


def scan(documents: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, n, terms, counts) per document: its number of terms, the query terms in it and how often each occurs."""
    shared = documents.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = guarded_automaton(shared.value)
        second = itemgetter(1)
        for batch in batches:
            sizes, found, counts = [], [], []
            for text in batch.column("text"):
                line = blanked(text.as_py() or "")
                seen = Counter(map(second, automaton.iter(line.decode("utf-8", "surrogatepass"))))
                sizes.append(count_terms(line))
                found.append(list(seen.keys()))
                counts.append(list(seen.values()))
            yield pa.record_batch(
                [
                    batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "terms", "counts"],
            )

    columns = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(columns, run, "doc_id long, n long, terms array<int>, counts array<long>")


class _Best:
    """The best ``k`` documents of each item met so far: score, then smaller doc_id, then none."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.floor = np.ones(items, np.int64)
        self.rows = [np.empty(0, t) for t in (np.int64, np.int64, bool, np.int64)]  # item, score, without id, id

    def add(self, scores: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        """``scores``: documents x items."""
        doc, item = np.nonzero(scores >= self.floor)
        if not doc.size:
            return
        new = (item, scores[doc, item], none[doc], ids[doc])
        item, score, without, id_ = rows = [np.concatenate(pair) for pair in zip(self.rows, new)]
        order = np.lexsort((id_, without, -score, item))
        sorted_item = item[order]
        place = np.arange(item.size) - np.searchsorted(sorted_item, sorted_item)
        self.rows = [a[order[place < self.k]] for a in rows]
        last = order[place == self.k - 1]
        self.floor[item[last]] = score[last]


def best_per_task(counted: DataFrame, weights: np.ndarray, first: np.ndarray, items: np.ndarray, n_items: int, docs: int, total: int, k: int) -> DataFrame:
    """(place, doc_id, score): each task's best documents per item.

    ``items[first[t]:first[t + 1]]`` are the places of the items that hold term ``t``."""
    shared = counted.sparkSession.sparkContext.broadcast((weights, first, items))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, first, items = shared.value
        step = max(1, min(CELLS // n_items, 2 * CELLS // max(items.size, 1)))
        best = _Best(n_items, k)
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                term, tf = (part.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("terms", "counts"))
                doc = np.repeat(np.arange(part.num_rows), np.diff(part.column("terms").offsets.to_numpy()))
                m = np.array([10 + 90 * n * docs // total for n in part.column("n").to_pylist()], np.int64)
                points = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
                degree = first[term + 1] - first[term]
                inside = np.arange(degree.sum()) - np.repeat(np.cumsum(degree) - degree, degree)
                cell = np.repeat(doc, degree) * n_items + items[np.repeat(first[term], degree) + inside]
                scores = np.zeros(part.num_rows * n_items, np.int64)
                np.add.at(scores, cell, np.repeat(points, degree))
                ids = part.column("doc_id")
                best.add(scores.reshape(-1, n_items), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))
        item, score, none, id_ = best.rows
        yield pa.record_batch([pa.array(item), pa.array(id_, pa.int64(), mask=none), pa.array(score)], ["place", "doc_id", "score"])

    return map_batches(counted.where(F.size("terms") > 0), run, "place long, doc_id long, score long")


def _rank_block(documents: DataFrame, rows: list, k: int) -> DataFrame:
    spark = documents.sparkSession
    held: dict[int | None, set[str]] = {}
    for item_id, text in rows:
        held.setdefault(item_id, set()).update(terms_of(text or ""))
    ids = list(held)
    terms = sorted(set().union(*held.values()))
    if not terms:
        return spark.createDataFrame([], RANKED)
    counted = stored(scan(documents, terms), "term_counts")
    docs, total = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not docs:
        return spark.createDataFrame([], RANKED)
    frequency = np.zeros(len(terms), np.int64)
    for term, df in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        frequency[term] = df
    weights = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * int(df) + 1))) for df in frequency], np.int64)
    place = {t: i for i, t in enumerate(terms)}
    holders: list[list[int]] = [[] for _ in terms]
    for item, item_id in enumerate(ids):
        for t in held[item_id]:
            holders[place[t]].append(item)
    first = np.concatenate(([0], np.cumsum([len(h) for h in holders])))
    items = np.array([i for h in holders for i in h], np.int64)
    found = best_per_task(counted, weights, first, items, len(ids), docs, total, k)
    order = Window.partitionBy("place").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    names = spark.createDataFrame([(i, item_id) for i, item_id in enumerate(ids)], "place long, item_id long")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).join(names, "place").select("item_id", "rank", "doc_id", "score")
    )


def search(documents: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents with a score above 0."""
    spark = documents.sparkSession
    queries = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    n, size = queries.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    parts = [_rank_block(documents, queries.where(block == b).collect(), k) for b in range(blocks)]
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], RANKED))
