"""Packing tokenised documents into sequences: shortest-pack-first over the histogram of lengths.

1. Documents are tokenised where they are read; a document longer than a sequence is cut into full pieces and a rest.
   Only (document, start, length, checksum) leaves the task.
2. The histogram has at most ``capacity`` entries whatever the corpus holds, so the packing itself works on counts: the
   lengths are placed longest first, each on the pack with the fewest tokens that still has room, and identical packs
   are one *pattern* with a count.  Every step uses up a length or moves a whole group of packs, so there are at most
   3 x ``capacity`` patterns.
3. Pieces of one length are ranked (rank within a salted share plus the share's offset, so a length that a third of all
   pieces have is no single group), and the rank names the pattern, the sequence and the slot.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.bpe import PART_BYTES, by_size, encoder, read_vocabulary
from caseloom.llm.common import map_batches, stored, texts_of

CAPACITY = 2048
END_ID = 1
SHARE_ROWS = 50_000  # pieces of one length that one ranking group holds on average
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@dataclass(frozen=True)
class Pattern:
    count: int  # sequences filled like this
    lengths: tuple[int, ...]  # pieces in order

    @property
    def used(self) -> int:
        return sum(self.lengths)


def shortest_pack_first(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that hold exactly the pieces of the histogram (length -> count)."""
    packs: dict[int, dict[tuple[int, ...], int]] = {}  # room left -> contents -> packs

    def put(room: int, lengths: tuple[int, ...], count: int) -> None:
        if count:
            group = packs.setdefault(room, {})
            group[lengths] = group.get(lengths, 0) + count

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is outside 1..{capacity}")
        while left:
            room = max(packs, default=0)
            if room >= length:
                contents, count = packs[room].popitem()
                if not packs[room]:
                    del packs[room]
                moved = min(count, left)
                put(room, contents, count - moved)
                put(room - length, (*contents, length), moved)
                left -= moved
            else:
                each = capacity // length
                full, rest = divmod(left, each)
                put(capacity - each * length, (length,) * each, full)
                put(capacity - rest * length, (length,) * rest, 1 if rest else 0)
                left = 0
    return [Pattern(n, c) for room in sorted(packs) for c, n in sorted(packs[room].items())]


def padding(patterns: list[Pattern], capacity: int = CAPACITY) -> int:
    """Tokens of padding: sequences are filled up to the capacity, unless their length is a power of two."""
    return sum(p.count * (capacity - p.used) for p in patterns if p.used & (p.used - 1))


class Plan:
    """Where the r-th piece of each length goes: a few arrays per length, bounded by the number of patterns."""

    def __init__(self, patterns: list[Pattern]):
        by_length: dict[int, list[tuple[int, int, int, int]]] = {}
        sequence = 0
        for p in patterns:
            offset = 0
            k = 0
            while k < len(p.lengths):
                length = p.lengths[k]
                run = 1
                while k + run < len(p.lengths) and p.lengths[k + run] == length:
                    run += 1
                by_length.setdefault(length, []).append((p.count * run, run, sequence, offset))
                offset += run * length
                k += run
            sequence += p.count
        self.sequences = sequence
        self.slots = {}
        for length, rows in by_length.items():
            pieces, run, first, offset = (np.array(x, np.int64) for x in zip(*rows))
            self.slots[length] = (np.concatenate(([0], np.cumsum(pieces))), run, first, offset)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the ``rank``-th piece (from 0) of each length."""
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for value in np.unique(length):
            rows = np.flatnonzero(length == value)
            starts, run, first, at = self.slots[int(value)]
            slot = np.searchsorted(starts, rank[rows], side="right") - 1
            inside = rank[rows] - starts[slot]
            sequence[rows] = first[slot] + inside // run[slot]
            offset[rows] = at[slot] + inside % run[slot] * value
        return sequence, offset


def cut_documents(documents: DataFrame, vocabulary_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise (NULL text: empty, so just the end id) and cut: full pieces first, the rest last."""
    vocabulary = documents.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(vocabulary.value)
        for batch in batches:
            for part in by_size(batch, 1, PART_BYTES):
                rows: list[tuple] = []
                for doc, ids in zip(part.column(0).to_pylist(), tool.encode(texts_of(part.column(1)))):
                    raw = memoryview(ids.tobytes() + end)
                    tokens = len(ids) + 1
                    for start in range(0, tokens, capacity):
                        piece = raw[4 * start : 4 * (start + capacity)]
                        rows.append((doc, start, len(piece) // 4, zlib.crc32(piece), tokens))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                )

    return map_batches(documents.select("doc_id", "text"), run, _PIECE)


def pack_documents(documents: DataFrame, vocabulary_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; sequences are gapless from offset 0 and hold at most ``capacity``.

    NULL doc_ids and repeated rows are documents like any other (equal rows are interchangeable); an empty table gives
    no rows; further columns are left out.
    """
    spark = documents.sparkSession
    pieces = stored(cut_documents(documents, vocabulary_path, capacity), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(Plan(shortest_pack_first(histogram, capacity)))

    shares = max(256, max(histogram.values(), default=0) // SHARE_ROWS)
    salted = pieces.withColumn("share", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(shares)))
    counts = salted.groupBy("length", "share").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "share", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "share").orderBy("doc_id", "start", "ids_crc32")
    ranked = salted.withColumn("place", F.row_number().over(inside)).join(offsets, ["length", "share"])
    ranked = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("place") - 1).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = plan.value.place(length, rank)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[*batch.schema.names[:5], "sequence_id", "offset"]
            )

    return map_batches(ranked, run, f"{_PIECE}, sequence_id long, offset long")
