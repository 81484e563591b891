"""Phrase collocation mining: exact n-gram counts by merged counting quotient filters, cohesion scores, best phrases per language.

1. Tasks cut texts into pieces and words and put them away in chunks: a chunk's distinct words with counts, and its text as
   places in that list.  The counts add up to the vocabulary of each language.
2. A candidate phrase has ``least`` occurrences, so has every word in it: only such words get ids (dense over all languages, so
   that an id implies its language).  A join by word brings each chunk the ids of its own words; no vocabulary is broadcast.
3. Tasks count the n-grams of frequent words of many chunks in a counting quotient filter (``caseloom.llm.quotient_filter``),
   packed word ids permuted into quotient and full remainder, and cut it by leading quotient bits into buckets.
4. The sorted filters of a bucket are merged; n-grams with ``least`` occurrences stay.  Every n-gram comes once per shard however
   often it occurs, the permutation spreads n-grams evenly, and the number of buckets follows the number of words, so no
   group is hot or grows.
5. Cuts, scores, containment and ranks are joins, aggregates and windows over the candidates.

Defined cases: a NULL text is empty, a NULL lang is ``und``; an empty table, or one without candidates, gives no row; ties go by
count, then phrase in byte order, so ranks are unique; repeated rows count as often as they occur; a text of any length is
whole; only text and lang are read, whatever other columns there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.common import discard, map_batches, stored, texts_of
from caseloom.llm.quotient_filter import CountingFilter, permute, restore
from caseloom.session import ship_package

CHUNK_BYTES = 4_000_000  # text of a chunk
SHARD_GRAMS = 4_000_000  # n-grams a task counts before it hands out a filter
BUCKET_GRAMS = 1_000_000  # n-grams of a bucket, if all were distinct
LEAST_BUCKET_BITS = 5
SALTS = 64

RANKED = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"


def _letters() -> bytes:
    table = bytearray(range(256))
    table[65:91] = range(97, 123)
    for c in b".,;:!?\x0a\x0b\x0c\x0d":
        table[c] = 10
    table[9] = 32
    return bytes(table)


_LETTERS = _letters()


def words_of(texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of texts in order, as a dictionary array, and which of them begin a piece."""
    raw = np.frombuffer(b"\n".join(texts).translate(_LETTERS), np.uint8)
    line = raw == 10
    inside = ~(line | (raw == 32))
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    begin, end = edge[::2], edge[1::2]
    offsets = np.concatenate(([0], np.cumsum(end - begin))).astype(np.int32)
    data = pa.py_buffer(raw[inside].tobytes())
    words = pa.Array.from_buffers(pa.string(), begin.size, [None, pa.py_buffer(offsets), data]).dictionary_encode()
    piece = np.cumsum(line)[begin] if begin.size else begin
    return words, np.concatenate(([True], piece[1:] != piece[:-1]))[: begin.size]


def chunks(documents: DataFrame) -> DataFrame:
    """(chunk, lang, words, counts, ids): ids are little-endian 32-bit places in ``words`` from 1, 0 ends a piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: dict[str, list[bytes]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal made, size
            for lang, texts in held.items():
                words, new = words_of(texts)
                if len(words):
                    place = words.indices.to_numpy()
                    ids = np.insert(place + 1, np.flatnonzero(new), 0).astype("<i4")
                    counts = np.bincount(place, minlength=len(words.dictionary))
                    columns = [[f"{task}-{made}"], [lang], [words.dictionary], [counts], [ids.tobytes()]]
                    kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary()]
                    made += 1
                    yield pa.record_batch(
                        [pa.array(c, k) if i != 2 else pa.ListArray.from_arrays([0, len(c[0])], c[0]) for i, (c, k) in enumerate(zip(columns, kinds))],
                        ["chunk", "lang", "words", "counts", "ids"],
                    )
            held.clear()
            size = 0

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch.column("text"))):
                data = text.encode("utf-8", "surrogatepass")
                held.setdefault(lang, []).append(data)
                size += len(data)
                if size >= CHUNK_BYTES:
                    yield from flush()
        yield from flush()

    columns = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return map_batches(columns, run, "chunk string, lang string, words array<string>, counts array<long>, ids binary")


def numbered(vocabulary: DataFrame) -> tuple[DataFrame, int, int]:
    """The stored table with a column ``id``, dense from 1, its number of rows and the sum of its column ``f``."""
    kept = stored(vocabulary.withColumn("mark", F.monotonically_increasing_id()), "frequent_words")
    part = F.shiftright("mark", 33)
    sizes = kept.groupBy(part.alias("part")).agg(F.count("*").alias("k"), F.sum("f").alias("f")).orderBy("part").collect()
    if not sizes:
        return kept.withColumn("id", F.col("mark")), 0, 0
    before = np.concatenate(([0], np.cumsum([r["k"] for r in sizes])))
    offsets = kept.sparkSession.createDataFrame([(r["part"], int(b)) for r, b in zip(sizes, before)], "part long, before long")
    number = F.col("before") + F.col("mark").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    out = kept.withColumn("part", part).join(offsets, "part").select("lang", "word", "f", number.alias("id"))
    return out, int(before[-1]), sum(r["f"] for r in sizes)


def shard_filters(chunk_table: DataFrame, frequent: DataFrame, longest: int, bits: int, bucket_bits: int) -> DataFrame:
    """(n, bucket, filter): packed counting filters of each shard's n-grams of 2 to ``longest`` frequent words."""
    places = chunk_table.select("chunk", "lang", F.posexplode("words").alias("place", "word"))
    known = places.join(frequent, ["lang", "word"]).groupBy("chunk").agg(F.collect_list(F.struct("place", "id")).alias("known"))
    coded = chunk_table.select("chunk", "ids").join(known, "chunk").select("ids", "known")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {n: [] for n in range(2, longest + 1)}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size
            for n, parts in waiting.items():
                if not parts:
                    continue
                first, rest = (np.concatenate(side) for side in zip(*parts))
                parts.clear()
                rest_bits = (n - 1) * bits
                made = CountingFilter.of(*permute(first, rest, bits, rest_bits), None, bits, rest_bits).split(bucket_bits)
                columns = [pa.array([n] * len(made), pa.int32()), pa.array([b for b, _ in made], pa.int64()), pa.array([f.pack() for _, f in made], pa.binary())]
                yield pa.record_batch(columns, ["n", "bucket", "filter"])
            size = 0

        for batch in batches:
            for row in range(batch.num_rows):
                ids = np.frombuffer(batch.column("ids")[row].as_buffer(), "<i4")
                pairs = batch.column("known")[row].values
                place, number = (pairs.field(c).to_numpy(zero_copy_only=False) for c in ("place", "id"))
                number_of = np.zeros(int(ids.max()) + 1, np.uint64)
                number_of[place + 1] = number
                words = number_of[ids]
                whole, rest = words != 0, np.zeros(words.size, np.uint64)
                for n in range(2, longest + 1):
                    m = max(words.size - n + 1, 0)
                    whole = whole[:m] & (words[n - 1 :] != 0)
                    rest = rest[:m] << np.uint64(bits) | words[n - 1 :]
                    at = np.flatnonzero(whole)
                    if at.size:
                        waiting[n].append((words[at], rest[at]))
                        size += at.size
                if size >= SHARD_GRAMS:
                    yield from flush()
        yield from flush()

    return map_batches(coded, run, "n int, bucket long, filter binary")


def merged_counts(filters: DataFrame, bits: int, bucket_bits: int, least: int) -> DataFrame:
    """(words, a): n-grams with at least ``least`` occurrences, as arrays of word ids."""

    def merge(key: tuple, group: pa.Table) -> pa.Table:
        n, bucket = key[0].as_py(), key[1].as_py()
        whole = CountingFilter.merged([CountingFilter.unpack(f) for f in group.column("filter").to_pylist()])
        often = whole.count >= least
        lead = np.uint64(bucket << (bits - bucket_bits))
        first, rest = restore(whole.quotient[often] | lead, whole.remainder[often], bits, whole.rest_bits)
        parts = [rest >> np.uint64(bits * k) & np.uint64((1 << bits) - 1) for k in reversed(range(n - 1))]
        words = np.stack([first, *parts], 1).astype(np.int64).reshape(-1)
        ends = np.arange(0, words.size + 1, n, dtype=np.int32)
        return pa.table({"words": pa.ListArray.from_arrays(ends, words), "a": whole.count[often]})

    ship_package(filters.sparkSession)
    return filters.groupBy("n", "bucket").applyInArrow(merge, "words array<long>, a long")


def _slice(start: Column | int, size: Column | int) -> Column:
    return F.slice("words", start, size)


def collocations(documents: DataFrame, longest: int = 3, least: int = 10, percent: int = 50, top: int = 2000, least_bits: int = 1) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``longest`` words: count ``a``, parts ``l`` and ``r`` of the weakest cut, score.

    ``percent``: a candidate goes if a longer one that holds it has this share of its count at least.  ``least_bits``: bits
    of a word id at least (they follow the vocabulary; ``longest - 1`` ids must fit into 64)."""
    spark = documents.sparkSession
    cut = stored(chunks(documents), "chunks")
    vocabulary = cut.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).groupBy("lang", F.col("w.words").alias("word")).agg(
        F.sum("w.counts").alias("f")
    )
    vocabulary = stored(vocabulary, "vocabulary")
    frequent, size, occurrences = numbered(vocabulary.where(F.col("f") >= least))
    if not size:
        return spark.createDataFrame([], RANKED)
    bits = max(size.bit_length(), least_bits)
    if bits * (longest - 1) > 64:
        raise ValueError(f"{longest} word ids of {bits} bits each are too long to pack")
    bucket_bits = min(bits, max(LEAST_BUCKET_BITS, (occurrences // BUCKET_GRAMS).bit_length()))
    filters = stored(shard_filters(cut, frequent, longest, bits, bucket_bits), "filters")
    discard(cut)
    found = stored(merged_counts(filters, bits, bucket_bits, least), "candidates")
    discard(filters)

    counts = found.unionByName(frequent.select(F.array("id").alias("words"), F.col("f").alias("a")))
    n = F.size("words")
    cuts = found.select("words", "a", F.explode(F.sequence(F.lit(1), n - 1)).alias("k")).select(
        "words", "a", "k", _slice(F.lit(1), F.col("k")).alias("left"), _slice(F.col("k") + 1, n - F.col("k")).alias("right")
    )
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select(F.col("words").alias(side), F.col("a").alias(name)), side)
    score = F.expr("(cast(a as decimal(18,0)) * cast(a as decimal(18,0)) * 1000000) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    scored = cuts.groupBy("words", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("weakest"))
    inside = found.where(n >= 3).select(F.explode(F.array(_slice(F.lit(1), n - 1), _slice(F.lit(2), n - 1))).alias("words"), F.col("a").alias("longer"))
    inside = inside.groupBy("words").agg(F.max("longer").alias("longer"))
    kept = scored.join(inside, "words", "left").where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a")))

    named = kept.select("words", F.posexplode("words").alias("place", "id")).join(frequent.select("id", "lang", "word"), "id").groupBy("words").agg(
        F.first("lang").alias("lang"), F.array_join(F.sort_array(F.collect_list(F.struct("place", "word")))["word"], " ").alias("phrase")
    )
    kept = kept.join(named, "words").select("lang", "phrase", "a", "weakest.l", "weakest.r", "weakest.score", "words")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("words"), F.lit(SALTS))
    for keys in (["lang", salt], ["lang"]):
        kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    totals = vocabulary.groupBy("lang").agg(F.sum("f").alias("n"))
    return kept.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
