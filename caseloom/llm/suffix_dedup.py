"""Removing passages that an earlier document already has, with suffix arrays.

A byte goes when it lies in a ``length``-byte string that also starts in a document with a smaller doc_id.

* **Shards that equal strings share.**  Every ``length``-byte window has an *anchor*: the ``GRAM``-byte piece in it with the
  smallest hash (the leftmost of equals).  Equal windows have equal anchors at equal places, so windows are sharded by anchor
  and equal strings always meet.  Neighbouring windows mostly have the same anchor and travel as one *context*, and only
  for anchors that at least two documents have (counted in full).
* **Per shard**: contexts with equal bytes are one, with their smallest doc_id.  Over the different contexts of a shard that
  have at least half a window around their anchor in common with another (the rest have no window in common) a suffix array is built by Larsson-Sadakane refinement: order by the first 8 bytes, then sort only the groups that are
  still open by the rank 8, 16, 32 ... bytes on.  Kasai's pass gives common prefixes (contexts side by side, one
  vector step per offset), and runs of common prefixes of ``length`` or more are equal strings.
* **Across shards**: an anchor with more contexts than a shard holds is split over several.  Each part names its distinct strings
  once, with their smallest doc_id; the minimum by string is an aggregate over at most one row per part, and goes back to the part
  as the part's own number of the string, so no task gets a whole hot anchor or all windows of a string.

Anchors are counted and shards worked off in a few rounds, each over its share of the anchors, so that shuffles and tables of one round are
gone when the next begins.  Nothing is sampled or capped: a boilerplate line of every document costs one context per task and document group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.bpe import by_size
from caseloom.llm.common import configured, discard, distinct, map_batches, mix, stored

LENGTH = 50
GRAM = 16
SHARD_BYTES = 1 << 19  # a suffix array with its helpers takes about 90 times this; small ones also stay in the processor's cache
SLICES = 4  # the anchors are handled in so many rounds, one after the other: what lies on disk for them is a share of all
SHARD_CONTEXTS = 1 << 15  # contexts of one anchor in one shard: about 2 MB
_FAR = np.iinfo(np.int64).max
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_UPPER, _LOWER = np.uint64(0xFFFFFFFF00000000), np.uint64(0x00000000FFFFFFFF)


# ---------------------------------------------------------------- anchors
def packed(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number, so that numbers sort like bytes (zeros after the end)."""
    padded = np.concatenate((raw, np.zeros(8, np.uint8)))
    return np.ndarray(len(raw), ">u8", padded, strides=(1,)).astype(np.uint64)


def _slide(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    step = 1
    while 2 * step <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return np.minimum(values[: len(values) - (width - step)], values[width - step :]) if step < width else values


def _gram_hashes(head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Hashes of pieces of ``GRAM`` bytes from their first and last eight bytes."""
    low = head * _M1
    low ^= low >> np.uint64(29)
    low += tail
    low *= _M2
    return low


def window_anchors(raw: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of each run of windows with one anchor place, and the anchor's hash."""
    if len(raw) < length:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    n = len(raw) - GRAM + 1
    low = _gram_hashes(np.ndarray(n, "<u8", raw, strides=(1,)), np.ndarray(n, "<u8", raw, offset=GRAM - 8, strides=(1,)))
    # the upper half of the hash with the place below it: the smallest of a window names its leftmost place
    placed = (low & _UPPER) | np.arange(n, dtype=np.uint64)
    least = _slide(placed, length - GRAM + 1)
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    last = np.concatenate((first[1:] - 1, [len(least) - 1]))
    return first, last, mix(low[(least[first] & _LOWER).astype(np.int64)])


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


def _anchors(documents: DataFrame, length: int) -> DataFrame:
    """doc_id, anchors, slice: the distinct anchors of each document, a row for each of its rounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_size(batch, 1):
                found = [distinct(window_anchors(_bytes(t.as_py()), length)[2]) for t in part.column(1)]
                hashes = np.concatenate(found).view(np.int64)
                slices = np.mod(hashes, SLICES)
                sorting = np.argsort(slices.astype(np.uint8), kind="stable")  # by slice, then document
                row = slices * len(found) + np.repeat(np.arange(len(found)), [len(f) for f in found])
                each = np.bincount(row, minlength=SLICES * len(found))
                some = np.flatnonzero(each)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(some % len(found))), _lists(hashes[sorting], each[some], pa.int64()), pa.array(some // len(found), pa.int32())],
                    names=["doc_id", "anchors", "slice"],
                )

    return map_batches(documents, run, "doc_id long, anchors array<long>, slice int")


def _contexts(documents: DataFrame, length: int) -> DataFrame:
    """doc_id, start, anchor, context of the windows whose anchor is in ``shared`` (documents: doc_id, text, shared)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_size(batch, 1):
                docs, starts, anchors, contexts = [], [], [], []
                for doc, text, shared in zip(part.column(0).to_pylist(), part.column(1), part.column(2)):
                    whole = (text.as_py() or "").encode()
                    first, last, anchor = window_anchors(np.frombuffer(whole, np.uint8), length)
                    known = np.sort(shared.values.to_numpy().view(np.uint64))
                    rows = np.flatnonzero(known[np.minimum(np.searchsorted(known, anchor), len(known) - 1)] == anchor)
                    docs.append(np.full(len(rows), doc))
                    starts.append(first[rows])
                    anchors.append(anchor[rows].view(np.int64))
                    contexts += [whole[a:b] for a, b in zip(first[rows].tolist(), (last[rows] + length).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x), pa.int64()) for x in (docs, starts, anchors)] + [pa.array(contexts, pa.binary())],
                    names=["doc_id", "start", "anchor", "context"],
                )

    return map_batches(documents, run, "doc_id long, start long, anchor long, context binary")


# ---------------------------------------------------------------- suffix arrays
def suffix_array(raw: np.ndarray) -> np.ndarray:
    """Positions in the order of the suffixes that begin there: Larsson-Sadakane refinement by doubling.

    ``group`` is the first place of the group a position belongs to; positions in groups of one are done."""
    n = len(raw)
    eight = packed(raw)
    order = np.argsort(eight)
    keys = eight[order]
    start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    size = np.diff(np.concatenate((start, [n])))
    group = np.empty(n, np.int64)
    group[order] = np.repeat(start, size)
    reach = 8
    while True:
        open_groups = size > 1
        if not open_groups.any():
            break
        place = np.repeat(start[open_groups], size[open_groups])
        first = np.concatenate(([0], np.cumsum(size[open_groups])[:-1]))
        slots = place + np.arange(len(place)) - np.repeat(first, size[open_groups])
        members = order[slots]
        # a suffix that ends before is the start of the others in its group, and comes first; of two the shorter
        ahead = np.where(members + reach < n, group[np.minimum(members + reach, n - 1)] + n + 1, n - members)
        key = (place << 32) | ahead
        sorting = np.argsort(key)
        members, key = members[sorting], key[sorting]
        order[slots] = members
        fresh = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        start = slots[fresh]
        size = np.diff(np.concatenate((fresh, [len(key)])))
        group[members] = np.repeat(start, size)
        reach *= 2
    return order


def common_prefixes(raw: np.ndarray, order: np.ndarray, starts: np.ndarray, sizes: np.ndarray, limit: int) -> np.ndarray:
    """Kasai: common prefix of each position with its predecessor in ``order``, up to ``limit``.

    Going one position on loses one byte at most, so each context keeps its running value; all contexts take the step
    from offset to offset together."""
    n = len(raw)
    padded = np.concatenate((raw, np.zeros(limit + 8, np.uint8)))
    eight = packed(padded)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int64)
    running = np.zeros(len(starts), np.int64)
    by_size_down = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[by_size_down], sizes[by_size_down]
    for offset in range(int(sizes.max(initial=0))):
        lanes = int(np.searchsorted(-sizes, -offset))  # contexts longer than the offset come first
        i = starts[:lanes] + offset
        j = before[i]
        h = np.maximum(running[:lanes] - 1, 0)
        h[j < 0] = 0
        live = np.flatnonzero((j >= 0) & (h < limit))
        while live.size:
            a, b = i[live] + h[live], j[live] + h[live]
            # suffixes end with the text: bytes after it never count as equal
            inside = np.maximum(a, b) + 8 <= n
            eq8 = inside & (eight[a] == eight[b])
            eq1 = ~eq8 & (np.maximum(a, b) < n) & (padded[a] == padded[b])
            h[live] += np.where(eq8, 8, np.where(eq1, 1, 0))
            live = live[(eq8 | eq1) & (h[live] < limit)]
        running[:lanes] = h
        out[i] = np.minimum(h, limit)
    return out[order]


def shard_minima(raw: np.ndarray, sizes: np.ndarray, docs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every window of the contexts that ``raw`` holds end to end: (context, offset, smallest doc over equal windows of
    the shard, number of its string)."""
    starts = np.cumsum(sizes) - sizes
    order = suffix_array(raw)
    prefix = common_prefixes(raw, order, starts, sizes, length)
    fresh = np.concatenate(([True], prefix[1:] < length))
    run = np.flatnonzero(fresh)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    offset = np.arange(len(raw)) - starts[owner]
    whole = offset + length <= sizes[owner]
    least = np.minimum.reduceat(np.where(whole, docs[owner], _FAR)[order], run)
    number = np.empty(len(raw), np.int64)
    number[order] = np.cumsum(fresh) - 1
    rows = np.flatnonzero(whole)
    return owner[rows], offset[rows], least[number[rows]], number[rows]


def meeting(raw: np.ndarray, begin: np.ndarray, sizes: np.ndarray, anchor: np.ndarray, length: int) -> np.ndarray:
    """May a context have a window in common with another of these contexts?  False only where it has none.

    A window reaches half of the bytes it has besides its anchor, or more, beyond the anchor on one side.  So contexts that have a window in
    common have their anchor and that many bytes before it in common, or the anchor and that many after it."""
    beyond = (length - GRAM + 1) // 2
    padded = np.concatenate((raw, np.zeros(8, np.uint8)))
    eight = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))
    place = begin[:, None] + np.arange(length - GRAM + 1)  # grams of the first window; its anchor is that of all
    low = _gram_hashes(eight[place], eight[place + GRAM - 8])
    at = np.argmin(low & _UPPER, axis=1)
    found = np.zeros(len(begin), bool)
    width = GRAM + beyond
    for first, inside in ((at, at + width <= sizes), (at - beyond, at >= beyond)):
        rows = np.flatnonzero(inside)
        start = begin[rows] + first[rows]
        key = anchor[rows].view(np.uint64)
        for k in (*range(0, width - 7, 8), width - 8):
            key = mix(key * _M1 + eight[start + k])
        sorting = np.argsort(key)
        equal = key[sorting][1:] == key[sorting][:-1]
        found[rows[sorting[1:][equal]]] = True
        found[rows[sorting[:-1][equal]]] = True
    return found


_VERDICTS = "anchor long, name long, offsets array<int>, counts array<int>, docs array<long>, string binary, part int, numbers array<int>"


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(values, kind))


def _binary(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of a binary column, and where each value begins and ends in them."""
    values = column.combine_chunks().cast(pa.large_binary())
    values = values.chunk(0) if isinstance(values, pa.ChunkedArray) else values
    ends = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    return np.frombuffer(values.buffers()[2], np.uint8), ends[:-1], ends[1:]


def _gathered(raw: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of the named stretches, end to end."""
    return raw[np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]


def _verdicts(rows: pa.Table, length: int) -> Iterator[pa.RecordBatch]:
    """Verdicts of one shard's contexts; see :func:`_shards`."""
    anchor, part, parts, name, docs = (rows.column(c).to_numpy() for c in ("anchor", "part", "parts", "name", "doc_id"))
    last = rows.column("last_doc").to_numpy() if "last_doc" in rows.column_names else np.full(len(docs), _FAR)
    raw, begin, end = _binary(rows.column("context"))
    sizes = end - begin
    same = np.concatenate(([False], (anchor[1:] == anchor[:-1]) & (part[1:] == part[:-1])))
    several = same | np.concatenate((same[1:], [False]))  # the only context of its anchor meets no other
    split = parts > 1
    check = np.flatnonzero(several & ~split)
    if check.size:
        several[check] = meeting(raw, begin[check], sizes[check], anchor[check], length)
    names = ["anchor", "name", "offsets", "counts", "docs", "string", "part", "numbers"]

    def batch(at: np.ndarray, offsets: pa.Array, counts: pa.Array, least: pa.Array, string: pa.Array, numbers: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(anchor[at]), pa.array(name[at]), offsets, counts, least, string, pa.array(part[at], pa.int32()), numbers], names=names)

    def nothing(n: int, kind: pa.DataType) -> pa.Array:
        return pa.nulls(n, kind)

    def empty(n: int, kind: pa.DataType) -> pa.ListArray:
        return _lists(np.empty(0, np.int64), np.zeros(n, np.int64), kind)

    alone = np.flatnonzero(~(several | split) & (docs < last))
    if alone.size:
        one = np.ones(len(alone), np.int64)
        yield batch(
            alone, _lists(0 * one, one, pa.int32()), _lists(sizes[alone] - length + 1, one, pa.int32()), _lists(docs[alone], one, pa.int64()),
            nothing(len(alone), pa.binary()), nothing(len(alone), pa.list_(pa.int32())),
        )
    rest = np.flatnonzero(several | split)
    if not rest.size:
        return
    own, offset, least, number = shard_minima(_gathered(raw, begin[rest], sizes[rest]), sizes[rest], docs[rest], length)
    own = rest[own]
    hot = split[own]

    # whole anchors: one entry per stretch of a context with one smallest doc; left out where no document loses by it
    o, k, d = own[~hot], offset[~hot], least[~hot]
    if o.size:
        first = np.flatnonzero(np.concatenate(([True], (o[1:] != o[:-1]) | (d[1:] != d[:-1]))))
        count = np.diff(np.concatenate((first, [len(o)])))
        lose = d[first] < last[o[first]]
        first, count = first[lose], count[lose]
        at, each = np.unique(o[first], return_counts=True)
        yield batch(
            at, _lists(k[first], each, pa.int32()), _lists(count, each, pa.int32()), _lists(d[first], each, pa.int64()),
            nothing(len(at), pa.binary()), nothing(len(at), pa.list_(pa.int32())),
        )

    # split anchors: each string of an (anchor, part) once; the windows of a context by the numbers of their strings
    o, k, d, n = own[hot], offset[hot], least[hot], number[hot]
    if o.size:
        group = np.cumsum(~same)[o]
        sorting = np.lexsort((n, group))
        fresh = np.concatenate(([True], (group[sorting][1:] != group[sorting][:-1]) | (n[sorting][1:] != n[sorting][:-1])))
        mine = np.empty(len(o), np.int64)
        mine[sorting] = np.cumsum(fresh) - 1
        once = sorting[fresh]
        texts = _gathered(raw, begin[o[once]] + k[once], np.full(len(once), length))
        one = np.ones(len(once), np.int64)
        strings = pa.Array.from_buffers(pa.binary(), len(once), [None, pa.py_buffer(np.arange(0, len(texts) + 1, length, dtype=np.int32)), pa.py_buffer(texts)])
        yield batch(o[once], empty(len(once), pa.int32()), empty(len(once), pa.int32()), _lists(d[once], one, pa.int64()), strings, _lists(mine[once], one, pa.int32()))
        at, each = np.unique(o, return_counts=True)
        yield batch(
            at, _lists(k, each, pa.int32()), empty(len(at), pa.int32()), empty(len(at), pa.int64()),
            nothing(len(at), pa.binary()), _lists(mine, each, pa.int32()),
        )


def _work_off(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Verdicts of contexts sorted by (anchor, part), about SHARD_BYTES of them at a time, or one (anchor, part) if that is larger."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.column(batch.schema.get_field_index("context")).nbytes
        if size >= SHARD_BYTES:
            rows = pa.Table.from_batches(held).combine_chunks()
            anchor, part = rows.column("anchor").to_numpy(), rows.column("part").to_numpy()
            border = np.flatnonzero((anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1]))
            if border.size:  # shards end between anchors
                yield from _verdicts(rows.slice(0, int(border[-1]) + 1), length)
                held = rows.slice(int(border[-1]) + 1).to_batches()
                size = sum(b.column(b.schema.get_field_index("context")).nbytes for b in held)
    if held:
        yield from _verdicts(pa.Table.from_batches(held), length)


def _shards(contexts: DataFrame, length: int) -> DataFrame:
    """Verdicts per context.  For split anchors each distinct string of an (anchor, part) once (``string``, ``docs`` and its
    number set), and per context the numbers of its windows' strings, for the merge.

    ``contexts``: anchor, part, parts, name, context, doc_id (the smallest), sorted by (anchor, part) inside partitions.  With
    ``last_doc``, the largest doc_id that has the context, verdicts by which no document loses anything are left out."""

    return map_batches(contexts, partial(_work_off, length=length), _VERDICTS)


def _merge(written: DataFrame) -> DataFrame:
    """Smallest doc of each window of split anchors over all their parts.

    A string has at most one row per part, and a part at most about SHARD_CONTEXTS contexts, so the rows of a string are few and
    travel with it: they are dealt by string once, and each part's answers go back to the part, which looks its windows up."""
    strings = written.where("string is not null").select("anchor", "part", F.get("numbers", F.lit(0)).alias("number"), "string", F.get("docs", F.lit(0)).alias("doc"))
    least = strings.groupBy("anchor", "string").agg(F.min("doc").alias("doc"), F.collect_list(F.struct("part", "number")).alias("owners"))
    named = least.select("anchor", "doc", F.explode("owners").alias("o")).select(
        "anchor", "o.part", F.lit(None).cast("long").alias("name"), F.array("o.number").alias("numbers"), F.lit(None).cast("array<int>").alias("offsets"), "doc"
    )
    windows = written.where("string is null and numbers is not null").select("anchor", "part", "name", "numbers", "offsets", F.lit(None).cast("long").alias("doc"))
    # answers come before the windows of their part
    dealt = named.unionByName(windows).repartition("anchor", "part").sortWithinPartitions("anchor", "part", F.col("doc").isNull())
    return map_batches(dealt, _answers, "anchor long, name long, offsets array<int>, counts array<int>, docs array<long>")


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per window of a split anchor, from rows sorted by (anchor, part) with the numbers' smallest docs first."""
    held: tuple[int, int] | None = None
    numbers, docs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for batch in batches:
        anchor, part = batch.column("anchor").to_numpy(), batch.column("part").to_numpy()
        border = np.flatnonzero((anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])) + 1
        for a, b in zip([0, *border.tolist()], [*border.tolist(), batch.num_rows]):
            if a == b:
                continue
            if held != (anchor[a], part[a]):
                held, numbers, docs = (anchor[a], part[a]), [], []
            rows = batch.slice(a, b - a)
            given = rows.filter(rows.column("doc").is_valid())
            if given.num_rows:
                numbers.append(given.column("numbers").flatten().to_numpy())
                docs.append(given.column("doc").to_numpy())
            asked = rows.filter(rows.column("doc").is_null())
            if asked.num_rows:
                number, doc = np.concatenate(numbers), np.concatenate(docs)
                sorting = np.argsort(number)
                numbers, docs = [number[sorting]], [doc[sorting]]
                wanted = asked.column("numbers").flatten().to_numpy()
                found = docs[0][np.searchsorted(numbers[0], wanted)]
                each = asked.column("numbers").value_lengths().to_numpy()
                one = np.ones(len(wanted), np.int64)
                offsets = _lists(asked.column("offsets").flatten().to_numpy(), one, pa.int32())
                name = np.repeat(asked.column("name").to_numpy(), each)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(wanted), held[0])), pa.array(name), offsets, _lists(one, one, pa.int32()), _lists(found, one, pa.int64())],
                    names=["anchor", "name", "offsets", "counts", "docs"],
                )


# ---------------------------------------------------------------- the operator
def repeated_spans(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, spans array<long>: bytes to remove, each start * 2^32 + end, not merged yet; documents without any are left out."""
    docs = documents.select("doc_id", "text").where("doc_id is not null")
    long = docs.where(F.octet_length("text") >= length)
    anchors = stored(_anchors(long, length), "anchors", slices="slice")
    rounds = [_shared_rows(anchors.where(F.col("slice") == k).select("doc_id", F.explode("anchors").alias("anchor"))) for k in range(SLICES)]
    discard(anchors)
    per_doc = stored(reduce(DataFrame.unionByName, rounds).groupBy("doc_id").agg(F.collect_set("anchor").alias("shared")), "shared")
    discard(*rounds)
    contexts = _contexts(long.join(per_doc, "doc_id").select("doc_id", "text", "shared"), length)
    contexts = contexts.withColumn("name", F.xxhash64("context")).withColumn("slice", F.pmod("anchor", F.lit(SLICES)).cast("int"))
    with configured(documents.sparkSession, {f"parquet.enable.dictionary#{c}": "false" for c in ("anchor", "context", "name")}):  # these hardly repeat
        contexts = stored(contexts, "contexts", slices="slice")
    discard(per_doc)
    parts = [_slice_spans(contexts.where(F.col("slice") == k).drop("slice"), length) for k in range(SLICES)]
    rows = reduce(DataFrame.unionByName, parts)
    spans = stored(rows.groupBy("doc_id").agg(F.collect_set("span").alias("spans")), "spans")
    discard(contexts, *parts)
    return spans


def _shared_rows(anchors: DataFrame) -> DataFrame:
    """The rows (doc_id, anchor) whose anchor several documents have; anchors come with all their rows."""
    shared = anchors.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("anchor")
    shared = stored(shared, "shared_anchors")
    rows = stored(anchors.join(shared, "anchor").select("doc_id", "anchor"), "shared_rows")
    discard(shared)
    return rows


def _slice_spans(contexts: DataFrame, length: int) -> DataFrame:
    """(doc_id, span) to remove, from all contexts (doc_id, start, anchor, context, name) of some anchors."""
    distinct_contexts = contexts.groupBy("anchor", "name", "context").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("last_doc"))
    distinct_contexts = stored(distinct_contexts, "distinct_contexts")
    hot = distinct_contexts.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > SHARD_CONTEXTS)
    # stored first: Spark then knows its size, and moves the contexts for this join only if it is too large to broadcast
    hot = stored(hot.select("anchor", F.ceil(F.col("n") / SHARD_CONTEXTS).cast("int").alias("parts")), "hot_anchors")
    split = distinct_contexts.join(hot, "anchor", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    split = split.withColumn("part", F.pmod(F.xxhash64("name"), "parts").cast("int"))
    split = split.repartition("anchor", "part").sortWithinPartitions("anchor", "part")
    written = stored(_shards(split.select("anchor", "part", "parts", "name", "context", "doc_id", "last_doc"), length), "verdicts")
    discard(distinct_contexts, hot)
    verdicts = written.where("numbers is null").drop("string", "part", "numbers").unionByName(_merge(written))

    pieces = contexts.select("doc_id", "start", "anchor", "name").join(verdicts, ["anchor", "name"])
    pieces = pieces.select("doc_id", "start", F.explode(F.arrays_zip("offsets", "counts", "docs")).alias("run"))
    pieces = pieces.where(F.col("run.docs") < F.col("doc_id"))
    begin = F.col("start") + F.col("run.offsets")
    spans = stored(pieces.select("doc_id", (F.shiftleft(begin, 32) + begin + F.col("run.counts") - 1 + length).alias("span")), "slice_spans")
    discard(written)
    return spans


def merge_spans(spans: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of covered bytes of every row's packed spans: starts, ends, and how many each row has."""
    each = np.nan_to_num(spans.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    packed_spans = spans.flatten().to_numpy()
    row = np.repeat(np.arange(len(spans)), each)
    sorting = np.lexsort((packed_spans, row))
    start, end = packed_spans[sorting] >> 32, packed_spans[sorting] & 0xFFFFFFFF
    # rows one after the other on one line: the furthest end so far is one running maximum
    line = row << 32
    furthest = np.maximum.accumulate(line + end)
    fresh = np.concatenate(([True], line[1:] + start[1:] > furthest[:-1]))[: len(row)]
    fresh[1:] |= row[1:] != row[:-1]
    first = np.flatnonzero(fresh)
    close = np.concatenate((first[1:], [len(row)]))[: len(first)] - 1
    return start[first], furthest[close] - line[first], np.bincount(row[first], minlength=len(spans))


def remove_repeats(documents: DataFrame, length: int = LENGTH, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_bytes, kept_text, then the columns named in ``carry``, for every row.

    ``kept_text`` is the remaining bytes as text, without those of a character that a removal cut in two.
    Texts are UTF-8 bytes (NULL: empty); texts shorter than ``length`` lose nothing.  Rows with equal doc_id are one document
    for the comparison (each loses what smaller ids have) and are expected to be copies.  A NULL doc_id takes no part: it
    neither loses nor removes anything.  Columns not in ``carry`` are left out; an empty table gives no rows.
    """
    spans = repeated_spans(documents, length)
    rows = documents.select("doc_id", "text", *carry).join(spans, "doc_id", "left").select("doc_id", "text", "spans", *carry)
    kept_schema = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_size(batch, 1):
                sizes, removed, counts, kept = [], [], [], []
                first, last, each = merge_spans(part.column(2))
                borders = np.stack((first, last), axis=1).ravel().tolist()  # start, end, start, end ...
                at = 0
                for text, n in zip(part.column(1).cast(pa.binary()).to_pylist(), each.tolist()):
                    whole = text or b""
                    ends = [0, *borders[at : at + 2 * n], len(whole)]
                    at += 2 * n
                    sizes.append(len(whole))
                    kept.append(b"".join([whole[a:b] for a, b in zip(ends[::2], ends[1::2])]) if n else whole)
                    removed.append(len(whole) - len(kept[-1]))
                    counts.append(n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(x, pa.int64()) for x in (sizes, removed, counts)), pa.array(kept, pa.binary()), pa.array([k.decode(errors="ignore") for k in kept], pa.string()), *part.columns[3:]],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_bytes", "kept_text", *carry],
                )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_bytes binary, kept_text string"
    return map_batches(rows, run, f"{schema}, {kept_schema}" if carry else schema)


def digest(result: DataFrame) -> DataFrame:
    """Contract form: the remaining bytes as a SHA-256."""
    return result.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))

