"""Near duplicates with HyperMinHash sketches.

* **Sketch.**  A document's set of word shingles is hashed to 64 bits.  The first bits choose one of ``REGISTERS`` buckets, and
  each bucket keeps its smallest value in compressed form: the number of leading zeros and the next ``MANTISSA`` bits.  A
  bucket that no shingle fell into holds the minimum of a hash function of its own over the whole set, so small sets fill
  their sketch too.
* **Classes.**  Documents with equal sets are one class from here on; a group of copies weighs as much as one document.
* **Bands.**  ``BANDS`` bands of ``ROWS`` registers: at the threshold of 0.85 a pair misses all of them with probability 6e-11.
* **Estimate.**  Equal registers, corrected for chance collisions of compressed registers, estimate the Jaccard similarity;
  pairs five standard deviations below the threshold are not looked at further (small sets always are).
* **Verification** on the full sets, and components of the verified links.

Buckets never expand into pairs.  First every class is compared with the smallest class of each of its buckets.  Where all
members of a bucket are then in one component, nothing is left to find.  The other buckets are filed in groups; the members
outside a group's largest component meet the group in blocks of bounded size, with their full sets, and verification happens
there: a pair that shares a band and whose estimate passes is verified at once, and only links that join two components leave
the task.  So no candidate link is lost, nothing grows with the number of pairs but arithmetic, and a group costs its size times
the number of its outsiders.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.bpe import by_size
from caseloom.llm.common import configured, discard, distinct, map_batches, mix, stored, window_hashes, word_hashes
from caseloom.llm.components import connected_components
from caseloom.session import ship_package

REGISTERS = 128
MANTISSA = 10
BANDS, ROWS = 32, 4
SURE_FROM, SMALL_FROM = 256, 32  # set sizes from which registers are independent, and from which they say anything
SMALL_LOWEST = 0.5  # lowest estimate for sets between the two
MARGIN = 5.0  # standard deviations
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20  # members of a group in one block, and about how many shingles they have together
# chance that two unequal registers coincide: sum over leading zeros of 4**-z / 2**(MANTISSA + 2), about
COLLISION = (1 / 3) / 2**MANTISSA

_BUCKET_BITS = np.uint64(REGISTERS.bit_length() - 1)
_SEEDS = mix(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; with fewer words than ``width``, of the whole sequence."""
    words = word_hashes((text or "").encode())
    if not words.size:
        return words
    return distinct(window_hashes(words, min(width, len(words))) + np.uint64(min(width, len(words))))


def _compressed(values: np.ndarray) -> np.ndarray:
    """Leading zeros (capped at 63) and the MANTISSA bits after the first one, in 16 bits."""
    exponent = 63 - np.floor(np.log2(np.maximum(values >> np.uint64(11), np.uint64(1)).astype(np.float64))).astype(np.int64) - 11
    exponent = np.clip(exponent, 0, 52)
    body = (values << exponent.astype(np.uint64)) << np.uint64(1)
    return (exponent.astype(np.uint16) << np.uint16(MANTISSA)) | (body >> np.uint64(64 - MANTISSA)).astype(np.uint16)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """REGISTERS compressed minima of a non-empty sorted set."""
    bucket = (shingles >> (np.uint64(64) - _BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))  # sorted hashes: the first of a bucket is its minimum
    values = np.empty(REGISTERS, np.uint64)
    values[bucket[first]] = shingles[first] << _BUCKET_BITS
    vacant = np.ones(REGISTERS, bool)
    vacant[bucket[first]] = False
    empty = np.flatnonzero(vacant)
    step = max(1, 65536 // len(shingles))
    for part in (empty[k : k + step] for k in range(0, len(empty), step)):
        values[part] = mix(shingles[None, :] ^ _SEEDS[part][:, None]).min(axis=1)
    return _compressed(values)


def estimate(equal: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the number of equal registers, corrected for chance collisions."""
    share = equal / REGISTERS
    return np.maximum(0.0, (share - COLLISION) / (1 - COLLISION))


def lowest_estimate(similarity: float) -> float:
    return similarity - MARGIN * np.sqrt(similarity * (1 - similarity) / REGISTERS)


def may_link(guess: np.ndarray, sizes: np.ndarray, similarity: float) -> np.ndarray:
    """Is the estimate high enough for a pair whose smaller set has this size?"""
    least = np.where(sizes >= SURE_FROM, lowest_estimate(similarity), np.where(sizes >= SMALL_FROM, SMALL_LOWEST, 0.0))
    return guess >= least


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, of its ROWS 16-bit registers and its number."""
    return mix(registers.reshape(BANDS, ROWS).astype("<u2").view("<u8")[:, 0] + np.arange(BANDS, dtype=np.uint64))


_SKETCHED = "doc_id long, n_shingles long, set1 long, set2 long, registers binary"
# Texts whose sets are needed are picked by a Bloom filter of their ids before they are shuffled; its bits are bounded by Spark's
# spark.sql.optimizer.runtime.bloomFilter.maxNumBits, whatever the number of ids.
_FILTERED = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
}


def sketches(documents: DataFrame, width: int) -> DataFrame:
    """Per document: set size, a 128-bit name of the set and its sketch (NULL for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_size(batch, 1):
                rows = []
                for text in part.column(1):
                    s = shingle_set(text.as_py(), width)
                    if not s.size:
                        rows.append((0, 0, 0, None))
                        continue
                    registers = sketch(s)
                    a = int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum().view(np.int64))
                    b = int(np.bitwise_xor.reduce(mix(s + np.uint64(0x14057B7EF767814F))).view(np.int64))
                    rows.append((len(s), a, b, registers.astype("<u2").tobytes()))
                n, a, b, registers = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(registers, pa.binary())],
                    names=["doc_id", "n_shingles", "set1", "set2", "registers"],
                )

    return map_batches(documents.select("doc_id", "text"), run, _SKETCHED)


def _banded(classes: DataFrame) -> DataFrame:
    """(key, id), one row per class and band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            registers = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2").reshape(-1, REGISTERS)
            keys = np.concatenate([band_keys(row) for row in registers] or [np.empty(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))], names=["key", "id"])

    return map_batches(classes.select("id", "registers"), run, "key long, id long")


def _sets(documents: DataFrame, wanted: DataFrame, width: int, name: str) -> DataFrame:
    """(id, shingles array<long>) of the wanted documents (column id, repeats allowed), stored."""
    ids = stored(wanted.groupBy("id").agg(F.count("*").alias("uses")), f"{name}_ids")
    # Spark makes Bloom filters of filtered scans only
    chosen = ids.where("uses > 0").select(F.col("id").alias("doc_id"))
    rows = documents.select("doc_id", "text").join(chosen, "doc_id", "left_semi").dropDuplicates(["doc_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_size(batch, 1):
                found = [shingle_set(t.as_py(), width).view(np.int64) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.int64()))], names=["id", "shingles"])

    with configured(documents.sparkSession, _FILTERED):
        found = stored(map_batches(rows, run, "id long, shingles array<long>"), name)
    discard(ids)
    return found


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the similarity: 100 * intersection >= percent * union."""
    a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.select("a", "b").join(a, "a").join(b, "b")
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    both = both.select("a", "b", common.alias("common"), (F.size("sa") + F.size("sb")).cast("long").alias("sizes"))
    return both.where(100 * F.col("common") >= percent * (F.col("sizes") - F.col("common"))).select("a", "b")


def _gated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and estimate allow the similarity, with the estimate."""
    own = classes.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("registers").alias("ra"))
    other = classes.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("registers").alias("rb"))
    rows = pairs.join(own, "a").join(other, "b")
    rows = rows.where((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))).select("a", "b", "na", "nb", "ra", "rb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS) for c in ("ra", "rb"))
            guess = estimate((ra == rb).sum(1))
            kept = pa.array(may_link(guess, np.minimum(batch.column("na").to_numpy(), batch.column("nb").to_numpy()), percent / 100))
            out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(guess)], names=["a", "b", "guess"])
            yield out.filter(kept)

    return map_batches(rows, run, "a long, b long, guess double")


def _labelled(rows: DataFrame, components: DataFrame, column: str, name: str) -> DataFrame:
    """Add the component of ``column``; a class without links is its own."""
    c = components.select(F.col("node").alias(column), F.col("component").alias("_c"))
    return rows.join(c, column, "left").withColumn(name, F.coalesce("_c", column)).drop("_c")


def _open_groups(members: DataFrame, classes: DataFrame, components: DataFrame) -> DataFrame:
    """(group, id, component, n, registers): members of the buckets that hold more than one component.

    One group of near copies shares many buckets.  A bucket is filed under the smallest class that any of its members shares a
    bucket with, so these buckets mostly fall together and their members are compared once instead of once per band.
    """
    rows = _labelled(members, components, "id", "component")
    still_open = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    rows = rows.join(still_open.where("low < high").select("key"), "key")
    rows = stored(rows.select("key", "id", "component", "least"), "open_buckets")
    nearest = rows.groupBy("id").agg(F.min("least").alias("near"))
    group = stored(rows.join(nearest, "id").groupBy("key").agg(F.min("near").alias("group")), "bucket_groups")
    named = rows.join(group, "key").select("group", "id", "component").distinct()
    found = stored(named.join(classes.select("id", "n", "registers"), "id"), "open_groups")
    discard(rows, group)
    return found


def _tile_links(left: pd.DataFrame, right: pd.DataFrame, percent: int) -> tuple[list[int], list[int]]:
    """Verified links between the rows of two blocks, as a forest over their components: no more links than rows."""
    found: tuple[list[int], list[int]] = ([], [])
    if not len(left) or not len(right):
        return found
    ids, sizes, parts, main = (right[c].to_numpy() for c in ("id", "n", "component", "main"))
    registers = np.frombuffer(b"".join(right["registers"]), "<u2").reshape(-1, REGISTERS)
    bands = registers.view("<u8")
    own = np.frombuffer(b"".join(left["registers"]), "<u2").reshape(-1, REGISTERS)
    shingles = np.concatenate(list(right["shingles"]))
    begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    names, codes = np.unique(shingles, return_inverse=True)
    hit = np.zeros(len(names) + 1, bool)
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = root[x]
        return x

    for k, (i, n, part, mine) in enumerate(zip(left["id"], left["n"], left["component"], left["shingles"])):
        # two outsiders meet in both orders and are looked at in one
        rows = np.flatnonzero((parts != part) & ((ids < i) | (parts == main)) & (100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n)))
        rows = rows[(bands[rows] == own[k].view("<u8")).any(1)] if rows.size else rows
        rows = rows[may_link(estimate((registers[rows] == own[k]).sum(1)), np.minimum(sizes[rows], n), percent / 100)] if rows.size else rows
        if not rows.size:
            continue
        at = np.searchsorted(names, mine)
        at = at[names[np.minimum(at, len(names) - 1)] == mine]
        hit[at] = True
        if rows.size * 4 < len(ids):
            common = np.array([np.count_nonzero(hit[codes[begin[r] : begin[r] + sizes[r]]]) for r in rows])
        else:
            common = np.add.reduceat(hit[codes].astype(np.int64), begin)[rows]
        hit[at] = False
        for r in rows[100 * common >= percent * (sizes[rows] + n - common)]:
            x, y = top(int(part)), top(int(parts[r]))
            if x != y:
                root[max(x, y)] = min(x, y)
                found[0].append(int(i))
                found[1].append(int(ids[r]))
    return found


def _left_over(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Verified links (a, b) between different components of a group; ``rows`` of ``_open_groups``, ``sets`` of all their ids."""
    parts = rows.groupBy("group", "component").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
    # stored first, so that the join below is one of two plain tables and Spark can split a large group's partition
    groups = parts.groupBy("group").agg(
        F.max(F.struct("rows", "component"))["component"].alias("main"), F.sum("rows").alias("rows"), F.sum("shingles").alias("shingles")
    )
    blocks = F.greatest(F.ceil(F.col("rows") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    groups = stored(groups.select("group", "main", blocks.alias("blocks")), "groups")
    rows = rows.join(groups, "group").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # outsiders meet every block of their group; they come in blocks of bounded size themselves
    outside = rows.where("component <> main").withColumnRenamed("block", "other")
    others = outside.select("group", "other").distinct()
    outside = outside.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    inside = rows.join(others, "group")
    fields = ["group", "other", "block", "id", "n", "component", "main", "registers", "shingles"]
    outside, inside = (side.join(sets, "id").select(*(F.col(f).alias(f) for f in fields)) for side in (outside, inside))
    keys = ["group", "other", "block"]

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(dict(zip("ab", (np.array(x, np.int64) for x in _tile_links(left, right, percent)))))

    ship_package(rows.sparkSession)
    return outside.groupBy(*keys).cogroup(inside.groupBy(*keys)).applyInPandas(meet, "a long, b long")


def near_duplicates(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row.

    Two documents are linked when 100 * |A and B| >= percent * |A or B| over their sets of ``width``-word shingles (words
    ``[^\\x20\\x09-\\x0D]+``, A-Z lowered); fewer words make one shingle of the whole sequence.  ``component_id`` is the smallest
    doc_id reachable over links, itself included; kept is doc_id = component_id.  NULL, empty and blank texts have an empty
    set and are linked with nothing.  Rows with equal doc_id are expected to be copies of one row, and each is returned.  A NULL
    doc_id takes no part: component_id is NULL and the row is kept.  Further columns are left out; an empty table gives no rows.
    """
    signed = stored(sketches(documents, width), "sketches")
    sets = ["n_shingles", "set1", "set2"]
    known = signed.where("n_shingles > 0 and doc_id is not null")
    first = known.groupBy(*sets).agg(F.min(F.struct("doc_id", "registers")).alias("first"))
    classes = stored(first.select(*sets, F.col("first.doc_id").alias("id"), F.col("n_shingles").alias("n"), F.col("first.registers").alias("registers")), "classes")
    named = classes.select(*sets, "id")

    banded = stored(_banded(classes), "bands")
    buckets = banded.groupBy("key").agg(F.min("id").alias("least"), F.count("*").alias("size")).where("size > 1")
    members = stored(banded.join(buckets, "key").select("key", "id", "least"), "members")
    discard(banded)

    stars = members.where("id <> least").select(F.col("id").alias("a"), F.col("least").alias("b")).distinct()
    stars = stored(_gated(stars, classes, percent), "stars")
    # one star per class first: most groups close with it
    nearest = stars.groupBy("a").agg(F.max(F.struct(F.col("guess"), (-F.col("b")).alias("b")))["b"].alias("b"))
    nearest = stored(nearest.select("a", (-F.col("b")).alias("b")), "nearest")
    full = _sets(documents, nearest.select(F.explode(F.array("a", "b")).alias("id")), width, "sets")
    links = stored(_verified(nearest, full, percent), "nearest_links")
    components = connected_components(links)
    discard(stars, nearest)

    left = _open_groups(members, classes, components)
    discard(members)
    if not left.isEmpty():
        more = left.select("id").distinct().join(full.select("id"), "id", "left_anti")
        further = _sets(documents, more, width, "more_sets")
        found = stored(_left_over(left, full.unionByName(further), percent), "rest_links")
        discard(further)
        if not found.isEmpty():
            components = connected_components(links.unionByName(found))
    discard(full, left)

    by_set = _labelled(named, components, "id", "component").select(*sets, F.col("component").alias("_component"))
    out = signed.select("doc_id", *sets).join(by_set, sets, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("_component")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
