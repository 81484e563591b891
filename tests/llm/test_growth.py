"""What keeps the operators' work in proportion to their input."""

from __future__ import annotations

import numpy as np

from pyspark.sql import functions as F

from caseloom.llm import bpe, common, suffix_dedup
from caseloom.llm.queries import vocabulary_path

PASSAGE = b"the one passage that very many documents of the corpus have in common, word for word"


def test_strings_of_split_anchors_meet_without_a_join(spark, table):
    rows = [(7, k % 3, 3, k, bytearray(f"{k:02d}".encode() + PASSAGE), 50 - k) for k in range(20)]
    contexts = table("anchor long, part int, parts int, name long, context binary, doc_id long", rows)
    merged = suffix_dedup._merge(suffix_dedup._shards(contexts.repartition(2, "anchor", "part").sortWithinPartitions("anchor", "part"), 50))
    assert "Join" not in merged._jdf.queryExecution().optimizedPlan().toString()
    found = {(r["name"], r["offsets"][0]): r["docs"][0] for r in merged.collect()}
    size = len(PASSAGE) + 2 - 50 + 1
    # windows inside the passage belong to the smallest doc, those with a context's own two letters to itself
    own = {(k, o) for k in range(20) for o in range(2) if o < 1 or f"{k:02d}"[1:] not in {f"{j:02d}"[1:] for j in range(20) if j != k}}
    assert all(found[k, o] == 50 - k for k, o in own)
    assert all(found[k, o] == 31 for k in range(20) for o in range(2, size))


def test_verdicts_by_which_nobody_loses_are_left_out(spark, table):
    rows = [(1, 0, 1, 10, bytearray(PASSAGE), 4, 4), (2, 0, 1, 20, bytearray(PASSAGE[:60]), 4, 9), (3, 0, 1, 30, bytearray(PASSAGE), 5, 5), (3, 0, 1, 31, bytearray(b"x" + PASSAGE), 8, 8)]
    contexts = table("anchor long, part int, parts int, name long, context binary, doc_id long, last_doc long", rows)
    found = suffix_dedup._shards(contexts.repartition(1).sortWithinPartitions("anchor", "part"), 50)
    n = len(PASSAGE) - 50 + 1
    assert sorted((r["name"], r["offsets"], r["counts"], r["docs"]) for r in found.collect()) == [(20, [0], [11], [4]), (31, [1], [n], [5])]


def test_anchors_are_counted_in_rounds(spark, table, monkeypatch):
    """Each round shuffles its share of the anchors, and all rounds together find what one would."""
    written = []
    plain = suffix_dedup.stored
    monkeypatch.setattr(suffix_dedup, "stored", lambda df, name, slices=None: (written.append(name), plain(df, name, slices))[1])
    docs = table("doc_id long, text string", [(k, f"{k:09d}" * 8 + PASSAGE.decode() + f"{k + 50:09d}" * 8) for k in range(1, 9)])
    found = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeats(docs).select("doc_id", "n_removed").collect()}
    assert found[1] == 0 and all(found[k] >= len(PASSAGE) for k in range(2, 9))
    assert written.count("shared_anchors") == suffix_dedup.SLICES


def test_packed_spans_merge_row_by_row():
    import pyarrow as pa

    spans = [None, [], [(0, 50), (40, 90), (200, 250)], [(10, 60), (60, 70), (0, 5)]]
    packed = pa.array([s and [a << 32 | b for a, b in s] for s in spans], pa.list_(pa.int64()))
    start, end, each = suffix_dedup.merge_spans(packed)
    assert list(zip(start.tolist(), end.tolist())) == [(0, 90), (200, 250), (0, 5), (10, 70)]
    assert each.tolist() == [0, 0, 2, 2]


def test_vocabulary_words_are_not_walked_and_order_is_no_matter(monkeypatch):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(vocabulary_path())
    texts = ["the people of the world", "zzqxj zzqxk zzq thethe's 12a \x00b\x1fc", "zzqxjpeople worldzz #<%a'll", "worldzzqxj zzqxj0 é zzqé"]
    tool = bpe.TrieEncoder(bpe.read_vocabulary(vocabulary_path()))
    for text in (*texts, " ".join(reversed(texts))):
        assert tool.encode([text])[0].tolist() == own.encode(text, add_special_tokens=False).ids
    fresh = bpe.TrieEncoder(bpe.read_vocabulary(vocabulary_path()))
    monkeypatch.setattr(fresh, "_candidates", None)
    assert np.array_equal(fresh.encode(texts[:1])[0], tool.encode(texts[:1])[0])


def test_bpe_words_are_encoded_side_by_side(monkeypatch):
    """Many new words take no step one by one, and get the ids of the walk over sorted words and of the vocabulary's library."""
    import random

    from tokenizers import Tokenizer

    own, rng = Tokenizer.from_file(vocabulary_path()), random.Random(9)
    words = {"".join(rng.choice(["th", "ing", "e", "r", "st", "q", "7", "é", "ĥ", "'", ".", "ß", "\x00", "日"]) for _ in range(rng.randint(1, 9))) for _ in range(4000)}
    texts = [" ".join(rng.sample(sorted(words), 400)) for _ in range(8)]
    expected = [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]
    tool = bpe.TrieEncoder(bpe.read_vocabulary(vocabulary_path()))
    walked = []
    one_by_one = tool._encode_words
    monkeypatch.setattr(tool, "_encode_words", lambda w: (walked.extend(w), one_by_one(w))[1])
    assert [e.tolist() for e in tool.encode(texts)] == expected and not walked
    monkeypatch.setattr(bpe, "FEWEST_LANES", 1 << 30)
    fresh = bpe.TrieEncoder(bpe.read_vocabulary(vocabulary_path()))
    assert [e.tolist() for e in fresh.encode(texts)] == expected
    monkeypatch.setattr(bpe, "FEWEST_LANES", 1)
    long = ["", "x" * 63 + " " + "thing" * 13, "y" * 200 + ". a", "zq", " \t", "a\x85b\xa0c d\x1ce"]
    assert [e.tolist() for e in fresh.encode(long)] == [e.ids for e in own.encode_batch(long, add_special_tokens=False)]
    assert fresh.encode([]) == []


def test_bpe_special_tokens_are_no_ordinary_chunks():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(vocabulary_path())
    tool = bpe.TrieEncoder(bpe.read_vocabulary(vocabulary_path()))
    texts = ["A5 a5 A49000"]
    for name in tool._special:
        texts += [name, f"x{name}y{name}{name} é{name}", f"A1 {name.upper()} {name.lower()} {name[:-1]}"]
    assert [e.tolist() for e in tool.encode(texts)] == [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]


def test_bpe_full_tables_keep_the_words_at_hand(monkeypatch):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(vocabulary_path())
    monkeypatch.setattr(bpe, "KEPT_WORDS", 20)
    tool = bpe.TrieEncoder(bpe.read_vocabulary(vocabulary_path()))
    texts = [" ".join(f"zq{a}{b}, é{a} {a}xx." for a in "abcdefgh") for b in "uvwxyz"]
    learnt = []
    learn = tool._learn
    monkeypatch.setattr(tool, "_learn", lambda chunks: (learnt.append(chunks), learn(chunks))[1])
    for text in [t for t in texts for _ in range(2)]:
        assert tool.encode([text])[0].tolist() == own.encode(text, add_special_tokens=False).ids
    assert len(learnt) == len(texts)


def test_a_shard_holds_a_few_dozen_megabytes():
    """Six megabytes of contexts of many anchors go through one task; an executor has room for several such tasks."""
    import tracemalloc

    import pyarrow as pa

    n, size = 90_000, 70
    texts = np.random.default_rng(3).integers(97, 123, n * size, dtype=np.uint8).tobytes()
    anchors = np.arange(n) // 6
    columns = {
        "anchor": anchors, "part": np.zeros(n, np.int32), "parts": np.ones(n, np.int32), "name": np.arange(n),
        "context": [texts[k : k + size] for k in range(0, n * size, size)], "doc_id": np.arange(n), "last_doc": np.arange(n) + 1,
    }
    batches = pa.table(columns).to_batches(max_chunksize=2048)
    tracemalloc.start()
    found = sum(b.num_rows for b in suffix_dedup._work_off(iter(batches), 50))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == n and peak < 120 << 20


def test_slices_are_written_without_a_sort_and_read_alone(spark):
    rows = spark.range(0, 4000, 1, 2).selectExpr("id", "cast(id * 7 % 4 as int) as slice")
    sliced = common.stored(rows, "sliced", slices="slice")
    for k in range(4):
        own = [r["id"] for r in sliced.where(f"slice = {k}").withColumn("file", F.input_file_name()).orderBy("file", F.monotonically_increasing_id()).collect()]
        assert sorted(own) == [i for i in range(4000) if i * 7 % 4 == k]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_anchors_lie_in_a_folder_per_round(spark, table, monkeypatch):
    """A round reads its own anchors, not those of all rounds."""
    sliced = {}
    plain = suffix_dedup.stored
    monkeypatch.setattr(suffix_dedup, "stored", lambda df, name, slices=None: (sliced.update({name: slices}), plain(df, name, slices))[1])
    suffix_dedup.repeated_spans(table("doc_id long, text string", [(k, PASSAGE.decode()) for k in range(3)]), 50)
    assert sliced["anchors"] == sliced["contexts"] == "slice"


def test_contexts_that_share_no_window_skip_the_suffix_array(monkeypatch):
    """A short phrase that many documents have gives their contexts an anchor in common, but nothing to remove."""
    import pyarrow as pa

    rng = np.random.default_rng(11)
    word = lambda n: rng.integers(97, 123, n, dtype=np.uint8).tobytes()
    phrases, passage = [word(int(n)) for n in rng.integers(17, 45, 30)], word(70)
    texts = [b"".join([word(40), phrases[k % 30], word(int(rng.integers(3, 40))), passage[k % 20 : 50 + k % 21] if k % 3 == 0 else b"", phrases[k % 7]]) for k in range(300)]
    rows = []
    for doc, text in enumerate(texts):
        first, last, anchor = suffix_dedup.window_anchors(np.frombuffer(text, np.uint8))
        rows += [(int(a), text[f : e + 50], doc) for f, e, a in zip(first, last, anchor.view(np.int64))]
    least = {}
    for a, c, doc in rows:
        least[a, c] = min(doc, least.get((a, c), doc))
    rows = sorted((a, c, doc) for (a, c), doc in least.items())
    owners = {}
    for k, (a, c, _) in enumerate(rows):
        for w in range(len(c) - 49):
            owners.setdefault((a, c[w : w + 50]), set()).add(k)
    meets = {k for own in owners.values() if len(own) > 1 for k in own}
    several = {k for k, r in enumerate(rows) if k and rows[k - 1][0] == r[0] or k + 1 < len(rows) and rows[k + 1][0] == r[0]}
    given = []
    plain = suffix_dedup.shard_minima
    monkeypatch.setattr(suffix_dedup, "shard_minima", lambda raw, sizes, docs, length: (given.append(len(sizes)), plain(raw, sizes, docs, length))[1])
    n = len(rows)
    batch = pa.table({
        "anchor": [r[0] for r in rows], "part": pa.array([0] * n, pa.int32()), "parts": pa.array([1] * n, pa.int32()), "name": list(range(n)),
        "context": pa.array([r[1] for r in rows], pa.binary()), "doc_id": [r[2] for r in rows],
    }).to_batches()
    found = {}
    for b in suffix_dedup._work_off(iter(batch), 50):
        for r in b.to_pylist():
            for o, c, d in zip(r["offsets"], r["counts"], r["docs"]):
                found |= {(r["name"], o + w): d for w in range(c)}
    expected = {(k, w): min(rows[j][2] for j in owners[a, c[w : w + 50]]) for k, (a, c, _) in enumerate(rows) for w in range(len(c) - 49)}
    assert found == expected
    assert len(meets) <= sum(given) < (len(meets) + len(several)) / 2


def test_anchors_travel_as_one_row_per_document_and_round(spark, table):
    rng = np.random.default_rng(2)
    texts = [rng.integers(97, 123, n, dtype=np.uint8).tobytes().decode() for n in (60, 900, 50, 4000)]
    rows = suffix_dedup._anchors(table("doc_id long, text string", list(enumerate(texts))), 50).collect()
    assert len({(r["doc_id"], r["slice"]) for r in rows}) == len(rows) <= suffix_dedup.SLICES * len(texts)
    for doc, text in enumerate(texts):
        anchors = set(suffix_dedup.window_anchors(np.frombuffer(text.encode(), np.uint8))[2].view(np.int64).tolist())
        own = [(a, r["slice"]) for r in rows if r["doc_id"] == doc for a in r["anchors"]]
        assert len(own) == len(anchors) and {a for a, _ in own} == anchors and all(a % suffix_dedup.SLICES == k for a, k in own)
