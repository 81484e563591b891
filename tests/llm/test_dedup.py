"""Near duplicates, repeated passages and components against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest

from caseloom.llm import hyperminhash, suffix_dedup
from caseloom.llm.components import connected_components

RNG = random.Random(5)
VOCABULARY = ["".join(RNG.choice("abcdefghij") for _ in range(RNG.randint(2, 7))) for _ in range(400)]


def prose(n: int) -> list[str]:
    return [RNG.choice(VOCABULARY) for _ in range(n)]


def edited(words: list[str], share: float) -> list[str]:
    return [RNG.choice(VOCABULARY) if RNG.random() < share else w for w in words]


@pytest.fixture(scope="module")
def corpus() -> list[tuple[int | None, str | None]]:
    texts: list[str | None] = [None, "", "   \n", "a", "a b", "A  B", "a b c", "x y z w"]
    base = prose(150)
    texts += [" ".join(edited(base, 0.02)) for _ in range(40)] + [" ".join(base)] * 10
    texts += [" ".join(edited(prose(60), 0.0)) for _ in range(30)]
    passage = " ".join(prose(30))
    texts += [" ".join(prose(20)) + passage + " ".join(prose(20)) for _ in range(15)]
    texts += ["aé" * 200, "é" + "aé" * 100, "\x00" * 120 + "b", "\x00" * 119 + "c", "ab " * 300]
    RNG.shuffle(texts)
    return list(enumerate(texts))


def sets_of(text: str | None, width: int) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1))


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, table, corpus, width, percent):
    sets = {i: sets_of(t, width) for i, t in corpus}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    expected = sorted((i, len(sets[i]), find(i), find(i) == i) for i in sets)
    rows = [(i, t, "clash", 0) for i, t in corpus]
    docs = table("doc_id long, text string, kept string, component_id int", rows)
    assert sorted(map(tuple, hyperminhash.near_duplicates(docs, width, percent).collect())) == expected


def test_near_duplicates_edges(spark, table):
    docs = table("doc_id long, text string", [(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (2, "a b c d")])
    found = sorted(map(tuple, hyperminhash.near_duplicates(docs, 3, 85).collect()), key=str)
    assert found == sorted([(None, 2, None, True), (4, 2, 2, False), (4, 2, 2, False), (2, 2, 2, True)], key=str)
    assert hyperminhash.near_duplicates(docs.limit(0), 3, 85).count() == 0


def test_sketch_estimates_jaccard():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(40):
        pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
        a, b = np.unique(pool[:2500]), np.unique(pool[500:])
        guess = hyperminhash.estimate((hyperminhash.sketch(a) == hyperminhash.sketch(b)).sum())
        errors.append(float(guess) - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08


def test_components(spark, table):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, 101), (101, 100), (102, 101), (7, 7)]
    found = dict(map(tuple, connected_components(table("a long, b long", links)).collect()))
    assert found == {**{k: 1 for k in range(1, 41)}, 100: 100, 101: 100, 102: 100}


def cut_by_hand(rows, length=50):
    first: dict[bytes, int] = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, b in texts:
        for p in range(len(b) - length + 1):
            k = b[p : p + length]
            first[k] = min(first.get(k, i), i)
    out = []
    for i, b in texts:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(np.int8)))) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("contexts_per_shard", [512, 4])
def test_repeats_equal_brute_force(spark, table, corpus, monkeypatch, contexts_per_shard):
    monkeypatch.setattr(suffix_dedup, "SHARD_CONTEXTS", contexts_per_shard)
    docs = table("doc_id long, text string, spans string", [(i, t, "clash") for i, t in corpus])
    found = suffix_dedup.digest(suffix_dedup.remove_repeats(docs)).collect()
    assert sorted(map(tuple, found)) == cut_by_hand(corpus)


def test_repeats_edges(spark, table):
    text = "q" * 30 + "the same long passage of words, again and again and again"
    docs = table("doc_id long, text string", [(None, text), (3, text), (3, text), (1, text), (2, None)])
    found = suffix_dedup.remove_repeats(docs).select("doc_id", "n_removed").collect()
    assert sorted(map(tuple, found), key=str) == sorted([(None, 0), (3, len(text)), (3, len(text)), (1, 0), (2, 0)], key=str)
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_suffix_array_and_prefixes():
    raw = np.frombuffer(b"mississippi" * 9 + b"abc" + b"\x00" * 20, np.uint8)
    order = suffix_dedup.suffix_array(raw)
    text = raw.tobytes()
    assert order.tolist() == sorted(range(len(text)), key=lambda p: text[p:])
    got = suffix_dedup.common_prefixes(raw, order, np.array([0, 40]), np.array([40, len(text) - 40]), 12)
    for k in range(1, len(text)):
        a, b = text[order[k - 1] :], text[order[k] :]
        want = next((n for n in range(12) if a[n : n + 1] != b[n : n + 1] or n >= min(len(a), len(b))), 12)
        assert got[k] == want


def test_blocks_link_what_brute_force_links():
    """Blocks of near copies around the threshold: the forest joins exactly the components of all links."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 120, dtype=np.uint64)
    rows = []
    for i in range(60):
        own = base.copy()
        changed = rng.choice(len(own), rng.integers(0, 12), replace=False)
        own[changed] = rng.integers(0, 1 << 63, len(changed), dtype=np.uint64)
        s = np.unique(own)
        rows.append((i, len(s), i, 0, hyperminhash.sketch(s).astype("<u2").tobytes(), s.view(np.int64)))
    rows = pd.DataFrame(rows, columns=["id", "n", "component", "main", "registers", "shingles"])
    rows = rows.sample(frac=1, random_state=1).reset_index(drop=True)

    def parts(links):
        root = list(range(len(rows)))
        for a, b in links:
            root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
        return root

    sets = {i: set(s.tolist()) for i, s in zip(rows["id"], rows["shingles"])}
    linked = {(a, b) for a in sets for b in sets if b < a and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    assert 0 < len(linked) < len(sets) * (len(sets) - 1) / 2
    found = list(zip(*hyperminhash._tile_links(rows[rows["component"] != 0], rows, 85)))
    assert set(found) <= linked and len(found) < len(sets)
    assert parts(found) == parts(linked)
    assert hyperminhash._tile_links(rows[:0], rows, 85) == ([], [])


def test_split_anchors_name_each_string_once_per_part(spark, table):
    """A passage in many surroundings: the rows that meet by string grow with the parts, not with the contexts."""
    passage = b"the one passage that very many documents of the corpus have in common, word for word"
    contexts, parts = [], 3
    for k in range(60):
        whole = f"{k:02d}{'x' * (k % 7)}".encode() + passage + f"{'y' * (k % 5)}{k:02d}".encode()
        contexts.append((7, k % parts, parts, k, bytearray(whole), 100 - k))
    rows = table("anchor long, part int, parts int, name long, context binary, doc_id long", contexts)
    written = suffix_dedup._shards(rows.repartition(4, "anchor", "part").sortWithinPartitions("anchor", "part"), 50).cache()
    per_string = written.where("string is not null").groupBy("anchor", "string").count().toPandas()
    assert per_string["count"].max() <= parts
    found = {(r["name"], r["offsets"][0]): r["docs"][0] for r in suffix_dedup._merge(written).collect()}
    least: dict[bytes, int] = {}
    windows = [(k, o, bytes(c[o : o + 50]), d) for _, _, _, k, c, d in contexts for o in range(len(c) - 49)]
    for _, _, w, d in windows:
        least[w] = min(least.get(w, d), d)
    assert found == {(k, o): least[w] for k, o, w, _ in windows}
