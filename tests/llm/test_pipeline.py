"""All stages of the corpus pipeline on a small corpus, each against its own input by brute force."""

from __future__ import annotations

import random

import pytest
from test_dedup import VOCABULARY, sets_of

import corpus_pipeline
from caseloom.llm import packing, quality_rules
from caseloom.llm.queries import vocabulary_path

RNG = random.Random(23)
COLUMNS = list(corpus_pipeline.COLUMNS)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def row(doc_id, text, lang="en"):
    return (doc_id, text, lang, "src", None if text is None else len(text))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("sf")
    common = ["the", "of", "and", "to", "in", "that", "is", "was", "it", "for", "with", "as", "on", "be", "at"]
    good = lambda n: " ".join(RNG.choice(common) if RNG.random() < 0.4 else RNG.choice(VOCABULARY) for _ in range(n))
    junk = lambda n: " ".join(RNG.choice(["$$$", "#buy", "|now|", "click", "###", "win"]) for _ in range(n))
    rows, labels = [], []
    for i in range(60):
        rows.append(row(i, good(RNG.randint(80, 160))))
        labels.append((i, 1, 0))
    for i in range(60, 90):
        rows.append(row(i, junk(RNG.randint(80, 160))))
        labels.append((i, 0, 0))
    base = rows[0][1].split()
    rows += [row(100 + k, " ".join([*base[:40], f"edit{k}", *base[41:]])) for k in range(3)]  # near copies of document 0
    rows += [row(110, rows[1][1]), row(111, rows[2][1])]  # exact copies
    passage = good(30)
    rows += [row(120 + k, f"{good(70)} {passage} {good(70)}") for k in range(3)]
    rows += [row(130, ""), row(131, None), row(None, good(100)), row(140, good(90)), row(140, good(95)), row(141, good(5) * 400)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as kept", "0D as log_weight", "1 as component_id", "2 as sequence_id")
    df.repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{root}/labels.parquet")
    return str(root)


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_stages_do_their_work_on_their_own_input(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = {}
    for name in ("quality_classifier", "quality_rules", "near_duplicates", "suffix_dedup"):
        before = docs
        docs = stages[name](spark, docs, folder)
        assert docs.columns == COLUMNS
        docs.write.parquet(f"{folder}/after_{name}")
        docs = spark.read.parquet(f"{folder}/after_{name}")
        kept[name] = (rows_of(before), rows_of(docs))

    # classifier: junk goes, clean documents stay; what stays is unchanged
    before, after = kept["quality_classifier"]
    assert {r for r in after} <= {r for r in before}
    ids = {r[0] for r in after}
    assert len(ids & set(range(60))) >= 57 and len(ids & set(range(60, 90))) <= 1

    # rules: exactly the rows the operator keeps
    before, after = kept["quality_rules"]
    verdict = {r["doc_id"]: r["kept"] for r in quality_rules.judged(spark.createDataFrame(before, SCHEMA)).collect() if r["doc_id"] is not None}
    assert after == [r for r in before if r[0] is None or verdict[r[0]]]
    assert not any(r[0] in (130, 131) for r in after)

    # near duplicates: one document, the smallest, of each group of the linked ones
    before, after = kept["near_duplicates"]
    sets = {r[0]: sets_of(r[1], 5) for r in before if r[0] is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                one, other = sorted((find(a), find(b)))
                root[other] = one
    assert {r[0] for r in after} - {None} == {i for i in sets if find(i) == i}
    assert not {r[0] for r in after} & {100, 101, 102, 110, 111}

    # repeated passages: no 50 bytes of a document start in one with a smaller id
    before, after = kept["suffix_dedup"]
    assert [r[0] for r in after] == [r[0] for r in before]
    seen: dict[bytes, int] = {}
    for doc_id, text, *_ in sorted((r for r in before if r[0] is not None), key=lambda r: r[0]):
        raw = (text or "").encode()
        for p in range(len(raw) - 49):
            seen.setdefault(raw[p : p + 50], doc_id)
    for doc_id, text, *_ in before:
        if doc_id is None:
            continue
        raw = text.encode()
        gone = [False] * len(raw)
        for p in range(len(raw) - 49):
            if seen[raw[p : p + 50]] < doc_id:
                gone[p : p + 50] = [True] * 50
        left = bytes(b for b, g in zip(raw, gone) if not g).decode(errors="ignore")
        assert left in [r[1] for r in after if r[0] == doc_id]
    assert all(r[4] == len(r[1]) for r in after)

    # packing: every document's ids once, in gapless sequences
    pieces = stages["packing"](spark, docs, folder)
    assert sorted(map(tuple, pieces.drop("sequence_id", "offset").collect()), key=str) == sorted(
        map(tuple, packing.pack_documents(spark.createDataFrame(after, SCHEMA), vocabulary_path()).drop("sequence_id", "offset").collect()), key=str)
    used: dict = {}
    for p in pieces.collect():
        used.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for places in used.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048


def test_run_is_its_stages_and_takes_an_empty_table(spark, folder, tmp_path):
    whole = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(whole.columns) and whole.count() > 50
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
