"""Archives, page text, BPE, packing, quality rules, licences, top-k and resampling."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.llm import bpe, html_text, licences, packing, quality_rules, resampling, topk, warc
from caseloom.llm.queries import vocabulary_path

TEXTS = [
    None, "", " \n\t", "Hello, WORLD's best! don't", "<|endoftext|>a<|startoftext|> b<|endoftext", "Straße ΟΔΟΣ é é İstanbul", "字 नमस्ते 😀👩‍👩‍👧 ½²",
    "\x1c!\x1c\x1f a\x85b\xa0c　d", "aaaaaaaaaaaaaaaaaaaaaaa " * 50, "</w> the</w>", "x" * 5000, "Hello, WORLD's best! don't",
]


def doc_rows():
    return list(enumerate(TEXTS)) + [(None, "no id"), (3, TEXTS[3])]


def test_bpe_equals_library(spark, table):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(vocabulary_path())
    expected = []
    for i, t in doc_rows():
        ids = own.encode(t or "", add_special_tokens=False).ids
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        expected.append((i, len(ids), sha(" ".join(map(str, ids))), sha(own.decode(ids, skip_special_tokens=False))))
    docs = table("doc_id long, text string, id int, decoded string", [(i, t, 0, "clash") for i, t in doc_rows()])
    assert sorted(map(tuple, bpe.digest_documents(docs, vocabulary_path()).collect()), key=str) == sorted(expected, key=str)
    full = {(r["id"], tuple(r["ids"])) for r in bpe.encode_documents(docs, vocabulary_path()).collect()}
    assert full == {(i, tuple(own.encode(t or "", add_special_tokens=False).ids)) for i, t in doc_rows()}
    assert bpe.digest_documents(docs.limit(0), vocabulary_path()).count() == 0


def test_bpe_random_words():
    from tokenizers import Tokenizer

    own, rng = Tokenizer.from_file(vocabulary_path()), random.Random(3)
    texts = [" ".join("".join(rng.choice("abcdeinorst'éß1!.") for _ in range(rng.randint(1, 12))) for _ in range(30)) for _ in range(300)]
    tool = bpe.TrieEncoder(bpe.read_vocabulary(vocabulary_path()))
    assert [e.tolist() for e in tool.encode(texts)] == [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]


def test_packing_holds_every_token_once(spark, table):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(vocabulary_path())
    rows = doc_rows() + [(100 + k, "word " * (37 * k % 900)) for k in range(60)]
    docs = table("doc_id long, text string, length int", [(i, t, 1) for i, t in rows])
    pieces = packing.pack_documents(docs, vocabulary_path(), 256).collect()
    want = Counter((i, len(own.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in rows)
    assert Counter((p["doc_id"], p["doc_tokens"]) for p in pieces if p["start"] == 0) == want
    ids = {i: np.array([*own.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in rows}
    sequences = defaultdict(list)
    for p in pieces:
        assert zlib.crc32(ids[p["doc_id"]][p["start"] : p["start"] + p["length"]].tobytes()) == p["ids_crc32"]
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    assert sum(p["length"] for p in pieces) == sum(len(ids[i]) for i, _ in rows)
    for filled in sequences.values():
        at = 0
        for offset, length in sorted(filled):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack_documents(docs.limit(0), vocabulary_path(), 256).count() == 0


def test_shortest_pack_first_keeps_the_histogram():
    rng = random.Random(1)
    histogram = Counter(rng.randint(1, 64) for _ in range(5000))
    patterns = packing.shortest_pack_first(histogram, 64)
    held = Counter()
    for p in patterns:
        assert p.used <= 64
        for length in p.lengths:
            held[length] += p.count
    assert held == histogram and len(patterns) <= 3 * 64
    assert packing.padding(patterns, 64) < 0.01 * sum(k * n for k, n in histogram.items())


WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def counts_by_hand(text):
    words = WORDS.findall(text or "")
    seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {k for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_equal_brute_force(spark, table):
    texts = [*TEXTS, "a b c a b c a b c", "x\nx\n \n \ny\nx", "a|b & c#", "a b c d " * 40, " ".join(f"w{k}" for k in range(60))]
    rows = [(i, t, None if i % 3 else "en", "clash") for i, t in enumerate(texts)] + [(None, "a", "xx", "clash")]
    docs = table("doc_id long, text string, lang string, n_words string", rows)
    found = {r["doc_id"]: r for r in quality_rules.judged(docs).collect()}
    for i, t, _, _ in rows:
        r, (n, chars, symbols, lines, repeated) = found[i], counts_by_hand(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, lines, repeated)
        assert r["base_failed"] == (n < 50 or 100 * repeated > 50 * n) and not (r["base_failed"] and r["kept"])
    assert quality_rules.judged(docs.limit(0)).count() == 0


def test_quality_verdicts_follow_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = quality_rules.judged(spark.read.parquet(f"{folder}/documents.parquet")).join(labels, "doc_id").where("not base_failed").toPandas()
    assert rows[rows.quality == 1].kept.mean() > 0.98 and rows[rows.quality == 0].kept.mean() < 0.35


def test_resampling(spark, table):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = resampling.resample(docs, labels).toPandas()
    assert len(rows) == docs.count()
    judged = rows.merge(labels.toPandas(), on="doc_id")
    assert judged[judged.quality == 1].kept.mean() > 0.98 and judged[judged.quality == 0].kept.mean() < 0.1
    few = table("doc_id long, text string, kept int", [(1, None, 0), (2, "", 0), (None, "a b", 0), (2, "", 0)])
    none = table("doc_id long, quality int", [])
    assert [r["kept"] for r in resampling.resample(few, none).collect()] == [True] * 4
    assert resampling.resample(few.limit(0), none).count() == 0


@pytest.mark.parametrize("change", ["none", "junk left out", "clean copies", "junk copies"])
def test_resampling_follows_the_amount_of_clean_text(spark, table, change):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(300)]
    clean = lambda: " ".join(rng.choices(words, [300 - k for k in range(300)], k=rng.randint(40, 120)))
    junk = lambda: " ".join(rng.choices(["buy", "now", "$$$", "click", *words[::60]], k=rng.randint(10, 60)))
    kinds = {i: int(i % 10 < 7) for i in range(1500)}
    rows = [(i, clean() if good else junk()) for i, good in kinds.items()]
    labels = [(i, good) for i, good in kinds.items() if i % 3 == 0]
    if change == "junk left out":
        rows = [(i, t) for i, t in rows if kinds[i] or i % 3 == 0]
    elif change != "none":
        text = dict(rows)[1 if change == "clean copies" else 8]
        rows += [(10_000 + k, text) for k in range(3000)]
        kinds |= {10_000 + k: int(change == "clean copies") for k in range(3000)}
    found = resampling.resample(table("doc_id long, text string", rows), table("doc_id long, quality int", labels)).toPandas()
    good = found["doc_id"].map(kinds) == 1
    assert found.columns.tolist() == ["doc_id", "log_weight", "gumbel_key", "kept"] and len(found) == len(rows)
    assert found[good]["kept"].mean() > 0.98 and found[~good]["kept"].mean() < 0.02
    copies = found["doc_id"] >= 10_000
    assert found[good & ~copies]["kept"].mean() > 0.98 and found[~good & ~copies]["kept"].mean() < 0.02


def test_kth_largest(spark, table):
    rng = np.random.default_rng(2)
    values = [float(x) for x in np.concatenate((rng.normal(size=2000), [1e9] * 3, np.zeros(500)))]
    keys = table("k double", [(v,) for v in values])
    for k in (1, 3, 4, 100, 1500, len(values)):
        assert resampling.kth_largest(keys, "k", k) == sorted(values, reverse=True)[k - 1]
    assert resampling.kth_largest(keys, "k", len(values) + 1) is None


@pytest.mark.parametrize("spread", [0.0, 1.5])
def test_topk_equals_brute_force(spark, table, spread):
    rng = np.random.default_rng(4)
    m = rng.normal(size=(900, 12)) * np.exp(rng.normal(size=(900, 1)) * spread)
    if spread:
        m[:600] = np.abs(m[:600])
    m[5] = m[6] = m[7] = 0
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)]
    odd = [(2000, None), (2001, [None] * 12), (2002, [float("nan")] * 12), (2003, [float("inf")] * 12), (2020, [1.0, 2.0]), (2021, [3.0, -1.0])]
    vectors = table("vec_id long, embedding array<double>, score int", [(i, v, 0) for i, v in rows + odd])
    whole = np.floor(64 * m).astype(np.int64)
    expected = []
    for q in range(0, 900, 20):
        scores = whole @ whole[q]
        best = sorted((-int(s), i) for i, s in enumerate(scores) if i != q)[:20]
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    expected.append((2020, 1, 2021, 64 * 192 + 128 * -64))
    monkey_block, topk.BLOCK = topk.BLOCK, 128
    try:
        found = topk.top_k(vectors, F.col("vec_id") % 20 == 0).collect()
    finally:
        topk.BLOCK = monkey_block
    assert sorted(map(tuple, found)) == sorted(expected)


@pytest.mark.parametrize("records", [3, 5000])
def test_archives(spark, table, monkeypatch, records):
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", records)
    pages = [(1, "http://a/x y", "same\r\n\r\n\x00é"), (2, None, "same\r\n\r\n\x00é"), (3, "", None), (4, "u", ""), (5, "u", "WARC/1.1\r\n\r\n"), (7, "u", "x" * 100_000), (-9, "u", "neg")]
    df = table("page_id long, url string, html string, record_type int", [(*p, 0) for p in pages])
    best: dict[bytes, int] = {}
    for i, _, h in pages:
        best[(h or "").encode()] = max(i, best.get((h or "").encode(), i))
    expected = []
    for i, _, h in pages:
        data = (h or "").encode()
        first = best[data] == i
        expected.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if first else "revisit", None if first else best[data]))
    assert sorted(tuple(r)[:5] for r in warc.archive_pages(df).collect()) == sorted(expected)
    assert warc.archive_pages(df.limit(0)).count() == 0


def test_arc_versions():
    body = b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nhi"
    v1 = b"filedesc://x 0.0.0.0 20010101000000 text/plain 8\n1 0 pages\n"[:-1] + b"\nhttp://a 1.2.3.4 2001 text/html %d\n" % len(body) + body + b"\n"
    v1 = v1.replace(b"text/plain 8\n1 0 pages", b"text/plain 9\n1 0 pages")
    block = b"2 0 pages"
    v2 = b"filedesc://x 0.0.0.0 20010101000000 text/plain 200 - - 0 x %d\n" % len(block) + block + b"\nhttp://b 1.2.3.4 20010203 text/html 200 - - 0 x %d\n" % len(body) + body
    for raw, version, url in ((v1, 1, "http://a"), (v2, 2, "http://b")):
        (found,) = warc.parse_arc(raw)
        assert (found["version"], found["url"], found["block"]) == (version, url, body)
    assert warc.iso_date("2001") == "2001-01-01T00:00:00Z"
    with pytest.raises(ValueError):
        list(warc.parse_arc(v1[:-10]))
    for key in (0, 1, -1, 2**63 - 1, -(2**63)):
        assert warc.key_of(warc.record_id("a", 1, key)) == key


PAGE = """<html><head><title>T</title><style>p{{}}</style></head><body><header><h2>Site</h2></header><nav><a href=x>Home, now, here</a></nav>
<div id="sidebar"><p>Side, side, side, side.</p></div><div class=wrap><div class="post">{0}<form><p>Form, a, b</p></form></div></div>
<div class="comments"><p>First, great, post, indeed, yes.</p></div><div class="cookie-notice">We use, cookies</div><footer>Foot</footer></body></html>"""


def test_page_text(spark, table):
    body = "<h1>A &amp; B</h1><p>One, two,\n  three&nbsp;four<script>x</script> and <a href=y>more</a> &#233;.<br>next<p>Second, long, paragraph" + ", word" * 30 + "<ul><li>i1<li>i2</ul>"
    want = "A & B One, two, three four and more é. next Second, long, paragraph" + ", word" * 30 + " i1 i2"
    rows = [(1, "u", PAGE.format(body), "clash"), (2, None, None, "clash"), (None, "u", "", "clash"), (4, "u", "<p>only text", "clash"), (5, "u", "<div><<>&</div", "clash")]
    pages = table("page_id long, url string, html string, text string", rows)
    found = {r["page_id"]: r for r in html_text.extract_pages(pages).collect()}
    assert found[1]["text"] == want and found[1]["n_chars"] == len(want)
    assert (found[2]["text"], found[2]["n_chars"], found[None]["text"], found[4]["text"]) == ("", 0, "", "only text")
    assert html_text.extract_pages(pages.limit(0)).count() == 0


def test_page_text_on_test_pages(spark):
    for row in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", row["html"], re.S).group(1)
        inner = re.sub(r"</?(?:p|h1|h2|li|ul|div|br)\b[^>]*>", " ", inner)
        import html

        assert html_text.main_text(row["html"]) == " ".join(html.unescape(re.sub(r"<[^>]*>", "", inner)).split())


def test_licences(spark, table):
    rows = [(1, "Some words.\nLicensed under the Apache License, Version 2.0.\nthe end of it"), (2, None), (3, ""), (4, "This work is licensed under the GNU General Public License, version 3."), (5, "the use of this and that in the work of the day"), (None, "Licensed under the MIT License.")]
    docs = table("doc_id long, text string, family int", [(*r, 0) for r in rows])
    found = {(r["doc_id"], r["position"], r["family"]) for r in licences.scan_licences(docs).where("confirmed").collect()}
    assert found == {(1, 1, "apache-2.0"), (4, 0, "gpl-3.0"), (None, 0, "mit")}
    assert licences.scan_licences(docs.limit(0)).count() == 0


def test_licences_of_the_test_table(spark):
    families = {
        "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0", "Released under the MIT License.": "mit",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc", "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    }
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = Counter((r["doc_id"], k, families[line]) for r in docs.collect() for k, line in enumerate((r["text"] or "").split("\n")) if line in families)
    found = Counter((r["doc_id"], r["position"], r["family"]) for r in licences.scan_licences(docs).where("confirmed").collect())
    assert len({f for _, _, f in want}) == 4 and found == want


def test_licences_of_creative_commons(spark, table):
    rows, want = [], set()
    for k, short in enumerate(("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")):
        name = short.replace("BY", "Attribution").replace("SA", "ShareAlike").replace("ND", "NoDerivatives").replace("NC", "NonCommercial")
        lines = [f"Licensed under CC {short} 4.0.", f"Licensed under a Creative Commons {name} 4.0 International License", f"Content is available under CC {short} 3.0"]
        rows.append((k, "\n".join(lines)))
        want |= {(k, i, f"cc-{short.lower()}") for i in range(3)}
    # copies in the corpus are no ordinary text
    rows += [(100 + k, "Licensed under CC BY-NC 4.0.\nsome words of a text") for k in range(200)]
    want |= {(100 + k, 0, "cc-by-nc") for k in range(200)}
    found = licences.scan_licences(table("doc_id long, text string", rows)).where("confirmed").collect()
    assert {(r["doc_id"], r["position"], r["family"]) for r in found} == want


def test_licence_calibration(spark, table):
    seen = [licences._variants(s) for s in (*licences.UNKNOWN, *(s for t in licences.TEMPLATES.values() for s in t))]
    words = lambda s: tuple(re.findall(r"[^\W_]+", s.lower()))
    known = {words(v) for variants in seen for v in variants}
    altered = [(f, v) for f, t in (*licences.TEMPLATES.items(), ("unknown", licences.UNKNOWN)) for s in t for v in licences._altered(s)]
    assert sum(words(v) in known for _, v in altered) < 0.05 * len(altered)
    assert licences.separating_limit([0.9, 0.6, 0.7], [0.2, 0.4]) == 0.5
    # altered notices of a known family: confirmed by its template, whatever their probability
    rows = [
        (1, "Kindly note, licensed under Apache License, Version 2.0, by the great people of many small towns and villages"),
        (2, "Permission hereby granted, free of charge, to any person who is obtaining a copy of this software and its associated documentation files (the \"Software\"), to deal in the Software without restriction"),
        (3, "This program may not be copied; its use is subject to the license terms of the owner and to a commercial agreement"),
    ]
    found = {r["doc_id"]: r for r in licences.scan_licences(table("doc_id long, text string", rows)).collect()}
    assert (found[1]["family"], found[1]["confirmed"], found[2]["family"], found[2]["confirmed"]) == ("apache-2.0", True, "mit", True)
    assert (found[3]["family"], found[3]["similarity"], found[3]["confirmed"]) == ("unknown", 0.0, False)


def test_licence_confirmed_below_the_limit(spark, table, monkeypatch):
    train = licences.train
    monkeypatch.setattr(licences, "train", lambda *a: (*train(*a)[:2], 1.1))  # no probability reaches the limit
    rows = [(1, "Licensed under the Apache License, Version 2.0."), (2, "All rights reserved.")]
    found = {r["doc_id"]: (r["family"], r["confirmed"]) for r in licences.scan_licences(table("doc_id long, text string", rows)).collect()}
    assert found == {1: ("apache-2.0", True), 2: ("unknown", False)}


@pytest.mark.parametrize("outer", ["article", "main"])
def test_page_text_keeps_all_parts_of_the_article(outer):
    long = "<p>One, two, three, four, five, six" + ", word" * 40 + ".</p>"
    text = "One, two, three, four, five, six" + ", word" * 40 + "."
    page = "<body><nav><a href=x>Home</a></nav><div class=top><ul><li><a href=a>Link one</a><li><a href=b>Link two</a></ul></div>{}<footer>Foot</footer></body>"
    for inner, want in (
        (f"<h1>Title</h1><div class='content'>{long * 3}</div>", f"Title {text} {text} {text}"),
        (f"<h1>Title</h1><p>Short.</p><div class='content'>{long * 3}</div><ul><li>i1<li>i2</ul>", f"Title Short. {text} {text} {text} i1 i2"),
        (f"<section>{long * 4}</section><section><h2>End</h2><p>Last.</p></section>", f"{text} {text} {text} {text} End Last."),
        (f"<header><h1>Title</h1></header><div><div>{long * 3}</div><aside>Ad, ad</aside></div>", None),
    ):
        found = html_text.main_text(page.format(f"<{outer}>{inner}</{outer}>"))
        assert found == want or want is None and "Ad" not in found and "Link" not in found and text in found
    # without an article element: headings, lists and short paragraphs beside the best container
    beside = f"<div class=wrap><h1>Title</h1><p>Short.</p><div class='content'>{long * 3}</div><ul><li>i1<li>i2</ul><ul><li><a href=a>Link three</a></ul></div>"
    assert html_text.main_text(page.format(beside)) == f"Title Short. {text} {text} {text} i1 i2"


def test_licences_wrapped_over_lines(spark, table):
    import textwrap

    mit = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense."
    )
    gpl = licences.TEMPLATES["gpl-3.0"][1]
    rows = [
        (1, "Some words.\n\n" + "\n".join(textwrap.wrap(mit, 72)) + "\n\nthe end of it"),
        (2, "\n".join(f" * {x}" for x in textwrap.wrap(gpl, 45))),
        (3, "Licensed under the Apache License, Version 2.0.\nLicensed under the MIT License."),
        (None, "x\n" + "\n".join(textwrap.wrap(gpl, 60))),
        (None, "x\n" + "\n".join(textwrap.wrap(gpl, 60))),
    ]
    found = [(r["doc_id"], r["position"], r["family"]) for r in licences.scan_licences(table("doc_id long, text string", rows)).where("confirmed").collect()]
    want = [(1, 2, "mit"), (2, 0, "gpl-3.0"), (3, 0, "apache-2.0"), (3, 1, "mit"), (None, 1, "gpl-3.0"), (None, 1, "gpl-3.0")]
    assert Counter(found) == Counter(want)


def test_licences_of_further_families_and_unknown_wording(spark, table):
    want = {
        "GNU Affero General Public License, version 3": "agpl-3.0", "SPDX-License-Identifier: Apache-2.0": "apache-2.0",
        "SPDX-License-Identifier: GPL-2.0-only": "gpl-2.0", "This is free and unencumbered software released into the public domain.": "unlicense",
        "Distributed under the Boost Software License, Version 1.0.": "bsl-1.0", "Licensed under the Zlib License.": "unknown",
        "Proprietary and confidential; redistribution is prohibited.": "unknown",
        "We may not obtain a copy of the book without permission of the publisher": "unknown",
    }
    rows = [*enumerate(want), (90, "word " * 200_000 + "\nLicensed under the MIT License.\n" + "the use of it " * 50_000), (91, "Licensed under the ISC License.\r\n" * 2)]
    found = licences.scan_licences(table("doc_id long, text string", rows)).collect()
    assert {text: [r["family"] for r in found if r["doc_id"] == k] for k, text in enumerate(want)} == {t: [f] for t, f in want.items()}
    assert [(r["position"], r["family"]) for r in found if r["doc_id"] == 90 and r["confirmed"]] == [(1, "mit")]
    assert sorted(r["position"] for r in found if r["doc_id"] == 91 and r["family"] == "isc") == [0, 1]


def test_telling_pairs_are_those_of_the_words(spark, table):
    """The pattern finds a text exactly when its word pairs hold a telling one."""
    rng = random.Random(5)
    words = ["free", "freed", "of", "the", "license", "licenses", "2", "0", "gnu", "general", "cc", "by", "bya"]
    pairs = ["free of", "of the", "gnu general", "general license", "2 0", "cc by", "the license"]
    told = set(pairs) - {"of the"}
    rows = [(k, "".join(rng.choice(words) + rng.choice([" ", "-", ", ", "\n", "_"]) for _ in range(rng.randint(0, 6)))) for k in range(600)]
    split = licences._pairs(licences._words(F.col("text")))
    got = table("doc_id long, text string", rows).select("text", F.lower("text").rlike(licences._START + licences.telling_pairs(pairs)).alias("hit"), split.alias("pairs")).collect()
    assert all(r["hit"] == bool(told & set(r["pairs"])) for r in got) and {r["hit"] for r in got} == {True, False}


ARTICLE = "<h1>Big title</h1>" + "".join(f"<p>Paragraph {k} has words, commas, and enough of plain text to score.</p>" for k in range(5))
PROSE = "Big title " + " ".join(f"Paragraph {k} has words, commas, and enough of plain text to score." for k in range(5))


@pytest.mark.parametrize("page, text", [
    (f'<body class="has-sidebar"><div class="container no-sidebar"><article>{ARTICLE}</article></div><footer>x</footer>', PROSE),
    (f'<div class="content-sidebar-wrap"><main><article>{ARTICLE}</article></main><div class="sidebar"><article><p>A teaser, short</p></article></div></div>', PROSE),
    (f'<article><header class="entry-header"><h1>Head line</h1></header>{ARTICLE}</article>', "Head line " + PROSE),
    (f'<article>{ARTICLE}<section class="legal"><p>Legal section.</p></section><div class="share">Share</div></article>', PROSE + " Legal section."),
    (f'<article>{ARTICLE}</article><div id="comments">' + "<article><p>A comment, and long, and longer still</p></article>" * 30 + "</div>", PROSE),
    (f'<div class="theme-widget-wrap"><div class="widget"><div>{ARTICLE}</div></div></div><div class="sidebar"><p>Side text</p></div>', PROSE),
    (f'<div class="header"><p>Site name</p></div><div>{ARTICLE}</div>', PROSE),
])
def test_page_text_and_classes_of_layout(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("page", [
    "<a" + "x" * 400_000, '<a "' * 100_000 + ">", "<a '\"" * 40_001 + " > end", "<" * 400_000, "<!--" * 100_000, "<div>x" * 20_000,
    "<article>x" * 20_000, "<div>" * 20_000 + "x" + "</div>" * 20_000 + "</b>" * 20_000, "<ul>" + "<li>x" * 20_000,
])
def test_odd_pages_take_linear_time(page):
    start = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - start < 10  # quadratic work would take minutes


def test_tags_that_never_end_are_text():
    assert html_text.main_text("<p>one, two</p> 3 < 4 <b") == "one, two 3 < 4 <b"
    assert html_text.main_text('<p class="x>one</p><p>two</p>') == "one two"


def test_archives_odd_addresses_and_missing_ids(spark, table):
    pages = table("page_id long, url string, html string", [(None, "a\tb", "same"), (None, "a\r\nb", "same"), (0, "filedesc://x y", "other"), (0, "u", "other"), (3, None, None)])
    rows = sorted(((r.page_id, r.uri, r.record_type, r.refers_to) for r in warc.archive_pages(pages).where("page_id is not null").collect()), key=lambda r: r[0])
    assert [r[0] for r in rows] == [0, 0, 3] and rows[2][1:] == ("urn:none", "response", None)
    assert {r[1] for r in rows[:2]} == {"filedesc://x%20y", "u"} and {(r[2], r[3]) for r in rows[:2]} == {("response", None), ("revisit", 0)}
    again = warc.archive_pages(pages).where("page_id is null").collect()
    assert {r.uri for r in again} == {"a%09b", "a%0D%0Ab"} and {r.refers_to for r in again} == {None}
    assert sorted(r.record_type for r in again) == ["response", "revisit"]
