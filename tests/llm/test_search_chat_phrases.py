"""Lexical scan, chat templates and phrase mining against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from caseloom.llm import chat, collocations, lexical_scan
from caseloom.llm.quotient_filter import CountingFilter, permute, restore
from caseloom.llm.template import TemplateError, compile_template, fold, parse

RNG = random.Random(11)
WORDS = ["the", "of", "a", "É", "été", "x1", "don", "t", "naïve", "北京", "zz", "q"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(n: int, signs: str = " ,.-'\n\t") -> str:
    return "".join(RNG.choice(WORDS) + RNG.choice(signs) * RNG.randint(1, 2) for _ in range(n))


# ---------------------------------------------------------------- lexical scan
def terms(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def ranked(documents, items, k):
    held = [(d, Counter(terms(t))) for d, t in documents]
    held = [(d, c) for d, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    wanted: dict = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        scores = []
        for d, c in held:
            m = 10 + 90 * sum(c.values()) * n // total
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in own if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k], 1)]
    return out


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(lexical_scan, "BLOCK_ITEMS", 3)
    monkeypatch.setattr(lexical_scan, "CELLS", 40)


def test_scan_equals_brute_force_in_blocks(spark, table, small_blocks):
    documents = [(i, prose(RNG.randint(1, 40))) for i in range(60)]
    documents += [(100, None), (101, ""), (102, " .,- "), (None, "zz q été"), (3, documents[3][1]), (3, "zz " * 5000), (103, "THE É the")]
    items = [(1, "The été"), (2, "zz q"), (2, "x1"), (3, None), (4, "... "), (None, "naïve 北京"), (5, "absent"), (6, "don't"), (7, "of a the")]
    docs = table("doc_id long, text string, n long, score long, item_id long", [(d, t, 1, 2, 3) for d, t in documents]).repartition(5)
    asked = table("item_id int, text string, terms string", [(i, t, "x") for i, t in items])
    assert found(lexical_scan.search(docs, asked, 4)) == sorted(ranked(documents, items, 4), key=str)


def test_scan_of_empty_tables(table):
    docs, none = table("doc_id long, text string", [(1, "a b")]), table("doc_id long, text string", [])
    items, nothing = table("item_id long, text string", [(1, "a")]), table("item_id long, text string", [])
    assert [lexical_scan.search(d, i).count() for d, i in ((none, items), (docs, nothing), (docs, items))] == [0, 0, 1]


def test_terms_side_by_side_share_their_blank():
    automaton = lexical_scan.guarded_automaton(["a", "aa", "ab"])
    hits = Counter(i for _, i in automaton.iter(lexical_scan.blanked("a A-aa.ab aab").decode()))
    assert hits == {0: 2, 1: 1, 2: 1} and lexical_scan.count_terms(lexical_scan.blanked("a A-aa.ab aab")) == 5


# ---------------------------------------------------------------- template language
def render(source, **values):
    out = compile_template(source)(**values)
    return "".join(out.pieces), out.marked


@pytest.mark.parametrize("source, values, expected", [
    ("{{ a ~ 'x' + 1 }}", {"a": "v"}, "vx1"),
    ("{{ m.k }}{{ m['k'] }}{{ m.gone }}{{ l[1] }}{{ l[9] }}", {"m": {"k": 2}, "l": [1, 3]}, "223"),
    ("{% if a == 1 %}one{% elif a in [] %}{% else %}other{% endif %}", {"a": 1}, None),
    ("{% if a == 1 %}one{% elif a == 2 %}two{% else %}other{% endif %}", {"a": 2}, "two"),
    ("{% for x in l -%} {{ loop.index }}{{ x }}{% if not loop.last %}, {% endif %}{% endfor %}", {"l": ["a", "b"]}, "1a, 2b"),
    ("{% set y = x | trim | upper %}{{ y }}{{ 'ab' | length }}", {"x": " q "}, "Q2"),
    ("a {#- gone #} b {%- if true -%} c {% endif %}", {}, "a  bc "),
    ("{{ 'yes' if a and not b else 'no' }}{{ true }}{{ none }}", {"a": 1, "b": 0}, "yestrue"),
    ("{{ '}}' }}{{ \"%}\\n\" }}", {}, "}}%}\n"),
    ("{{ 7 % 4 }}{{ 'a' in 'cat' }}{{ 3 < 5 }}{{ 'a' < 5 }}{{ 'b' not in 'cat' }}", {}, "3truetruefalsetrue"),
])
def test_template_language(source, values, expected):
    if expected is None:
        with pytest.raises(TemplateError):
            compile_template(source)
    else:
        assert render(source, **values)[0] == expected


def test_nothing_is_reachable_but_the_values():
    class Secret:
        key = "secret"

    assert render("{{ s.key }}{{ s.__class__ }}{{ t.__class__ }}{{ t.upper }}", s=Secret(), t="text")[0] == ""
    for source in ("{{ f() }}", "{{ a", "{% if a %}", "{% endfor %}", "{% import os %}", "{{ a | eval }}", "{% for x in %}{% endfor %}", "{{ a b }}"):
        with pytest.raises(TemplateError):
            compile_template(source)


def test_constants_are_folded():
    tree = fold(parse("a{{ 'b' ~ 1 }}{% if 1 == 2 %}x{% elif true %}c{% else %}y{% endif %}{% if none %}z{% endif %}{{ v }}"), {})
    assert [(n.kind, n.parts[0]) for n in tree.parts[0]][0] == ("text", "ab1c") and [n.kind for n in tree.parts[0]] == ["text", "write"]


def test_generation_blocks_are_code_point_stretches():
    text, marked = render("é{% generation %}{{ a }}{% endgeneration %}|{% generation %}{% endgeneration %}", a="日本")
    assert text == "é日本|" and marked == [(1, 3), (4, 4)]


# ---------------------------------------------------------------- chat
SAYINGS = ["", "hi", "</s>[INST] ok [/INST]", "<", "<\\/s>", "\\", "\\\\<s>", "<</SYS>>", "<<<s>>", "[[INST]", " [/INST", "<|role|>é\n", "x" * 5000]


@pytest.mark.parametrize("text", SAYINGS)
def test_guarded_texts_hold_no_control_string_and_come_back(text):
    guarded = chat.guard_for(chat.CONTROLS)(text)
    assert chat.unguard(guarded) == text and not any(c in guarded for c in chat.CONTROLS)


def test_conversations_are_read_back_whole(spark, table):
    roles = ["user", "assistant", "system", "tool<s>", "", None]
    rows = [(c, t, RNG.choice(roles), RNG.choice([*SAYINGS, None])) for c in range(40) for t in range(RNG.randint(1, 9))]
    rows += [(50, None, "user", "late"), (50, 2, "user", "b"), (50, 2, "user", "a"), (50, 2, "user", "a"), (None, 0, "user", "x"), (None, 0, "assistant", "y")]
    turns = table("conv_id long, turn long, role string, text string, formatted string, turns int", [(*r, "-", 0) for r in rows]).repartition(7)
    formatted = chat.format_conversations(turns)
    assert formatted.columns == ["conv_id", "formatted", "loss_from", "loss_to"]
    kept = {r["conv_id"]: r for r in formatted.collect()}
    digests = {r["conv_id"]: r for r in chat.digest(formatted).collect()}
    groups: dict = {}
    for c, t, role, text in rows:
        groups.setdefault(c, []).append((t is None, t or 0, role or "", text or ""))
    assert set(kept) == set(groups) == set(digests)
    for c, members in groups.items():
        said = [(role, text) for *_, role, text in sorted(members)]
        assert chat.read_turns(kept[c]["formatted"]) == said
        loss = "".join(text for role, text in said if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for role, text in said)
        assert tuple(digests[c])[1:] == (
            len(said), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(kept[c]["formatted"]))


def test_no_conversations_and_faulty_templates(table):
    none = table("conv_id long, turn long, role string, text string", [])
    assert chat.digest(chat.format_conversations(none)).count() == 0
    with pytest.raises(TemplateError):
        chat.format_conversations(none, "{{ a")
    with pytest.raises(ValueError):
        chat.guard_for(("x",))


# ---------------------------------------------------------------- quotient filters
@pytest.mark.parametrize("bits, rest_bits", [(1, 1), (5, 10), (20, 40), (21, 42), (31, 62), (32, 64), (40, 40)])
def test_filters_keep_every_entry_and_count(bits, rest_bits):
    rng = np.random.default_rng(3)
    first = rng.integers(0, 2**bits, 4000, dtype=np.uint64)
    rest = rng.integers(0, 2**rest_bits - 1, 4000, dtype=np.uint64, endpoint=True)
    first[:900], rest[:900] = first[0], rest[0]  # one very frequent entry, beyond a byte
    mixed = permute(first, rest, bits, rest_bits)
    again = restore(*mixed, bits, rest_bits)
    assert (again[0] == first).all() and (again[1] == rest).all()
    expected = Counter(zip(first.tolist(), rest.tolist()))
    parts = [CountingFilter.of(mixed[0][a:b], mixed[1][a:b], None, bits, rest_bits) for a, b in ((0, 1500), (1500, 1501), (1501, 1501), (1501, 4000))]
    merged = CountingFilter.merged([CountingFilter.unpack(p.pack()) for p in parts])
    lead = min(bits, 3)
    got: Counter = Counter()
    for bucket, part in merged.split(lead):
        back = CountingFilter.unpack(part.pack())
        quotient = back.quotient | np.uint64(bucket << (bits - lead))
        ids = restore(quotient, back.remainder, bits, rest_bits)
        got.update(dict(zip(zip(ids[0].tolist(), ids[1].tolist()), back.count.tolist())))
    assert got == expected


# ---------------------------------------------------------------- collocations
def mined(documents, longest, least, percent, top):
    totals: Counter = Counter()
    f: Counter = Counter()
    for lang, text in documents:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out: dict = {}
    for (lang, words), a in candidates.items():
        longer = [b for (other, w), b in candidates.items() if other == lang and len(w) > len(words)
                  and any(w[i : i + len(words)] == words for i in range(len(w) - len(words) + 1))]
        if any(100 * b >= percent * a for b in longer):
            continue
        score, _, left, right = min(
            (10**6 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words)))
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, r, phrase.decode(), -a, left, right, totals[lang], -score)
        for lang, rows in out.items() for r, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1))


@pytest.mark.parametrize("longest, least_bits, top", [(3, 1, 7), (4, 1, 2000), (3, 32, 2000)])
def test_collocations_equal_brute_force(spark, table, monkeypatch, longest, least_bits, top):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 400)
    monkeypatch.setattr(collocations, "SHARD_GRAMS", 300)
    documents = [(RNG.choice(["en", "fr", None]), prose(RNG.randint(1, 60), " \t,.\n\x0b ?")) for _ in range(80)]
    documents += [("en", None), (None, ""), ("fr", " .\n"), ("de", "New York. " * 12), ("de", "new york"), ("und", "the of the of " * 20), ("en", "a b \x1c " * 3)]
    documents += [documents[0]] * 12
    df = table("lang string, text string, words string, n int, id long", [(*d, "-", 1, 2) for d in documents]).repartition(4)
    got = sorted(tuple(r) for r in collocations.collocations(df, longest, 5, 50, top, least_bits).collect())
    assert got == mined(documents, longest, 5, 50, top)


def test_collocations_of_nothing(table):
    assert collocations.collocations(table("lang string, text string", [])).count() == 0
    assert collocations.collocations(table("lang string, text string", [("en", "once only"), (None, None)])).count() == 0
    with pytest.raises(ValueError):
        collocations.collocations(table("lang string, text string", [("en", "a b " * 30)]), longest=5, least_bits=20)
