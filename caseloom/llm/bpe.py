"""BPE encoding by last tokens of prefixes, and decoding.

Every prefix of a BPE encoding is the encoding of the text it covers, and two tokens may stand side by side
exactly when BPE over their joined text gives the two back.  So the encoding of a word is known from one number
per prefix, the *last token* of the prefix's encoding: the one vocabulary entry that ends there and may follow the
last token of the prefix before it.  New words of a batch are encoded side by side, letter by letter, each letter with
one step of arrays; few or very long words by a depth-first walk over their trie, which is their sorted order.

Texts are cut at white space, and each distinct chunk of a batch is looked up once.  Only the vocabulary file goes to the
workers (a broadcast of its fixed size).  Chunks met before are kept in a table of bounded size per worker; it changes
speed, never results.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from caseloom.llm.common import map_batches, texts_of

KEPT_WORDS = 400_000  # entries of a worker's table; when full it keeps its older half and what the texts at hand need
PART_BYTES = 3 << 20  # text that is encoded at once
LONGEST_LANE = 64  # letters of words that are encoded side by side
FEWEST_LANES = 256

_WHITE = re.compile("[\t-\r \x85\xa0  -     　]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")  # white space to str.split, not to Unicode
_BEYOND_LATIN = re.compile("[^\x00-ɏ]")
# The vocabulary's own word pattern (a fixed value of its file).
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[A-Za-z]+|[0-9]|[^\t-\r A-Za-z0-9]+")  # the same on ASCII
_CLOSING = frozenset(".,;:!?)]\"")  # marks that most often follow a word; alone they are a word of their own
_NEVER = 1 << 60
_FIT_BITS = 20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    for shift, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + shift)
    return [letters[b] for b in range(256)]


_LETTERS = _byte_letters()


class TrieEncoder:
    """Encoder and decoder for one word-level BPE vocabulary in the ``tokenizers`` JSON format."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        described = json.loads(vocabulary)
        model = described["model"]
        self._own = Tokenizer.from_str(vocabulary)  # only its normaliser and splitter, for scripts beyond Latin
        self._end = model["end_of_word_suffix"]
        ids: dict[str, int] = model["vocab"]
        self.names = [""] * (1 + max([*ids.values(), *(a["id"] for a in described["added_tokens"])]))
        for name, i in ids.items():
            self.names[i] = name
        self._special = {a["content"]: a["id"] for a in described["added_tokens"]}
        for name, i in self._special.items():
            self.names[i] = name
        self._special_pattern = re.compile("|".join(map(re.escape, sorted(self._special, key=len, reverse=True))) or r"(?!)")
        self._rank: dict[int, int] = {}
        self._parts: dict[int, tuple[int, int, int]] = {}
        self._right: dict[int, list[tuple[int, int]]] = {}
        self._left: dict[int, list[tuple[int, int]]] = {}
        self._fits: dict[int, bool] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            pair = ids[a] << 20 | ids[b]
            self._rank[pair] = rank
        for rank, (a, b) in enumerate(model["merges"]):
            # a token is usable if BPE over its own text ends in it; the first derivation that does is its own
            made = ids[a + b]
            if made not in self._parts and not self._broken(ids[a], ids[b], whole=True):
                self._parts[made] = (ids[a], ids[b], rank)
        made_by_merge = {ids[a + b] for a, b in model["merges"]}
        usable = {n: i for n, i in ids.items() if i in self._parts or i not in made_by_merge}
        self._inner = {n: i for n, i in usable.items() if not n.endswith(self._end)}
        self._final = {n[: -len(self._end)]: i for n, i in usable.items() if n.endswith(self._end)}
        self._inner_sizes, self._final_sizes = self._sizes(self._inner), self._sizes(self._final)
        self._inner_ends: dict[str, tuple] = {}
        self._final_ends: dict[str, tuple] = {}
        self._chunks: dict[str, bytes] = {}  # a word in ASCII letters is a chunk too
        self._foreign: dict[str, bytes] = {}  # words in other byte letters, which a chunk may spell with another meaning

    # ------------------------------------------------------------ which tokens may stand side by side
    @staticmethod
    def _sizes(entries: dict[str, int]) -> dict[str, tuple[int, ...]]:
        """Lengths above four of the entries with given last four letters, longest first."""
        found: dict[str, set[int]] = {}
        for name in entries:
            if len(name) > 4:
                found.setdefault(name[-4:], set()).add(len(name))
        return {ending: tuple(sorted(sizes, reverse=True)) for ending, sizes in found.items()}

    @staticmethod
    def _candidates(ending: str, entries: dict[str, int], sizes: dict[str, tuple[int, ...]]) -> tuple[tuple[int, int], ...]:
        """(length, token) of the entries a text with these last letters can end in, longest first; -1: look it up."""
        long = [(k, -1) for k in sizes.get(ending, ())]
        return (*long, *((k, entries[ending[-k:]]) for k in range(len(ending), 0, -1) if ending[-k:] in entries))

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens on one edge of a token's derivation, smallest first, each with the rank of the merge that uses it up."""
        known = self._right if side else self._left
        if token not in known:
            chain, used = [], _NEVER
            t = token
            while True:
                chain.append((t, used))
                if t not in self._parts:
                    break
                used = self._parts[t][2]
                t = self._parts[t][side]
            known[token] = chain[::-1]
        return known[token]

    def _broken(self, a: int, b: int, whole: bool = False) -> bool:
        """Would BPE merge across the border of ``a`` and ``b`` before both are complete (or at all)?

        Plays the two edges forward in merge order.  Equal ranks go to the leftmost pair.  ``whole``: the merge of
        the complete tokens themselves is wanted."""
        left, right = self._edge(a, 1), self._edge(b, 0)
        i = j = 0
        rank = self._rank.get
        while True:
            (x, x_used), (y, y_used) = left[i], right[j]
            r = rank(x << 20 | y)
            last = x_used == _NEVER and y_used == _NEVER
            if r is not None and r < x_used and r <= y_used:
                return not (whole and last)
            if last:
                return False
            if x_used <= y_used:
                i += 1
            else:
                j += 1

    # ------------------------------------------------------------ the trie
    def _encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Encode distinct words in sorted order, which walks their trie depth first: ``last`` and ``size`` hold the
        last-token states of the word before, and those of the prefix shared with it still stand."""
        words = sorted(words)
        deepest = max(map(len, words), default=0)
        last, size = [0] * (deepest + 1), [0] * (deepest + 1)
        inner, final, fits = self._inner, self._final, self._fits
        inner_ends, final_ends = self._inner_ends, self._final_ends
        made, pack = {}, struct.pack
        before, known = "", 0  # the states of the first ``known`` letters of ``before`` are worked out
        for word in words:
            token = final.get(word, -1)
            if token >= 0:  # a word of the vocabulary is one token
                made[word] = pack("<I", token)
                continue
            length = len(word)
            depth = 0
            for letter, other in zip(word, before):
                if letter != other or depth == known:
                    break
                depth += 1
            while depth < length - 1:
                depth += 1
                ending = word[max(depth - 4, 0) : depth]
                choice = inner_ends.get(ending)
                if choice is None:
                    choice = inner_ends[ending] = self._candidates(ending, inner, self._inner_sizes)
                for k, token in choice:
                    if k < depth:
                        if token < 0 and (token := inner.get(word[depth - k : depth], -1)) < 0:
                            continue
                        pair = last[depth - k] << 20 | token
                        ok = fits.get(pair)
                        if ok is None:
                            ok = fits[pair] = not self._broken(last[depth - k], token)
                        if ok:
                            break
                    elif k == depth and (token >= 0 or (token := inner.get(word[:depth], -1)) >= 0):
                        break
                else:
                    raise ValueError(f"no encoding ends at {word[:depth]!r}")
                last[depth], size[depth] = token, k
            before, known = word, length - 1
            ending = word[-4:]
            choice = final_ends.get(ending)
            if choice is None:
                choice = final_ends[ending] = self._candidates(ending, final, self._final_sizes)
            for k, token in choice:
                if k < length:
                    if token < 0 and (token := final.get(word[length - k :], -1)) < 0:
                        continue
                    pair = last[length - k] << 20 | token
                    ok = fits.get(pair)
                    if ok is None:
                        ok = fits[pair] = not self._broken(last[length - k], token)
                    if ok:
                        break
            else:
                raise ValueError(f"no encoding ends at {word!r}")
            ids, at = [token], length - k
            while at:
                ids.append(last[at])
                at -= size[at]
            ids.reverse()
            made[word] = pack(f"<{len(ids)}I", *ids)
        return made

    # ------------------------------------------------------------ many words side by side
    def _suffix_states(self) -> None:
        """Tables for the longest vocabulary entry that ends a prefix: an Aho-Corasick automaton over all beginnings of entries.

        ``_goto``: state by row of a state and column of the next letter.  Letters that only stand alone have no column, just a state.  ``_ends``:
        a state's longest entry inside a word and at its end; ``_shorter``: the next entry that ends the same texts."""
        entries = (self._inner, self._final)
        column = {c: k for k, c in enumerate(sorted({c for names in entries for n in names if len(n) > 1 for c in n}))}
        names = ["", *sorted({n[:k] for e in entries for n in e for k in range(1, len(n) + 1)}, key=len)]
        state = {n: k for k, n in enumerate(names)}
        codes = 1 + max(map(ord, _LETTERS))
        self._column, self._alone = np.full(codes, -1, np.int32), np.zeros(codes, np.int32)
        for letter in _LETTERS:
            self._column[ord(letter)], self._alone[ord(letter)] = column.get(letter, -1), state.get(letter, 0)
        # a state from which no entry goes on goes where the next shorter one goes, and needs no row
        goes_on = np.zeros(len(names), bool)
        goes_on[[state[n[:-1]] for n in names[1:]]] = True
        self._row = np.where(goes_on, np.cumsum(goes_on) - 1, 0).astype(np.int32)
        self._goto = np.zeros((int(goes_on.sum()), len(column)), np.int32)
        fall = np.zeros(len(names), np.int32)
        sizes = np.array([len(n) for n in names])
        for depth in range(1, int(sizes[-1]) + 1):
            level = np.arange(*np.searchsorted(sizes, (depth, depth + 1)))
            above = np.array([state[names[v][:-1]] for v in level])
            by = np.array([column.get(names[v][-1], -1) for v in level])
            level_with, above, by = level[by >= 0], above[by >= 0], by[by >= 0]
            if depth > 1:
                fall[level_with] = self._goto[self._row[fall[above]], by]
            self._goto[self._row[above], by] = level_with
            on = level[goes_on[level]]
            self._goto[self._row[on]] = self._goto[self._row[fall[on]]]
            ended = level[~goes_on[level]]
            self._row[ended] = self._row[fall[ended]]
        self._ends, self._shorter = [], []
        self._token_size = np.zeros(len(self.names), np.int32)
        for e in entries:
            ends = [-1] * len(names)
            for v, (n, f) in enumerate(zip(names, fall.tolist())):
                ends[v] = e[n] if n in e else ends[f] if v else -1
            shorter = np.full(len(self.names), -1, np.int32)
            for n, i in e.items():
                shorter[i], self._token_size[i] = ends[fall[state[n]]], len(n)
            self._ends.append(np.array(ends, np.int32))
            self._shorter.append(shorter)
        self._fit_slots = np.full(1 << _FIT_BITS, -1, np.int64)  # pair and verdict of the pairs met last

    def _fitting(self, pairs: np.ndarray) -> np.ndarray:
        """May the two tokens of each pair stand side by side?"""
        slots = ((pairs.view(np.uint64) * _SPREAD) >> np.uint64(64 - _FIT_BITS)).view(np.int64)
        held = self._fit_slots[slots]
        missing = np.flatnonzero(held >> 1 != pairs)
        if missing.size:
            new, back = np.unique(pairs[missing], return_inverse=True)
            fits, verdicts = self._fits, []
            for pair in new.tolist():
                ok = fits.get(pair)
                if ok is None:
                    ok = fits[pair] = not self._broken(pair >> 20, pair & 0xFFFFF)
                verdicts.append(ok)
            held[missing] = (new << 1 | np.array(verdicts, np.int64))[back]
            self._fit_slots[slots[missing]] = held[missing]
        return (held & 1).astype(bool)

    def _last_tokens(self, last: np.ndarray, lanes: np.ndarray, depth: int, states: np.ndarray, at_end: bool) -> np.ndarray:
        """Last token of the encoding of the first ``depth`` letters of each lane's word: the longest that may follow."""
        token = self._ends[at_end][states]
        open_lanes = np.arange(len(lanes))
        while True:
            tried = token[open_lanes]
            if (tried < 0).any():
                raise ValueError("no encoding ends at a letter")
            before = depth - self._token_size[tried]
            ok = before == 0
            rest = np.flatnonzero(~ok)
            ok[rest] = self._fitting(last[before[rest], lanes[open_lanes[rest]]].astype(np.int64) << 20 | tried[rest])
            open_lanes = open_lanes[~ok]
            if not open_lanes.size:
                return token
            token[open_lanes] = self._shorter[at_end][token[open_lanes]]

    def _encode_side_by_side(self, words: list[str]) -> dict[str, bytes]:
        """:meth:`_encode_words` for many short words: all of them take the step from letter to letter together."""
        if not hasattr(self, "_goto"):
            self._suffix_states()
        words = sorted(words, key=len, reverse=True)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        letters = np.frombuffer("".join(words).encode("utf-16-le"), "<u2")
        begin = np.cumsum(sizes) - sizes
        last = np.zeros((sizes[0], len(words)), np.int32)  # row d: last tokens of the first d letters
        close, states = np.empty(len(words), np.int32), np.zeros(len(words), np.int32)
        for depth in range(1, int(sizes[0]) + 1):
            inside, upto = np.searchsorted(-sizes, (-depth, 1 - depth)).tolist()  # longer words come first, then those that end here
            letter = letters[begin[:upto] + depth - 1]
            column = self._column[letter]
            states = np.where(column < 0, self._alone[letter], self._goto[self._row[states[:upto]], column])
            if inside:
                last[depth, :inside] = self._last_tokens(last, np.arange(inside), depth, states[:inside], False)
            if inside < upto:
                close[inside:upto] = self._last_tokens(last, np.arange(inside, upto), depth, states[inside:], True)
        lanes, token, rounds = np.arange(len(words)), close, []
        at = sizes - self._token_size[close]
        count = np.zeros(len(words), np.int64)
        while True:
            rounds.append((lanes, token))
            count[lanes] += 1
            more = at > 0
            if not more.any():
                break
            lanes, at = lanes[more], at[more]
            token = last[at, lanes]
            at = at - self._token_size[token]
        end = np.cumsum(count)
        ids = np.empty(int(end[-1]), "<u4")
        for k, (lanes, token) in enumerate(rounds):  # from the last token to the first
            ids[end[lanes] - 1 - k] = token
        raw, end = ids.tobytes(), (4 * end).tolist()
        return dict(zip(words, [raw[a:b] for a, b in zip([0, *end], end)]))

    def _encode_new(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids of new distinct words: short ones side by side, few or long ones one by one."""
        final, made, short, others = self._final, {}, [], []
        for word in words:
            token = final.get(word, -1)
            if token >= 0:  # a word of the vocabulary is one token
                made[word] = struct.pack("<I", token)
            else:
                (short if len(word) <= LONGEST_LANE else others).append(word)
        if len(short) >= FEWEST_LANES:
            made |= self._encode_side_by_side(short)
        else:
            others += short
        return made | self._encode_words(others)

    # ------------------------------------------------------------ texts to words
    def _split(self, chunk: str) -> list[str]:
        """Words of a normalised text without white space, in byte letters."""
        if chunk.isascii():
            words = _ASCII_WORDS.findall(chunk)
            return words if chunk.isprintable() else [w if w.isprintable() else "".join([_LETTERS[b] for b in w.encode()]) for w in words]
        if _BEYOND_LATIN.search(chunk):
            return [piece for piece, _ in self._own.pre_tokenizer.pre_tokenize_str(chunk)]
        words = [chunk] if chunk.isalpha() else _WORDS.findall(chunk)
        return [w if w.isascii() and w.isprintable() else "".join([_LETTERS[b] for b in w.encode()]) for w in words]

    def _normalised(self, text: str) -> str:
        """A text without special tokens, normalised, with ASCII white space (and no other) between its chunks."""
        if text.isascii():
            text = text.lower()
            return text if not _SEPARATORS.search(text) else " ".join([c for c in _WHITE.split(text) if c])
        if _BEYOND_LATIN.search(text):
            text = self._own.normalizer.normalize_str(text)
        else:
            text = text.lower()  # Latin letters are composed already, and lower-case one by one
        return " ".join([c for c in _WHITE.split(text) if c] if _SEPARATORS.search(text) else text.split())

    def _marked(self, text: str) -> str:
        """A normalised text, in which ``A`` and its id stand for each special token: other chunks have no upper-case letters."""
        if "<" not in text or not self._special_pattern.search(text):
            return self._normalised(text)
        found, at = [], 0
        for m in self._special_pattern.finditer(text):
            found += [self._normalised(text[at : m.start()]), f"A{self._special[m.group()]}"]
            at = m.end()
        return " ".join([*found, self._normalised(text[at:])])

    def _learn(self, chunks: list[str]) -> None:
        """Put the ids of new distinct chunks into the table, and those of their words."""
        table, foreign = self._chunks, self._foreign
        alone, closed, others = [], [], {}
        for c in chunks:
            if c.isascii():
                if c.isalpha():
                    alone.append(c)
                    continue
                if c[-1:] in _CLOSING and c[:-1].isalpha():
                    closed.append(c)
                    continue
            others[c] = self._split(c) if c[:1] != "A" else []
        wanted = set(alone)
        wanted.update([w for w in [c[:-1] for c in closed] if w not in table], [w for w in _CLOSING if w not in table])
        wanted.update([w for words in others.values() for w in words if w not in (table if w.isascii() else foreign)])
        made = self._encode_new(wanted)
        for word in [w for w in made if not w.isascii()]:
            foreign[word] = made.pop(word)
        table.update(made)
        for c in closed:
            table[c] = table[c[:-1]] + table[c[-1]]
        for c, words in others.items():
            if c[:1] == "A":
                table[c] = struct.pack("<I", int(c[1:]))
            else:
                table[c] = b"".join([table[w] if w.isascii() else foreign[w] for w in words])

    def _ids_of(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks.  A full table keeps its older half and what these chunks need."""
        found = list(map(self._chunks.get, chunks))
        if len(self._chunks) > KEPT_WORDS:
            # the chunks met first are mostly the frequent ones
            self._chunks = dict(islice(self._chunks.items(), KEPT_WORDS // 2))
            self._chunks.update((c, ids) for c, ids in zip(chunks, found) if ids is not None)
        if len(self._foreign) > KEPT_WORDS // 2:
            self._foreign.clear()
        if len(self._fits) > 4 * KEPT_WORDS:
            self._fits.clear()
            self._inner_ends.clear()
            self._final_ends.clear()
        missing = [k for k, ids in enumerate(found) if ids is None]
        if missing:
            self._learn([chunks[k] for k in missing])
            for k in missing:
                found[k] = self._chunks[chunks[k]]
        return found

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text, as the vocabulary's own library gives without added special tokens.

        Each distinct chunk of all texts is looked up once; the ids of the others are copies."""
        if not texts:
            return []
        chunks = pc.ascii_split_whitespace(pa.array([self._marked(t) for t in texts], pa.large_string()))
        coded = chunks.flatten().dictionary_encode()
        each = self._ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = np.frombuffer(b"".join(each), "<u4")
        size = np.fromiter(map(len, each), np.int64, len(each)) // 4
        begin = np.cumsum(size) - size
        chunk = coded.indices.to_numpy()
        size = size[chunk]
        end = np.cumsum(size)
        place = np.repeat(begin[chunk] - (end - size), size)
        place += np.arange(len(place))
        borders = np.concatenate(([0], end))[chunks.offsets.to_numpy()]
        return np.split(ids[place], borders[1:-1])

    def decode(self, ids: np.ndarray) -> str:
        """Names of the tokens, special ones included, joined by one space: the file names no decoder."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))


_encoders: dict[str, TrieEncoder] = {}


def encoder(vocabulary: str) -> TrieEncoder:
    """The worker's encoder for a vocabulary; tables are built once per process."""
    key = hashlib.sha256(vocabulary.encode()).hexdigest()
    if key not in _encoders:
        _encoders[key] = TrieEncoder(vocabulary)
    return _encoders[key]


def encode_documents(documents: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode and decode each text: (id, ids array<int>, decoded string).

    NULL and empty texts have no ids and an empty decoding.  Rows are independent, so repeated rows, NULL ids, empty
    tables and further columns (left out) change nothing.
    """
    vocabulary = documents.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(vocabulary.value)
        for batch in batches:
            for part in by_size(batch, 1, PART_BYTES):
                ids = tool.encode(texts_of(part.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())), pa.array([tool.decode(i) for i in ids], pa.string())],
                    names=["id", "ids", "decoded"],
                )

    kind = documents.schema[id_column].dataType.simpleString()
    rows = documents.select(documents[id_column].alias("id"), documents[text_column].alias("text"))
    return map_batches(rows, run, f"id {kind}, ids array<int>, decoded string")


def by_size(batch: pa.RecordBatch, column: int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``most`` bytes of text: what a task holds follows bytes, not rows."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + most, side="right")))
        yield batch.slice(start, end - start)
        start = end


def digest_documents(documents: DataFrame, vocabulary_path: str) -> DataFrame:
    """Contract form of :func:`encode_documents`: counts and SHA-256 digests instead of ids and texts.

    Same encoder and decoder; the digests are taken in the task that has the ids, so that ids need not be moved.
    """
    vocabulary = documents.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(vocabulary.value)
        numbers = [str(i) for i in range(len(tool.names))]
        for batch in batches:
            for part in by_size(batch, 1, PART_BYTES):
                ids = tool.encode(texts_of(part.column(1)))
                spelt = [" ".join(map(numbers.__getitem__, i.tolist())) for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(i) for i in ids], pa.int64()),
                        pa.array([hashlib.sha256(s.encode()).hexdigest() for s in spelt], pa.string()),
                        pa.array([hashlib.sha256(tool.decode(i).encode()).hexdigest() for i in ids], pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return map_batches(
        documents.select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()
