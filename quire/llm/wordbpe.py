"""Operator 2, BPE encoding and decoding with a segment tree over adjacent pair ranks.

Each pre-token's pairs are leaves of a segment tree whose nodes hold the least (rank, position); the root is the
leftmost pair of lowest rank.  A merge changes three leaves, so each costs a logarithm, and a text without
white space of any length is encoded in O(n log n).  Short pre-tokens that aren't cached are merged together: row by row of
one numpy matrix lies a tree each, and every step takes all roots and updates all trees (merge_rows).

Null text is empty and has no tokens; empty texts, repeated rows and empty tables give the rows one expects; very
long texts need memory in proportion to their own length only.  Columns besides the id and the text are not read.
"""

from __future__ import annotations

import gc
import hashlib
import json
import string
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from quire.llm.common import map_batches, table, texts

# The pre-tokenisation rule of the public vocabulary file, white space being Unicode's.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^" + SPACE + r"\p{L}\p{N}]+"
# What a tokenizers file must say for WordBPE to be its equal.
EXPECTED_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
EXPECTED_PIECES = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
EXPECTED_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}
NONE = 1 << 62
#: Leaves of the largest trees that are merged together, and characters of text whose new words meet in one step.
LEAVES, CHUNK = 64, 2_000_000
PUNCTUATION = frozenset(string.punctuation)


#: Keys of more characters are not kept, so that what is kept has a bound in bytes too.
LONGEST = 256


class Twofold(dict):
    """A map filled by fill(key) that forgets: of two generations the older goes when the newer is full.  Long keys are not kept."""

    def __init__(self, fill, size: int):
        super().__init__()
        self.fill, self.size, self.old = fill, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.fill(key)
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(key) > LONGEST:
            return
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value


def merge(symbols: list[int], pairs: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """BPE over symbol ids; pairs maps two ids to (rank, merged id).

    tree[1] is the least of all leaves, a leaf being rank * 2^32 + position, or NONE.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    get, size = pairs.get, 1
    while size < n - 1:
        size *= 2
    tree = [NONE] * (2 * size)
    for i in range(n - 1):
        if p := get((symbols[i], symbols[i + 1])):
            tree[size + i] = p[0] << 32 | i
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    if tree[1] == NONE:
        return symbols
    syms, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))

    def put(i: int, value: int) -> None:
        k = size + i
        tree[k] = value
        while k > 1:
            k >>= 1
            a, b = tree[2 * k], tree[2 * k + 1]
            least = a if a < b else b
            if tree[k] == least:
                return
            tree[k] = least

    while (root := tree[1]) != NONE:
        i = root & 0xFFFFFFFF
        j = after[i]
        syms[i] = pairs[syms[i], syms[j]][1]
        syms[j] = -1
        k = after[i] = after[j]
        if j < n - 1:
            put(j, NONE)
        if k < n:
            before[k] = i
            p = get((syms[i], syms[k]))
            put(i, p[0] << 32 | i if p else NONE)
        else:
            put(i, NONE)
        if (h := before[i]) >= 0:
            p = get((syms[h], syms[i]))
            put(h, p[0] << 32 | h if p else NONE)
    return [s for s in syms if s >= 0]


class PairTable:
    """Merges as sorted arrays, to look many pairs up at once."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]], vocab: int):
        self.vocab = vocab
        rows = sorted((a * vocab + b, rank) for (a, b), (rank, _) in pairs.items())
        self.keys = np.array([k for k, _ in rows] or [-1], np.int64)
        self.ranks = np.array([r for _, r in rows] or [0], np.int64)
        self.merged = np.zeros(int(self.ranks.max()) + 1, np.int64)
        for rank, out in pairs.values():
            self.merged[rank] = out

    def leaves(self, a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
        """rank * 2^32 + position of each pair (a, b) at a position; NONE where it doesn't merge or a symbol is negative."""
        key = a * self.vocab + b
        k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[k] == key) & (a >= 0) & (b >= 0), self.ranks[k] << 32 | at, NONE)


def merge_rows(symbols: np.ndarray, size: int, table: PairTable) -> np.ndarray:
    """merge() of many short words: rows of symbols, at least two columns more than `size` leaves, filled up with -1.

    Returns the rows after all merges, with -1 where a symbol went into another.
    """
    n, width = symbols.shape
    syms = symbols.copy()
    places = np.arange(width)
    after, before = np.tile(places + 1, (n, 1)), np.tile(places - 1, (n, 1))
    tree = np.full((n, 2 * size), NONE, np.int64)
    tree[:, size:] = table.leaves(syms[:, :size], syms[:, 1 : size + 1], places[:size])
    for k in range(size - 1, 0, -1):
        np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1], out=tree[:, k])
    row = np.flatnonzero(tree[:, 1] != NONE)
    while len(row):
        root = tree[row, 1]
        i = root & 0xFFFFFFFF
        j = after[row, i]
        k = after[row, j]
        h = before[row, i]
        own = table.merged[root >> 32]
        syms[row, i], syms[row, j] = own, -1
        after[row, i], before[row, k] = k, i
        inner, led = j < size, h >= 0
        tree[row[inner], size + j[inner]] = NONE
        tree[row, size + i] = table.leaves(own, syms[row, k], i)
        front = h[led]
        tree[row[led], size + front] = table.leaves(syms[row[led], front], own[led], front)
        node = size + np.stack([i, np.where(inner, j, i), np.where(led, h, i)])
        for _ in range(size.bit_length() - 1):
            node >>= 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
        row = row[tree[row, 1] != NONE]
    return syms


@lru_cache(1)
def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordBPE:
    """Lower-casing BPE with word ends, as in a tokenizers JSON file; exact for NFC, \\s+ and Lowercase normalizers.

    units: white-space separated pieces keep their result, up to twice `cache` of them.
    """

    def __init__(self, path: str, cache: int = 200_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if (spec["normalizer"], spec["pre_tokenizer"], spec.get("decoder"), *(model[k] for k in EXPECTED_MODEL)) != (EXPECTED_NORMALIZER, EXPECTED_PIECES, None, *EXPECTED_MODEL.values()):
            raise ValueError(f"{path}: only lower-casing BPE with these normalizers and pre-tokenizers, without a decoder, is implemented")
        self.vocab, self.end = model["vocab"], model["end_of_word_suffix"] or ""
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.added.items()}
        self.joined = {i: str(i) for i in self.names}
        self.named = {str(i): t for i, t in self.names.items()}
        self.pairs = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.pairs[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        self.table = PairTable(self.pairs, max(self.vocab.values(), default=0) + 1)
        letters = byte_letters()
        self.first = [self.vocab.get(letters[b]) for b in range(256)]
        self.last = [self.vocab.get(letters[b] + self.end) for b in range(256)]
        self.whole_alphabet = None not in self.first and None not in self.last
        self.first_of, self.last_of = (np.array([x or 0 for x in v], np.int64) for v in (self.first, self.last))
        self.split_words = regex.compile(WORDS).findall
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")").split if self.added else lambda s: [s]
        #: No special string hides in letters with one mark behind them.
        self.plain = all(sum(not c.isalpha() for c in a) > 1 for a in self.added)
        self.words = Twofold(self.word, cache)
        self.units = Twofold(self.unit, cache)

    def shown(self, ids: list[int]) -> str:
        """Decimal ids, joined by a space."""
        return " ".join(map(self.joined.__getitem__, ids))

    def word(self, w: str) -> str:
        b = w.encode()
        return self.shown(merge([x for x in [*(self.first[c] for c in b[:-1]), self.last[b[-1]]] if x is not None], self.pairs))

    def fill_words(self, new: set[str]) -> None:
        """Put words into the cache, short ones by merge_rows(), grouped by the size of their trees."""
        if not self.whole_alphabet:
            return
        groups: dict[int, list[tuple[str, bytes]]] = {}
        for w in new:
            b = w.encode()
            if len(b) <= LEAVES + 1:
                groups.setdefault(1 << max(0, len(b) - 2).bit_length(), []).append((w, b))
        for size, members in groups.items():
            for at in range(0, len(members), 1 << 14):
                part = members[at : at + (1 << 14)]
                lengths = np.fromiter((len(b) for _, b in part), np.int64, len(part))
                flat = np.frombuffer(b"".join([b for _, b in part]), np.uint8)
                ends = np.cumsum(lengths) - 1
                ids = self.first_of[flat]
                ids[ends] = self.last_of[flat[ends]]
                rows = np.full((len(part), size + 2), -1, np.int64)
                rows[np.arange(size + 2) < lengths[:, None]] = ids
                done = merge_rows(rows, size, self.table)
                left = done >= 0
                out, stops = done[left].tolist(), np.cumsum(left.sum(1)).tolist()
                start = 0
                for (w, _), stop in zip(part, stops, strict=True):
                    self.words.put(w, self.shown(out[start:stop]))
                    start = stop

    def pieces(self, text: str) -> list[str]:
        """Python's white space is Unicode's and four separators besides; texts with those are only cut at spaces."""
        return text.split(" ") if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()

    def normalize(self, s: str) -> str:
        if not s.isascii():
            s = unicodedata.normalize("NFC", s).replace("Σ", "σ")  # letter by letter: no final sigma
        return s.lower()

    def parts(self, u: str) -> list[str | int]:
        """Words, and ids of special strings, in a piece without spaces."""
        if self.plain and (u.isascii() or max(u) < "\u0100"):  # composed already, and every lower-case form a letter
            if u.isalpha():
                return [u.lower()]
            if u[:-1].isalpha() and u[-1] in PUNCTUATION:
                return [u[:-1].lower(), u[-1]]
        out: list[str | int] = []
        for k, part in enumerate(self.split_added(u)):
            if k % 2:
                out.append(self.added[part])
            elif part:
                out += self.split_words(self.normalize(part))
        return out

    def value(self, parts: list[str | int]) -> str:
        words = self.words
        if len(parts) == 1 and isinstance(parts[0], str):
            return words[parts[0]]
        return " ".join([v for p in parts if (v := words[p] if isinstance(p, str) else self.shown([p]))])

    def unit(self, u: str) -> str:
        """Ids of a piece without spaces, joined by a space."""
        return self.value(self.parts(u))

    def encode_all(self, texts: list[str]) -> Iterator[tuple[str, int]]:
        """Decimal ids of each text, joined by a space, and how many there are.

        White space separates words and is dropped, so pieces between spaces are independent.  Texts are taken in groups of
        about CHUNK characters, whose new words are merged together.
        """
        at = 0
        while at < len(texts):
            pieces, chars = [], 0
            while at < len(texts) and (not pieces or chars + len(texts[at]) <= CHUNK):
                chars += len(texts[at])
                pieces.append(self.pieces(texts[at]))
                at += 1
            units, words = self.units, self.words
            new = {u: self.parts(u) for u in set().union(*pieces).difference(units, units.old)}
            self.fill_words({p for parts in new.values() for p in parts if isinstance(p, str)}.difference(words, words.old))
            long = {}
            for u, parts in new.items():
                value = self.value(parts)
                if len(u) > LONGEST:
                    long[u] = value
                else:
                    units.put(u, value)
            for piece in pieces:
                ids = " ".join([v for u in piece if (v := units[u])]) if not long else " ".join([v for u in piece if (v := long[u] if u in long else units[u])])
                yield ids, ids.count(" ") + 1 if ids else 0

    def encode(self, text: str) -> list[int]:
        return [int(x) for x in next(self.encode_all([text]))[0].split()]

    def decode_joined(self, ids: str) -> str:
        """decode() of decimal ids joined by a space."""
        return " ".join(map(self.named.__getitem__, ids.split(" "))) if ids else ""

    def decode(self, ids: list[int]) -> str:
        """As a file without a decoder is decoded: tokens joined by a space; unknown ids are left out."""
        return " ".join(self.names[i] for i in ids if i in self.names)


@lru_cache(2)
def loaded(path: str) -> WordBPE:
    out = WordBPE(path)
    gc.freeze()  # nothing here forms cycles, and each full collection walks through all that is cached
    gc.set_threshold(100_000, 50, 1000)
    return out


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, ids array<int>) for each document.  path is resolved on the workers when None."""

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        flat, ends = [np.empty(0, np.int32)], [0]
        for ids, count in loaded(path or default_path()).encode_all(texts(b.column(1))):
            flat.append(np.fromstring(ids, np.int32, sep=" "))
            ends.append(ends[-1] + count)
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat), pa.int32()))
        return pa.RecordBatch.from_arrays([b.column(0), lists], [key, "ids"])

    return map_batches(docs.select(key, text), fn, f"`{key}` {dict(docs.dtypes)[key]}, ids array<int>")


def decode(frame: DataFrame, key: str = "doc_id", ids: str = "ids", path: str | None = None) -> DataFrame:
    """(key, text) from (key, ids); null ids give an empty text."""

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        t = loaded(path or default_path())
        return pa.RecordBatch.from_arrays([b.column(0), pa.array([t.decode(x or []) for x in b.column(1).to_pylist()], pa.string())], [key, "text"])

    return map_batches(frame.select(key, ids), fn, f"`{key}` {dict(frame.dtypes)[key]}, text string")


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """The ids of each text, and the text decoded from those ids, returned as a count and digests."""

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        t = loaded(path or default_path())
        n, ids, plain = [], [], []
        for joined, count in t.encode_all(texts(b.column(1))):
            n.append(count)
            ids.append(hashlib.sha256(joined.encode()).hexdigest())
            plain.append(hashlib.sha256(t.decode_joined(joined).encode()).hexdigest())
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(plain, pa.string())], [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(docs.select(key, text), fn, f"`{key}` {dict(docs.dtypes)[key]}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
