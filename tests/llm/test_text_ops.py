"""Operators 2, 3 and 6 against the library or brute force."""

import hashlib
import json
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quire.llm import decontam, quality, wordbpe

ODD = [
    "",
    " ",
    "\n\t",
    "Hello, WORLD's isn't we'll 123 4½",
    "ΑΣ Σ ΟΔΥΣΣΕΥΣ İstanbul é é  x　y z\x1cq\x85r",
    "<|endoftext|>a<|startoftext|> b <|endoftext|>",
    "á́ ́b ﬁ ① 漢字かな 😀😀 �",
    "x" * 5000,
    "ab" * 3000 + "!" * 999,
    "straße ÄÖÜ ſ K Å",
    "Ｆｕｌｌ 12345 '' 's'S 'LL",
]


@pytest.fixture(scope="module")
def documents(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "z") for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows + [(50, None, "q"), (51, "tie tie", "q"), (51, "tie tie", "q"), (None, "no id", "q")], "doc_id long, text string, n_words string")


TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def library(text):
    t = TOKENIZER
    ids = t.encode(text or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_as_library(spark, sf, documents, odd):
    assert {r[0]: tuple(r)[1:] for r in wordbpe.query(spark, sf).collect()} == {i: library(t) for i, t in documents}
    got = sorted((tuple(r) for r in wordbpe.digests(odd).collect()), key=str)
    assert got == sorted(((r.doc_id, *library(r.text)) for r in odd.collect()), key=str)


def test_bpe_round(spark, odd):
    ids = wordbpe.encode(odd.where("doc_id < 40"))
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    plain = {r.doc_id: r.text for r in wordbpe.decode(ids).collect()}
    assert plain == {i: t.decode(t.encode(x, add_special_tokens=False).ids, skip_special_tokens=False) for i, x in enumerate(ODD)}


def test_merge_against_scan():
    rnd = random.Random(1)
    for _ in range(300):
        pairs, names = {}, {}
        for rank in range(12):
            a, b = rnd.randrange(6 + rank), rnd.randrange(6 + rank)
            pairs.setdefault((a, b), (rank, 6 + rank))
        s = [rnd.randrange(6) for _ in range(rnd.randrange(1, 60))]
        want = list(s)
        while True:
            best = min(((pairs[p][0], i) for i, p in enumerate(zip(want, want[1:])) if p in pairs), default=None)
            if best is None:
                break
            i = best[1]
            want[i : i + 2] = [pairs[want[i], want[i + 1]][1]]
        assert wordbpe.merge(s, pairs) == want, names
        size = 64
        rows = np.full((2, size + 2), -1, np.int64)
        rows[:, : len(s)] = s
        rows[1, 1:] = -1
        both = wordbpe.merge_rows(rows, size, wordbpe.PairTable(pairs, 32))
        assert both[0][both[0] >= 0].tolist() == want and both[1][both[1] >= 0].tolist() == s[:1]


def test_cache_turns_over():
    """Results stay right while words and pieces are forgotten, and across groups of texts."""
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    many = [x + f" w{i} {i}ab, Été{i % 7}." for i, x in enumerate(ODD * 20)]
    got = [[int(i) for i in ids.split()] for ids, _ in wordbpe.WordBPE(path, cache=5).encode_all(many)]
    assert got == [t.encode(x, add_special_tokens=False).ids for x in many]


def counts(text):
    b = (text or "").encode()
    w = b.split()
    win = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    c = Counter(win)
    mark = {j for i, x in enumerate(win) if c[x] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in b.split(b"\n") if x.split()]
    n = len(w)
    return n, sum(len(x.decode()) for x in w), sum(b.count(x) for x in b"#*$%&|<>"), sum(lines[i] in lines[:i] for i in range(len(lines))), len(mark), n < 50 or 100 * len(mark) > 50 * n


def test_quality(spark, sf, documents, odd):
    got = {r.doc_id: tuple(r)[1:7] for r in quality.query(spark, sf).collect()}
    assert got == {i: counts(t) for i, t in documents}
    assert quality.judge(odd).count() == odd.count() and quality.kept(odd).columns == odd.columns
    assert quality.judge(odd.limit(0)).collect() == []
    rnd = random.Random(2)
    plain = " ".join("".join(rnd.choice("abcdefghiklmnoprstuvw") for _ in range(rnd.randrange(2, 9))) for _ in range(400))
    junk = rnd.randbytes(3000).hex()
    cases = {1: plain, 2: "word " * 900, 3: junk, 4: plain[:1000] + " " + " ".join(f"spam{i % 2} ham eggs" for i in range(1500))}
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(list(cases.items()), "doc_id long, text string")).collect()}
    assert [got[i].kept for i in cases] == [True, False, False, False]


def test_bands_reject_incompressible():
    bands = quality.Bands()
    rnd = random.Random(3)
    words = " ".join(rnd.randbytes(12).hex() for _ in range(150)).encode()
    assert quality.verdicts([words], bands)[0][6]  # hex still halves, and a text shorter than a chunk is judged as a whole alone
    raw = " ".join("".join(chr(rnd.randrange(0x3400, 0x9FFF)) for _ in range(6)) for _ in range(2000)).encode()
    v = quality.verdicts([raw], bands)[0]
    assert not v[5] and not v[6] and v[7] < 1.4


def item_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(text, items):
    """Operator 6's contract by sliding every window over the text."""
    w = item_words(text)
    mark, found = set(), set()
    for item, t in items:
        x = item_words(t)
        for p in [x[i : i + 8] for i in range(len(x) - 7)] or ([x] if x else []):
            for i in range(len(w) - len(p) + 1):
                if w[i] == p[0] and w[i : i + len(p)] == p:
                    mark.update(range(i, i + len(p)))
                    found.add(item)
    return len(w), len(mark), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(found) >= 2


def test_kept(spark, sf, documents):
    """The verdicts by compressing with the limits as they are stated."""
    z, bands = zstandard.ZstdCompressor(level=3), quality.Bands()
    want = {}
    for i, t in documents:
        b, ok = t.encode(), not counts(t)[5]
        if ok:
            low, high = [x[1:] for x in bands.whole if len(b) < x[0]][0]
            ok = low <= len(b) / len(z.compress(b)) <= high
        if ok and len(b) > 4096:
            pieces = [b[a : a + 4096] for a in range(0, len(b), 4096)]
            pieces[-1] = b[-4096:]
            ok = sum(not 1.88 <= 4096 / len(z.compress(p)) <= 2.85 for p in pieces) <= 0.3 * len(pieces)
        want[i] = ok
    assert {r.doc_id: r.kept for r in quality.query(spark, sf).collect()} == want
    z = zstandard.ZstdCompressor(level=3)
    for size, chunks in ((0, 0), (1, 0), (2048, 0), (4096, 0), (4097, 2), (8192, 2), (8193, 3), (9000, 3)):
        assert quality.ratios(b"x" * size, bands, z)[1:] == (chunks, chunks)


def test_very_long_text(spark):
    rnd = random.Random(4)
    text = " ".join("".join(rnd.choices("abcdefghiklmnoprstuvw", k=rnd.randrange(2, 9))) for _ in range(400_000))
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame([(5, text[-200:])], "item_id long, text string")
    assert quality.judge(frame).first().n_words == 400_000
    assert decontam.search(frame, bench).first()["items"] == ["5"] and decontam.clean(frame, bench, least_items=1).count() == 0


def test_other_tokenizer_is_refused(tmp_path):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    spec["normalizer"] = None
    (tmp_path / "x.json").write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(ValueError):
        wordbpe.WordBPE(str(tmp_path / "x.json"))


def test_decontamination(spark, sf, documents, odd):
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = {r[0]: tuple(r)[1:] for r in decontam.query(spark, sf).collect()}
    assert got == {i: brute(t, items) for i, t in documents}
    assert any(v[1] for v in got.values())


def test_decontamination_verdict(spark, tmp_path):
    """Two items make a document contaminated, one item found twice does not."""
    a, b = "one two three four five six seven eight", "red orange yellow green blue indigo violet black"
    docs = [(1, f"{a} and {b}"), (2, f"{a} and {a}"), (3, b[4:]), (4, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, a), (8, b)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: (r.n_items, r.contaminated) for r in decontam.query(spark, str(tmp_path)).collect()}
    assert got == {1: (2, True), 2: (1, False), 3: (0, False), 4: (0, False)}


def test_decontamination_cases(spark, monkeypatch):
    items = [(1, "a b c d e f g h i j"), (2, "Tie Tie"), (3, None), (4, "!!"), (5, "the"), (6, "a B c d E f g h"), (7, "a a a a a a a a"), (None, "x y"), (2, "Tie Tie")]
    docs = [(1, "A B C D E F G H I J K"), (2, "tie tie tie"), (3, None), (4, ""), (5, "THE end"), (6, "z a b c d e f g h z a b c d e f g h"), (7, "a " * 20), (8, "ñ tie ñ"), (9, "x y"), (9, "x y")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame([(*d, "c") for d in docs], "doc_id long, text string, items string")
    want = sorted((i, *brute(t, [(str(a), b) for a, b in items if a is not None])[:3]) for i, t in docs)
    for block in (1, 200_000):
        monkeypatch.setattr(decontam, "BLOCK", block)
        got = decontam.search(frame, bench).select("doc_id", "n_words", F.expr("aggregate(spans, 0L, (a, s) -> a + s.end - s.start)"), F.size("items").cast("long"))
        assert sorted(map(tuple, got.collect())) == want
        for least in (1, 2):
            clean = decontam.clean(frame.withColumnsRenamed({"items": "n_words"}), bench, least_items=least)
            assert clean.columns == ["doc_id", "text", "n_words"] and sorted(r.doc_id for r in clean.collect()) == sorted(r[0] for r in want if r[3] < least)
    assert decontam.search(frame, bench.limit(0)).where("size(items) > 0").count() == 0
    assert decontam.search(frame.limit(0), bench).count() == 0
