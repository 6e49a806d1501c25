"""Operators 1 and 5: round trips through their files."""

import hashlib
import os
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quire.llm import common, tokenbin, warc
from tests.llm.test_text_ops import ODD

BYTES = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def crcs(rows):
    out, start = [], 0
    for key, text in rows:
        ids = BYTES.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((key, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_tokens(spark, sf):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert sorted(map(tuple, tokenbin.query(spark, sf).collect())) == crcs(rows)


def test_tokens_odd(spark, tmp_path):
    rows = [(i - 3, t) for i, t in enumerate(ODD + ["a  b", "a \n b", "x y\n\nz ", "end ", " a b", "a\nb c\td e", "it's <|endoftext|> x", "a b c d"])]
    frame = spark.createDataFrame([*((i, t, "x") for i, t in rows), (90, None, ""), (None, "no id", ""), (91, "tie", ""), (91, "tie", "")], "doc_id long, text string, start string")
    want = crcs([(None, "no id"), *rows, (90, None), (91, "tie"), (91, "tie")])
    for part in (1 << 20, 300):
        root = f"file://{tmp_path}/t{part}"
        manifest = tokenbin.write(frame, root, part_bytes=part)
        assert (len(manifest["parts"]) > 1) == (part == 300)
        got = tokenbin.read(spark, root, digests=True).collect()
        assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    ids = {r.doc_id: r.ids for r in tokenbin.read(spark, root).collect()}
    assert ids[90] == [0] and tokenbin.read_one(root, 4) == ids[4] and tokenbin.read_one(root, 1234) is None
    again = f"file://{tmp_path}/again"
    assert tokenbin.write(frame.repartition(3), again, part_bytes=300) == manifest
    for name in os.listdir(f"{tmp_path}/t300"):
        with open(f"{tmp_path}/t300/{name}", "rb") as a, open(f"{tmp_path}/again/{name}", "rb") as b:
            assert a.read() == b.read()
    tokenbin.write(frame.limit(0), f"file://{tmp_path}/none")
    assert tokenbin.read(spark, f"file://{tmp_path}/none").collect() == []


def test_tokens_dictionary(spark, sf, tmp_path):
    manifest = tokenbin.write(spark.read.parquet(f"{sf}/documents.parquet"), f"file://{tmp_path}/t")
    assert manifest["dictionary"] and os.path.exists(f"{tmp_path}/t/dict-{manifest['dictionary']}.zdict")
    assert not [x for x in os.listdir(f"{tmp_path}/t") if x.endswith(".tmp")]


def test_tokens_hot(spark, tmp_path):
    """A third of the rows without an id, a third with one id, and copies: cut into parts, none of them much above the limit."""
    rows = [(None, f"none {i}") for i in range(300)] + [(7, f"seven {i}") for i in range(300)] + [(i - 150, "same") for i in range(300)] + [(8, "copy")] * 300
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    root = f"file://{tmp_path}/t"
    manifest = tokenbin.write(frame, root, part_bytes=3000)
    assert max(p["n_docs"] for p in manifest["parts"]) < 150 and len(manifest["parts"]) > 12
    got = sorted(tokenbin.read(spark, root).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert sorted(tuple(r.ids) for r in got) == sorted(tuple(BYTES.encode(t, add_special_tokens=False).ids + [0]) for _, t in rows)
    starts = [r.start for r in got]
    assert starts == [sum(r.n_tokens for r in got[:i]) for i in range(len(got))]


def test_ranges(spark):
    for values, target in (([-(1 << 63), (1 << 63) - 1, 0, 5, 5, 6], 1), ([3] * 9, 2), (list(range(1000)), 10), ([0] * 50 + [1 << 62], 5), ([i * i * i for i in range(500)], 7)):
        frame = spark.createDataFrame([(v, n) for n, v in enumerate(values)], "v long, n long")
        keys = [F.col("v"), F.col("n")]
        ranges = common.range_shards(frame, keys, F.lit(1), target)
        got = frame.select("v", "n", ranges.number(keys).alias("s")).orderBy("v", "n").collect()
        assert [r.s for r in got] == sorted(r.s for r in got) and {r.s for r in got} <= set(range(ranges.count))
        sizes = [sum(r.s == s for r in got) for s in range(ranges.count)]
        assert max(sizes) <= target and len(sizes) <= 2 * len(values) / target + 1


def test_dictionary_sample():
    ids = np.arange(100_000, dtype="<u2").tobytes()
    found = tokenbin.blocks_of(ids, 2)
    assert len(found) == 4 and found[0] == ids[:4096] and found[-1] == ids[-4096:] and tokenbin.blocks_of(b"ab", 2) == [b"ab"]


def expected(rows):
    first, out = {}, []
    for k, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (h or "").encode()
        d = hashlib.sha256(b).hexdigest()
        if len(b) < 100 or d not in first:
            if len(b) >= 100 and k is not None:
                first[d] = k
            out.append((k, len(b), d, "response", None))
        else:
            out.append((k, len(b), d, "revisit", first[d]))
    return sorted(out, key=str)


def test_warc(spark, sf, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, warc.query(spark, sf).collect()), key=str) == expected(rows)
    odd = [(1, "http://a b\n", "x" * 100), (0, None, None), (2, "u", "x" * 100), (3, "u", "short"), (4, "v", "short"), (5, "w", ""), (None, "n", "x" * 100), (None, "n", "y" * 200), (6, "é", "é" * 50), (7, "q", "é" * 50), (7, "q", "é" * 50), (8, "z", "\r\n\r\nWARC/1.1\r\n" * 99)]
    frame = spark.createDataFrame([(*r, "c") for r in odd], "page_id long, url string, html string, digest string")
    for n, (roll, size) in enumerate(((1 << 20, 1 << 20), (500, 600), (500, 600))):
        root = f"file://{tmp_path}/w{n}"
        manifest = warc.write(frame.repartition(n + 1), root, roll=roll, shard_bytes=size)
        back = warc.read(spark, root).collect()
        assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back), key=str) == expected(odd)
        assert {r.payload for r in back if r.page_id == 8} == {odd[-1][2].encode()}
    assert len(manifest["files"]) > 3
    for f in manifest["files"]:
        with open(f"{tmp_path}/w1/{f['name']}", "rb") as a, open(f"{tmp_path}/w2/{f['name']}", "rb") as b:
            assert a.read() == b.read()
    warc.write(frame.limit(0), f"file://{tmp_path}/none")
    assert warc.read(spark, f"file://{tmp_path}/none").collect() == []


def test_warc_hot(spark, tmp_path):
    rows = [(None, f"u{i}", f"{i} " * 60) for i in range(200)] + [(i, "u", "same page " * 30) for i in range(200)]
    root = f"file://{tmp_path}/w"
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    manifest = warc.write(frame, root, shard_bytes=20_000)
    assert max(f["records"] for f in manifest["files"]) < 120 and len(manifest["files"]) > 4
    assert sorted(map(tuple, warc.read(spark, root, payloads=False).drop("url").collect()), key=str) == expected(rows)
