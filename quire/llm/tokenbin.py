"""Operator 1, token-id files: documents compressed one by one with a shared zstandard dictionary.

A dataset is a folder of
  dict-<hash>.zdict      the dictionary, trained on serialized id arrays (absent where too few documents exist to train one)
  part-NNNNN.tidz        the documents' zstandard frames, one after another
  part-NNNNN.tidx        MAGIC, the dictionary's sha256, the count; then arrays: ids, null flags, ends of frames, token counts
  manifest.json          the parts with their sums; written last, so a folder without it isn't a dataset

Ids are little-endian, 2 bytes each where the vocabulary allows, else 4.  Any document is read with two seeks.

Documents ascend by id, rows without an id first, equal ids by a hash of their content, so equal input gives equal files.  Parts are
ranges of (id, hash, place): an id, or no id, in a third of all rows is cut by content, and a row in a third of all by where it was read.  A
part is rolled after ROLL_DOCS documents, so its index has a bound.  Null text is empty: it holds the end id alone; a very long text is one
frame, held whole once.  Repeated rows are all kept.  Files are written under temporary names and
renamed, so a repeated task replaces its file by the same bytes.  An empty table gives a dataset without parts.  Columns
besides the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import as_batches, bound_batches, drop, map_batches, new_path, open_fs, range_shards, stage, table, texts
from quire.llm.wordbpe import Twofold, byte_letters

MAGIC = b"TIDX0001"
#: The dictionary is trained on so many rows at most, those of least hash, of any length: each gives so many blocks of so many ids at most, spread evenly.
SAMPLE, SAMPLE_BLOCKS, SAMPLE_IDS = 400, 4, 2048
DICTIONARY_BYTES = 65_536
#: Compressed bytes in a part, documents after which it is rolled, and documents read by a task.
PART_BYTES, ROLL_DOCS, READ_DOCS = 32 << 20, 1 << 20, 20_000
# Fixed value: the public byte-level pre-tokenisation pattern.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteBPE:
    """Ids by the tokenizers library, each distinct piece between spaces being encoded once while it is kept.

    A single space followed by other than white space begins a piece that is independent of what stands before, if the
    text has no two white-space characters side by side; other texts are given to the library whole.
    """

    def __init__(self, path: str, cache: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.width = "<u2" if self.tokenizer.get_vocab_size(True) <= 1 << 16 else "<u4"
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        plain = json.loads(self.tokenizer.to_str().partition('"vocab"')[0].rpartition('"model"')[0].rstrip().rstrip(",") + "}")
        self.by_piece = plain.get("normalizer") is None and plain["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self.letters = {b: c for b, c in byte_letters().items()}
        self.ascii = {b: c for b, c in self.letters.items() if b < 128}
        self.find = regex.compile(PIECES).findall
        self.odd = re.compile("[^\n -~\xa1-\u024f]").search
        self.raw = [i.to_bytes(2 if self.width == "<u2" else 4, "little") for i in range(self.tokenizer.get_vocab_size(True))]
        self.pieces = Twofold(self.piece, cache)
        self.words = Twofold(self.word, cache)

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, self.width).tobytes()

    def word(self, w: str) -> bytes:
        mapped = w.translate(self.ascii) if w.isascii() else "".join(map(self.letters.__getitem__, w.encode()))
        raw = self.raw
        return b"".join([raw[t.id] for t in self.model.tokenize(mapped)])

    def piece(self, p: str) -> bytes:
        words, body = self.words, p[1:] if p[0] == " " else p
        if body.isalpha():
            return words[p]
        if body[:-1].isalpha() and body[-1] in ".,":
            return words[p[:-1]] + words[p[-1]]
        return b"".join([words[w] for w in self.find(p)])

    def encode(self, text: str) -> bytes:
        if not self.by_piece or any(s in text for s in (*self.special, "  ", " \n", "\n ", "\n\n")) or self.odd(text):
            return self.whole(text)
        first, *rest = text.split(" ")
        pieces = self.pieces
        return (pieces[first] if first else b"") + b"".join([pieces[" " + p] for p in rest])


@lru_cache(2)
def loaded(path: str) -> ByteBPE:
    return ByteBPE(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def blocks_of(ids: bytes, width: int) -> list[bytes]:
    """Up to SAMPLE_BLOCKS blocks of SAMPLE_IDS ids, the first and the last of them among them."""
    size = SAMPLE_IDS * width
    if len(ids) <= SAMPLE_BLOCKS * size:
        return [ids]
    last = (len(ids) - size) // width
    return [ids[(a := last * i // (SAMPLE_BLOCKS - 1) * width) : a + size] for i in range(SAMPLE_BLOCKS)]


def train_dictionary(docs: DataFrame, key: str, text: str, path: str | None, end: int) -> bytes:
    """A dictionary from the bounded sample above; empty where there are too few documents.

    Hashes alone are ranked; those above a threshold for 16 times the sample don't leave their tasks.
    """
    rows = docs.select(F.xxhash64(key, text).alias("h"), F.col(text).alias("t")).where("length(t) > 0")
    n = docs.select(key).count()
    most = (1 << 63) - 1 if n <= 64 * SAMPLE else (1 << 64) * 16 * SAMPLE // n - (1 << 63)
    low = [r.h for r in rows.select("h").where(F.col("h") <= most).distinct().orderBy("h").limit(SAMPLE).collect()]
    if not low:
        return b""

    def fn(batches):
        t, seen = loaded(path or default_path()), set()
        for b in batches:
            out = []
            for h, x in zip(b.column(0).to_pylist(), texts(b.column(1)), strict=True):
                if h not in seen:  # copies of a row count once
                    seen.add(h)
                    out.append((h, blocks_of(t.encode(x) + np.asarray([end], t.width).tobytes(), int(t.width[2]))))
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in out], pa.int64()), pa.array([x for _, x in out], pa.list_(pa.binary()))], ["h", "ids"])

    bound_batches(docs.sparkSession)
    chosen = rows.where(F.col("h") <= low[-1]).mapInArrow(fn, "h long, ids array<binary>").groupBy("h").agg(F.min("ids").alias("ids"))
    samples = [bytes(x) for r in chosen.collect() for x in r.ids]
    if len(samples) < 32:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 8 + 256), sorted(samples)).as_bytes()
    except zstandard.ZstdError:
        return b""


def zdict(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def put(fs, at: str, data: bytes) -> None:
    """A whole file under its name, or none."""
    temp = f"{at}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(temp) as f:
        f.write(data)
    fs.move(temp, at)


def write(docs: DataFrame, root: str, key: str = "doc_id", text: str = "text", path: str | None = None, end: int = 0, part_bytes: int = PART_BYTES) -> dict:
    """Write the dataset to root and return its manifest.  `end` is appended to each document."""
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    raw = train_dictionary(docs, "key", "text", path, end)
    digest = hashlib.sha256(raw).hexdigest()
    shared = spark.sparkContext.broadcast(raw)

    def encode(b: pa.RecordBatch) -> pa.RecordBatch:
        t = loaded(path or default_path())
        z = zstandard.ZstdCompressor(level=3, dict_data=zdict(shared.value))
        tail = np.asarray([end], t.width).tobytes()
        ids = [t.encode(x) + tail for x in texts(b.column(1))]
        size = len(tail)
        return pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) // size for x in ids], pa.int64()), pa.array([z.compress(x) for x in ids], pa.binary())], ["key", "n", "frame"])

    frames, at = stage(map_batches(docs, encode, "key long, n long, frame binary"), "frames")
    frames = frames.select("*", F.xxhash64("frame").alias("h"), F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("place"))
    keys = [F.col("key").isNotNull().cast("long"), F.coalesce("key", F.lit(0)), F.col("h"), F.col("place")]
    ranges = range_shards(frames, keys, F.octet_length("frame") + 40, part_bytes)
    shards = ranges.count
    own = open_fs(root)
    own[0].create_dir(own[1], recursive=True)
    if raw:
        put(own[0], f"{own[1]}/dict-{digest}.zdict", raw)

    def flush(fs, folder: str, shard: int, nth: int, rows: list[tuple], temp: str, out) -> dict:
        out.close()
        name = f"part-{shard:05d}-{nth:03d}"
        fs.move(temp, f"{folder}/{name}.tidz")
        keys, counts, sizes = zip(*rows, strict=True)
        index = MAGIC + bytes.fromhex(digest) + len(rows).to_bytes(8, "little")
        index += np.asarray([k or 0 for k in keys], "<i8").tobytes() + np.asarray([k is None for k in keys], "u1").tobytes()
        index += np.cumsum(sizes, dtype="<u8").tobytes() + np.asarray(counts, "<u8").tobytes()
        put(fs, f"{folder}/{name}.tidx", index)
        return {"shard": shard, "nth": nth, "name": name, "n_docs": len(rows), "n_tokens": sum(counts), "bytes": sum(sizes)}

    def save(batches):
        fs, folder = open_fs(root)
        shard, nth, rows, temp, out = None, 0, [], "", None
        for b in batches:
            done = []
            for s, k, n, frame in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if s != shard or len(rows) >= ROLL_DOCS:
                    if out:
                        done.append(flush(fs, folder, shard, nth, rows, temp, out))
                    nth = nth + 1 if s == shard else 0
                    shard, rows, temp = s, [], f"{folder}/.{uuid.uuid4().hex}.tmp"
                    out = fs.open_output_stream(temp)
                out.write(frame)
                rows.append((k, n, len(frame)))
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=kept)
        if out:
            yield pa.RecordBatch.from_pylist([flush(fs, folder, shard, nth, rows, temp, out)], schema=kept)

    kept = pa.schema([("shard", pa.int32()), ("nth", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("bytes", pa.int64())])
    bound_batches(spark)
    dealt = frames.select(ranges.number(keys).alias("shard"), "key", "n", "frame", "h").repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", F.col("key").asc_nulls_first(), "h", "n", "frame").drop("h")
    parts = sorted((r.asDict() for r in dealt.mapInArrow(save, "shard int, nth int, name string, n_docs long, n_tokens long, bytes long").collect()), key=lambda r: (r["shard"], r["nth"]))
    start = 0
    for p in parts:
        p["start"] = start
        start += p["n_tokens"]
    manifest = {"format": MAGIC.decode(), "dictionary": digest if raw else None, "end": end, "n_tokens": start, "parts": parts}
    put(own[0], f"{own[1]}/manifest.json", json.dumps(manifest, sort_keys=True).encode())
    drop(spark, at)
    shared.unpersist()
    return manifest


class Part:
    """A part opened for reading."""

    def __init__(self, root: str, name: str, width: str):
        fs, folder = open_fs(root)
        with fs.open_input_file(f"{folder}/{name}.tidx") as f:
            raw = f.read()
        if raw[:8] != MAGIC:
            raise ValueError(f"{name}: not a token index")
        digest, n = raw[8:40].hex(), int.from_bytes(raw[40:48], "little")
        at = 48
        self.keys = np.frombuffer(raw, "<i8", n, at)
        self.null = np.frombuffer(raw, "u1", n, at + 8 * n)
        self.ends = np.frombuffer(raw, "<u8", n, at + 9 * n)
        self.counts = np.frombuffer(raw, "<u8", n, at + 17 * n)
        words = b""
        if digest != hashlib.sha256(b"").hexdigest():
            with fs.open_input_file(f"{folder}/dict-{digest}.zdict") as f:
                words = f.read()
            if hashlib.sha256(words).hexdigest() != digest:
                raise ValueError(f"{name}: the dictionary is another one")
        self.z = zstandard.ZstdDecompressor(dict_data=zdict(words))
        self.data, self.width = fs.open_input_file(f"{folder}/{name}.tidz"), width

    def key(self, i: int) -> int | None:
        return None if self.null[i] else int(self.keys[i])

    def ids(self, i: int) -> np.ndarray:
        a = int(self.ends[i - 1]) if i else 0
        ids = np.frombuffer(self.z.decompress(self.data.read_at(int(self.ends[i]) - a, a)), self.width)
        if len(ids) != self.counts[i]:
            raise ValueError(f"document {self.key(i)}: {len(ids)} ids, {self.counts[i]} in the index")
        return ids


def read(spark: SparkSession, root: str, digests: bool = False, key: str = "doc_id", path: str | None = None) -> DataFrame:
    """(key, start, n_tokens, ids) of every document; with digests, ids_crc32 in place of ids.

    start counts the ids of all documents before.  Parts are read in pieces of READ_DOCS documents.
    """
    fs, folder = open_fs(root)
    with fs.open_input_file(f"{folder}/manifest.json") as f:
        manifest = json.loads(f.read())
    units = [(p["name"], p["start"], a, min(a + READ_DOCS, p["n_docs"])) for p in manifest["parts"] for a in range(0, p["n_docs"], READ_DOCS)]
    frame = spark.createDataFrame(units, "name string, start long, first long, past long").repartition(max(1, len(units)))
    last = ("ids_crc32", pa.int64()) if digests else ("ids", pa.list_(pa.int64()))
    kinds = pa.schema([(key, pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), last])

    def fn(batches):
        width = loaded(path or default_path()).width
        for b in batches:
            for name, start, first, past in zip(*(c.to_pylist() for c in b.columns), strict=True):
                p = Part(root, name, width)
                at = start + int(p.counts[:first].sum())
                rows, held = [], 0
                for i in range(first, past):
                    ids = p.ids(i)
                    rows.append((p.key(i), at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()) if digests else ids.tolist()))
                    at += len(ids)
                    held += 0 if digests else len(ids)
                    if len(rows) >= 5000 or held > 1 << 21 or i + 1 == past:
                        yield from as_batches(pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.types, strict=True)], kinds.names))
                        rows, held = [], 0

    return frame.mapInArrow(fn, f"`{key}` long, start long, n_tokens long, " + ("ids_crc32 long" if digests else "ids array<long>"))


def read_one(root: str, doc_id: int, path: str | None = None) -> list[int] | None:
    """Ids of one document, or None: an index look-up and one short read in each part that may hold it."""
    fs, folder = open_fs(root)
    with fs.open_input_file(f"{folder}/manifest.json") as f:
        manifest = json.loads(f.read())
    for m in manifest["parts"]:
        p = Part(root, m["name"], loaded(path or default_path()).width)
        n = int(p.null.sum())
        i = n + int(np.searchsorted(p.keys[n:], doc_id))
        if i < len(p.keys) and p.keys[i] == doc_id:
            return p.ids(i).tolist()
    return None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "tokens")
    write(table(spark, sf_dir, "documents"), root)
    return read(spark, root, digests=True)
