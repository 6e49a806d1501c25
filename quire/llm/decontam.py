"""Operator 6, benchmark decontamination by Wu-Manber search over words.

Patterns are the benchmark items' windows of 8 words (shorter items: one window of all their words).  For each pattern
length m, a shift table over blocks of B = 2 words says how far the search window may move: m - 1 for blocks in no
pattern, else the least distance from the block to a pattern's end.  Where the shift is 0, the bucket of that suffix block
holds the patterns, and a direct comparison of all words confirms.  Patterns of one word have B = 1.

Null has no words; an item without words has no window, so it never occurs.  Empty texts and tables give zero
counts or no rows.  Repeated items (equal item_id) count once; equal texts under two ids count as two items.  Items
without an id can't be counted and are left out: their windows are neither hits nor contaminate.  Columns
besides ids and texts are not read, and clean() returns them untouched.

The benchmark is a stated query set: its patterns are packed into blocks of at most BLOCK windows (one item has a block of its own beyond
that).  The documents are searched in one pass for each block, whose tables are broadcast alone and given up after it; with more than one block what was
found is written down between passes.  So memory is bounded at any number of items.  A very long text is searched in
one go, with memory in proportion to itself.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.llm.common import drop, fresh, map_batches, named, stage, table, utf8

WINDOW = 8
#: Windows in a block that is broadcast: under 64 MB in a worker.
BLOCK = 200_000
# Bytes 0-9, a-z and those of non-ASCII letters make words once A-Z are lowered; all others divide.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(b: bytes) -> list[bytes]:
    return b.translate(FOLD).split()


class Patterns:
    """Wu-Manber tables of one pattern length."""

    def __init__(self, m: int, patterns: dict[tuple[bytes, ...], list]):
        self.m, self.b = m, min(2, m)
        self.shift: dict = {}
        self.bucket: dict = defaultdict(dict)
        for p, items in patterns.items():
            for end in range(self.b, m + 1):
                block = p[end - 2 : end] if self.b == 2 else p[0]
                self.shift[block] = min(self.shift.get(block, m), m - end)
            self.bucket[p[-2:] if self.b == 2 else p[0]][p] = items
        self.bucket = dict(self.bucket)

    def search(self, w: list[bytes]):
        """(start, items) for each occurrence."""
        m, n, get, bucket = self.m, len(w), self.shift.get, self.bucket
        if m == 1:
            for i, x in enumerate(w):
                if x in bucket:
                    yield i, bucket[x][(x,)]
            return
        i, free = m - 1, m - 1
        while i < n:
            step = get((w[i - 1], w[i]), free)
            if step:
                i += step
                continue
            items = bucket[w[i - 1], w[i]].get(tuple(w[i - m + 1 : i + 1]))
            if items:
                yield i - m + 1, items
            i += 1


def windows(text: bytes, size: int = WINDOW) -> list[tuple[bytes, ...]]:
    w = words(text)
    if not w:
        return []
    return [tuple(w[i : i + size]) for i in range(len(w) - size + 1)] or [tuple(w)]


def build(rows) -> list[Patterns]:
    """Tables, one for each pattern length, from (item, window) rows."""
    by: dict[int, dict] = defaultdict(lambda: defaultdict(list))
    for item, w in rows:
        if item not in by[len(w)][w]:
            by[len(w)][w].append(item)
    return [Patterns(m, dict(p)) for m, p in sorted(by.items())]


def hits(w: list[bytes], tables: list[Patterns]) -> tuple[set, list[tuple[int, int]]]:
    """Items with occurring windows, and the hit spans (start, end) in words, merged and ascending."""
    items, spans = set(), []
    for t in tables:
        for at, own in t.search(w):
            items.update(own)
            spans.append((at, at + t.m))
    spans.sort()
    merged: list[tuple[int, int]] = []
    for a, b in spans:
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return items, merged


def blocks(benchmark: DataFrame, item: str, text: str, size: int):
    """Pattern tables of at most BLOCK windows (or one item's), one after another."""
    rows: list = []
    for r in benchmark.select(F.col(item).cast("string"), F.col(text).cast("binary")).where(f"`{item}` is not null").toLocalIterator():
        own = [(r[0], w) for w in dict.fromkeys(windows(bytes(r[1] or b""), size))]
        if rows and len(rows) + len(own) > BLOCK:
            yield build(rows)
            rows = []
        rows += own
    yield build(rows)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


FOUND = (("n_words", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))
FOUND_SQL = "{} long, {} array<string>, {} array<struct<start:long,end:long>>"


def passes(docs: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str, size: int) -> tuple[DataFrame, list[str]]:
    """docs with three more columns, whose names are returned: words, items found (sorted), and spans of hit words."""
    spark, names = docs.sparkSession, fresh(docs.columns, *(n for n, _ in FOUND))
    where, n, plain = docs.columns.index(text), len(docs.columns), docs.columns
    schema = StructType([*docs.schema, *StructType.fromDDL(FOUND_SQL.format(*names))])
    now, path = docs, None
    for k, tables in enumerate(blocks(benchmark, item, item_text, size)):
        if k:  # the pass before is written down, and what it read is given up
            now, at = stage(now, "decontamination")
            if path:
                drop(spark, path)
            path = at
        shared = spark.sparkContext.broadcast(tables)

        def fn(b: pa.RecordBatch, shared=shared, first=not k) -> pa.RecordBatch:
            words_, items, spans = [], [], []
            old = [(None, [], [])] * b.num_rows if first else zip(*(b.column(n + i).to_pylist() for i in range(3)), strict=True)
            for t, (_, i0, s0) in zip(utf8(b.column(where)), old, strict=True):
                w = words(t)
                i, s = hits(w, shared.value)
                words_.append(len(w))
                items.append(sorted(i.union(i0)))
                spans.append([{"start": x, "end": y} for x, y in merged([*s, *((x["start"], x["end"]) for x in s0)])])
            return pa.RecordBatch.from_arrays([*b.columns[:n], *(pa.array(c, t) for c, (_, t) in zip((words_, items, spans), FOUND, strict=True))], [*plain, *names])

        now = map_batches(now, fn, schema)
    return now, names


def search(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """(key, n_words, items array<string> sorted, spans array<struct<start,end>> of hit words) for each document."""
    found, names = passes(docs.select(key, text), benchmark, text, item, item_text, size)
    return found.select(key, *(F.col(c).alias(n) for c, (n, _) in zip(names, FOUND, strict=True)))


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", least_items: int = 2) -> DataFrame:
    """Documents in which windows of fewer than least_items items occur, every column as it was."""
    found, names = passes(docs, benchmark, text, "item_id", "text", WINDOW)
    return found.where(F.size(names[1]) < least_items).select(*map(named, docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        F.expr("aggregate(spans, 0L, (a, s) -> a + s.end - s.start)").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("items") >= 2).alias("contaminated"),
    )
