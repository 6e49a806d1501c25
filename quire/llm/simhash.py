"""Operator 9, SimHash near-duplicates by deletion-variant signatures.

Fingerprints of 64 bits are made of XXH64 hashes of 3-word shingles.  Two fingerprints that differ in at most 2 bits differ in
at most one bit of one 32-bit half, so each distinct fingerprint is filed 64 times: under each half with one bit wiped out.  Equal
signatures meet in one sorted stream, and distances are verified within each meeting.  A meeting hands on a forest over its
verified links (each member and the least of its part), never all pairs.  Meetings of over CAP fingerprints are not compared: their
members are filed again under all 2016 pairs of wiped bits, where equal signatures mean a link by themselves,
so the result is exact at any size.

Null and empty texts have fingerprint zero, linked like any other.  Rows without an id count for links but not for the
smallest id (a group of such rows alone has a null component).  Repeated rows all appear.  A very long text is hashed in
one pass, with memory in proportion to itself.  An empty table gives an empty result.  Columns besides the id and the text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import drop, map_batches, stage, table, utf8, wide_batches
from quire.llm.components import components

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SEED, SHINGLE, BITS = 42, 3, 2
#: Fingerprints that are compared with one another within a meeting.
CAP = 2048


def fingerprint(b: bytes) -> int:
    """The 64-bit SimHash of a text in UTF-8."""
    words = b.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(SHINGLE, len(words))
    xxh = xxhash.xxh64_intdigest
    h = np.array([xxh(joined[a:e], SEED) for a, e in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)], np.uint64)
    return majority(h)


def majority(h: np.ndarray) -> int:
    """The number whose bits are set in over half the hashes."""
    votes = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 15):
        votes += np.unpackbits(h[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The kept columns and fp, the fingerprint as a signed long."""

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t) for t in utf8(b.column(b.num_columns - 1))], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps, pa.int64())], [*keep, "fp"])

    kinds = dict(docs.dtypes)
    return map_batches(docs.select(*keep, text), fn, ", ".join(f"`{k}` {kinds[k]}" for k in keep) + ", fp long")


def forest(fps: np.ndarray) -> tuple[list[int], list[int]]:
    """(member, least of its part) over links of at most BITS bits among distinct fingerprints."""
    left, out_u, out_v = np.sort(fps), [], []
    while len(left) > 1:
        part, front, left = [left[0]], [left[0]], left[1:]
        while front and len(left):
            near = np.bitwise_count((left ^ front.pop()).view(np.uint64)) <= BITS
            if near.any():
                found = left[near].tolist()
                part += found
                front += found
                left = left[~near]
        least = int(part[0])
        out_u += [int(x) for x in part[1:]]
        out_v += [least] * (len(part) - 1)
    return out_u, out_v


def met(batches, cap: int):
    """Groups of equal leading columns in a sorted stream: (fingerprints, True), or in pieces of over cap members: (piece, False)."""
    key, held, size, over = None, [], 0, False
    for b in batches:
        *ks, fp = (c.to_numpy(zero_copy_only=False) for c in b.columns)
        if not len(fp):
            continue
        change = np.zeros(len(fp) - 1, bool)
        for k in ks:
            change |= k[1:] != k[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(fp)]
        for a, z in zip(cuts, cuts[1:], strict=False):
            mine = tuple(int(k[a]) for k in ks)
            if mine != key:
                if size > 1:
                    yield np.concatenate(held), not over
                key, held, size, over = mine, [], 0, False
            held.append(fp[a:z])
            size += z - a
            if size > cap:
                over = True
                yield np.concatenate(held), False
                held, size = [np.empty(0, np.int64)], max(cap, 2)
    if size > 1:
        yield np.concatenate(held), not over


def links(distinct: DataFrame) -> tuple[DataFrame, list[str]]:
    """Edges (u, v) over distinct fingerprints (fp) that keep every connection of at most BITS bits; and their paths."""
    spark = distinct.sparkSession
    filed = distinct.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("n")).select(
        F.expr("((CASE WHEN n < 32 THEN fp & 4294967295L ELSE shiftrightunsigned(fp, 32) END) & ~shiftleft(1L, n % 32)) | shiftleft(CAST(n AS BIGINT), 32)").alias("key"), "fp"
    )

    def compare(batches):
        for fps, whole in met(batches, CAP):
            if whole:
                u, v = forest(fps)
            else:
                u, v = fps.tolist(), [None] * len(fps)
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    with wide_batches(spark):
        found, a = stage(filed.repartition(F.col("key")).sortWithinPartitions("key", "fp").mapInArrow(compare, "u long, v long").distinct(), "links")
    crowded = found.where("v IS NULL").select("u")
    edges, paths = found.where("v IS NOT NULL"), [a]
    if not crowded.isEmpty():

        def equal(batches):
            for fps, _ in met(batches, 1 << 30):
                yield pa.RecordBatch.from_arrays([pa.array(fps[1:], pa.int64()), pa.array(np.full(len(fps) - 1, fps[0]), pa.int64())], ["u", "v"])

        pairs = F.expr("flatten(transform(sequence(0, 62), i -> transform(sequence(i + 1, 63), j -> i * 64 + j)))")
        wiped = crowded.select("u", F.explode(pairs).alias("n")).select(F.expr("u & ~shiftleft(1L, CAST(n / 64 AS INT)) & ~shiftleft(1L, n % 64)").alias("key"), F.col("n").cast("long").alias("n"), "u")
        with wide_batches(spark):
            more, b = stage(wiped.repartition("key", "n").sortWithinPartitions("key", "n", "u").mapInArrow(equal, "u long, v long").distinct(), "links-crowded")
        edges, paths = edges.union(more), [a, b]
    return edges, paths


def labelled(prints: DataFrame, key: str) -> tuple[DataFrame, str]:
    """(fp, least) of a staged (key, fp): the smallest key of each fingerprint's component; and the path."""
    spark = prints.sparkSession
    distinct, a = stage(prints.groupBy("fp").agg(F.min(key).alias("first")), "distinct")
    edges, paths = links(distinct.select("fp"))
    roots, b = components(edges)
    drop(spark, *paths)
    rooted, c = stage(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first"), "rooted")
    least, d = stage(rooted.groupBy("root").agg(F.min("first").alias("least")), "least")
    out, e = stage(rooted.select("fp", "root").join(least, "root").select("fp", "least"), "labels")
    drop(spark, a, b, c, d)
    return out, e


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint, component_id) of each document."""
    prints, _ = stage(fingerprints(docs.select(F.col(key), F.col(text)), key, text=text), "prints")
    labels, _ = labelled(prints, key)
    return prints.join(labels, "fp").select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least").alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents"))
