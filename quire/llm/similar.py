"""Operator 9 for texts: near copies by SimHash links, verified and completed to all pairs of Jaccard similarity >= 0.8.

Two texts are linked when their sets of shingles (XXH64 of SHINGLE words in a row, fewer in shorter texts) have a Jaccard similarity of
SIMILARITY or more.  One text of each class of linked ones stays.

Fingerprints alone can't tell such pairs: at a similarity of 0.8 some ten of 64 bits differ, more than deletion variants reach.  So
 1. SimHash fingerprints of the sets meet by the deletion-variant signatures of simhash.links(), and sets of equal least hashes meet the
    least set among them.  These pairs, a few for each set, are verified on the whole sets and grouped: copies are never expanded into pairs.
 2. A prefix filter finds every pair that may be linked and lies in different groups: with the n shingles of each set in one order, two
    linked sets meet in one of the first n - ceil(SIMILARITY * n) + 1.  The most frequent shingles come last in the order, so passages that many texts share file nothing but such texts.
    First each set that meets one of another group is verified against the centre of the meeting, the set with the earliest place, and groups grow by that.
    Then sizes, places, and the parities of the hashes in PARITIES bits, of which two sets differ in no more than they have shingles apart, rule out pairs
    where they meet; those that are left, and may be linked by how often they meet, are verified.
The classes are those of comparing all pairs.  Meetings of over BLOCK sets are cut into blocks that are compared two by two.  Rows are made
of pairs that pass these bounds alone, but a meeting's parities are compared in memory pair by pair, which is the square of its size.

Texts of equal words are one set from the start; null and empty texts are alike.  A link needs no id: of a class the smallest id stays,
ties and rows without an id by place.  A very long text needs memory in proportion to itself.  Repeated rows are one class.  An empty
table gives an empty one.  All columns come back untouched, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import simhash
from quire.llm.common import drop, forget, keep_side, map_batches, named, side_values, stage, utf8, wide_batches, with_row_id, write_side
from quire.llm.components import components

LOWER = simhash.LOWER
SEED, SHINGLE, SIMILARITY = 42, 5, 0.8
#: Share of a set, in order of hash, whose shingles are counted to find frequent ones; how often those occur, and how many are kept at most.
COUNTED, OFTEN, FREQUENT = 0.35, 6, 1 << 20
#: Bits in which the fingerprints of a likely pair differ at most; it spares verification and loses nothing, as all pairs come later.
NEAR = 16
#: Sets of one meeting that are compared at once, and pairs in a batch that is handed on.
BLOCK, PAIRS = 1024, 50_000
#: Bits of parities, in longs.
PARITIES = 1024
BITS = [f"b{i}" for i in range(PARITIES // 64)]


def shingles(b: bytes, size: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of a text's shingles, ascending."""
    words = b.translate(LOWER).split()
    k = min(size, len(words))
    if not k:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    xxh = xxhash.xxh64_intdigest
    return np.unique(np.array([xxh(joined[a:e], SEED) for a, e in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)], np.uint64))


def prefix(n: int, similarity: float) -> int:
    return n - math.ceil(similarity * n - 1e-9) + 1


def least_shared(n, m, similarity: float):
    """Elements that sets of n and m share at least if they are linked."""
    return np.ceil(similarity / (1 + similarity) * (n + m) - 1e-9)


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both) - 1e-9


def possible(n, at, m, other, similarity: float):
    """Whether sets of n <= m that meet at these places of their orders can be linked, if they haven't met before."""
    return (n >= similarity * m - 1e-9) & (np.minimum(n - at, m - other) >= least_shared(n, m, similarity))


def parities(h: np.ndarray) -> np.ndarray:
    """PARITIES bits: whether an odd number of the hashes falls to each.  Two sets differ in at most as many bits as there are elements of one alone."""
    odd = np.bincount((h & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def near(n, m, a: np.ndarray, b: np.ndarray, similarity: float):
    """Whether sets of n and m with these parities, a column each, can be linked."""
    return np.bitwise_count((a ^ b).view(np.uint64)).sum(0, dtype=np.int64) <= n + m - 2 * least_shared(n, m, similarity)


def flat(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


class Scan:
    """The rows of a table of texts, told apart by file and number, of which one for each set carries the set's number (sid)."""

    def __init__(self, rows: DataFrame, ident: list[str], text: str, places: DataFrame, size: int, similarity: float):
        self.rows = rows.select(F.col(named(text)).alias("text"), *ident)
        self.places, self.size, self.similarity, self.spark = places, size, similarity, rows.sparkSession

    def shingled(self, values: DataFrame, name: str, fn, schema: str) -> tuple[DataFrame, str]:
        """fn(values, sets) of the rows that have a value in (file, row, value), hashed where they are read; staged."""
        root, size = write_side(values, name), self.size

        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            of, kept = utf8(b.column(0)), []
            _, pieces = side_values(root, b.column(1), b.column(2))
            for at, value in pieces:
                kept += zip(value.to_pylist(), (shingles(of[i], size) for i in at.tolist()), strict=True)
            return fn(kept)

        out, path = stage(map_batches(self.rows, run, schema), name)
        drop(self.spark, root)
        return out, path

    def marks(self) -> tuple[DataFrame, str]:
        """(kind, key, sid, fp): 0 the fingerprint, 1 the two least hashes, 2 (without a sid) the counted hashes of a batch, with their number as fp."""

        def fn(kept):
            kind, key, sid, fp, counted = [], [], [], [], []
            for i, h in kept:
                if len(h):
                    low, own = h[:2].view(np.int64), np.array([simhash.majority(h)], np.uint64).view(np.int64)
                    key += [own, low]
                    kind.append(np.repeat(np.array([0, 1], np.int8), (1, len(low))))
                    sid.append(np.repeat(i, 1 + len(low)))
                    fp.append(np.repeat(own, 1 + len(low)))
                    counted.append(h[: math.ceil(COUNTED * len(h))].view(np.int64))
            often, n = np.unique(flat(counted), return_counts=True)
            kind = np.concatenate([flat(kind), np.full(len(often), 2)]).astype(np.int8)
            sid = np.concatenate([flat(sid), np.full(len(often), -1)])
            return pa.RecordBatch.from_arrays([pa.array(kind, pa.int8()), pa.array(np.concatenate([flat(key), often]), pa.int64()), pa.array(sid, pa.int64(), mask=sid < 0), pa.array(np.concatenate([flat(fp), n]), pa.int64())], ["kind", "key", "sid", "fp"])

        return self.shingled(self.places.withColumnRenamed("sid", "value"), "similar-marks", fn, "kind byte, key long, sid long, fp long")

    def filed(self, roots: DataFrame, frequent: np.ndarray) -> tuple[DataFrame, str]:
        """(key, n, sid, at, root): each set under the hashes of its prefix, with the place in the order and its group."""
        shared, similarity = self.spark.sparkContext.broadcast(frequent), self.similarity

        def fn(kept):
            often, cols = shared.value, ([], [], [], [], [])
            for v, h in kept:
                if not len(h):
                    continue
                k = np.minimum(np.searchsorted(often, h), max(len(often) - 1, 0))
                late = often[k] == h if len(often) else np.zeros(len(h), bool)
                first = prefix(len(h), similarity)
                head = np.argsort(late, kind="stable")[:first]
                for c, x in zip(cols, (h[head].view(np.int64), np.full(first, len(h)), np.full(first, v["sid"]), np.arange(first), np.full(first, v["root"])), strict=True):
                    c.append(x)
            return pa.RecordBatch.from_arrays([pa.array(flat(c), t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()), strict=True)], ["key", "n", "sid", "at", "root"])

        value = F.struct("sid", F.coalesce("root", "sid").alias("root")).alias("value")
        values = self.places.join(roots.withColumnRenamed("node", "sid"), "sid", "left").select("file", "row", value)
        return self.shingled(values, "similar-filed", fn, "key long, n int, sid long, at int, root long")

    def parities(self, wanted: DataFrame) -> tuple[DataFrame, str]:
        """(sid, *BITS) of the wanted sets (sid)."""
        values = self.places.join(wanted, "sid").select("file", "row", F.col("sid").alias("value"))

        def fn(kept):
            bits = np.array([parities(h) for _, h in kept], np.int64).reshape(len(kept), len(BITS))
            return pa.RecordBatch.from_arrays([pa.array([i for i, _ in kept], pa.int64()), *(pa.array(np.ascontiguousarray(c), pa.int64()) for c in bits.T)], ["sid", *BITS])

        return self.shingled(values, "similar-bits", fn, longs(["sid", *BITS]))

    def compared(self, pairs: DataFrame, encode, judge) -> tuple[DataFrame, str]:
        """The staged pairs (u, v) for which judge(codes of u, of v) holds; each set travels as encode(its hashes)."""
        wanted = pairs.select(F.explode(F.array("u", "v")).alias("sid")).distinct()
        values = self.places.join(wanted, "sid").select("file", "row", F.col("sid").alias("value"))

        def fn(kept):
            return pa.RecordBatch.from_arrays([pa.array([i for i, _ in kept], pa.int64()), pa.array([encode(h) for _, h in kept], pa.binary())], ["sid", "h"])

        sets, a = self.shingled(values, "similar-sets", fn, "sid long, h binary")
        left, b = stage(pairs.join(sets.select(F.col("sid").alias("u"), F.col("h").alias("hu")), "u"), "similar-left")
        both = left.join(sets.select(F.col("sid").alias("v"), F.col("h").alias("hv")), "v").select("u", "v", "hu", "hv")

        def keep(b: pa.RecordBatch) -> pa.RecordBatch:
            ok = [judge(x, y) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            return pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["u", "v"]).filter(pa.array(ok, pa.bool_()))

        out, path = stage(map_batches(both, keep, "u long, v long"), "similar-edges")
        drop(self.spark, a, b)
        return out, path

    def verified(self, pairs: DataFrame) -> tuple[DataFrame, str]:
        """The linked ones of staged pairs (u, v): short codes rule most others out, whole sets decide."""
        similarity = self.similarity
        left, a = self.compared(pairs, code, lambda x, y: perhaps(x, y, similarity))
        out, path = self.compared(left, lambda h: h.tobytes(), lambda x, y: alike(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), similarity))
        drop(self.spark, a)
        return out, path


def code(h: np.ndarray) -> bytes:
    """About a byte for each hash: differences of their leading bits, of which there are 8 to 16 patterns for each hash."""
    bits = int(len(h)).bit_length() + 3
    steps = np.diff(h >> np.uint64(64 - bits), prepend=np.uint64(0))
    width = 1 if int(steps.max()) < 1 << 8 else 4
    return bytes([bits, width]) + steps.astype(f"<u{width}").tobytes()


def perhaps(x: bytes, y: bytes, similarity: float) -> bool:
    """Whether sets of these codes can be linked: what they share is at most what their leading bits share."""
    a, b = (np.cumsum(np.frombuffer(z, f"<u{z[1]}", offset=2), dtype=np.int64) for z in (x, y))
    if x[0] != y[0]:
        a, b = a >> max(0, x[0] - y[0]), b >> max(0, y[0] - x[0])
    (a1, na), (b1, nb) = (np.unique(z, return_counts=True) for z in (a, b))
    _, i, j = np.intersect1d(a1, b1, assume_unique=True, return_indices=True)
    return bool(np.minimum(na[i], nb[j]).sum() >= least_shared(len(a), len(b), similarity))


def frequent_keys(marks: DataFrame) -> np.ndarray:
    """The most frequent counted hashes, ascending: those above the least count of at least OFTEN that leaves at most FREQUENT."""
    # Nearly all keys differ: sums by task would only spill, and a batch has summed up its own, so a hot key sends a row for each batch.
    counts, a = stage(marks.where("kind = 2").select("key", "fp").repartition(F.col("key")).groupBy("key").agg(F.sum("fp").alias("n")).where(F.col("n") > OFTEN), "similar-often")
    left, least = FREQUENT, OFTEN
    for r in counts.groupBy(F.floor(F.log2("n") * 8).alias("band")).agg(F.count("*").alias("c"), F.min("n").alias("n")).orderBy(F.desc("band")).collect():
        left -= r.c
        if left < 0:
            break
        least = r.n - 1
    else:
        least = OFTEN
    keys = counts.where(F.col("n") > least).select("key").toArrow().column("key").to_numpy()
    drop(marks.sparkSession, a)
    return np.sort(keys.view(np.uint64))


def first_pairs(marks: DataFrame) -> tuple[DataFrame, list[str]]:
    """A few likely pairs (u, v) of sets, u > v: each with the least of equal fingerprint or least hash, and of linked fingerprints the least of each."""
    spark = marks.sparkSession
    own = marks.where("kind < 2")
    least, a = stage(own.groupBy("kind", "key").agg(F.min(F.struct("sid", "fp")).alias("x"), F.count("*").alias("c")).select("kind", "key", F.col("x.sid").alias("least"), F.col("x.fp").alias("print"), "c"), "similar-least")
    stars = own.join(least.where("c > 1"), ["kind", "key"]).where(f"sid > least AND bit_count(fp ^ print) <= {NEAR}").select(F.col("sid").alias("u"), F.col("least").alias("v"))
    prints = least.where("kind = 0").select(F.col("key").alias("fp"), "least")
    edges, paths = simhash.links(prints.select("fp"))
    linked = edges.join(prints.select(F.col("fp").alias("u"), F.col("least").alias("a")), "u").join(prints.select(F.col("fp").alias("v"), F.col("least").alias("b")), "v")
    out, b = stage(stars.union(linked.select(F.greatest("a", "b"), F.least("a", "b"))).distinct(), "similar-first")
    drop(spark, a, *paths)
    return out, [b]


def groups_of(batches, keys: int, cap: int):
    """(members, whole) for the groups of equal leading columns in a sorted stream, as arrays (columns, members); in pieces beyond cap."""
    held, over = None, False
    for b in batches:
        if not b.num_rows:
            continue
        now = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns])
        if held is not None:
            now = np.concatenate([held, now], 1)
        cuts = np.flatnonzero((now[:keys, 1:] != now[:keys, :-1]).any(0)) + 1
        edges = np.concatenate(([0], cuts))
        held = now[:, edges[-1] :]
        for a, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if z - a > 1 or over:
                yield now[:, a:z], not over and z - a <= cap
            over = False
        if held.shape[1] > cap:
            yield held[:, :-1], False
            held, over = held[:, -1:], True
    if held is not None and (held.shape[1] > 1 or over):
        yield held, not over and held.shape[1] <= cap


def pairs_of(n, sid, at, root, bits, similarity: float, side=None):
    """(u, v, sizes, places) arrays, u > v, of the possible pairs, of different groups (and sides, if given), of sets in order of size."""
    if (root == root[0]).all():
        return
    for i in range(len(n) - 1):
        j = partners(i, n, at, root, similarity)
        if side is not None:
            j = j[side[j] != side[i]]
        if len(j):
            j = j[near(n[i], n[j], bits[:, i : i + 1], bits[:, j], similarity)]
        if len(j):
            i_first = sid[i] > sid[j]
            yield tuple(x for c in (sid, n, at) for x in (np.where(i_first, c[i], c[j]), np.where(i_first, c[j], c[i])))


def partners(i: int, n, at, root, similarity: float) -> np.ndarray:
    """The later sets of a meeting, in order of size, that set i may be linked to and that are of another group."""
    j = np.arange(i + 1, np.searchsorted(n, n[i] / similarity + 1e-6, "right"))
    return j[(root[j] != root[i]) & possible(n[i], at[i], n[j], at[j], similarity)]


def partnered(n, at, root, similarity: float) -> np.ndarray:
    """Which sets of a meeting, in order of size, have one they may be linked to."""
    out = np.zeros(len(n), bool)
    if (root != root[0]).any():
        for i in range(len(n) - 1):
            if len(j := partners(i, n, at, root, similarity)):
                out[i] = True
                out[j] = True
    return out


def batched(found, names: list[str]):
    """Record batches of about PAIRS rows of a stream of arrays."""
    held, size = [], 0
    for cols in found:
        held.append(cols)
        size += len(cols[0])
        if size > PAIRS:
            yield joined(held, names)
            held, size = [], 0
    if held:
        yield joined(held, names)


def joined(held: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*held, strict=True)], names)


def longs(names: list[str]) -> str:
    return ", ".join(f"{c} long" for c in names)


PAIR, POSTING = ["u", "v", "nu", "nv", "au", "av"], ["key", "n", "sid", "at", "root"]


def meetings(postings: DataFrame, similarity: float) -> tuple[DataFrame, str]:
    """Of staged filed(), the rows of sets that meet one of another group to which they may be linked, and all rows of meetings of over BLOCK sets."""

    def meet(batches):
        def found():
            for g, whole in groups_of(batches, 1, BLOCK):
                own = g[:, partnered(g[1], g[3], g[4], similarity)] if whole else g
                if own.shape[1]:
                    yield tuple(own)

        return batched(found(), POSTING)

    with wide_batches(postings.sparkSession):
        return stage(postings.select(*POSTING).repartition(F.col("key")).sortWithinPartitions("key", "n", "sid").mapInArrow(meet, longs(POSTING)), "similar-met")


def central_pairs(met: DataFrame, similarity: float) -> tuple[DataFrame, str]:
    """Pairs (u, v), u > v, of each set and the centre of its meeting, that of least place, where they may be linked: one for each row at most."""
    centres, a = stage(met.groupBy("key").agg(F.min(F.struct("at", "sid", "n", "root")).alias("x")).select("key", *(F.col(f"x.{c}").alias(f"c_{c}") for c in ("at", "sid", "n", "root"))), "similar-centres")
    able = f"least(n, c_n) >= {similarity!r}D * greatest(n, c_n) - 1e-9D AND least(n - at, c_n - c_at) >= ceil({similarity / (1 + similarity)!r}D * (n + c_n) - 1e-9D)"
    pairs = met.join(centres, "key").where("root <> c_root").where(able).select(F.greatest("sid", "c_sid").alias("u"), F.least("sid", "c_sid").alias("v"))
    out, b = stage(pairs.distinct(), "similar-central")
    drop(met.sparkSession, a)
    return out, b


def rest_pairs(met: DataFrame, sets: DataFrame, similarity: float) -> tuple[DataFrame, str]:
    """Every pair (u, v) of different groups that may be linked, from meetings() and its sets (sid, root, *BITS), all staged.

    A pair that has met c times, last at these places, shares c shingles and at most what follows.  Meetings that are dropped as too
    late follow all that are kept, so they are counted in what follows.
    """
    spark = met.sparkSession
    rooted, a = stage(met.select("key", "n", "sid", "at").join(sets.select("sid", "root"), "sid"), "similar-rooted")
    mixed, b = stage(rooted.groupBy("key").agg(F.count("*").alias("c"), F.min("root").alias("a"), F.max("root").alias("z")).where("a < z").select("key", F.ceil(F.col("c") / BLOCK).alias("blocks")), "similar-mixed")
    apart, c = stage(rooted.join(mixed, "key"), "similar-apart")

    def across(batches):
        def found():
            for g, _ in groups_of(batches, 3, 1 << 40):
                lo, hi, n, sid, at, root, own = g[1], g[2], *g[3:8]
                yield from pairs_of(n, sid, at, root, g[8:], similarity, own if lo[0] != hi[0] else None)

        return batched(found(), PAIR)

    own = F.pmod(F.xxhash64("sid"), F.col("blocks")).alias("own")
    cut = apart.join(sets.drop("root"), "sid").select(*POSTING, own, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"), *BITS)
    cut = cut.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "n", "sid", "at", "root", "own", *BITS)
    with wide_batches(spark):
        all_met, d = stage(cut.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "n", "sid").mapInArrow(across, longs(PAIR)), "similar-across")
    bound = F.expr(f"c + least(nu - 1 - au, nv - 1 - av) >= ceil({similarity / (1 + similarity)!r}D * (nu + nv) - 1e-9D)")
    pairs = all_met.groupBy("u", "v", "nu", "nv").agg(F.count("*").alias("c"), F.max("au").alias("au"), F.max("av").alias("av")).where(bound).select("u", "v")
    out, e = stage(pairs, "similar-rest")
    drop(spark, a, b, c, d)
    return out, e


def grouped(scan: Scan) -> tuple[DataFrame, str]:
    """(node, root) of the sets that have a link; and its path."""
    spark, similarity = scan.spark, scan.similarity
    marks, a = scan.marks()
    often = frequent_keys(marks)
    first, b = first_pairs(marks)
    drop(spark, a)
    forget(spark)
    edges, c = scan.verified(first)
    forget(spark)
    roots, d = components(edges)
    drop(spark, *b, c)
    postings, a = scan.filed(roots, often)
    met, b = meetings(postings, similarity)
    drop(spark, a)
    forget(spark)
    roots, d = joined_roots(scan, roots, d, *central_pairs(met, similarity))
    wanted, a = stage(met.select("sid").distinct(), "similar-wanted")
    bits, c = scan.parities(wanted)
    sets, e = stage(bits.join(roots.withColumnRenamed("node", "sid"), "sid", "left").select("sid", F.coalesce("root", "sid").alias("root"), *BITS), "similar-rooted-bits")
    drop(spark, a, c)
    pairs, a = rest_pairs(met, sets, similarity)
    drop(spark, b, e)
    forget(spark)
    return joined_roots(scan, roots, d, pairs, a)


def joined_roots(scan: Scan, roots: DataFrame, roots_at: str, pairs: DataFrame, pairs_at: str) -> tuple[DataFrame, str]:
    """The roots once the linked ones of staged pairs are added; what was read is dropped."""
    more, a = scan.verified(pairs)
    out, b = components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).union(more))
    drop(scan.spark, roots_at, pairs_at, a)
    return out, b


def one_each(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class, the one of smallest id (then by place), every column as it was."""
    spark = docs.sparkSession
    rows, ident, _ = with_row_id(docs)

    def digests(b: pa.RecordBatch) -> pa.RecordBatch:
        of = [xxhash.xxh3_128_digest(b" ".join(t.translate(LOWER).split())) for t in utf8(b.column(3))]
        return pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(of, pa.binary())], ["id", "file", "row", "words"])

    named_rows = rows.select(F.col(named(key)).alias("id"), F.col(ident[0]).alias("file"), F.col(ident[1]).alias("row"), F.col(named(text)))
    prints = map_batches(named_rows, digests, f"id {dict(docs.dtypes)[key]}, file string, row long, words binary")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "file", "row")
    distinct, a = stage(prints.groupBy("words").agg(F.min(rank).alias("first")).select("first", F.monotonically_increasing_id().alias("sid")), "distinct")
    places, b = stage(distinct.select("first.file", "first.row", "sid"), "similar-places")
    roots, c = grouped(Scan(rows, ident, text, places, size, similarity))
    rooted = distinct.join(roots.withColumnRenamed("node", "sid"), "sid", "left").select(F.coalesce("root", "sid").alias("root"), "first")
    keep = write_side(rooted.groupBy("root").agg(F.min("first").alias("least")).select("least.file", "least.row", F.lit(True).alias("value")), "kept")
    drop(spark, a, b, c)
    return keep_side(rows, ident, docs.columns, keep)
