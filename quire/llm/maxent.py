"""Operator 7, language-model scoring with a hashed maximum-entropy model and class-factored softmax.

P(token | history) = P(class | history) * P(token | class).  The class is predicted by a softmax whose logits sum
hashed feature weights: a bias, the previous word (n-gram), the word two back (skip), the pair of both, and the word
three back (skip).
Classes group the vocabulary by the spelling of its words (k-means over character trigrams) and then by frequency; words below the TOP most frequent, and unknown ones, fall in the tail class of the
group that their last two bytes point to.  P(token | class) is the smoothed relative frequency of the training tokens.

Training: in each of ROUNDS rounds every task takes its share of the training documents and makes gradient updates on minibatches
of sparse features in numpy, starting from the weights of the round before; the weights of all tasks are averaged block
by block, weighted by tokens, in a shuffle of two levels.  All training tokens are used for counts and for gradients.

Frequent words, classes and weights have a fixed size and are broadcast.  Counts of tail words grow with the corpus: they stay a
table, and the scores of tail tokens are completed by a join on the word's hash (a tail word is below the TOP-th in
frequency, so no key of that join is hot).

A very long text is coded whole, with memory in proportion to itself, and scored in batches.
Null text is empty: it scores its end token.  Repeated rows are each learnt and scored; a null id counts as the text ''
for the split.  Without training documents all tokens are unknown and scores are those of smoothing alone.  Columns besides the id and the
text are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import bound_batches, drop, map_batches, stage, table, utf8
from quire.llm.simhash import LOWER

#: Words with a place of their own, spelling groups, and frequency bins within a group.
TOP, GROUPS, BINS = 16_384, 8, 6
#: Hash buckets (a power of two) of each feature kind, kinds (previous, skip 2, pair, skip 3), rounds, tokens in a minibatch, rate.
BUCKETS, KINDS, ROUNDS, BATCH, RATE = 4096, 4, 2, 8192, 0.2
FOLDS, HELD_OUT = 5, 1
DIMS = 256
#: Distinct words whose counts a task holds, and rows of weights in a block of the averaging shuffle.
HELD, BLOCK = 300_000, 512
END = b""


def words(b: bytes) -> list[bytes]:
    """The words of a text, lower-cased, without the end."""
    return b.translate(LOWER).split()


def held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS == HELD_OUT


def word_hash(w: bytes) -> int:
    return xxhash.xxh64_intdigest(w, 7) - (1 << 63)


def spelling(ws: list[bytes]) -> np.ndarray:
    """Unit vectors of hashed character trigrams (of bytes, with word ends)."""
    out = np.zeros((len(ws), DIMS), np.float32)
    for i, w in enumerate(ws):
        p = b"^" + w[:64] + b"$"
        for j in range(len(p) - 2):
            out[i, (p[j] * 31 + p[j + 1] * 17 + p[j + 2] * 7) % DIMS] += 1
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def centroids(vectors: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """Weighted spherical k-means, started at far-apart vectors in order: the same for the same input."""
    if not len(vectors):
        return np.eye(k, DIMS, dtype=np.float32)
    chosen = [int(np.argmax(weights))]
    near = vectors @ vectors[chosen[0]]
    while len(chosen) < k:
        chosen.append(int(np.argmax((1 - near) * np.sqrt(weights))))
        near = np.maximum(near, vectors @ vectors[chosen[-1]])
    c = vectors[chosen].copy()
    for _ in range(12):
        own = np.argmax(vectors @ c.T, 1)
        for g in range(k):
            mean = (vectors[own == g] * np.sqrt(weights[own == g])[:, None]).sum(0)
            c[g] = mean / max(float(np.linalg.norm(mean)), 1e-9)
    return c


@dataclass
class Vocabulary:
    """What is broadcast: fixed in size whatever the corpus."""

    ids: dict[bytes, int]  # of the top words; the end of text is one of them
    counts: np.ndarray  # of the top words
    classes: np.ndarray  # class of each top word, then of each group's tail
    endings: dict[bytes, int]
    total: int
    distinct: int
    within: np.ndarray  # log10 P(word | class) of the top words
    tail: np.ndarray  # tokens and distinct words of each group's tail
    n_classes: int

    def group(self, w: bytes) -> int:
        return self.endings.get(w[-2:], 0)


def endings(ws: list[bytes], own: np.ndarray, n: np.ndarray) -> dict[bytes, int]:
    """The group that most tokens of each two-byte ending belong to, among the top words; it places tail words."""
    sums: dict[bytes, np.ndarray] = {}
    for w, g, c in zip(ws, own.tolist(), n.tolist(), strict=True):
        sums.setdefault(w[-2:], np.zeros(GROUPS))[g] += c
    return {e: int(np.argmax(x)) for e, x in sums.items()}


def count_words(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(w, n): partial counts of training tokens by task, and the ends of texts under the empty word."""

    def run(batches):
        held: Counter = Counter()

        def out():
            flat = list(held.items())
            for at in range(0, len(flat), 50_000):
                w, n = zip(*flat[at : at + 50_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(w, pa.binary()), pa.array(n, pa.int64())], ["w", "n"])

        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), utf8(b.column(1)), strict=True):
                if not held_out(k):
                    held.update(words(t))
                    held[END] += 1
            if len(held) > HELD:
                yield from out()
                held.clear()
        yield from out()

    bound_batches(docs.sparkSession)
    return docs.select(key, text).mapInArrow(run, "w binary, n long")


def tail_groups(counts: DataFrame, ids, ends: dict[bytes, int]) -> DataFrame:
    """(h, n, g) of the words that aren't among the top."""

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(w, n) for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if w not in ids.value]
        ws = [w for w, _ in rows]
        return pa.RecordBatch.from_arrays([pa.array([word_hash(w) for w in ws], pa.int64()), pa.array([n for _, n in rows], pa.int64()), pa.array([ends.get(w[-2:], 0) for w in ws], pa.int32())], ["h", "n", "g"])

    return map_batches(counts, fn, "h long, n long, g int")


def least_of_top(counts: DataFrame) -> int:
    """A count that at least TOP words reach, and few others: with it tasks don't each send TOP words to be ranked."""
    left, least = TOP, 1
    for r in counts.groupBy(F.floor(F.log2("n") * 16).alias("band")).agg(F.count("*").alias("c"), F.min("n").alias("n")).orderBy(F.desc("band")).collect():
        left, least = left - r.c, r.n
        if left <= 0:
            return least
    return 1


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, DataFrame, str]:
    """The vocabulary of a staged (w, n) table, and the staged tail (h, n, g)."""
    spark = counts.sparkSession
    total, distinct = counts.agg(F.sum("n"), F.count("*")).first()
    top = [(bytes(r.w), r.n) for r in counts.where(F.col("n") >= least_of_top(counts)).orderBy(F.desc("n"), "w").limit(TOP).collect()]
    ids = {w: i for i, (w, _) in enumerate(top)}
    n = np.array([c for _, c in top], np.float64)
    vectors = spelling([w for w, _ in top])
    centres = centroids(vectors, n, GROUPS)
    own = np.argmax(vectors @ centres.T, 1) if top else np.zeros(0, np.int64)
    ends = endings([w for w, _ in top], own, n)
    shared = spark.sparkContext.broadcast(set(ids))
    tail, at = stage(tail_groups(counts, shared, ends), "tail")
    sums = np.zeros((GROUPS, 2))
    for r in tail.groupBy("g").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        sums[r.g] = r.n, r.v
    classes = np.zeros(len(top) + GROUPS, np.int64)
    for g in range(GROUPS):
        mine = np.flatnonzero(own == g)  # by falling frequency
        if len(mine):
            share = (np.cumsum(n[mine]) - n[mine] / 2) / n[mine].sum()
            classes[mine] = g * (BINS + 1) + np.minimum((np.sqrt(share) * BINS).astype(np.int64), BINS - 1)
        classes[len(top) + g] = g * (BINS + 1) + BINS
    mass = np.bincount(classes[: len(top)], n, GROUPS * (BINS + 1))
    within = np.log10(n / mass[classes[: len(top)]]) if top else np.zeros(0)
    return Vocabulary(ids, n.astype(np.int64), classes, ends, int(total or 0), int(distinct), within, sums, GROUPS * (BINS + 1)), tail, at


class Coder:
    """Words to codes: the place of a top word, or TOP + group for others.

    Both tables are small enough for a core's cache; a larger one of tail words is slower than their endings.
    """

    def __init__(self, v: Vocabulary):
        self.v, self.n = v, len(v.ids)
        self.tail = {e: self.n + g for e, g in v.endings.items()}

    def codes(self, b: bytes) -> tuple[np.ndarray, list[bytes]]:
        ws = words(b)
        ws.append(END)
        code = np.fromiter(map(self.v.ids.get, ws, repeat(-1)), np.int64, len(ws))
        rest, tail = np.flatnonzero(code < 0), self.tail.get
        code[rest] = [tail(ws[i][-2:], self.n) for i in rest.tolist()]
        return code, ws


CODERS: dict[int, Coder] = {}


def coder(shared) -> Coder:
    key = id(shared.value)
    if key not in CODERS:
        CODERS.clear()
        CODERS[key] = Coder(shared.value)
    return CODERS[key]


def features(code: np.ndarray, n_codes: int) -> np.ndarray:
    """(KINDS, tokens) rows of the weight table that are active for each token of one text; n_codes stands for its beginning."""
    back = np.full((3, len(code)), n_codes, np.int64)
    for k in range(3):
        back[k, k + 1 :] = code[: len(code) - k - 1]
    mixed = np.stack([back[0], back[1] + 1_000_003, back[0] * 2_654_435_761 + back[1] * 40_503 + 7, back[2] + 5_000_011])
    with np.errstate(over="ignore"):
        h = mixed.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(40)) & np.uint64(BUCKETS - 1)).astype(np.int64) + np.arange(0, KINDS * BUCKETS, BUCKETS)[:, None]


ROOMS: dict[str, np.ndarray] = {}


def room(name: str, shape: tuple[int, int], kind) -> np.ndarray:
    """An array to be written over, kept from one minibatch to the next: fresh megabytes cost more to map than to fill."""
    size, held = shape[0] * shape[1], ROOMS.get(name)
    if held is None or held.size < size or held.dtype != kind:
        held = ROOMS[name] = np.empty(size, kind)
    return held[:size].reshape(shape)


def logits(w: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Class scores; the last row of w is the bias."""
    z = w.take(f[0], 0)
    z += w[-1]
    own = room("logits", z.shape, w.dtype)
    for k in range(1, KINDS):
        z += w.take(f[k], 0, out=own, mode="clip")
    return z


def softmax(z: np.ndarray) -> np.ndarray:
    z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(1, keepdims=True)
    return z


def update(w: np.ndarray, squares: np.ndarray, f: np.ndarray, y: np.ndarray) -> None:
    """One adaptive gradient step on a minibatch, touching the rows of its active features only."""
    p = softmax(logits(w, f))
    p[np.arange(len(y)), y] -= 1
    w[-1] -= RATE * (g := p.mean(0)) / np.sqrt(squares[-1] + (g * g).sum() + 1e-8)
    squares[-1] += (g * g).sum()
    wide, mine = room("wide", p.shape, np.float64), room("mine", p.shape, np.float64)
    wide[:] = p
    for k in range(KINDS):
        own = f[k] - k * BUCKETS
        order = np.argsort(own.astype(np.uint16), kind="stable")  # a radix sort; BUCKETS fit 16 bits
        own = own[order]
        first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        g = (np.add.reduceat(wide.take(order, 0, out=mine, mode="clip"), first, axis=0) / len(y)).astype(np.float32)
        rows = own[first] + k * BUCKETS
        squares[rows] += (g * g).mean(1)
        w[rows] -= RATE * 0.5 * g / np.sqrt(squares[rows] + 1e-8)[:, None]


def start_weights(v: Vocabulary) -> np.ndarray:
    mass = np.bincount(v.classes[: len(v.ids)], v.counts, v.n_classes).astype(float)
    mass[np.arange(GROUPS) * (BINS + 1) + BINS] += v.tail[:, 0]
    w = np.zeros((KINDS * BUCKETS + 1, v.n_classes), np.float32)
    w[-1] = np.log((mass + 0.5) / (mass.sum() + 0.5 * v.n_classes))
    return w


def train(docs: DataFrame, key: str, text: str, v: Vocabulary, shared) -> np.ndarray:
    """Weights after ROUNDS rounds; round r takes the training documents whose crc32 falls to it."""
    spark = docs.sparkSession
    w = start_weights(v)
    shape = w.shape
    for r in range(ROUNDS):
        now = spark.sparkContext.broadcast(w)

        def run(batches, r=r, now=now):
            code_of, own, squares = coder(shared), now.value.copy(), np.full(shape[0], 1e-6, np.float32)
            fs, ys, held, seen = [], [], 0, 0
            for b in batches:
                for k, t in zip(b.column(0).to_pylist(), utf8(b.column(1)), strict=True):
                    if held_out(k) or zlib.crc32(str(k).encode()) // FOLDS % ROUNDS != r:
                        continue
                    code, _ = code_of.codes(t)
                    fs.append(features(code, code_of.n + GROUPS))
                    ys.append(code_of.v.classes[code])
                    held += len(code)
                    if held >= BATCH:
                        f, y = np.concatenate(fs, 1), np.concatenate(ys)
                        for at in range(0, len(y), BATCH):
                            update(own, squares, f[:, at : at + BATCH], y[at : at + BATCH])
                        seen, fs, ys, held = seen + held, [], [], 0
            if held:
                update(own, squares, np.concatenate(fs, 1), np.concatenate(ys))
                seen += held
            if seen:
                blocks = [own[at : at + BLOCK].tobytes() for at in range(0, shape[0], BLOCK)]
                n = len(blocks)
                yield pa.RecordBatch.from_arrays([pa.array(range(n), pa.int32()), pa.array([zlib.crc32(blocks[0]) % 32] * n, pa.int32()), pa.array([seen] * n, pa.int64()), pa.array(blocks, pa.binary())], ["block", "half", "n", "w"])

        def mean(batches):
            """Weighted means of a sorted stream of (block, half, n, w)."""
            key_, total, acc = None, 0, None

            def out():
                return pa.RecordBatch.from_arrays([pa.array([key_[0]], pa.int32()), pa.array([key_[1]], pa.int32()), pa.array([total], pa.int64()), pa.array([(acc / total).astype(np.float32).tobytes()], pa.binary())], ["block", "half", "n", "w"])

            for b in batches:
                for block, half, n, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if (block, half) != key_:
                        if key_ is not None:
                            yield out()
                        key_, total, acc = (block, half), 0, 0.0
                    acc = acc + np.frombuffer(raw, np.float32).astype(np.float64) * n
                    total += n
            if key_ is not None:
                yield out()

        schema = "block int, half int, n long, w binary"
        parts = docs.select(key, text).mapInArrow(run, schema)
        for level in range(2):
            halves = F.col("half") if level == 0 else F.lit(0)
            parts = parts.withColumn("half", halves.cast("int")).repartition("block", "half").sortWithinPartitions("block", "half", "n", "w").mapInArrow(mean, schema)
        got = {x.block: np.frombuffer(x.w, np.float32) for x in parts.collect()}
        if got:
            w = np.concatenate([got[i] for i in sorted(got)]).reshape(shape).copy()
        now.unpersist()
    return w


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of each document."""
    spark = docs.sparkSession
    docs = docs.select(key, text)
    counts, a = stage(count_words(docs, key, text).groupBy("w").agg(F.sum("n").alias("n")), "words")
    v, tail, _ = vocabulary(counts)
    shared = spark.sparkContext.broadcast(v)
    weights = spark.sparkContext.broadcast(train(docs, key, text, v, shared))
    total, low = v.total, v.total + 0.5 * (v.distinct + 1)
    smooth = v.tail[:, 0] + 0.5 * (v.tail[:, 1] + 1)

    def run(batches):
        code_of, w = coder(shared), weights.value
        top, classes = code_of.n, code_of.v.classes
        base = np.log10((np.concatenate([code_of.v.counts, np.zeros(GROUPS + 1)]) + 0.5) / low)
        within = np.concatenate([code_of.v.within, np.zeros(GROUPS)])
        for b in batches:
            rows, tails = [], []
            for k, t in zip(b.column(0).to_pylist(), utf8(b.column(1)), strict=True):
                code, ws = code_of.codes(t)
                known = code < top
                f, y, s = features(code, top + GROUPS), classes[code], 0.0
                for at in range(0, len(y), BATCH):
                    z = logits(w, f[:, at : at + BATCH])
                    z -= z.max(1, keepdims=True)
                    mine = z[np.arange(len(z)), y[at : at + BATCH]].astype(np.float64)
                    s += float((mine - np.log(np.exp(z, out=z).sum(1, dtype=np.float64))).sum())
                lone = int(not known[-1])  # the end where nothing was learnt
                tails.append(Counter([ws[i] for i in np.flatnonzero(~known[:-1]).tolist()]))
                rows.append((k, held_out(k), len(code), int(known.sum()), float(base[code[known]].sum()) + lone * float(base[-1]), s / np.log(10) + float(within[code].sum())))
            cols = list(zip(*rows, strict=True)) or [()] * 6
            of, ends = [x for t in tails for x in t], code_of.v.endings.get
            items = [pa.array([word_hash(x) for x in of], pa.int64()), pa.array([ends(x[-2:], 0) for x in of], pa.int32()), pa.array([c for t in tails for c in t.values()], pa.int64())]
            rest = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, tails)]), pa.int32()), pa.StructArray.from_arrays(items, ["h", "g", "n"]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cols[1], pa.bool_()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.float64()), pa.array(cols[5], pa.float64()), rest], [key, "held_out", "n_tokens", "top", "base", "part", "rest"])

    scored = docs.mapInArrow(run, f"`{key}` {dict(docs.dtypes)[key]}, held_out boolean, n_tokens long, top long, base double, part double, rest array<struct<h:long,g:int,n:long>>")
    parts, _ = stage(scored.withColumn("_row", F.monotonically_increasing_id()), "scored")
    rest = parts.select("_row", F.explode("rest").alias("x")).select("_row", F.col("x.h").alias("h"), F.col("x.g").alias("g"), F.col("x.n").alias("tf"))
    c = F.coalesce(F.col("n"), F.lit(0))
    mass = F.element_at(F.array(*(F.lit(float(x)) for x in smooth)), F.col("rest.g") + 1)
    done = (
        rest.alias("rest").join(tail.select("h", "n"), "h", "left")
        .groupBy("_row")
        .agg(F.sum(F.when(c > 0, F.col("tf")).otherwise(0)).alias("known"), F.sum(F.col("tf") * F.log10((c + 0.5) / F.lit(low))).alias("more_base"), F.sum(F.col("tf") * F.log10((c + 0.5) / mass)).alias("more"))
    )
    drop(spark, a)
    zero = lambda x: F.coalesce(F.col(x), F.lit(0))
    return parts.drop("rest").join(done, "_row", "left").select(
        key, "held_out", "n_tokens", (F.col("top") + zero("known")).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + zero("more_base")).alias("base_score"), (F.col("part") + zero("more")).alias("score")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
