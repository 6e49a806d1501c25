"""Operator 8, URL filters: rules, then exact membership of a list by a cascade of Bloom filters.

A key is host and path.  Level 1 holds the listed keys; level 2 the keys of the corpus that level 1 takes falsely; level 3 the
listed keys that level 2 takes falsely; and so on until a level takes none falsely.  For every key of the universe the first level
that refuses it tells the answer, so the filter is exact there and no page needs a join.

Levels are built of 64-bit words that Spark merges with bit_or.  They are written to the shared folder by shard of the key's
hash, so many that a shard holds about SHARD_KEYS listed keys, and as many of the universe's keys that level 1 takes falsely, at most (about 0.5 MB each).
So whatever is in a worker's memory has a bound that follows from the counts of both; beyond HELD_SHARDS shards the keys (not the pages) are dealt by shard first.  Keys are told apart by 128 bits of hash.

Null url, or one without ://, has an empty host and path, which is a key like any other.  Repeated rows are all judged; an
empty table gives no rows.  A very long url is only hashed.  The list is any table of hosts and paths.  Columns besides the id and the url are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import bound_batches, drop, new_path, open_fs, stage, table
from quire.llm.tokenbin import put

# The rules as (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
SHARD_KEYS, HELD_SHARDS = 200_000, 16
#: False positives of the first level and of later ones; hashes of a level follow.
FIRST, LATER = 1 / 256, 1 / 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    rest = F.coalesce(F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))), F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def ruled(host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for what, h, p in sorted(RULES, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def shape(n: int, rate: float) -> tuple[int, int]:
    """Bits (a multiple of 64) and hashes of a filter of n keys."""
    k = max(1, round(np.log2(1 / rate)))
    return max(64, -(-int(n * k * 1.4427 + 1) // 64) * 64), k


def spots(h: np.ndarray, g: np.ndarray, level: int, bits: int, k: int) -> np.ndarray:
    """(keys, k) bit numbers, other ones for each level."""
    with np.errstate(over="ignore"):
        a = (h ^ np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
        a ^= a >> np.uint64(31)
        b = ((g + np.uint64(level)) * np.uint64(0x94D049BB133111EB)) | np.uint64(1)
        x = a[:, None] + b[:, None] * np.arange(k, dtype=np.uint64)[None, :]
        x ^= x >> np.uint64(29)
    return x % np.uint64(bits)


@lru_cache(HELD_SHARDS * 40)
def level_words(root: str, shard: int, level: int) -> tuple[np.ndarray, int] | None:
    fs, folder = open_fs(root)
    try:
        with fs.open_input_file(f"{folder}/{level:02d}-{shard:06d}.bloom") as f:
            raw = f.read()
    except FileNotFoundError:
        return None
    return np.frombuffer(raw, "<u8", offset=8), int.from_bytes(raw[:8], "little")


def taken(root: str, shard: int, level: int, h: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Which keys a level's filter holds; a shard without that level holds none."""
    own = level_words(root, shard, level)
    if own is None:
        return np.zeros(len(h), bool)
    words, k = own
    at = spots(h, g, level, len(words) * 64, k)
    return ((words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).all(1)


def columns(b: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [b.column(b.schema.names.index(n)).to_numpy(zero_copy_only=False) for n in names]


def by_shard(s: np.ndarray):
    for x in np.unique(s).tolist():
        yield x, np.flatnonzero(s == x)


def build(universe: DataFrame, root: str) -> int:
    """Write the cascade of (h, g, shard, listed), a staged frame of the distinct keys, and return the number of levels."""
    spark = universe.sparkSession
    fs, folder = open_fs(root)
    fs.create_dir(folder, recursive=True)
    sides = {True: universe.where("listed"), False: universe.where("NOT listed")}
    paths: dict[bool, str | None] = {True: None, False: None}
    level = 0
    while True:
        level += 1
        side = level % 2 == 1
        own = sides[side]
        sizes = own.groupBy("shard").count()
        if own.isEmpty():
            break
        rate = FIRST if level == 1 else LATER

        def bits_of(batches, level=level, rate=rate):
            for b in batches:
                h, g, s, n = columns(b, "h", "g", "shard", "n")
                for x, rows in by_shard(s):
                    m, k = shape(int(n[rows[0]]), rate)
                    at = np.unique(spots(h[rows].view(np.uint64), g[rows].view(np.uint64), level, m, k))
                    word, bit = (at >> np.uint64(6)).astype(np.int64), (np.uint64(1) << (at & np.uint64(63))).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), x), pa.int32()), pa.array(word), pa.array(bit), pa.array(np.full(len(at), m), pa.int64()), pa.array(np.full(len(at), k), pa.int64())], ["shard", "word", "bit", "m", "k"])

        def save(batches, level=level):
            fs, folder = open_fs(root)
            now, words, k = None, None, 0

            def out():
                put(fs, f"{folder}/{level:02d}-{now:06d}.bloom", int(k).to_bytes(8, "little") + words.tobytes())

            for b in batches:
                s, w, v, m, ks = columns(b, "shard", "word", "bit", "m", "k")
                for x, rows in by_shard(s):
                    if x != now:
                        if now is not None:
                            out()
                        now, words, k = x, np.zeros(int(m[rows[0]]) // 64, np.uint64), int(ks[rows[0]])
                    words[w[rows]] |= v[rows].view(np.uint64)
            if now is not None:
                out()
            yield pa.RecordBatch.from_arrays([pa.array([0 if now is None else 1], pa.int64())], ["done"])

        counted = own.join(sizes.withColumnRenamed("count", "n"), "shard")
        words = counted.select("h", "g", "shard", "n").mapInArrow(bits_of, "shard int, word long, bit long, m long, k long").groupBy("shard", "word").agg(F.expr("bit_or(bit)").alias("bit"), F.max("m").alias("m"), F.max("k").alias("k"))
        words.repartition("shard").sortWithinPartitions("shard", "word").mapInArrow(save, "done long").agg(F.sum("done")).collect()

        def falsely(batches, level=level):
            for b in batches:
                h, g, s = columns(b, "h", "g", "shard")
                keep = np.zeros(len(h), bool)
                for x, rows in by_shard(s):
                    keep[rows] = taken(root, x, level, h[rows].view(np.uint64), g[rows].view(np.uint64))
                yield b.filter(pa.array(keep))

        other, at = stage(sides[not side].select("h", "g", "shard", "listed").mapInArrow(falsely, "h long, g long, shard int, listed boolean"), "cascade")
        if paths[not side]:
            drop(spark, paths[not side])
        sides[not side], paths[not side] = other, at
        if level > 64:
            raise ValueError("two keys share all hashes")
    drop(spark, *filter(None, paths.values()))
    return level - 1


def listed_in(root: str, levels: int, shard: int, h: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Membership of keys of the universe: the first level that refuses tells."""
    out = np.zeros(len(h), bool)
    alive = np.arange(len(h))
    for level in range(1, levels + 1):
        held = taken(root, shard, level, h[alive], g[alive])
        out[alive[~held]] = level % 2 == 0
        alive = alive[held]
        if not len(alive):
            return out
    out[alive] = levels % 2 == 1
    return out


def hashed(pages: DataFrame, key: str, url: str) -> DataFrame:
    host, path = host_path(F.col(url))
    both = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    return both.withColumns({"h": F.xxhash64(F.lit(1), "host", "path"), "g": F.xxhash64("path", F.lit(2), "host")})


def repeated(pages: DataFrame, url: str = "url", least: int = 2) -> DataFrame:
    """The production list: keys (host, path) under which the corpus holds several rows, as crawler traps give."""
    host, path = host_path(F.col(url))
    return pages.select(host.alias("host"), path.alias("path")).groupBy("host", "path").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("host", "path")


def judge(pages: DataFrame, listed: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict): a rule's verdict, else block for listed keys and allow for all others."""
    spark = pages.sparkSession
    bound_batches(spark)
    marks, a = stage(listed.select("host", "path").distinct().select(F.xxhash64(F.lit(1), "host", "path").alias("h"), F.xxhash64("path", F.lit(2), "host").alias("g"), F.lit(True).alias("listed")), "listed")
    own, c = stage(hashed(pages, key, url).select("h", "g").distinct(), "universe-keys")
    shards = max(1, -(-marks.count() // SHARD_KEYS), -(-int(own.count() * FIRST) // SHARD_KEYS))
    keys = hashed(pages, key, url).withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))
    universe, b = stage(own.join(marks, ["h", "g"], "full").select("h", "g", F.pmod("h", F.lit(shards)).cast("int").alias("shard"), F.coalesce("listed", F.lit(False)).alias("listed")), "universe")
    drop(spark, c)
    root = new_path(spark, "cascade-filters")
    levels = build(universe, root)
    drop(spark, a, b)
    rule, verdict = ruled(F.col("host"), F.col("path"))
    rows = keys.select(key, "host", "path", rule.alias("rule"), verdict.alias("ruled"), "h", "g", "shard")
    if shards > HELD_SHARDS:
        rows = rows.repartition("shard", F.pmod(F.xxhash64(key), F.lit(64)))

    def decide(batches):
        for b in batches:
            h, g, s = columns(b, "h", "g", "shard")
            hit = np.zeros(len(h), bool)
            for x, at in by_shard(s):
                hit[at] = listed_in(root, levels, x, h[at].view(np.uint64), g[at].view(np.uint64))
            own = [r or ("block" if x else "allow") for r, x in zip(b.column(4).to_pylist(), hit.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(own, pa.string())], [*b.schema.names[:4], "verdict"])

    return rows.mapInArrow(decide, f"`{key}` {dict(pages.dtypes)[key]}, host string, path string, rule string, verdict string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judge(pages, repeated(pages))


SQL = """
    WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    k AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(substr(coalesce(rest, ''), length(regexp_extract(coalesce(rest, ''), '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM r),
    f AS (SELECT *, count(*) OVER (PARTITION BY host, path) AS n, CASE
      WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM k)
    SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN n >= 2 THEN 'block' ELSE 'allow' END AS verdict FROM f
"""
