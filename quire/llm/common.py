"""What the training-data operators share: staging, side files, range sharding, Arrow maps."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Upper limits of an Arrow batch handed to Python; long texts make rows the wrong unit.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ROWS_CONF, BYTES_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by rows and bytes so that very long texts can't fill a worker.

    Spark reads both when a plan runs, which for a returned frame is after its operator, so they stay set.
    """
    spark.conf.set(ROWS_CONF, str(BATCH_ROWS))
    spark.conf.set(BYTES_CONF, str(BATCH_BYTES))


@contextmanager
def wide_batches(spark: SparkSession, rows: int = 100_000):
    """Larger batches for short rows, while a stage is written; what was set before comes back."""
    before = spark.conf.get(ROWS_CONF)
    spark.conf.set(ROWS_CONF, str(rows))
    try:
        yield
    finally:
        spark.conf.set(ROWS_CONF, before)


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where unset, a fresh local one in local mode (tests) alone."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="quire-")
        spark.sparkContext.setCheckpointDir(root)
    return root if "://" in root or root.startswith("file:") else f"file://{root}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark).rstrip('/')}/quire/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Cut lineage: write df to the shared folder as Parquet and read it back.

    Returns the frame and its path, which drop() frees.  Both sides of a later join are then plain
    scans under exchanges, so adaptive execution can split skewed partitions.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, *paths: str) -> None:
    jvm = spark.sparkContext._jvm
    for p in paths:
        at = jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def forget(spark: SparkSession) -> None:
    """Free the shuffle files of finished stages: Spark deletes them once the driver's collector finds that no plan can ask for them."""
    spark.sparkContext._jvm.System.gc()


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """A file system that a Python worker can write to, for a URI of the shared folder."""
    return pafs.FileSystem.from_uri("file://" + uri.removeprefix("file:") if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table | None], schema: str) -> DataFrame:
    """mapInArrow with one output batch for each input batch; empty batches pass through fn as well.  fn must take columns by place."""
    bound_batches(df.sparkSession)
    if any("." in c for c in df.columns):  # mapInArrow would take such a name for a field of a struct
        df = df.toDF(*(c.replace(".", "_") + f"_{i}" for i, c in enumerate(df.columns)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from as_batches(fn(b))

    return df.mapInArrow(run, schema)


def as_batches(out: pa.RecordBatch | pa.Table | None) -> list[pa.RecordBatch]:
    if out is None:
        return []
    return out.to_batches() if isinstance(out, pa.Table) else [out]


def keep_rows(df: DataFrame, verdict: Callable[[list[bytes]], list[bool]], text: str = "text") -> DataFrame:
    """Whole rows of df, every column as it was, for which verdict(texts in UTF-8; null: empty) holds."""
    where, names = df.columns.index(text), df.columns

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(b.columns, names).filter(pa.array(verdict(utf8(b.column(where))), pa.bool_()))

    return map_batches(df, fn, df.schema)


def utf8(column: pa.Array) -> list[bytes]:
    """Values of a string or binary column as bytes; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


#: Slices into which a range is cut at most, and ranges that sharding makes at most (targets grow beyond).
FAN, MOST_SHARDS = 4096, 1 << 16


class Shards:
    """Ascending ranges of a composite key of longs: a trie of equal slices, so that a look-up takes constant time.

    A node is (column, lowest value, slice width, first of its cells); a cell holds a shard (>= 0) or a child node (-1 - node).
    """

    def __init__(self, columns: int):
        self.columns, self.nodes, self.cells, self.depth, self.count, self.spread = columns, [], [], 0, 1, {}

    def number(self, keys: list[Column]) -> Column:
        """The shard of a row with these keys (no nulls)."""
        if not self.nodes:
            return F.lit(0)
        literal = lambda xs: F.from_json(F.lit("[" + ",".join(map(str, xs)) + "]"), "array<bigint>")
        col, low, width, first = (literal(x) for x in zip(*self.nodes, strict=True))
        cells, all_keys = literal(self.cells), F.array(*(k.cast("bigint") for k in keys))

        def step(at: Column, _) -> Column:
            node = (-at).cast("int")  # element_at counts from 1
            key = F.element_at(all_keys, F.element_at(col, node).cast("int") + 1)
            slice_ = F.call_function("div", key.cast("decimal(20,0)") - F.element_at(low, node).cast("decimal(20,0)"), F.element_at(width, node).cast("decimal(20,0)"))
            return F.when(at >= 0, at).otherwise(F.element_at(cells, (F.element_at(first, node) + slice_).cast("int") + 1))

        return F.aggregate(F.sequence(F.lit(1), F.lit(self.depth)), F.lit(-1).cast("bigint"), step).cast("int")


def range_shards(df: DataFrame, keys: list[Column], weight: Column, target: int) -> Shards:
    """Deterministic ascending ranges of a composite key (longs without nulls) of about `target` weight each, or MOST_SHARDS of them.

    A range is cut into equal slices of the key's span, whose weights one job sums with partial aggregation; slices above the target are cut
    again, all of a level in one job, a slice of one value by the key's next column.  So a value that many rows share is split by what follows, and only
    rows equal in all columns stay together.  The driver sees a few sums for each shard.
    """
    base = df.select(*(k.cast("long").alias(f"k{i}") for i, k in enumerate(keys)), weight.cast("double").alias("w"))
    out = Shards(len(keys))
    ends = base.agg(F.sum("w"), *(f(f"k{i}") for i in range(len(keys)) for f in (F.min, F.max))).first()
    if ends[0] is None:
        return out
    target = max(target, ends[0] / MOST_SHARDS)
    bounds = [(ends[1 + 2 * i], ends[2 + 2 * i]) for i in range(len(keys))]
    leaves: dict[int, float] = {}  # cell to weight
    todo = [(0, *bounds[0], ends[0], None)]  # column, lowest, highest, weight, cell that leads here
    while todo:
        born = []
        for col, a, b, w, cell in todo:
            while a == b and col + 1 < len(keys):
                col += 1
                a, b = bounds[col]
            n = min(FAN, max(4, int(4 * w / target)), b - a + 1)  # 4: the width of a slice stays a long
            width = -(-(b - a + 1) // n)
            n = -(-(b - a + 1) // width)
            born.append(len(out.nodes))
            if cell is not None:
                out.cells[cell] = -1 - len(out.nodes)
            out.nodes.append((col, a, width, len(out.cells)))
            out.cells += range(len(out.cells), len(out.cells) + n)  # each its own number while sums are taken
            out.spread[len(out.nodes) - 1] = (n, b)
        out.depth += 1
        fresh = out.nodes[born[0]][3]
        sums = base.select(out.number([F.col(f"k{i}") for i in range(len(keys))]).alias("cell"), "w").where(F.col("cell") >= fresh).groupBy("cell").agg(F.sum("w").alias("w")).collect()
        weights = {r.cell: r.w for r in sums}
        todo = []
        for node in born:
            col, a, width, first = out.nodes[node]
            n, b = out.spread[node]
            for c in range(n):
                w = weights.get(first + c, 0.0)
                lo, hi = a + c * width, min(b, a + (c + 1) * width - 1)
                if w > target and (lo < hi or any(bounds[i][0] < bounds[i][1] for i in range(col + 1, len(keys)))):
                    todo.append((col, lo, hi, w, first + c))
                else:
                    leaves[first + c] = w
    shard, acc = 0, 0.0

    def walk(node: int):
        first, n = out.nodes[node][3], out.spread[node][0]
        for c in range(first, first + n):
            if c in leaves:
                yield c
            else:
                yield from walk(-1 - out.cells[c])

    for c in walk(0):
        if acc and acc + leaves[c] > target:
            shard, acc = shard + 1, 0.0
        acc += leaves[c]
        out.cells[c] = shard
    out.count = shard + 1
    return out


def named(c: str) -> str:
    """A column name as an expression."""
    return "`" + c.replace("`", "``") + "`"


def fresh(taken: list[str], *names: str) -> list[str]:
    """Names like these that no column has."""
    low = {t.lower() for t in taken}
    return [next(c for c in (n + "_" * i for i in range(len(low) + 1)) if c.lower() not in low) for n in names]


def with_row_id(df: DataFrame) -> tuple[DataFrame, list[str], list[str]]:
    """df as a Parquet scan with a lasting identity for each row, its file and number in it; the names of these columns; paths to drop.

    A frame that isn't a plain scan is written to the shared folder first.
    """
    names = fresh(df.columns, "_row_file", "_row_number")
    ident = lambda d: d.select("*", *(d.metadataColumn("_metadata")[f].alias(n) for f, n in zip(("file_path", "row_index"), names, strict=True)))
    try:
        out = ident(df)
        out.schema  # noqa: B018  (the analyzer's turn)
        return out, names, []
    except Exception:  # no scan below: the analyzer knows no such column
        kept, path = stage(df, "rows")
        return ident(kept), names, [path]


#: Rows of a file that share a side file: 2 to this power.
SIDE_BITS = 16


def side_name(file: str, block: int) -> str:
    return f"{hashlib.md5(file.encode()).hexdigest()}-{block}.arrow"


def write_side(df: DataFrame, name: str) -> str:
    """Side files of values (file, row, value) for rows of Parquet files, at most one value for a row; their folder.

    Each covers 2^SIDE_BITS rows of one file, so a task that scans the file reads those of its own rows, and texts are filtered or patched
    where they are read, with nothing broadcast and no text shuffled.
    """
    spark = df.sparkSession
    root = new_path(spark, name)
    fs, folder = open_fs(root)
    fs.create_dir(folder, recursive=True)
    kind = dict(df.dtypes)["value"]

    def save(batches):
        fs, folder = open_fs(root)
        now, held, done = None, [], 0

        def out():
            t = pa.concat_tables(held).combine_chunks()
            at = f"{folder}/{side_name(*now)}"
            temp = f"{at}.{uuid.uuid4().hex}.tmp"
            with fs.open_output_stream(temp) as f, pa.ipc.new_file(f, t.schema) as w:
                w.write_table(t)
            fs.move(temp, at)

        for b in batches:
            if not b.num_rows:
                continue
            files, blocks = b.column(0), b.column(1).to_numpy()
            names = files.to_pylist()
            cuts = [0, *(i for i in range(1, len(names)) if blocks[i] != blocks[i - 1] or names[i] != names[i - 1]), len(names)]
            for a, z in zip(cuts, cuts[1:], strict=False):
                if (names[a], int(blocks[a])) != now:
                    if now:
                        out()
                    now, held, done = (names[a], int(blocks[a])), [], done + 1
                held.append(pa.Table.from_batches([b.slice(a, z - a).select(["row", "value"])]))
        if now:
            out()
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], ["done"])

    dealt = df.select(F.col("file"), F.shiftright("row", SIDE_BITS).alias("block"), F.col("row").cast("long").alias("row"), F.col("value").cast(kind).alias("value"))
    bound_batches(spark)
    dealt.repartition("file", "block").sortWithinPartitions("file", "block", "row").mapInArrow(save, "done long").agg(F.sum("done")).collect()
    return root


@lru_cache(4)
def side_file(root: str, name: str) -> tuple[np.ndarray, pa.Array] | None:
    fs, folder = open_fs(root)
    try:
        with fs.open_input_file(f"{folder}/{name}") as f:
            t = pa.ipc.open_file(f).read_all().combine_chunks()
    except FileNotFoundError:
        return None
    value = t.column("value").chunk(0)
    return t.column("row").to_numpy(), value


def side_values(root: str, files: pa.Array, rows: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, pa.Array]]]:
    """Which rows of a batch have a value, and pieces (places in the batch, their values)."""
    at, names = rows.to_numpy(zero_copy_only=False), files.to_pylist()
    blocks = at >> SIDE_BITS
    has, pieces, n = np.zeros(len(at), bool), [], len(at)
    cuts = [0, *(i for i in range(1, n) if blocks[i] != blocks[i - 1] or names[i] != names[i - 1]), n] if n else []
    for a, z in zip(cuts, cuts[1:], strict=False):
        own = side_file(root, side_name(names[a], int(blocks[a])))
        if own is None:
            continue
        k = np.minimum(np.searchsorted(own[0], at[a:z]), len(own[0]) - 1)
        hit = np.flatnonzero(own[0][k] == at[a:z])
        if len(hit):
            has[a + hit] = True
            pieces.append((a + hit, own[1].take(pa.array(k[hit]))))
    return has, pieces


def keep_side(rows: DataFrame, ident: list[str], columns: list[str], root: str) -> DataFrame:
    """The rows with a side value, and these columns of them."""
    n = len(columns)

    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(b.columns[:n], columns).filter(pa.array(side_values(root, b.column(n), b.column(n + 1))[0]))

    whole = rows.select(*map(named, columns), *ident)
    return map_batches(whole, fn, whole.select(*map(named, columns)).schema)
