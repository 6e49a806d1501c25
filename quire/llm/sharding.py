"""Operator 4, sharding by a permutation-filled look-up table.

Each shard orders the slots of a prime-sized table by a permutation of its own (an offset and a step from its name's sha256);
in turns each claims the first free slot of its order until all are taken.  A key goes to the shard that owns slot
hash(key) mod size: constant time, all but even, and when a shard leaves few keys of other shards move.

The table has `size` entries whatever the data hold (a proven bound), so it travels as a constant of the plan: no
shuffle, no join.  A null key is hashed as the empty text; equal keys share a shard; an empty table gives no rows; a very long
key is only hashed.  Columns other than the key are not read by place().
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import fresh, named, table

#: Production parameters: the names of the shards, and the prime number of slots.
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))
SIZE = 6553


def number(text: str) -> int:
    """First 60 bits of sha256: in SQL conv(substr(sha2(text, 256), 1, 15), 16, 10)."""
    return int(hashlib.sha256(text.encode()).hexdigest()[:15], 16)


def fill(names: tuple[str, ...], size: int) -> list[int]:
    """Slot by slot, the position in names of the owner."""
    if size < len(names) or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the size must be a prime of at least the number of shards")
    order = [(number(f"offset:{n}") % size, number(f"skip:{n}") % (size - 1) + 1) for n in names]
    owner, nexts, left = [-1] * size, [0] * len(names), size
    while left:
        for i, (offset, skip) in enumerate(order):
            while owner[at := (offset + nexts[i] * skip) % size] >= 0:
                nexts[i] += 1
            owner[at] = i
            nexts[i] += 1
            left -= 1
            if not left:
                break
    return owner


def slot(key: Column, size: int = SIZE) -> Column:
    return (F.conv(F.substring(F.sha2(F.coalesce(key.cast("string"), F.lit("")), 256), 1, 15), 16, 10).cast("bigint") % size).cast("int")


def owners(names: tuple[str, ...], size: int) -> Column:
    return F.from_json(F.lit("[" + ",".join(f'"{names[i]}"' for i in fill(names, size)) + "]"), "array<string>")


def place(df: DataFrame, key: str, names: tuple[str, ...] = SHARDS, size: int = SIZE) -> DataFrame:
    """(key, slot, shard) for each row; a key of such a name keeps it, and the new column gets a `_`."""
    slot_name, shard_name = fresh([key], "slot", "shard")
    at = df.select(F.col(named(key)), slot(F.col(named(key)), size)).toDF("k", "at")
    return at.select(F.col("k").alias(key), F.col("at").cast("long").alias(slot_name), F.element_at(owners(names, size), F.col("at") + 1).alias(shard_name))


def write(df: DataFrame, path: str, key: str, names: tuple[str, ...] = SHARDS, size: int = SIZE) -> str:
    """df by folders of shards, under a column name that is returned (`_shard`, or more of `_` where a column has that name).

    Rows are written where they are read: a hot shard is spread over all tasks, none is gathered.
    """
    (column,) = fresh(df.columns, "_shard")
    df.withColumn(column, F.element_at(owners(names, size), slot(F.col(named(key)), size) + 1)).write.partitionBy(column).parquet(path)
    return column


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place(table(spark, sf_dir, "documents"), "doc_id")


def sql() -> str:
    """The query in DuckDB's SQL: the filled table as a list of owners, and 60 bits of sha256."""
    filled = ", ".join(map(str, fill(SHARDS, SIZE)))
    return f"""
    WITH s AS (SELECT doc_id, (('0x' || substr(sha256(coalesce(doc_id::VARCHAR, '')), 1, 15))::UBIGINT % {SIZE})::BIGINT AS slot FROM documents),
    t AS (SELECT unnest([{filled}]) AS owner, unnest(range({SIZE})) AS slot)
    SELECT doc_id, slot, 'shard-' || lpad(owner::VARCHAR, 3, '0') AS shard FROM s JOIN t USING (slot)
    """


SQL = sql()
