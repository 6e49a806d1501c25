"""Leakage-free hash splits: members of a group always share a split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.export import SEED


def hash_bucket(seed: str, group: Column, buckets: int = 100) -> Column:
    """First 32 bits of sha256(seed:group), modulo buckets."""
    return (F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), group), 256), 1, 8), 16, 10).cast("bigint") % buckets).cast("bigint")


def split_name(bucket: Column, train: int = 80, validation: int = 90) -> Column:
    return F.when(bucket < train, "train").when(bucket < validation, "val").otherwise("test")


def group_by_text(df: DataFrame, key: str, text: str) -> DataFrame:
    """Group id of each row: shared by exact copies, own otherwise.

    Copies are counted with partial aggregation; the digests that occur once need no join partner, so only the
    repeated ones are matched back.
    """
    rows = df.select(F.col(key), F.sha2(F.col(text).cast("binary"), 256).alias("sha"))
    repeated = rows.groupBy("sha").agg(F.count("*").alias("copies")).where("copies > 1")
    return rows.join(repeated, "sha", "left").select(key, F.when(F.col("copies") > 1, F.concat(F.lit("dup:"), F.substring("sha", 1, 12))).otherwise(F.concat(F.lit("doc:"), "sha")).alias("split_group_id"))


def assign(groups: DataFrame, seed: str = SEED, group: str = "split_group_id") -> DataFrame:
    out = groups.withColumn("bucket", hash_bucket(seed, F.col(group)))
    return out.withColumn("split", split_name(F.col("bucket")))


def source_group(corpus: Column, pair_key: Column, stem: Column, basename: Column, sha: Column, duplicate: Column) -> Column:
    """Split group of a source: its pair's key (or stem, or name), or its duplicates, or its own content."""
    return F.when(corpus == "sc", F.concat(F.lit("sc_pair:"), F.coalesce(pair_key, stem, basename))).otherwise(F.coalesce(duplicate, F.concat(corpus, F.lit(":"), sha)))


def with_splits(pages: DataFrame, splits: DataFrame, group: str = "split_group_id") -> DataFrame:
    """pages with the split of their group where they have none yet."""
    s = splits.select(group, F.col("split").alias("_split")).distinct()
    d = pages.join(s, group, "left")
    return d.withColumn("split", F.coalesce(*(["split"] if "split" in pages.columns else []), "_split")).drop("_split")


def counts(assigned: DataFrame, name: str = "split") -> DataFrame:
    """Rows of each split, zeros kept."""
    return assigned.agg(*(F.count_if(F.col(name) == n).alias(n) for n in ("train", "val", "test")))
