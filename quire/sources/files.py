"""Sources and sinks: JSON lines with a fixed schema, and file discovery with digests and types."""

from __future__ import annotations

import glob
import json
import os

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.functions import text as T
from quire.operators.split import source_group


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of a JSON-lines table; a missing path is an empty table, a malformed line an error when read."""
    try:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    """Columns in name order, nulls written."""
    df.select(*sorted(df.columns)).write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)


def read_log(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """An append-only log as a stream."""
    return spark.readStream.schema(schema).json(path)


def read_json(path: str, default=None):
    """One JSON object; `default` where the file is missing."""
    try:
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    except FileNotFoundError:
        return default


def write_json(path: str, value) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, indent=2, sort_keys=True)


def external_roots(parent: str, pattern: str, needs: tuple[str, ...] = ("fir", "sc_english", "sc_hindi")) -> list[str]:
    """Folders beside one another, by a pattern, that hold all the folders needed (or hold a folder of that name without the star that does)."""
    out = []
    for p in sorted(glob.glob(f"{parent}/{pattern}")):
        inner = f"{p}/{pattern.rstrip('*')}"
        root = inner if os.path.isdir(inner) else p
        if os.path.isdir(p) and not p.lower().endswith(".zip") and all(os.path.isdir(f"{root}/{n}") for n in needs):
            out.append(root)
    return out


#: source_set and the language its files are in, by folder: (folder, corpus, source_set, language or None).
Spec = tuple[str, str, str, str | None]
FOUND = "source_path string, corpus string, source_set string, given string, size_bytes bigint, sha256 string, mime_type string, head binary"


def discover(spark: SparkSession, specs: list[Spec], glob: str = "*") -> DataFrame:
    """One row for each file below the folders: path, corpus, set, size, sha256, type and leading bytes.  Without folders that exist, none."""
    found = spark.createDataFrame([], FOUND)
    for folder, corpus, name, language in specs:
        if not os.path.isdir(folder.removeprefix("file://")):
            continue
        d = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
        found = found.unionByName(d.select(F.col("path").alias("source_path"), F.lit(corpus).alias("corpus"), F.lit(name).alias("source_set"), F.lit(language).cast("string").alias("given"), F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"), T.mime_of(F.substring("content", 1, 4096)).alias("mime_type"), F.substring("content", 1, 1 << 16).alias("head")))
    return found.withColumn("basename", F.element_at(F.split("source_path", "/"), -1))


def dispatched(found: DataFrame) -> DataFrame:
    """Discovered files with what their corpus says of them: kind, language, parts of the name, pair key."""
    name, corpus = F.col("basename"), F.col("corpus")
    stem = T.stem_of(name)
    language = F.coalesce("given", F.when(F.endswith(stem, F.lit("_HIN")), "HIN").when(F.endswith(stem, F.lit("_EN")), "EN"))
    only = lambda c, kind: F.when(corpus == kind, c)
    d = found.withColumns({k: only(c, "sc") for k, c in T.citation(name, language).items()} | {k: only(c, "fir") for k, c in T.report_name(name).items()})
    kind = F.when(corpus == "sc", "supreme_court_report").when(corpus == "fir", "fir")
    hint = F.when(corpus == "fir", "hi-Deva+en-Latn").when(corpus != "sc", "hi-Deva+sa-Deva").when(F.col("language_variant") == "HIN", "hi-Deva").otherwise("en-Latn")
    return d.withColumns({
        "extension": F.lower(F.regexp_extract(name, r"(?<=.)(\.[^.]+)$", 1)), "source_category": F.coalesce(kind, F.lit("book_page")), "doc_type": F.coalesce(kind, F.lit("gita_page")), "language_hint": hint,
        "sc_pair_key": F.col("citation_key"),
    })


def judged(files: DataFrame) -> DataFrame:
    """Dispatched files, with opens, page_count and failure, as valid sources or with a reason for quarantine; their duplicates and split groups."""
    d = files.withColumn("quarantine_reason", T.quarantine_reason(F.col("mime_type"), F.col("opens"), F.col("page_count"), F.col("failure"))).withColumn("valid_source", F.col("quarantine_reason").isNull())
    twice = duplicate_groups(files).select("sha256", F.concat(F.lit("sha256:"), "sha256").alias("duplicate_group_id"))
    d = d.join(twice, "sha256", "left")
    return d.withColumn("split_group_id", source_group(F.col("corpus"), F.col("sc_pair_key"), F.col("canonical_stem"), F.col("basename"), F.col("sha256"), F.col("duplicate_group_id")))


def of_corpora(files: DataFrame, corpora: list[str]) -> tuple[DataFrame, DataFrame]:
    """Files of some corpora, and the duplicates that are left among them."""
    own = files.where(F.col("corpus").isin(corpora))
    return own, duplicate_groups(own)


def quarantined(files: DataFrame) -> DataFrame:
    return files.where(F.coalesce("quarantine_reason", F.lit("")) != "")


def image_size(content: bytes) -> tuple[int, int] | None:
    """Width and height from the header of a PNG or JPEG."""
    if content[:8] == b"\x89PNG\r\n\x1a\n" and len(content) >= 24:
        return int.from_bytes(content[16:20], "big"), int.from_bytes(content[20:24], "big")
    at = 2
    while content[:2] == b"\xff\xd8" and at + 9 <= len(content) and content[at] == 0xFF:
        kind, size = content[at + 1], int.from_bytes(content[at + 2 : at + 4], "big")
        if kind in range(0xC0, 0xD0) and kind not in (0xC4, 0xC8, 0xCC):
            return int.from_bytes(content[at + 7 : at + 9], "big"), int.from_bytes(content[at + 5 : at + 7], "big")
        at += 2 + size
    return None


def image_dimensions(head: F.Column) -> F.Column:
    """struct(width, height) by the leading bytes of an image file; nulls where they hold none."""

    def sizes(heads: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(s[0], s[1]) if b is not None and (s := image_size(bytes(b))) else (None, None) for b in heads], columns=["width", "height"]).astype("Int32")

    sizes.__annotations__ = {"heads": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(sizes, "width int, height int")(head)


def duplicate_groups(files: DataFrame, sha: str = "sha256", member: str = "source_path") -> DataFrame:
    """(sha, copies, first member) of contents that occur twice or more; members aren't gathered."""
    return files.where(F.col(sha) != "missing").groupBy(sha).agg(F.count("*").alias("copies"), F.min(member).alias("first_member")).where("copies > 1")


def pdf_page_count(info: F.Column) -> F.Column:
    return F.nullif(F.regexp_extract(info, r"(?m)^Pages:\s+(\d+)", 1), F.lit("")).cast("int")


def text_pages(df: DataFrame, key: str, text: str) -> DataFrame:
    """Pages of a document's text, divided by form feeds, numbered from 1."""
    return df.select(key, F.posexplode(F.split(text, "\f")).alias("i", "t")).select(key, (F.col("i") + 1).alias("page_index"), T.strip(F.col("t")).alias("text"))
