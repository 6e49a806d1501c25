"""The training-data queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.llm import decontam, maxent, pii, quality, sharding, simhash, tokenbin, urlfilter, warc, wordbpe

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": tokenbin.query,
    "op2_word_bpe": wordbpe.query,
    "op3_quality_bands": quality.query,
    "op4_sharding": sharding.query,
    "op5_warc": warc.query,
    "op6_decontamination": decontam.query,
    "op7_maxent": maxent.query,
    "op8_url_filter": urlfilter.query,
    "op9_simhash": simhash.query,
    "op10_pii": pii.query,
}

SQL: dict[str, str] = {"op4_sharding": sharding.SQL, "op5_warc": warc.SQL, "op8_url_filter": urlfilter.SQL}
