"""Annotation of pages by a remote model behind a protocol, and its scheduling as a batch plan."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators import runlog


class Annotator(Protocol):
    """Gives a page's payload as text, or an error: {"ok", "text", "error_type", "error"}."""

    def __call__(self, page_id: str, attempt: int) -> dict: ...


def annotate(pages: DataFrame, make: Callable[[], Annotator], valid: Callable[[str], list[str]], quota: Callable[[str], float | None], invalid: int = 3, most: int = 12, spacing: float = 0.0) -> DataFrame:
    """One run row for each page: attempts until a payload is valid, `invalid` fail, or `most` are made in all; waits for quota aren't failures.

    make() builds the annotator once in each task; valid() names a payload's errors; quota() gives the seconds to wait of a quota error, else None.
    spacing is kept between requests of a task: for a rate over all, times the number of tasks at work.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask, last = make(), 0.0
        for frame in frames:
            out = []
            for page in frame["page_id"]:
                bad, n, row = 0, 0, {}
                while bad < invalid and n < most:
                    time.sleep(max(0.0, last + spacing - time.time()))
                    last, n = time.time(), n + 1
                    got = ask(page, n)
                    wait = None if got.get("ok") else quota(got.get("error") or "")
                    if wait is not None:
                        row = {"status": "quota_backoff", "retry_after_seconds": wait, **got}
                        time.sleep(wait if spacing else 0)
                        continue
                    errors = valid(got["text"]) if got.get("ok") else []
                    row = {"status": "call_failed" if not got.get("ok") else "accepted" if not errors else "invalid_json_or_quality", "validation_errors": errors, **got}
                    if row["status"] == "accepted":
                        break
                    bad += 1
                out.append((page, n, row.get("status", "failed"), row.get("status") == "accepted", list(row.get("validation_errors", [])), row.get("error_type"), row.get("error"), row.get("retry_after_seconds"), row.get("text")))
            yield pd.DataFrame(out, columns=["page_id", "attempts", "status", "ok", "validation_errors", "error_type", "error", "retry_after_seconds", "payload"])

    return pages.select("page_id").mapInPandas(run, "page_id string, attempts int, status string, ok boolean, validation_errors array<string>, error_type string, error string, retry_after_seconds double, payload string")


def scheduled(pages: DataFrame, gold: DataFrame, runs: DataFrame, model: str, limit: int, concurrency: int, most: int = 3) -> DataFrame:
    """The pages to annotate now, in `concurrency` tasks: without gold of this model, not exhausted, fewest failures first, then cheapest."""
    mine = runs.where(F.col("model") == model)
    failed = runlog.failed_attempts(mine, "page_id", F.col("attempts"), ~(F.col("ok") | F.col("quota") | F.col("transient")))
    done = gold.where(F.col("valid") & (F.col("teacher_model") == model)).select(F.col("source_page_id").alias("page_id"))
    return runlog.pending(pages, done, failed, "page_id", "render_bytes", most, limit).repartition(concurrency, "page_id")


def disabled(pages: DataFrame, model: str, skipped: bool) -> DataFrame:
    """Run rows of pages that aren't attempted: the model is switched off, or its key is missing."""
    return pages.select("page_id", F.lit("not_attempted_gemini_disabled" if skipped else "not_attempted_missing_api_key").alias("status"), F.lit(0).alias("attempts"), F.lit(model).alias("model"))


def sleeps(runs: DataFrame, column: str = "sleep_seconds") -> DataFrame:
    return runs.agg(F.min(column).alias("min"), F.max(column).alias("max"), F.count(column).alias("n"))
