"""Streaming over an annotation log: first acceptance by page, and streaks of quota errors."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def first_accepted(log: DataFrame, page: str = "page_id", ok: str = "ok", at: str = "created_at", delay: str = "1 day") -> DataFrame:
    """The first acceptance of each page; a page is remembered for `delay` of the log's own time, so the state has a bound."""
    return log.where(F.col(ok)).withWatermark(at, delay).dropDuplicatesWithinWatermark([page])


def quota_streaks(log: DataFrame, key: str, seq: str, quota: str, stop: int = 3) -> DataFrame:
    """(key, seq) where a streak of quota rows reaches `stop`; the counter is kept between batches."""

    def step(k, frames, state: GroupState):
        n = state.get[0] if state.exists else 0
        hits = []
        for seqs, flags in ((f[seq], f[quota]) for f in [pd.concat(list(frames)).sort_values(seq)]):
            for s, q in zip(seqs, flags, strict=True):
                n = n + 1 if q else 0
                if n == stop:
                    hits.append(s)
        state.update((n,))
        yield pd.DataFrame({key: [k[0]] * len(hits), seq: hits})

    kind = dict(log.dtypes)
    return log.groupBy(key).applyInPandasWithState(step, f"{key} {kind[key]}, {seq} {kind[seq]}", "n int", "append", GroupStateTimeout.NoTimeout)
