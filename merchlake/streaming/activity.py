"""Which addresses are there, from a stream of sightings.

An address is there from its first sighting until it has not been seen for a
while; seen again later, it is back.  Each such spell is one row, told when the watermark
has passed its end for good.  State for an address is its open spells and the time it was first seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_STATE = "first long, told long, begins array<long>, ends array<long>"


def joined(begins: np.ndarray, ends: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Spells that lie at most gap apart become one; in any order in, in order of time out."""
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], np.maximum.accumulate(ends[order])
    new = np.r_[True, begins[1:] > ends[:-1] + gap]
    return begins[new], ends[np.r_[new[1:], True]]


def spells(stream: DataFrame, key: str, when: str, absence_seconds: int, late: str = "1 day") -> DataFrame:
    """key, spell (from 1), first_seen_at, seen_from, last_seen_at, gone_at: every spell that is over.

    A spell is over when the watermark has passed last_seen_at by the
    absence.  Sightings may come in any order within the watermark, and the
    batches that they come in do not change the rows; later ones are dropped.
    Null keys and null times are left out.
    """
    gap = absence_seconds * 1_000_000
    end_ms = lambda ends: -((-(ends + gap)) // 1000)  # noqa: E731  whole milliseconds, as timers have them

    def step(k: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, told, begins, ends = state.get if state.exists else (None, 0, [], [])
        begins, ends = np.array(begins, np.int64), np.array(ends, np.int64)
        for pdf in pdfs:
            at = pdf[when].astype("datetime64[us]").astype(np.int64).to_numpy()
            if len(at):
                first = int(at.min() if first is None else min(first, at.min()))
                begins, ends = joined(np.r_[begins, at], np.r_[ends, at], gap)
        now = state.getCurrentWatermarkMs()
        over = end_ms(ends) < now
        n = int(over.sum())  # the earliest ones
        if n:
            us = lambda x: pd.to_datetime(x, unit="us")
            yield pd.DataFrame({key: [k[0]] * n, "spell": np.arange(told + 1, told + n + 1), "first_seen_at": us(np.full(n, first)), "seen_from": us(begins[over]), "last_seen_at": us(ends[over]), "gone_at": us(ends[over] + gap)})
        state.update((first, told + n, begins[~over].tolist(), ends[~over].tolist()))
        if n < len(ends):
            state.setTimeoutTimestamp(max(int(end_ms(ends[~over]).min()), now))

    kind = dict(stream.dtypes)[key]
    rows = stream.where(F.col(key).isNotNull() & F.col(when).isNotNull()).select(key, F.col(when).cast("timestamp").alias(when)).withWatermark(when, late)
    out = f"`{key}` {kind}, spell long, first_seen_at timestamp, seen_from timestamp, last_seen_at timestamp, gone_at timestamp"
    return rows.groupBy(key).applyInPandasWithState(step, out, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
