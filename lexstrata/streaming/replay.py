"""A change log as a stream: the current state of every key, and late changes that retract nothing but their own."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATE = "at timestamp, seq bigint, gone boolean, value bigint"


def current_state(log: DataFrame, late: str = "7 days", keep_days: int | None = None) -> DataFrame:
    """user_id, k, seq, action, value whenever a key's state changes. log: (user_id, k, ts, event_id, action, cents), a stream.

    A change counts if no later one (by time, then event_id) has been seen for its key: effective dates order changes,
    not arrival. Keys are independent, so state is partitioned by key; what is older than the watermark is dropped.
    A key's state is kept until the watermark is keep_days beyond its last change (None: for ever, as a value may hold
    for ever; a key that changes again after that begins anew).
    """
    from pyspark.sql.streaming.state import GroupStateTimeout

    def step(key, batches: Iterator, state) -> Iterator:
        import pandas as pd

        if state.hasTimedOut:
            state.remove()
            return
        at, seq, gone, value = state.get if state.exists else (pd.Timestamp.min.to_pydatetime(), -1, True, None)
        out = []
        for pdf in batches:
            for r in pdf.sort_values(["ts", "event_id"]).itertuples():
                if (r.ts.to_pydatetime(), r.event_id) <= (at, seq) or r.action == "KEEP":
                    continue
                was = (gone, value)
                at, seq, gone, value = r.ts.to_pydatetime(), int(r.event_id), r.action == "DELETE", None if r.action == "DELETE" else int(r.cents)
                if was != (gone, value):
                    out.append((*key, seq, r.action, value))
        state.update((at, seq, gone, value))
        if keep_days is not None and seq >= 0:
            until = int(pd.Timestamp(at).timestamp() * 1000) + keep_days * 86_400_000
            state.setTimeoutTimestamp(max(until, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["user_id", "k", "seq", "action", "value"])

    stamped = log.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return stamped.groupBy("user_id", "k").applyInPandasWithState(step, "user_id bigint, k bigint, seq bigint, action string, value bigint", STATE, "append", GroupStateTimeout.NoTimeout if keep_days is None else GroupStateTimeout.EventTimeTimeout)


def windowed_counts(events: DataFrame, length: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Changes by window and type, with late ones up to a bound."""
    stamped = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return stamped.groupBy(F.window("ts", length), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")
