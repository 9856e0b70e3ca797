"""A change log as a stream of version histories: late changes correct the intervals that earlier ones gave."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

OUT = "user_id bigint, k bigint, valid_from timestamp, seq bigint, valid_to timestamp, value bigint, gone boolean, revision bigint"
CHANGE, STATE = "at timestamp, seq bigint", "gone boolean, value bigint"


def _processor():
    """The class is made here, so that it travels with its code to workers that lack the package."""
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

    class History(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.changes = handle.getMapState("changes", CHANGE, STATE)
            self.revision = handle.getValueState("revision", "n bigint")

        def _held(self) -> dict:
            return {tuple(k): tuple(v) for k, v in self.changes.iterator()}

        def handleInputRows(self, key, rows, timerValues):
            import pandas as pd

            held, fresh = self._held(), {}
            for pdf in rows:
                for r in pdf.itertuples():
                    if r.action != "KEEP":
                        gone = r.action == "DELETE"
                        fresh[r.ts.to_pydatetime(), int(r.event_id)] = (gone, None if gone else int(r.cents))
            changed = {at: state for at, state in fresh.items() if held.get(at) != state}
            held |= changed
            for at, state in changed.items():
                self.changes.updateValue(at, state)
            order = sorted(held)
            # A change gives its own interval, and the end of the one before it; no other interval knows of it.
            touched = sorted({j for i, at in enumerate(order) if at in changed for j in (i - 1, i) if j >= 0})
            revision = self.revision.get()[0] if self.revision.exists() else 0
            out = []
            for i in touched:
                revision += 1
                gone, value = held[order[i]]
                out.append((*key, *order[i], order[i + 1][0] if i + 1 < len(order) else None, value, gone, revision))
            if out:
                self.revision.update((revision,))
                self._settle(held, timerValues)
            yield pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])

        def _settle(self, held: dict, timerValues) -> None:
            """Forgets what no later change can touch: all before the last change at or below the watermark. A timer comes
            back when the watermark passes the next one."""
            import datetime

            ms = timerValues.getCurrentWatermarkInMs()
            seen = datetime.datetime.fromtimestamp(ms / 1000) if ms > 0 else datetime.datetime.min
            order = sorted(held)
            last = max((i for i, (at, _) in enumerate(order) if at <= seen), default=0)
            for at in order[:last]:
                self.changes.removeKey(at)
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            if last + 1 < len(order):
                self.handle.registerTimer(int(order[last + 1][0].timestamp() * 1000) + 1)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            import pandas as pd

            self._settle(self._held(), timerValues)
            yield pd.DataFrame([], columns=[c.split()[0] for c in OUT.split(", ")])

        def close(self) -> None:
            pass

    return History()


def interval_corrections(log: DataFrame, late: str = "7 days") -> DataFrame:
    """Rows of a history as they become known: (user_id, k, valid_from, seq) names an interval, the row of the highest revision holds.

    log: (user_id, k, ts, event_id, action, cents), a stream in any order. A change between two others gives its own interval and
    a correction of the one before it; what follows the next change stays. KEEP changes nothing; a DELETE is a row with `gone`,
    as it may take the place of nothing yet end an interval. A change that is there twice counts once; one seen anew with another
    value corrects its interval. Keys are independent; a key's state is the changes of the last `late` before the
    watermark and one more, so it does not grow with the stream; Spark drops changes older than the watermark. A key of many
    changes within `late` is read whole when one of them comes. The state store has to be RocksDB
    (spark.sql.streaming.stateStore.providerClass), which Spark asks for with processors of this kind.
    """
    stamped = log.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return stamped.groupBy("user_id", "k").transformWithStateInPandas(statefulProcessor=_processor(), outputStructType=OUT, outputMode="Append", timeMode="EventTime")


def settled(corrections: DataFrame, keys: tuple[str, ...] = ("user_id", "k")) -> DataFrame:
    """The intervals that a table of corrections says hold: keys, valid_from, valid_to, value, as versions.intervals() gives them."""
    named = [*keys, "valid_from", "seq"]
    last = corrections.groupBy(*named).agg(F.max_by(F.struct("valid_to", "value", "gone"), "revision").alias("r"))
    return last.where("not r.gone").select(*keys, "valid_from", "r.valid_to", "r.value")


def as_known(corrections: DataFrame, revision: int, keys: tuple[str, ...] = ("user_id", "k")) -> DataFrame:
    """The intervals as they were known after so many corrections of each key: what a reader saw before later ones came."""
    return settled(corrections.where(F.col("revision") <= revision), keys)


def corrected_often(corrections: DataFrame, keys: tuple[str, ...] = ("user_id", "k")) -> DataFrame:
    """Intervals that were corrected, with how often, and the first and last end that they were given."""
    w = W.partitionBy(*keys, "valid_from", "seq").orderBy("revision")
    numbered = corrections.withColumn("_first", F.first("valid_to").over(w))
    out = numbered.groupBy(*keys, "valid_from", "seq").agg(F.count(F.lit(1)).alias("n"), F.min_by("_first", "revision").alias("first_end"), F.max_by("valid_to", "revision").alias("last_end"))
    return out.where("n > 1")
