"""Near-duplicate suppression on a stream, with state that time bounds.

A text has a MinHash signature of sixteen values, cut into eight bands of two. Texts that share a band meet in that band's state: a list of
the signatures that the band let through, each with its moment. An item is suppressed in a band when a signature in the list, not
older than ``keep_seconds``, equals its own in at least ``least`` values; otherwise it enters the list. An item goes through when no band
suppresses it. Only with ``most`` does a list lose its oldest entry beyond so many, and an item the partners that it would have met there.

State is thus what a band let through in ``keep_seconds``. Bands are dealt to BUCKETS keys, whose state is a map with one row for each band that
is held, so that Python is called once a bucket and micro-batch and looks up the bands that came only. A bucket has one timer: when the watermark passes the age
of the newest entry that the timer knows of, all entries of that age go, and bands without entries with them. A frequent band is one
row, read and written once a micro-batch. Signatures that differ in few values agree in one of as many parts and one more, so an item is compared
only with the entries of its band that have a part in common with it, however many there are. Needs a state store with several columns,
RocksDB, which :func:`state_settings` names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from listmill.functions.similarity import SIGNATURE, signature
from listmill.functions.text import tokens
from listmill.sources.tables import write_batch

# Digits of a signature value, values of a band.
DIGITS, ROWS = 8, 2
# Keys that bands are dealt to; a checkpoint goes with their number.
BUCKETS = 1024
LEAST, KEEP_SECONDS = 13, 7 * 24 * 3600

_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_settings(spark: SparkSession) -> None:
    """The state store that lists and timers need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)


def banded(rows: DataFrame, key: str, text: str, moment: str) -> DataFrame:
    """id, moment, signature, bucket and one row for each band; a text without words is a band of its own, which nothing shares."""
    signed = rows.select(
        F.col(key).cast("string").alias("id"), F.col(moment).alias("moment"), signature(F.array_distinct(tokens(F.col(text)))).alias("signature")
    )
    width = DIGITS * ROWS
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(SIGNATURE // ROWS - 1)),
        lambda b: F.concat_ws(":", b.cast("string"), F.substring("signature", b * width + 1, F.lit(width))),
    )
    lone = F.array(F.concat(F.lit("none:"), F.coalesce("id", F.lit(""))))
    rows = signed.withColumn("band", F.explode(F.when(F.col("signature").isNotNull(), bands).otherwise(lone)))
    return rows.withColumn("bucket", F.pmod(F.xxhash64("band"), F.lit(BUCKETS)).cast("int"))


def _values(signatures: list[str]) -> np.ndarray:
    """Eight hex digits are eight bytes, compared as one number."""
    return np.frombuffer("".join(signatures).encode(), np.uint64).reshape(len(signatures), SIGNATURE)


# What a band holds, the oldest first: moments in microseconds and signatures.
_HELD = np.dtype([("moment", np.int64), ("signature", np.uint64, SIGNATURE)])


@lru_cache
def _parts(least: int) -> list[slice]:
    """The bytes of the parts of a signature: two that are equal in ``least`` values or more are equal in one part."""
    edges = np.linspace(0, SIGNATURE, min(SIGNATURE, SIGNATURE - least + 1) + 1).astype(int) * DIGITS
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]


class Suppressor(StatefulProcessor):
    """Decides the items of each band of a bucket in the order of their moments, then ids."""

    def __init__(self, least: int, most: int | None, keep_seconds: int):
        self.least, self.most, self.keep = least, most, keep_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getMapState("kept", "band string", "entries binary")

    def _decide(self, held: np.ndarray, moments: np.ndarray, signatures: np.ndarray) -> tuple[np.ndarray, list[bool]]:
        """What the band holds afterwards, and whether each item is suppressed."""
        entries = np.empty(len(held) + len(moments), _HELD)
        entries[: len(held)] = held
        entries["moment"][len(held) :], entries["signature"][len(held) :] = moments, signatures
        values, when, by_part = entries["signature"], entries["moment"].tolist(), {}

        def parts(at: int) -> list[tuple[int, bytes]]:
            raw = values[at].tobytes()
            return [(n, raw[p]) for n, p in enumerate(_parts(self.least))]

        listed, decided = list(range(len(held))), []
        for at in listed:
            for part in parts(at):
                by_part.setdefault(part, []).append(at)
        # the entries before this one are beyond the bound on their number; the oldest go first, and the moments of items only grow
        first = 0
        for at in range(len(held), len(entries)):
            own, oldest = parts(at), when[at] - self.keep
            met = sorted({e for part in own for e in by_part.get(part, ()) if e >= first and when[e] >= oldest})
            alike = bool(met) and bool(((values[met] == values[at]).sum(axis=1) >= self.least).any())
            decided.append(alike)
            if not alike:
                listed.append(at)
                for part in own:
                    by_part.setdefault(part, []).append(at)
                if self.most is not None:
                    listed = [e for e in listed if when[e] >= oldest][-self.most :]
                    first = listed[0]
        after = entries[listed]
        return after[after["moment"] >= moments[-1] - self.keep], decided

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # the rows of one bucket in one micro-batch, which the source's rate cap bounds
        data = pd.concat(list(rows), ignore_index=True).sort_values(["band", "moment", "id"], kind="stable")
        suppressed = np.zeros(len(data), bool)
        signed = np.flatnonzero(data["signature"].notna().to_numpy())
        if len(signed):
            bands = data["band"].to_numpy()[signed]
            moments = data["moment"].to_numpy().astype("datetime64[us]").astype(np.int64)[signed]
            signatures = _values(data["signature"].to_numpy()[signed].tolist())
            begin = np.flatnonzero(np.concatenate(([True], bands[1:] != bands[:-1])))
            known, newest = self.kept.exists(), None
            for low, high in zip(begin, [*begin[1:], len(bands)], strict=True):
                found = self.kept.getValue((bands[low],)) if known else None
                before = found[0] if found else b""
                held, decided = self._decide(np.frombuffer(before, _HELD), moments[low:high], signatures[low:high])
                suppressed[signed[low:high]] = decided
                after = held.tobytes()
                if after != before:
                    self.kept.updateValue((bands[low],), (after,))
                    newest = max(int(held["moment"].max()), newest or 0)
            if newest is not None and next(iter(self.handle.listTimers()), None) is None:
                self._wake_after(newest)
        yield pd.DataFrame({"id": data["id"].to_numpy(), "moment": data["moment"].to_numpy(), "band": data["band"].to_numpy(), "suppressed": suppressed})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, newest, changed = timerValues.getCurrentWatermarkInMs() * 1000, None, []
        for (band,), (entries,) in self.kept.iterator():
            held = np.frombuffer(entries, _HELD)
            fresh = held[held["moment"] + self.keep > now]
            if len(fresh):
                newest = max(int(fresh["moment"].max()), newest or 0)
            if len(fresh) < len(held):
                changed.append((band, fresh.tobytes()))
        for band, entries in changed:
            if entries:
                self.kept.updateValue((band,), (entries,))
            else:
                self.kept.removeKey((band,))
        if newest is not None:
            self._wake_after(newest)
        return iter([])

    def _wake_after(self, newest: int) -> None:
        """One timer a bucket, at the age of the newest entry it knows of."""
        self.handle.registerTimer((newest + self.keep) // 1000)

    def close(self) -> None:
        pass


def decisions(
    stream: DataFrame, key: str, text: str, moment: str, delay: str, least: int = LEAST, most: int | None = None, keep_seconds: int = KEEP_SECONDS
) -> DataFrame:
    """id, moment, band and whether the band suppresses the item, for each band of each item; all in the item's micro-batch."""
    rows = banded(stream.withWatermark(moment, delay), key, text, moment)
    return rows.groupBy("bucket").transformWithStateInPandas(
        Suppressor(least, most, keep_seconds), "id string, moment timestamp, band string, suppressed boolean", "Append", "EventTime"
    )


def write_unique(decided: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Write id and kept of each item, one folder a micro-batch, replaced as a whole when the batch is repeated."""

    def write(batch: DataFrame, number: int) -> None:
        write_batch(batch.groupBy("id").agg((~F.max("suppressed")).alias("kept")), path, number)

    writer = decided.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
