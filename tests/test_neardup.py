"""Near-duplicate suppression on a stream: restarts, bounded state and timers."""

import datetime as dt
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from listmill.session import fresh_dir
from listmill.sources import messages
from listmill.streaming import neardup

SCHEMA = "id long, text string, moment timestamp"


def add(spark, folder, rows):
    shaped = [(k, text, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)) for k, text, s in rows]
    spark.createDataFrame(shaped, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, source, out, checkpoint, **bounds):
    neardup.state_settings(spark)
    stream = messages.file_stream(spark, source, SCHEMA, "parquet", max_files=1)
    query = neardup.write_unique(neardup.decisions(stream, "id", "text", "moment", "1 second", **bounds), out, checkpoint, once=True)
    query.awaitTermination()
    entries = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in query.recentProgress if p["stateOperators"]]
    return {r.id: r.kept for r in spark.read.parquet(out).collect()}, entries


def text(seed, n=60):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(10_000)}" for _ in range(n))


def test_copies_go_after_a_restart_and_return_after_their_time(spark):
    source, out, checkpoint = (fresh_dir(spark, n) for n in ("near-in", "near-out", "near-ckpt"))
    add(spark, source, [(1, text(1), 0), (2, text(2), 1), (3, text(1), 2), (4, None, 3), (5, "", 4)])
    kept, _ = run(spark, source, out, checkpoint, keep_seconds=100)
    assert kept == {"1": True, "2": True, "3": False, "4": True, "5": True}
    # a new process goes on with the state of the checkpoint
    near = text(2).split()
    add(spark, source, [(6, " ".join([*near[:-1], "other"]), 10), (7, text(7), 11)])
    kept, _ = run(spark, source, out, checkpoint, keep_seconds=100)
    assert kept["6"] is False and kept["7"] is True
    # a copy after keep_seconds is new; the watermark has cleared the bands of older texts
    add(spark, source, [(8, text(8), 5_000)])
    add(spark, source, [(9, text(1), 5_001)])
    kept, entries = run(spark, source, out, checkpoint, keep_seconds=100)
    assert kept["8"] and kept["9"]
    assert entries[-1] <= 3 * 2 * 8  # lists and timers of two texts in eight bands


def test_state_is_bounded(spark):
    source, out, checkpoint = (fresh_dir(spark, n) for n in ("near-in", "near-out", "near-ckpt"))
    # one frequent word makes bands that all share; the rest differ
    for part in range(3):
        add(spark, source, [(100 * part + k, "same " * 3 + f"only{part}x{k}", 100 * part + k) for k in range(100)])
    kept, entries = run(spark, source, out, checkpoint, most=4, keep_seconds=1_000_000)
    assert len(kept) == 300
    bands = spark.read.parquet(source).transform(lambda d: neardup.banded(d, "id", "text", "moment")).select("band").distinct().count()
    # at most four entries, a timer and its index for each band, however many items came
    assert max(entries) <= bands * (4 + 3)


def test_values_are_compared_whole(spark):
    rows = spark.createDataFrame([(1, "a b c"), (2, "c b a a"), (3, None), (4, " ")], "id long, text string").withColumn("moment", F.current_timestamp())
    found = neardup.banded(rows, "id", "text", "moment").collect()
    signed = {r.id: r.signature for r in found}
    assert signed["1"] == signed["2"] and len(signed["1"]) == 128 and signed["3"] is None
    assert sorted(r.band for r in found if r.id in "34") == ["none:3", "none:4"]
    assert (neardup._values([signed["1"]]) == neardup._values([signed["2"]])).all()


class Held(dict):
    """A map state that counts what is looked up."""

    looked = 0

    def exists(self):
        return bool(self)

    def getValue(self, key):
        self.looked += 1
        return self.get(key)

    def updateValue(self, key, value):
        self[key] = value


def test_one_call_decides_the_bands_of_a_bucket():
    timers = []
    handle = type("Handle", (), {"listTimers": lambda self: iter(timers), "registerTimer": lambda self, at: timers.append(at)})()
    suppressor = neardup.Suppressor(13, 5, 100)
    suppressor.handle, suppressor.kept = handle, Held()
    at = lambda s: pd.Timestamp(2024, 1, 1) + pd.Timedelta(seconds=s)

    def decide(*rows):
        data = pd.DataFrame([(i, at(s), sig and sig * 128, b) for i, s, sig, b in rows], columns=["id", "moment", "signature", "band"])
        (out,) = suppressor.handleInputRows((0,), iter([data]), None)
        return {(r.id, r.band): bool(r.suppressed) for r in out.itertuples()}

    found = decide(("1", 0, "a", "x"), ("2", 1, "b", "y"), ("3", 2, "a", "y"), ("4", 3, "a", "x"), ("5", 4, None, "none:5"))
    assert found == {("1", "x"): False, ("2", "y"): False, ("3", "y"): False, ("4", "x"): True, ("5", "none:5"): False}
    # bands that did not come are not looked up, and the bucket has one timer
    assert set(suppressor.kept) == {("x",), ("y",)} and suppressor.kept.looked == 0 and len(timers) == 1
    assert decide(("6", 5, "b", "y"), ("7", 200, "b", "y")) == {("6", "y"): True, ("7", "y"): False}
    assert suppressor.kept.looked == 1 and len(timers) == 1


def test_no_partner_goes_for_the_length_of_a_list():
    """A frequent band holds hundreds of unlike texts; a copy of the first is still suppressed, as every pair compared would tell."""
    r = random.Random(4)
    rows, moments = [], []
    for n in range(400):
        if n % 3 == 2:
            own = list(rows[r.randrange(len(rows))])
            for k in r.sample(range(2, 16), r.choice([0, 2, 3, 4])):
                own[k] = r.randrange(1 << 32)
        else:
            own = [7, 7] + [r.randrange(1 << 32) for _ in range(14)]
        rows.append(tuple(own))
        moments.append(n * 1_000_000)
    rows.append(rows[0])
    moments.append(400 * 1_000_000)
    signatures = neardup._values(["".join(f"{v:08x}" for v in own) for own in rows])
    held, decided = np.empty(0, neardup._HELD), []
    # in three calls, as the list comes back from the state
    suppressor = neardup.Suppressor(13, None, 1_000)
    for part in (slice(0, 150), slice(150, 151), slice(151, None)):
        held, some = suppressor._decide(held, np.array(moments[part], np.int64), signatures[part])
        decided += some
    expected, kept = [], []
    for own in rows:
        alike = any(sum(a == b for a, b in zip(own, other)) >= 13 for other in kept)
        expected.append(alike)
        if not alike:
            kept.append(own)
    assert decided == expected and decided[-1] and len(held) == len(kept) > 64
    # a bound that is asked for still holds
    few, some = neardup.Suppressor(13, 5, 1_000)._decide(np.empty(0, neardup._HELD), np.array(moments, np.int64), signatures)
    assert len(few) == 5 and not some[-1]

