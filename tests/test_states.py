"""What the states of ordered streams hold and how they are asked, without a stream."""

import random

import pandas as pd
from pyspark.sql import types as T

from millrace.streaming import ordered

FIELDS = [T.StructField(n, T.StringType()) for n in ("us", "k", "request", "side")]


class Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Map(dict):
    containsKey, getValue, updateValue, removeKey = dict.__contains__, dict.get, dict.__setitem__, dict.__delitem__


class Handle:
    def __init__(self):
        self.timers = []

    def getMapState(self, *_):
        return Map()

    def getValueState(self, *_):
        return Value()

    def registerTimer(self, at):
        self.timers.append(at)


class Clock:
    def __init__(self, at=0):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at

    getExpiryTimeInMs = getCurrentWatermarkInMs


def released(processor, key=(0,)):
    out = []
    for at in sorted(set(processor.handle_.timers)):
        out += list(processor.handleExpiredTimer(key, None, Clock(at)))
    return pd.concat(out, ignore_index=True)


def test_a_micro_batch_is_taken_in_bounded_runs(monkeypatch):
    monkeypatch.setattr(ordered, "ROWS_AT_ONCE", 100)
    monkeypatch.setattr(ordered.gathered, "__defaults__", (100,))
    processor = ordered._FirstResponse(FIELDS, ["us", "side"], 1_000_000, 5_000_000)
    processor.init(Handle())
    frames = (
        pd.DataFrame({"us": range(n, n + 50), "k": [str(i) for i in range(n, n + 50)], "request": "{}", "side": ordered.REQUEST}) for n in range(0, 1000, 50)
    )
    list(processor.handleInputRows((0,), frames, Clock()))
    sizes = [len(ordered.unpacked(v)) for v in processor.chunks.values()]
    assert sum(sizes) == 1000 and max(sizes) <= 100
    # The requests wait in slot 0; their time runs out in slot 5, which has a timer of its own and no rows.
    assert sorted(processor.handle_.timers) == [1000, 6000]
    found = released(processor)
    assert len(found) == 1000 and found["answer"].isna().all() and not processor.chunks and not processor.sizes


def test_a_state_answers_its_keys_together():
    rng = random.Random(3)
    rows = [(rng.randrange(3_000_000), f"u{rng.randrange(40)}", n, f"i{n}" if n % 2 else None, (n + 1) % 2) for n in range(600)]
    frame = pd.DataFrame(rows, columns=["us", "k", "id", "info", "side"])
    fields = [T.StructField(c, T.StringType()) for c in frame.columns]
    processor = ordered._AsOf(fields, ["us", "side", "id"], 1_000_000, "id", "info", "none")
    processor.init(Handle())
    early = pd.concat(processor.handleInputRows((0,), iter([frame[:200], frame[200:]]), Clock()))
    # One timer for each slot, whatever the number of keys.
    assert sorted(processor.handle_.timers) == [1000, 2000, 3000]
    infos = sorted((us, id_, k, info) for us, k, id_, info, side in rows if side == 0)
    want = {id_: ([i for u, _, o, i in infos if o == k and u <= us] or ["none"])[-1] for us, k, id_, _, side in rows if side == 1}
    for found in (early, released(processor)):
        assert len(found) == 300 and dict(zip(found["tie"], found["info"])) == want
