"""The streamed breaker over a large batch: its memory, and its order across runs on disk."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pandas as pd

from salvor.operators.provider import ARCHIVE, observe, start
from salvor.streaming import streams


def stepper(breaker=ARCHIVE):
    """The function that a stream gives each endpoint's rows to."""
    got = {}
    grouped = SimpleNamespace(applyInPandasWithState=lambda f, *_: got.update(f=f))
    streams.breaker_stream(SimpleNamespace(groupBy=lambda _: grouped), breaker)
    return got["f"]


def outcomes(n: int, seed: int = 1) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    f = pd.DataFrame({"event_id": rng.permutation(n), "ts": rng.integers(0, n // 3, n).astype(float), "failure": rng.random(n) < 0.3})
    return f.assign(content=~f["failure"])


class State(SimpleNamespace):
    def update(self, value):
        self.exists, self.get = True, value


def test_a_large_batch_needs_bounded_memory(monkeypatch):
    monkeypatch.setattr(streams, "HELD", 20_000, raising=False)
    n, seen = 200_000, 0
    frames = (outcomes(5_000, k) for k in range(n // 5_000))
    tracemalloc.start()
    for out in stepper()(("cdx",), frames, State(hasTimedOut=False, exists=False)):
        seen += len(out)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == n and peak < 20 << 20


def test_rows_are_taken_in_order_across_runs(monkeypatch):
    monkeypatch.setattr(streams, "HELD", 64, raising=False)
    f = outcomes(1_000)
    state = State(hasTimedOut=False, exists=False)
    got = pd.concat(stepper()(("cdx",), iter([f[k : k + 37] for k in range(0, len(f), 37)]), state))
    s, want = start(), []
    for r in f.sort_values(["ts", "event_id"]).itertuples():
        met = observe(s, r.ts, r.failure, r.content, ARCHIVE)
        want.append(("cdx", r.event_id, r.ts, r.failure, r.content, met, s["consecutive"], s["pause_until"], s["openings"]))
    assert list(got.itertuples(index=False, name=None)) == want
    assert state.get == (s["consecutive"], s["pause_until"], s["probe"], s["openings"])


def test_events_without_time_or_id_come_last():
    f = pd.DataFrame({"event_id": [3.0, np.nan, 1.0, 2.0], "ts": [1.0, 1.0, np.nan, 0.0], "failure": [True, None, True, False], "content": [False, True, False, True]})
    got = [pd.concat(stepper()(("cdx",), iter([f]), State(hasTimedOut=False, exists=False)))]
    assert got[0]["event_id"].astype(object).where(got[0]["event_id"].notna(), None).tolist() == [2, 3, None, 1]
    assert got[0]["failure"].tolist() == [False, True, False, True]
