"""Panes with revisions, against the rule taken batch by batch."""

import datetime as dt
import math
import random
import zlib

from pyspark.sql import functions as F

from claimloom.llm import panes

SCHEMA = "click_id bigint, ts timestamp_ntz, arrived_at timestamp_ntz, client_id bigint, kind string, value double, props string"
HOUR, DAY = 3_600_000_000, 86_400_000_000
ZERO = dt.datetime(1970, 1, 1)
us = lambda t: (t - ZERO) // dt.timedelta(microseconds=1)


def fed(batches, n, grace=6 * HOUR, close=96 * HOUR):
    """The contract's loop: ``batches`` are (batch, kind, hour, click_id, cents, event)."""
    out, state, w = [], {}, -math.inf
    for b in range(n):
        mine = [r for r in batches if r[0] == b]
        new = {}
        for _, kind, hour, click, cents, _ in mine:
            if w >= (hour + 1) * HOUR + close:
                out.append((b, "late", kind, hour, click, 1, cents))
                continue
            pane = state.setdefault((kind, hour), [0, 0, None])
            new.setdefault((kind, hour), (pane[0], pane[1]))
            pane[0] += 1
            pane[1] += cents
        for (kind, hour), pane in list(state.items()):
            if pane[2] is not None and (kind, hour) in new:
                out.append((b, "retract", kind, hour, -1, *new[kind, hour]))
                out.append((b, "replace", kind, hour, -1, pane[0], pane[1]))
            if pane[2] is None and w >= (hour + 1) * HOUR + grace:
                out.append((b, "emit", kind, hour, -1, pane[0], pane[1]))
                pane[2] = b
            if w >= (hour + 1) * HOUR + close:
                del state[kind, hour]
        w = max([w, *(r[5] for r in mine)])
    out += [(n - 1, "final", k, h, -1, p[0], p[1]) for (k, h), p in state.items() if p[2] is None]
    return sorted(out)


def rows_of(frame):
    return sorted((r.batch, r.record, r.kind, r.hour, r.click_id, r.n_rows, r.cents) for r in frame.collect())


def test_random_batches_and_exact_bounds(spark):
    rng = random.Random(11)
    rows, last = [], 0
    for i in range(220):
        b = rng.choice([0, 1, 2, 4])  # the fourth batch is empty
        event = rng.choice([-30 * HOUR, 0]) + (b * 2 * DAY + rng.randrange(0, 3 * DAY) - rng.choice([0, 0, 5 * DAY]))
        rows.append((b, rng.choice("xy"), event // HOUR, i, rng.randrange(-50, 500), event))
    # a watermark exactly at a pane's due time, and one a millisecond short of another's
    rows = [r for r in rows if r[0] != 0 or r[5] < 0]
    rows += [(0, "z", -100, 1000, 5, -100 * HOUR), (0, "edge", -94, 1001, 7, -93 * HOUR), (1, "z", -100, 1002, 6, -100 * HOUR + 5)]
    assert max(r[5] for r in rows if r[0] == 0) >= -93 * HOUR
    got = rows_of(panes.revisions(spark.createDataFrame([(b, k, h, c, v, e) for b, k, h, c, v, e in rows], panes.BATCH), 5))
    assert got == fed(rows, 5)
    assert {r[1] for r in got} == {"late", "emit", "retract", "replace", "final"}


def test_due_and_closed_at_the_millisecond(spark):
    # W is at the end and 6 hours for hour 0, one millisecond short for hour 1; then the same for closing
    close = 96 * HOUR
    rows = [(0, "a", 0, 1, 1, 5), (0, "a", 1, 2, 2, HOUR), (0, "w", 7, 3, 0, 7 * HOUR), (1, "a", 0, 4, 4, 6), (1, "a", 1, 5, 8, HOUR + 1)]
    rows += [(1, "w", 97, 6, 0, HOUR + close), (2, "a", 0, 7, 16, 7), (2, "a", 1, 8, 32, HOUR + 2)]
    short = [(b, k, h, c, v, e - 1000 if k == "w" else e) for b, k, h, c, v, e in rows]
    for some in (rows, [(b, k, (e // HOUR), c, v, e) for b, k, h, c, v, e in short]):
        assert rows_of(panes.revisions(spark.createDataFrame(some, panes.BATCH), 3)) == fed(some, 3)


def test_clicks_are_cut_as_the_contract_says(spark):
    rng = random.Random(2)
    t = lambda d, s=0: dt.datetime(2024, 1, 1) + dt.timedelta(days=d, seconds=s)
    data = []
    for i in range(150):
        at = t(rng.randrange(20), rng.randrange(86400))
        data.append((i, at - dt.timedelta(seconds=rng.choice([0, 5, 4000, 200000]), microseconds=rng.randrange(10**6)), at, 1, rng.choice(["view", None, "none"]), rng.choice([1.005, -2.345, None, math.nan, math.inf, 7.0]), "{}"))
    data += [data[0], data[1], (None, t(1), t(1, 3), 1, "view", 1.0, ""), (None, t(1), t(1, 3), 1, "view", 1.0, ""), (None, t(1), t(1, 4), 1, "view", 1.0, ""), (500, None, t(2), 1, "view", 1.0, ""), (501, t(2), None, 1, "view", 1.0, "")]
    frame = spark.createDataFrame(data, SCHEMA).withColumns({c: F.lit("x") for c in ("batch", "row", "day", "q", "whole", "hour", "event_us")})
    seen, want = set(), []
    for click, ts, at, _, kind, value, _ in data:
        key = click if click is not None else (ts, at, kind, value)
        if ts is None or key in seen:
            continue
        seen.add(key)
        day = us(at or ts) // DAY
        q = day % 8
        event = us(ts) - (day - q) * DAY
        cents = math.floor(100 * value + 0.5) if value is not None and math.isfinite(value) else 0
        want.append((min(7, q + max(0, zlib.crc32(("" if click is None else str(click)).encode()) % 30 - 23)), kind or "none", event // HOUR, click, cents, event))
    got = [tuple(r) for r in panes.clicks_by_batch(frame, 8).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_no_rows(spark):
    assert panes.revisions(spark.createDataFrame([], panes.BATCH), 2).count() == 0
