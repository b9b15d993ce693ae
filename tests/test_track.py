"""The track query against a plain tracker that tries every assignment, on a few walks."""

import datetime
import itertools

import numpy as np
import pandas as pd

from portico.operators import tracking
from portico.plans import registry

START = datetime.datetime(2024, 1, 5, 8)
#: (event_id, second, user_id, value): walkers that start abreast, join later or come alone. Walks in turn are too far apart in place or time to be linked.
EVENTS = [(1, 0, 8, 10.0), (2, 0, 16, 13.5), (3, 0, 24, 16.0), (43, 1, 8, 14.0), (10, 1, 16, 90.0), (7, 20, 8, 12.0), (8, 20, 32, 12.5), (9, 21, 8, 90.0), (11, 0, 9, 10.0), (12, 0, 17, 40.0), (15, 1, 9, 14.0), (13, 9, 9, 10.0), (14, 2, 3, 50.0)]


def detections(base):
    out = {}
    for event, second, user, value in EVENTS:
        for s in range(10):
            x, y = value * 5 + s * 4, event % 40 * 10 + s * 2
            out.setdefault(user % 8, {}).setdefault(base + second + s / 5, []).append((f"{event}:{s}", float(x), float(y)))
    return out


def cheapest(cost):
    rows, columns = len(cost), len(cost[0])
    if rows > columns:
        return [(i, j) for j, i in cheapest([list(c) for c in zip(*cost, strict=True)])]
    return list(enumerate(min(itertools.permutations(range(columns), rows), key=lambda p: sum(cost[i][j] for i, j in enumerate(p)))))


def overlap(p, q):
    w, h = (max(0.0, min(p[k] + p[k + 2] / 2, q[k] + q[k + 2] / 2) - max(p[k] - p[k + 2] / 2, q[k] - q[k + 2] / 2)) for k in (0, 1))
    return w * h / (p[2] * p[3] + q[2] * q[3] - w * h)


def plain_tracks(frames):
    """Birth, Kalman motion, gated cost and assignment by trial; all boxes are 20 x 40 and sure, none is missed."""
    r = np.diag([max(20 * 0.05, 1), max(40 * 0.05, 1), max(20 * 0.1, 1), max(40 * 0.1, 1)]) ** 2
    h = np.eye(4, 8)
    live, every = [], []
    for index, (now, seen) in enumerate(sorted(frames.items())):
        live = [f for f in live if now - f["path"][-1][0] <= (2.5 if len(f["path"]) >= f["need"] else 1.0)]
        for f in live:
            dt = now - f["at"]
            step, q = np.eye(8), np.zeros((8, 8))
            for k, a in enumerate((25.0, 25.0, 10.0, 10.0)):
                step[k, k + 4] = dt
                g = np.zeros(8)
                g[k], g[k + 4] = dt * dt / 2, dt
                q += a * a * np.outer(g, g)
            f.update(state=step @ f["state"], cov=step @ f["cov"] @ step.T + q, at=now)
        boxes = [np.array([x, y, 20.0, 40.0]) for _, x, y in sorted(seen)]
        cost = []
        for f in live:
            d2 = [float((z - h @ f["state"]) @ np.linalg.inv(h @ f["cov"] @ h.T + r) @ (z - h @ f["state"])) for z in boxes]
            cost.append([0.7 * d / 13.28 + 0.3 * (1 - overlap(f["state"][:4], z)) if d <= 13.28 else 1e6 for d, z in zip(d2, boxes, strict=True)])
        pairs = [(i, j) for i, j in (cheapest(cost) if live else []) if cost[i][j] <= 0.88]
        for i, j in pairs:
            f = live[i]
            gain = f["cov"] @ h.T @ np.linalg.inv(h @ f["cov"] @ h.T + r)
            f["state"], f["cov"] = f["state"] + gain @ (boxes[j] - h @ f["state"]), (np.eye(8) - gain @ h) @ f["cov"]
            f["path"].append((now, boxes[j][0], boxes[j][1]))
        for j in set(range(len(boxes))) - {j for _, j in pairs}:
            v = np.diag([*np.diag(r), *[1e4] * 4])
            live.append({"id": len(every) + 1, "need": 2 if index < 10 else 4, "state": np.array([*boxes[j], 0, 0, 0, 0]), "cov": v, "at": now, "path": [(now, boxes[j][0], boxes[j][1])]})
            every.append(live[-1])
    return {f["id"]: f["path"] for f in every if len(f["path"]) >= f["need"]}


def test_track_query_tracks_every_event(spark, tmp_path):
    rows = [(e, START + datetime.timedelta(seconds=s), u, "view", v, "{}") for e, s, u, v in EVENTS]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    got = {(r["device_id"], r["track_id"]): r for r in registry.QUERIES["track"](spark, str(tmp_path)).collect()}
    base = int(START.replace(tzinfo=datetime.UTC).timestamp()) - registry.CREATED
    want = {(device, str(k)): path for device, frames in detections(base).items() for k, path in plain_tracks(frames).items()}
    assert {k: [(round(p["timestamp"], 6), p["centre"]["x"], p["centre"]["y"]) for p in r["path"]] for k, r in got.items()} == {k: [(round(t, 6), x, y) for t, x, y in path] for k, path in want.items()}
    assert sum(len(p) for p in want.values()) == 10 * len(EVENTS)
    assert len(want) == len(EVENTS)
    for (_, _), r in got.items():
        first = r["path"][0]
        assert (r["n_points"], r["confidence"], r["best_crop"]["frame_id"]) == (len(r["path"]), 0.9, f"{first['timestamp']:.1f}")
        assert (r["best_crop"]["bbox"]["x1"], r["best_crop"]["bbox"]["y2"]) == (first["centre"]["x"] - 10, first["centre"]["y"] + 20)


def test_stretches_give_the_tracks_of_the_whole_batch(spark):
    """Cut at quiet times and tracked apart, a device's history gives the same tracks and ids as in one go."""
    r = np.random.default_rng(4)
    rows, t = [], 100.0
    for block in range(40):
        t += float(r.choice([0.6, 2.4, 2.6, 40.0]))
        starts = r.uniform(0, 60, size=(int(r.integers(1, 4)), 2))
        for k in range(int(r.integers(2, 14))):
            for w, (x, y) in enumerate(starts):
                if r.random() < 0.85:
                    cx, cy = x + 4 * k + r.normal(), y + 2 * k + r.normal()
                    rows.append(("d", round(t + k / 5, 3), f"{t + k / 5:.3f}", f"{block}:{w}:{k}", cx, cy, cx - 10, cy - 20, cx + 10, cy + 20, float(r.choice([0.3, 0.9]))))
        t += 14 / 5
    frame = pd.DataFrame(rows, columns=["device_id", "timestamp", "frame_id", "detection_id", "cx", "cy", "x1", "y1", "x2", "y2", "confidence"])
    want = {str(f.order): [(float(o[tracking.T]), float(o[tracking.X])) for o in f.obs] for f in tracking.track(frame)}
    found = tracking.track_devices(spark.createDataFrame(frame).repartition(3)).collect()
    assert {x["track_id"]: [(p["timestamp"], p["centre"]["x"]) for p in x["path"]] for x in found} == want
    assert len(want) > 20


def crowd(seed, blocks, most):
    """One device's detections with quiet times, crossing walks, missed, unsure, repeated and empty frames."""
    r = np.random.default_rng(seed)
    rows, t = [], 100.0
    for block in range(blocks):
        t += float(r.choice([0.2, 0.6, 1.2, 2.4, 2.6, 40.0]))
        starts, speed = r.uniform(0, 120, size=(int(r.integers(1, most)), 2)), r.normal(0, 6, size=(most, 2))
        length = int(r.integers(2, 14))
        for k in range(length):
            now = t + k / 5
            if r.random() < 0.1:
                rows.append((round(now, 3), f"{now:.3f}x", None, *[None] * 6, None))
            for w, place in enumerate(starts):
                if r.random() < 0.8:
                    cx, cy = place + speed[w] * k + r.normal(0, 1, 2)
                    b, h = 20 * r.uniform(0.8, 1.2), 40 * r.uniform(0.8, 1.2)
                    rows.append((round(now, 3), f"{now:.3f}", f"{block}:{w}:{k}", cx, cy, cx - b / 2, cy - h / 2, cx + b / 2, cy + h / 2, float(r.choice([0.2, 0.3, 0.45, 0.9, 0.91]))))
        t += length / 5
    return pd.DataFrame(rows, columns=["timestamp", "frame_id", "detection_id", "cx", "cy", "x1", "y1", "x2", "y2", "confidence"])


def shown(f):
    return [(float(o[tracking.T]), float(o[tracking.X])) for o in f.obs], f.best_frame, float(f.best[tracking.CONF]), float(f.best[tracking.X1])


def test_devices_tracked_in_step_give_the_tracks_of_each_alone(spark, monkeypatch):
    """Crowded devices, tracked together frame by frame over all their stretches; what competes goes through the same assignment."""
    monkeypatch.setattr(tracking, "SPAN_SECONDS", 60)
    every = {d: crowd(d, 80, 2 + d) for d in range(6)}
    want = {(d, str(f.order)): shown(f) for d, frame in every.items() for f in tracking.track(frame)}
    rows = [(d, *(None if x != x else x for x in r)) for d, frame in every.items() for r in frame.itertuples(index=False)]
    kinds = "device_id int, timestamp double, frame_id string, detection_id string, cx double, cy double, x1 double, y1 double, x2 double, y2 double, confidence double"
    found = tracking.track_devices(spark.createDataFrame(rows, kinds).repartition(3)).collect()
    got = {(x["device_id"], x["track_id"]): ([(p["timestamp"], p["centre"]["x"]) for p in x["path"]], x["best_crop"]["frame_id"], x["best_crop_confidence"], x["best_crop"]["bbox"]["x1"]) for x in found}
    assert got == want
    assert len(want) > 200


def test_frames_of_all_stretches_are_one_step(monkeypatch):
    """A thousand walks apart from each other take as many steps as one of them has frames."""
    import pyarrow as pa
    from portico.operators import lockstep

    n, frames = 1000, 10
    t = np.repeat(np.arange(n) * 60.0, frames) + np.tile(np.arange(frames) / 5, n)
    x = np.tile(np.arange(frames) * 4.0, n)
    table = pa.table({"d": np.zeros(n * frames, np.int64), "_group": np.zeros(n * frames, np.int64), "_begin": t * 0, "_end": t * 0 + t[-1], "_early": t < 2, "_real": t >= 0, "_frame": [f"{v:.1f}" for v in t], "_detection": [str(i) for i in range(n * frames)],
                      "timestamp": t, "cx": x, "cy": x, "x1": x - 10, "y1": x - 20, "x2": x + 10, "y2": x + 20, "confidence": x * 0 + 0.9})
    steps, plain = [], lockstep.match
    monkeypatch.setattr(lockstep, "match", lambda *a: steps.append(1) or plain(*a))
    found = lockstep.track_groups(table, "d").to_pylist()
    assert len(steps) == frames - 1
    assert [r["_born"] for r in found if r["_order"] is None] == [n]
    assert sorted(r["_order"] for r in found if r["_order"]) == list(range(1, n + 1))
    assert {len(r["path"]) for r in found if r["_order"]} == {frames}
