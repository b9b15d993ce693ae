"""Multi-object tracking of one camera's detections, and its Spark form.

The tracker keeps all live tracks as stacked arrays, and costs of a frame are one array operation over tracks and
detections. It is sequential only while tracks live: where a camera sees nothing for longer than any track may
wait, its history falls into stretches that know nothing of each other. Stretches are tracked in parallel, in groups of
neighbours; only one stretch's detections need to be in memory together.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .assignment import assign

# -- fixed values ---------------------------------------------------------------------------------
BOOTSTRAP_FRAMES, BOOTSTRAP_HITS, LATER_HITS = 10, 2, 4
TENTATIVE_SECONDS, ACTIVE_SECONDS = 1.0, 2.5
HIGH, LOW = 0.50, 0.25
MATCH_COST, RECOVERY_COST = 0.88, 0.80
RESCUE_SECONDS, RESCUE_COST = 1.75, 0.94
LINK_SECONDS, LINK_COST, LINK_ROUNDS = 1.75, 0.48, 2
GATE, MOTION_SHARE, OVERLAP_SHARE = 13.28, 0.70, 0.30
CENTRE_ACCELERATION, SIZE_ACCELERATION = 25.0, 10.0
CENTRE_ERROR, SIZE_ERROR, FIRST_VELOCITY_VARIANCE = 0.05, 0.10, 10_000.0
ENDPOINT, LEAST_BOX, FAR, TIE = 4, 1e-3, 1e6, 1e-12
RESCUE = {"position": 0.65, "direction": 0.15, "box": 0.10, "gap": 0.05, "confidence": 0.05, "gate": 16.0, "ratio": (0.25, 4.0), "soft": 2.0, "history": 0.08, "step": 0.06, "most": 0.18}
LINK = {"position": 0.55, "direction": 0.15, "speed": 0.10, "box": 0.10, "gap": 0.10, "ratio": (0.4, 2.5), "soft": 1.75, "birth": 0.06, "death": 0.06, "active": 0.04, "weak": 0.05}

#: No track lives on, and no two fragments are linked, over a longer time without frames.
QUIET_SECONDS = max(TENTATIVE_SECONDS, ACTIVE_SECONDS, RESCUE_SECONDS, LINK_SECONDS)
#: Stretches that begin within one such span of a device's time are handed to a Python worker together.
SPAN_SECONDS = 21_600

#: Columns of an observation.
T, X, Y, X1, Y1, X2, Y2, CONF = range(8)


def sizes(obs: np.ndarray) -> np.ndarray:
    return np.maximum(np.stack([obs[..., X2] - obs[..., X1], obs[..., Y2] - obs[..., Y1]], axis=-1), LEAST_BOX)


def measured(obs: np.ndarray) -> np.ndarray:
    """Centre and size of observations."""
    return np.concatenate([obs[..., [X, Y]], sizes(obs)], axis=-1)


def noise(z: np.ndarray) -> np.ndarray:
    """Diagonal of the measurement covariance."""
    size = np.maximum(z[..., 2:4], LEAST_BOX)
    return np.maximum(np.concatenate([size * CENTRE_ERROR, size * SIZE_ERROR], axis=-1), 1.0) ** 2


def propagate(state: np.ndarray, cov: np.ndarray, dt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Constant-velocity motion of stacked states over times dt."""
    n = len(dt)
    step = np.tile(np.eye(8), (n, 1, 1))
    step[:, range(4), range(4, 8)] = dt[:, None]
    var = np.array([CENTRE_ACCELERATION, CENTRE_ACCELERATION, SIZE_ACCELERATION, SIZE_ACCELERATION]) ** 2
    added, i = np.zeros((n, 8, 8)), np.arange(4)
    added[:, i, i] = var * dt[:, None] ** 4 / 4
    added[:, i, i + 4] = added[:, i + 4, i] = var * dt[:, None] ** 3 / 2
    added[:, i + 4, i + 4] = var * dt[:, None] ** 2
    return np.einsum("nij,nj->ni", step, state), step @ cov @ step.transpose(0, 2, 1) + added


def overlap(z: np.ndarray, obs: np.ndarray) -> np.ndarray:
    """Intersection over union of predicted boxes (centre, size) and observed ones, all with all."""
    half = np.maximum(z[:, 2:4], LEAST_BOX) / 2
    low, high = (z[:, :2] - half)[:, None], (z[:, :2] + half)[:, None]
    other_low, other_high = obs[None, :, [X1, Y1]], obs[None, :, [X2, Y2]]
    shared = np.maximum(np.minimum(high, other_high) - np.maximum(low, other_low), 0).prod(axis=2)
    union = np.maximum(high - low, 0).prod(axis=2) + np.maximum(other_high - other_low, 0).prod(axis=2) - shared
    return np.divide(shared, union, out=np.zeros_like(shared), where=union > 0)


@dataclass
class Fit:
    """A line through up to four endpoint observations of centre and log size."""

    start: float
    value: np.ndarray
    velocity: np.ndarray
    scatter: np.ndarray
    trust: float

    def at(self, time: float) -> np.ndarray:
        return self.value + self.velocity * (time - self.start)


def fit_line(obs: np.ndarray) -> Fit:
    v = np.concatenate([obs[:, [X, Y]], np.log(sizes(obs))], axis=1)
    t = obs[:, T] - obs[0, T]
    if len(obs) == 1 or np.ptp(t) <= 1e-9:
        return Fit(obs[0, T], v[0], np.zeros(4), np.zeros(2), 0.0)
    c = t - t.mean()
    slope = c @ (v - v.mean(axis=0)) / (c @ c)
    base = v.mean(axis=0) - slope * t.mean()
    rest = v - base - t[:, None] * slope
    return Fit(obs[0, T], base, slope, (rest[:, :2] ** 2).mean(axis=0), {2: 0.35, 3: 0.70}.get(len(obs), 1.0))


@dataclass
class Fragment:
    order: int
    need: int
    obs: list[np.ndarray]
    best_frame: str
    best: np.ndarray
    state: np.ndarray
    cov: np.ndarray
    seen_state: np.ndarray
    seen_cov: np.ndarray
    predicted: float
    active: bool = False
    closed: bool = False
    parts: list[int] = field(default_factory=list)

    @property
    def seen(self) -> float:
        return float(self.obs[-1][T])

    @property
    def count(self) -> int:
        return len(self.obs)

    def take(self, o: np.ndarray, frame: str) -> None:
        """Kalman update with an observation, in Joseph's form."""
        z = measured(o)
        r = np.diag(noise(z))
        gain = np.linalg.solve(self.cov[:4, :4] + r, self.cov[:4]).T
        left = np.eye(8)
        left[:, :4] -= gain
        self.state = self.state + gain @ (z - self.state[:4])
        self.state[2:4] = np.maximum(self.state[2:4], LEAST_BOX)
        cov = left @ self.cov @ left.T + gain @ r @ gain.T
        self.cov = (cov + cov.T) / 2
        self.seen_state, self.seen_cov = self.state.copy(), self.cov.copy()
        self.obs.append(o)
        if o[CONF] > self.best[CONF]:
            self.best, self.best_frame = o, frame
        self.active = self.active or len(self.obs) >= self.need


def born(o: np.ndarray, frame: str, order: int, need: int) -> Fragment:
    z = measured(o)
    state = np.concatenate([z, np.zeros(4)])
    cov = np.diag(np.concatenate([noise(z), np.full(4, FIRST_VELOCITY_VARIANCE)]))
    return Fragment(order, need, [o], frame, o, state, cov, state.copy(), cov.copy(), float(o[T]), active=need <= 1, parts=[order])


def match(tracks: list[Fragment], obs: np.ndarray, most: float) -> list[tuple[int, int]]:
    """Gated pairs of least total cost of motion and overlap."""
    if not tracks or not len(obs):
        return []
    state, cov = np.stack([f.state for f in tracks]), np.stack([f.cov for f in tracks])
    z = measured(obs)
    s = np.tile(cov[:, None, :4, :4], (1, len(obs), 1, 1))
    s[..., range(4), range(4)] += noise(z)[None]
    gap = z[None] - state[:, None, :4]
    d2 = np.maximum((gap * np.linalg.solve(s, gap[..., None])[..., 0]).sum(axis=2), 0)
    ok = np.isfinite(d2) & (d2 <= GATE)
    cost = np.where(ok, MOTION_SHARE * d2 / GATE + OVERLAP_SHARE * (1 - overlap(state[:, :4], obs)), FAR)
    return [(i, j) for i, j in assign(cost) if ok[i, j] and cost[i, j] <= most]


def box_cost(ratio: np.ndarray, soft: float) -> np.ndarray:
    return np.minimum(np.abs(np.log(ratio)) / np.log(soft), 1).mean(axis=-1)


def turn(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cosine of the angle between vectors; 1 where either has no length."""
    n = np.linalg.norm(u, axis=-1) * np.linalg.norm(v, axis=-1)
    return np.clip(np.divide((u * v).sum(axis=-1), n, out=np.ones_like(n), where=n > 0), -1, 1)


def rescue(tracks: list[Fragment], obs: np.ndarray, now: float) -> list[tuple[int, int]]:
    """Unmatched established tracks and left-over detections joined by plausible continuation."""
    if not tracks or not len(obs):
        return []
    w = RESCUE
    last = np.stack([f.obs[-1] for f in tracks])
    fits = [fit_line(np.stack(f.obs[-ENDPOINT:])) for f in tracks]
    gap = now - last[:, T]
    size_a, size_b = sizes(last)[:, None], sizes(obs)[None]
    ratio = size_b / size_a
    ok = ((ratio >= w["ratio"][0]) & (ratio <= w["ratio"][1])).all(axis=2) & ((gap >= 0) & (gap <= RESCUE_SECONDS))[:, None]
    diagonal = np.hypot(*np.moveaxis((size_a + size_b) / 2, 2, 0))
    move = obs[None, :, [X, Y]] - last[:, None, [X, Y]]
    length = np.linalg.norm(move, axis=2)
    velocity = np.stack([f.velocity[:2] for f in fits])
    speed = np.linalg.norm(velocity, axis=1)
    trust = np.array([f.trust for f in fits])[:, None]
    ok &= length <= 2 * diagonal + (1.5 * speed * gap)[:, None]
    var = np.stack([np.diag(f.cov)[:2] for f in tracks])[:, None] + noise(measured(obs))[None, :, :2]
    var = np.minimum(var, ((1.5 * diagonal) ** 2)[..., None])
    d2 = ((obs[None, :, [X, Y]] - np.stack([f.state[:2] for f in tracks])[:, None]) ** 2 / var).sum(axis=2)
    ok &= np.isfinite(d2) & (d2 <= w["gate"])
    moving = (trust > 0) & (speed[:, None] > 1e-9) & (length > 0.25 * diagonal)
    cosine = turn(np.broadcast_to(velocity[:, None], move.shape), move)
    ok &= ~(moving & (trust >= 0.7) & (cosine < -0.75))
    unsure = 1 - np.clip((obs[:, CONF] - LOW) / max(1 - LOW, 1e-9), 0, 1)
    bonus = w["history"] * np.minimum(np.log1p([f.count for f in tracks]) / np.log(26.0), 1)
    base = w["position"] * np.minimum(d2 / w["gate"], 1) + w["direction"] * np.where(moving, trust * (1 - cosine) / 2, 0) + w["box"] * box_cost(ratio, w["soft"])
    base += w["gap"] * ((gap / RESCUE_SECONDS) ** 2)[:, None] + w["confidence"] * unsure[None] - bonus[:, None]
    base = np.maximum(base, 0)
    ok &= np.isfinite(base) & (base <= RESCUE_COST)
    if not ok.any():
        return []
    extra = np.maximum(ok.sum(axis=1) - 1, 0)[:, None] + np.maximum(ok.sum(axis=0) - 1, 0)[None]
    cost = base + np.minimum(w["step"] * extra, w["most"]) + TIE * (np.arange(ok.size).reshape(ok.shape) + 1)
    n = len(tracks)
    alone = np.full((n, n), FAR)
    alone[range(n), range(n)] = RESCUE_COST + TIE * (np.arange(n) + 1)
    whole = np.concatenate([np.where(ok, cost, FAR), alone], axis=1)
    return [(i, j) for i, j in assign(whole) if j < len(obs) and ok[i, j] and cost[i, j] <= RESCUE_COST]


def link_costs(parts: list[Fragment], begin: float, end: float) -> dict[tuple[int, int], float]:
    """Costs of (earlier, later) fragments of which the later may go on with the earlier: a band join on time, then gates."""
    w = LINK
    obs = [np.stack(f.obs) for f in parts]
    first, last = np.stack([o[0] for o in obs]), np.stack([o[-1] for o in obs])
    by_start = np.argsort(first[:, T], kind="stable")
    starts = first[by_start, T]
    lo, hi = np.searchsorted(starts, last[:, T], "right"), np.searchsorted(starts, last[:, T] + LINK_SECONDS, "right")
    a = np.repeat(np.arange(len(parts)), hi - lo)
    b = by_start[np.concatenate([np.arange(x, y) for x, y in zip(lo, hi, strict=True)]).astype(int)] if len(a) else a
    on = np.array([f.active for f in parts])
    keep = (a != b) & (on[a] | on[b])
    a, b = a[keep], b[keep]
    if not len(a):
        return {}
    heads, tails = [fit_line(o[:ENDPOINT]) for o in obs], [fit_line(o[-ENDPOINT:]) for o in obs]
    gap = first[b, T] - last[a, T]
    size_a, size_b = sizes(last)[a], sizes(first)[b]
    ratio = size_b / size_a
    diagonal = np.hypot(*((size_a + size_b) / 2).T)
    va, vb = np.stack([f.velocity[:2] for f in tails])[a], np.stack([f.velocity[:2] for f in heads])[b]
    sa, sb = np.linalg.norm(va, axis=1), np.linalg.norm(vb, axis=1)
    from_, to = last[a][:, [X, Y]], first[b][:, [X, Y]]
    ok = ((ratio >= w["ratio"][0]) & (ratio <= w["ratio"][1])).all(axis=1) & (gap > 0) & (gap <= LINK_SECONDS)
    ok &= np.linalg.norm(to - from_, axis=1) <= 4 * diagonal + 1.5 * np.maximum(sa, sb) * gap
    state, cov = propagate(np.stack([parts[i].seen_state for i in a]), np.stack([parts[i].seen_cov for i in a]), gap)
    s = cov[:, :2, :2].copy()
    s[:, range(2), range(2)] += noise(measured(first[b]))[:, :2]
    miss = to - state[:, :2]
    forward = np.maximum((miss * np.linalg.solve(s, miss[..., None])[..., 0]).sum(axis=1), 0)
    back = np.stack([heads[j].at(t)[:2] for j, t in zip(b, last[a, T], strict=True)])
    trust_b, trust_a = np.array([f.trust for f in heads])[b], np.array([f.trust for f in tails])[a]
    var = np.maximum(size_a * CENTRE_ERROR, 1.0) ** 2 + np.stack([f.scatter for f in heads])[b] + ((CENTRE_ACCELERATION * gap**2 / 2) ** 2)[:, None]
    var += np.where(trust_b < 0.5, (0.25 * diagonal) ** 2, 0)[:, None]
    backward = ((from_ - back) ** 2 / var).sum(axis=1)
    ok &= np.isfinite(forward) & np.isfinite(backward) & (forward <= GATE) & (backward <= GATE)
    trust = np.where((sa > 1e-9) & (sb > 1e-9), trust_a * trust_b, 0)
    jitter = diagonal / np.maximum(gap, 1 / 3)
    count, conf = np.array([len(o) for o in obs]), np.array([o[:, CONF].mean() for o in obs])
    evidence = (np.minimum((count[a] + count[b]) / 8, 1) + np.minimum((conf[a] + conf[b]) / 2, 1) + (trust_a + trust_b) / 2) / 3
    cost = w["position"] * (np.minimum(forward / GATE, 1) + np.minimum(backward / GATE, 1)) / 2
    cost += w["direction"] * trust * (1 - turn(va, vb)) / 2 + w["speed"] * trust * np.minimum(np.linalg.norm(va - vb, axis=1) / (sa + sb + jitter), 1)
    cost += w["box"] * box_cost(ratio, w["soft"]) + w["gap"] * (gap / LINK_SECONDS) ** 2
    cost -= w["birth"] * np.clip((first[b, T] - begin) / LINK_SECONDS, 0, 1) + w["death"] * np.clip((end - last[a, T]) / LINK_SECONDS, 0, 1)
    cost += w["weak"] * (1 - evidence) - w["active"] * np.where(on[a] & on[b], 1.0, 0.5)
    cost = np.maximum(cost, 0)
    ok &= np.isfinite(cost) & (cost <= LINK_COST)
    return {(int(i), int(j)): float(c) for i, j, c in zip(a[ok], b[ok], cost[ok], strict=True)}


def chained(chain: list[Fragment]) -> Fragment:
    """Linked fragments as one: the earliest one's id, the latest one's motion, all distinct points in time order."""
    points = {(o[T], o[X], o[Y]): o for f in reversed(chain) for o in reversed(f.obs)}
    eldest, latest = min(chain, key=lambda f: f.order), max(chain, key=lambda f: f.seen)
    best = max(sorted(chain, key=lambda f: f.order), key=lambda f: f.best[CONF])
    return replace(
        eldest, obs=[points[k] for k in sorted(points)], best=best.best, best_frame=best.best_frame, active=any(f.active for f in chain), parts=[p for f in chain for p in f.parts],
        state=latest.seen_state.copy(), cov=latest.seen_cov.copy(), seen_state=latest.seen_state.copy(), seen_cov=latest.seen_cov.copy(), predicted=latest.seen,
    )


def apart(pairs: Iterable[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Pairs (earlier, later) in groups that share neither an earlier nor a later fragment, so each is assigned by itself."""
    root: dict[tuple[int, int], tuple[int, int]] = {}

    def top(v: tuple[int, int]) -> tuple[int, int]:
        while root.setdefault(v, v) != v:
            root[v] = v = root[root[v]]
        return v

    pairs = list(pairs)
    for i, j in pairs:
        root[top((0, i))] = top((1, j))
    out: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for i, j in pairs:
        out.setdefault(top((0, i)), []).append((i, j))
    return list(out.values())


def linked(parts: list[Fragment], begin: float, end: float) -> list[Fragment]:
    """Fragments joined to longer tracks, in at most two rounds."""
    for _ in range(LINK_ROUNDS):
        costs = link_costs(parts, begin, end) if parts else {}
        if not costs:
            break
        n = len(parts)
        after = {}
        for pairs in apart(costs):
            rows, columns = sorted({i for i, _ in pairs}), sorted({j for _, j in pairs})
            at, to = {i: k for k, i in enumerate(rows)}, {j: k for k, j in enumerate(columns)}
            m, own = len(rows), len(columns)
            whole = np.full((m, own + m), FAR)
            for i, j in pairs:
                whole[at[i], to[j]] = costs[i, j] + TIE * (i * n + j + 1)
            whole[range(m), range(own, own + m)] = LINK_COST + TIE * (np.array(rows) + 1)
            after |= {rows[i]: columns[j] for i, j in assign(whole) if j < own and (rows[i], columns[j]) in costs}
        if not after:
            break
        out = []
        for i in set(range(n)) - set(after.values()):
            chain = [i]
            while chain[-1] in after:
                chain.append(after[chain[-1]])
            out.append(chained([parts[k] for k in chain]) if len(chain) > 1 else parts[i])
        parts = sorted(out, key=lambda f: f.order)
    return parts


def in_order(detections: pd.DataFrame) -> pd.DataFrame:
    """Frames by time and id, a frame's detections by id as text."""
    d = detections.assign(_f=detections["frame_id"].astype(str), _d=detections["detection_id"].astype(str)).sort_values(["timestamp", "_f", "_d"], kind="stable")
    if not np.isfinite(d["timestamp"].to_numpy(float)).all():
        raise ValueError("frame times must be finite")
    return d


def track(detections: pd.DataFrame) -> list[Fragment]:
    """Established tracks of one batch: columns frame_id, timestamp, detection_id, x1, y1, x2, y2, cx, cy, confidence.

    Frames go by time and id, a frame's detections by id as text. A row without a detection_id stands for an empty frame.
    """
    d = in_order(detections)
    return stretch(d, 0, float(d["timestamp"].iloc[0]), float(d["timestamp"].iloc[-1]))[0] if len(d) else []


def stretch(d: pd.DataFrame, before: int, begin: float, end: float) -> tuple[list[Fragment], int]:
    """Established tracks of ordered detections, and how many fragments were born; `before` frames of the batch, which lasts from `begin` to `end`, lie further back."""
    live: list[Fragment] = []
    every: list[Fragment] = []
    times, frames, real = d["timestamp"].to_numpy(float), d["_f"].to_numpy(object), d["detection_id"].notna().to_numpy()
    values = d[["timestamp", "cx", "cy", "x1", "y1", "x2", "y2", "confidence"]].to_numpy(float)
    cuts = np.flatnonzero((times[1:] != times[:-1]) | (frames[1:] != frames[:-1])) + 1
    for index, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(d)], strict=True), before):
        now, frame, obs = times[a], frames[a], values[a:b][real[a:b]]
        high, low = obs[obs[:, CONF] >= HIGH], obs[(obs[:, CONF] >= LOW) & (obs[:, CONF] < HIGH)]
        live = [f for f in live if now - f.seen <= (ACTIVE_SECONDS if f.active else TENTATIVE_SECONDS)]
        if live:
            state, cov = propagate(np.stack([f.state for f in live]), np.stack([f.cov for f in live]), np.array([now - f.predicted for f in live]))
            state[:, 2:4] = np.maximum(state[:, 2:4], LEAST_BOX)
            for k, f in enumerate(live):
                f.state, f.cov, f.predicted = state[k], (cov[k] + cov[k].T) / 2, now
        pairs = match(live, high, MATCH_COST)
        for i, j in pairs:
            live[i].take(high[j], frame)
        taken, used = {i for i, _ in pairs}, {j for _, j in pairs}
        rest = [f for i, f in enumerate(live) if i not in taken and f.active]
        pairs = match(rest, low, RECOVERY_COST)
        for i, j in pairs:
            rest[i].take(low[j], frame)
        taken, low_used = {i for i, _ in pairs}, {j for _, j in pairs}
        lost = [f for i, f in enumerate(rest) if i not in taken and len(f.obs) >= 2 and now - f.seen <= RESCUE_SECONDS]
        open_high = [j for j in range(len(high)) if j not in used]
        spare = np.concatenate([high[open_high], low[[j for j in range(len(low)) if j not in low_used]]])
        for i, j in rescue(lost, spare, now):
            lost[i].take(spare[j], frame)
            if j < len(open_high):
                used.add(open_high[j])
        for j in range(len(high)):
            if j not in used:
                fresh = born(high[j], frame, len(every) + 1, BOOTSTRAP_HITS if index < BOOTSTRAP_FRAMES else LATER_HITS)
                every.append(fresh)
                live.append(fresh)
    done = linked(every, begin, end) if len(every) > 1 else every
    return [f for f in done if f.active], len(every)


BOX = "struct<x1:double,y1:double,x2:double,y2:double>"
SCHEMA = f"track_id string, path array<struct<timestamp:double,centre:struct<x:double,y:double>>>, best_crop struct<frame_id:string,bbox:{BOX}>, best_crop_confidence double"


def time_spans(rows: DataFrame) -> DataFrame:
    """One row for each span of a device that has frames: cut (begin of its first own stretch; null: none begins there), group (the span in which
    the stretch before it began), begin and end of the device, whether the device's first BOOTSTRAP_FRAMES frames may lie there."""
    device = Window.partitionBy("_by").orderBy("_span")
    before = device.rowsBetween(Window.unboundedPreceding, -1)
    # two frames of one cell are never further apart than QUIET_SECONDS
    cells = rows.groupBy("_by", "_span", F.floor(F.col("timestamp") / QUIET_SECONDS).alias("_cell")).agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"))
    gap = F.col("lo") - F.lag("hi").over(Window.partitionBy("_by", "_span").orderBy("lo")) > QUIET_SECONDS
    spans = cells.withColumn("gap", gap).groupBy("_by", "_span").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count(F.lit(1)).alias("cells"), F.min(F.when(F.col("gap"), F.col("lo"))).alias("cut"))
    fresh = F.coalesce(F.col("lo") - F.lag("hi").over(device) > QUIET_SECONDS, F.lit(True))
    spans = spans.withColumn("cut", F.when(fresh, F.col("lo")).otherwise(F.col("cut")))
    whole = Window.partitionBy("_by")
    return spans.select(
        "_by", "_span", "cut", F.last(F.when(F.col("cut").isNotNull(), F.col("_span")), ignorenulls=True).over(before).alias("group"),
        F.min("lo").over(whole).alias("_begin"), F.max("hi").over(whole).alias("_end"), (F.coalesce(F.sum("cells").over(before), F.lit(0)) < BOOTSTRAP_FRAMES).alias("first"),
    )


def track_devices(detections: DataFrame, by: str = "device_id") -> DataFrame:
    """Tracks of each device: `by`, track_id, path, best_crop, best_crop_confidence. Ids start at 1 for each device.

    A device's history falls into stretches at each gap of more than QUIET_SECONDS. Stretches that begin in one span of
    SPAN_SECONDS meet in one task, whole, and are tracked in step with others. Ids count the fragments born in all earlier
    stretches.
    """
    from . import lockstep  # it builds on this module

    frame = F.coalesce(F.col("frame_id").cast("string"), F.lit("None"))
    rows = detections.select(
        F.col(by).alias("_by"), F.floor(F.col("timestamp") / SPAN_SECONDS).alias("_span"), frame.alias("_frame"), F.coalesce(F.col("detection_id").cast("string"), F.lit("None")).alias("_detection"),
        F.col("detection_id").isNotNull().alias("_real"), *[F.col(c).cast("double").alias(c) for c in lockstep.VALUES],
    )
    # one short row for each span: kept, as its size tells how to join it
    spans = time_spans(rows).persist()
    spans.count()
    early = rows.select("_by", "_span", "timestamp", "_frame").join(spans.where("first").select(F.col("_by").alias("_b"), F.col("_span").alias("_s")), F.col("_by").eqNullSafe(F.col("_b")) & (F.col("_span") == F.col("_s"))).select("_by", "timestamp", "_frame").distinct()
    tenth = early.withColumn("_n", F.row_number().over(Window.partitionBy("_by").orderBy("timestamp", "_frame"))).where(F.col("_n") == BOOTSTRAP_FRAMES)
    told = spans.join(tenth.select(F.col("_by").alias("_b"), F.struct("timestamp", "_frame").alias("_tenth")), F.col("_by").eqNullSafe(F.col("_b")), "left")
    told = told.select(F.col("_by").alias("_b"), F.col("_span").alias("_s"), "cut", "group", "_begin", "_end", "_tenth")
    d = rows.join(told, F.col("_by").eqNullSafe(F.col("_b")) & (F.col("_span") == F.col("_s")), "left")
    d = d.withColumn("_group", F.when(F.col("timestamp") >= F.col("cut"), F.col("_span")).otherwise(F.col("group")))
    d = d.withColumn("_early", F.coalesce(F.struct("timestamp", "_frame") <= F.col("_tenth"), F.lit(True)))
    d = d.select(F.col("_by").alias(by), "_group", "_begin", "_end", "_early", "_real", "_frame", "_detection", *lockstep.VALUES)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        def finite():
            for batch in batches:
                if batch["timestamp"].null_count or not np.isfinite(batch["timestamp"].to_numpy()).all():
                    raise ValueError("frame times must be finite")
                yield batch

        for table in lockstep.whole_groups(finite(), by):
            yield from lockstep.track_groups(table, by).to_batches()

    kind = dict(detections.dtypes)[by]
    columns = f"`{by}` {kind}, _group long, _born long, _order long, {SCHEMA.removeprefix('track_id string, ')}"
    # few bytes but much work: by number, so that the groups are not put together in a few tasks
    dealt = d.repartition(int(detections.sparkSession.conf.get("spark.sql.shuffle.partitions")), by, "_group").sortWithinPartitions("_group", by)
    found = dealt.mapInArrow(run, columns)
    # a group's tracks come before its own row
    earlier = Window.partitionBy(by).orderBy("_group", F.col("_order").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = found.withColumn("track_id", (F.col("_order") + F.sum("_born").over(earlier)).cast("string"))
    return found.where("_order is not null").select(by, "track_id", "path", "best_crop", "best_crop_confidence")
