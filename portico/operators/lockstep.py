"""The tracker over many stretches at once: frame k of every stretch is one array operation.

All covariances are diagonal but for each value with its own speed, so a state is four pairs of value and speed. What a
step decides follows `tracking.stretch`: pairs that nothing competes with are taken at once, all others go through its
own assignment, rescue and linking, one stretch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import tracking as k
from .assignment import assign

#: Rows that are tracked together; one longer group is still one.
ROWS = 1 << 17
#: Pairs up to which an assignment is found rather than looked at first.
ASSIGNED = 36
#: Values of a detection in the tracker's order.
VALUES = ["timestamp", "cx", "cy", "x1", "y1", "x2", "y2", "confidence"]
ACCELERATION = np.array([k.CENTRE_ACCELERATION, k.CENTRE_ACCELERATION, k.SIZE_ACCELERATION, k.SIZE_ACCELERATION]) ** 2
#: Slack of gates that only choose what is looked at exactly.
SLACK = 1 + 1e-6


def ragged(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges of n places from `first` on in a row, and the range of each."""
    which = np.repeat(np.arange(len(n)), n)
    return np.arange(len(which)) - (np.cumsum(n) - n)[which] + first[which], which


def moved(value, speed, cov, dt):
    """Values, speeds and covariances (value, mixed, speed) after times dt."""
    dt = dt[:, None]
    a, b, c = cov
    return value + dt * speed, (a + dt * b + (b + dt * c) * dt + ACCELERATION * dt**4 / 4, b + dt * c + ACCELERATION * dt**3 / 2, c + ACCELERATION * dt**2)


def overlap(z: np.ndarray, obs: np.ndarray) -> np.ndarray:
    """Intersection over union of predicted boxes (centre, size) and observed ones, one with one."""
    half = np.maximum(z[:, 2:4], k.LEAST_BOX) / 2
    low, high, other_low, other_high = z[:, :2] - half, z[:, :2] + half, obs[:, [k.X1, k.Y1]], obs[:, [k.X2, k.Y2]]
    shared = np.maximum(np.minimum(high, other_high) - np.maximum(low, other_low), 0).prod(axis=1)
    union = np.maximum(high - low, 0).prod(axis=1) + np.maximum(other_high - other_low, 0).prod(axis=1) - shared
    return np.divide(shared, union, out=np.zeros_like(shared), where=union > 0)


class Tracks:
    """Stacked tracks of all stretches, in order of birth."""

    def __init__(self, obs: np.ndarray):
        most = len(obs)
        self.obs, self.z, self.n = obs, k.measured(obs), 0
        self.noise = k.noise(self.z)
        self.value, self.speed = np.zeros((most, 4)), np.zeros((most, 4))
        self.cov = tuple(np.zeros((most, 4)) for _ in range(3))
        self.stretch, self.last, self.first, self.best, self.count, self.need = (np.zeros(most, np.int64) for _ in range(6))
        self.predicted, self.active = np.zeros(most), np.zeros(most, bool)
        self.kept = (np.zeros((most, 4)), np.zeros((most, 4)), tuple(np.zeros((most, 4)) for _ in range(3)))  # values, speeds and covariances as of the last detection
        self.of, self.before = np.full(most, -1), np.full(most, -1)  # of each detection its track, and the one before it there

    def born(self, rows: np.ndarray, stretch: np.ndarray, need: np.ndarray) -> np.ndarray:
        own = np.arange(self.n, self.n + len(rows))
        self.n += len(rows)
        self.value[own], self.cov[0][own], self.cov[2][own] = self.z[rows], self.noise[rows], k.FIRST_VELOCITY_VARIANCE
        self.stretch[own], self.need[own], self.count[own], self.predicted[own] = stretch, need, 1, self.obs[rows, k.T]
        self.last[own] = self.first[own] = self.best[own] = rows
        self.active[own], self.of[rows] = need <= 1, own
        self.keep(own)
        return own

    def keep(self, own: np.ndarray) -> None:
        for kept, now in zip((*self.kept[:2], *self.kept[2]), (self.value, self.speed, *self.cov), strict=True):
            kept[own] = now[own]

    def predict(self, own: np.ndarray, now: np.ndarray) -> None:
        value, cov = moved(self.value[own], self.speed[own], [c[own] for c in self.cov], now - self.predicted[own])
        value[:, 2:4] = np.maximum(value[:, 2:4], k.LEAST_BOX)
        self.value[own], self.predicted[own] = value, now
        for c, new in zip(self.cov, cov, strict=True):
            c[own] = new

    def take(self, own: np.ndarray, rows: np.ndarray) -> None:
        """Kalman updates in Joseph's form."""
        a, b, c = (x[own] for x in self.cov)
        r = self.noise[rows]
        g, h = a / (a + r), b / (a + r)
        miss = self.z[rows] - self.value[own]
        value = self.value[own] + g * miss
        value[:, 2:4] = np.maximum(value[:, 2:4], k.LEAST_BOX)
        self.value[own], self.speed[own] = value, self.speed[own] + h * miss
        self.cov[0][own] = (1 - g) * a * (1 - g) + g * r * g
        self.cov[1][own] = (1 - g) * (b - a * h) + g * r * h
        self.cov[2][own] = c - h * b - (b - h * a) * h + h * r * h
        self.before[rows], self.of[rows], self.last[own] = self.last[own], own, rows
        self.count[own] += 1
        better = self.obs[rows, k.CONF] > self.obs[self.best[own], k.CONF]
        self.best[own] = np.where(better, rows, self.best[own])
        self.active[own] |= self.count[own] >= self.need[own]
        self.keep(own)

    def seen(self, own: np.ndarray) -> np.ndarray:
        return self.obs[self.last[own], k.T]

    def tail(self, own: int) -> np.ndarray:
        """The last detections of a track, as far as a line is laid through them."""
        rows = [int(self.last[own])]
        while len(rows) < k.ENDPOINT and self.before[rows[-1]] >= 0:
            rows.append(int(self.before[rows[-1]]))
        return self.obs[rows[::-1]]


def crossed(tracks: Tracks, own: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (track, detection) of all pairs of one stretch; `of` are the detections' stretches in order, of n."""
    count = np.bincount(of, minlength=n)
    at, which = ragged((np.cumsum(count) - count)[tracks.stretch[own]], count[tracks.stretch[own]])
    return which, at


def twins(cost: np.ndarray) -> np.ndarray | None:
    """The pairs that `assign` finds where like tracks meet like detections: blocks of one cost that share no row or column, FAR elsewhere.

    The first row of a block gets its first column, and so on. None where costs are not like that, or a row of the shorter side is left over.
    """
    if cost.shape[0] > cost.shape[1]:
        found = twins(cost.T)
        return None if found is None else found.T
    ok = cost < k.FAR
    first = ok.argmax(axis=1)
    names, head, of, n = np.unique(first, return_index=True, return_inverse=True, return_counts=True)
    block = ok[head]
    if not ok.any(axis=1).all() or (block.sum(axis=0) > 1).any() or (block.sum(axis=1) < n).any():
        return None
    if (cost != np.where(block, cost[head, names][:, None], k.FAR)[of]).any():
        return None
    order = np.argsort(of, kind="stable")
    place = np.empty(len(of), np.int64)
    place[order] = np.arange(len(of)) - (np.cumsum(n) - n)[of[order]]
    rank = np.cumsum(block, axis=1) - 1
    return block[of] & (rank[of] == place[:, None])


def match(tracks: Tracks, own: np.ndarray, rows: np.ndarray, of: np.ndarray, n: int, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (track, detection) of gated pairs of least total cost in each stretch; as `tracking.match`."""
    i, j = crossed(tracks, own, of, n)
    t, o = own[i], rows[j]
    gap = tracks.z[o] - tracks.value[t]
    d2 = np.maximum((gap * (gap / (tracks.cov[0][t] + tracks.noise[o]))).sum(axis=1), 0)
    ok = np.isfinite(d2) & (d2 <= k.GATE)
    i, j, t, o = i[ok], j[ok], t[ok], o[ok]
    cost = k.MOTION_SHARE * d2[ok] / k.GATE + k.OVERLAP_SHARE * (1 - overlap(tracks.value[t], tracks.obs[o]))
    meet = (np.bincount(i, minlength=len(own))[i] > 1) | (np.bincount(j, minlength=len(rows))[j] > 1)
    keep = cost <= most
    if meet.any():
        stretch = tracks.stretch[t]
        asked = np.unique(stretch[meet])
        lo, hi = (np.searchsorted(stretch, asked, side) for side in ("left", "right"))
        a, b = (np.searchsorted(tracks.stretch[own], asked, side) for side in ("left", "right"))
        c, d = (np.searchsorted(of, asked, side) for side in ("left", "right"))
        rows_, columns = b - a, d - c
        # where all pairs cost the same, the first track gets the first detection, and so on
        even = (hi - lo == rows_ * columns) & (np.minimum.reduceat(cost, lo) == np.maximum.reduceat(cost, lo))
        pairs, which = ragged(lo[even], (hi - lo)[even])
        keep[pairs] &= i[pairs] - a[even][which] == j[pairs] - c[even][which]
        for x, y, first, m, left, w in zip(*(v[~even].tolist() for v in (lo, hi, a, rows_, c, columns)), strict=True):
            at = (i[x:y] - first) * w + j[x:y] - left
            whole = np.full(m * w, k.FAR)
            whole[at] = cost[x:y]
            whole = whole.reshape(m, w)
            taken = twins(whole) if m * w > ASSIGNED else None
            if taken is None:
                taken = np.zeros((m, w), bool)
                for p, q in assign(whole):
                    taken[p, q] = True
            keep[x:y] &= taken.ravel()[at]
    return i[keep], j[keep]


def rescued(tracks: Tracks, own: np.ndarray, rows: np.ndarray, of: np.ndarray, n: int, now: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs that `tracking.rescue` finds in each stretch; it is asked where any pair is near enough."""
    i, j = crossed(tracks, own, of, n)
    t, o = own[i], rows[j]
    size_a, size_b = k.sizes(tracks.obs[tracks.last[t]]), k.sizes(tracks.obs[o])
    ratio = size_b / size_a
    diagonal = np.hypot(*((size_a + size_b) / 2).T)
    var = np.minimum(tracks.cov[0][t, :2] + tracks.noise[o, :2], ((1.5 * diagonal) ** 2)[:, None])
    d2 = ((tracks.obs[o][:, [k.X, k.Y]] - tracks.value[t, :2]) ** 2 / var).sum(axis=1)
    low, high = k.RESCUE["ratio"]
    near = ((ratio >= low / SLACK) & (ratio <= high * SLACK)).all(axis=1) & (d2 <= k.RESCUE["gate"] * SLACK)
    found = []
    for s in np.unique(tracks.stretch[t[near]]).tolist():
        a, b = np.searchsorted(tracks.stretch[own], [s, s + 1])
        c, d = np.searchsorted(of, [s, s + 1])
        lost = [SimpleNamespace(obs=tracks.tail(x), count=int(tracks.count[x]), state=tracks.value[x], cov=np.diag(tracks.cov[0][x])) for x in own[a:b].tolist()]
        found += [(a + x, c + y) for x, y in k.rescue(lost, tracks.obs[rows[c:d]], float(now[s]))]
    return tuple(np.array(found, np.int64).reshape(-1, 2).T)


def link_stretches(tracks: Tracks) -> np.ndarray:
    """Stretches in which any fragment may go on with another one, by time, size and forward motion alone."""
    n = tracks.n
    of, first, last = tracks.stretch[:n], tracks.obs[tracks.first[:n]], tracks.obs[tracks.last[:n]]
    order = np.lexsort((first[:, k.T], of))
    # stretches one after the other on one line of time, only to find candidates
    new = np.r_[True, of[order][1:] != of[order][:-1]]
    s = np.cumsum(new) - 1
    start, long_ = first[order][new, k.T], np.maximum.reduceat(last[order][:, k.T], np.flatnonzero(new))
    base = np.r_[0, np.cumsum(long_ - start + 2 * k.LINK_SECONDS)[:-1]]
    begin, end = first[order][:, k.T] - start[s] + base[s], last[order][:, k.T] - start[s] + base[s]
    lo, hi = np.searchsorted(begin, end - 1e-3), np.searchsorted(begin, end + k.LINK_SECONDS + 1e-3, "right")
    found = []
    for at in range(0, n, ROWS):
        b, a = ragged(lo[at : at + ROWS], (hi - lo)[at : at + ROWS])
        a, b = order[a + at], order[b]
        gap = first[b, k.T] - last[a, k.T]
        keep = (of[a] == of[b]) & (gap > 0) & (gap <= k.LINK_SECONDS) & (tracks.active[a] | tracks.active[b])
        a, b, gap = a[keep], b[keep], gap[keep]
        ratio = k.sizes(first[b]) / k.sizes(last[a])
        low, high = k.LINK["ratio"]
        value, cov = moved(tracks.kept[0][a], tracks.kept[1][a], [c[a] for c in tracks.kept[2]], gap)
        miss = first[b][:, [k.X, k.Y]] - value[:, :2]
        forward = (miss**2 / (cov[0][:, :2] + tracks.noise[tracks.first[b], :2])).sum(axis=1)
        near = ((ratio >= low / SLACK) & (ratio <= high * SLACK)).all(axis=1) & (forward <= k.GATE * SLACK)
        found.append(of[a[near]])
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def fragment(tracks: Tracks, own: int, order: int, rows: np.ndarray, frames: pa.Array) -> k.Fragment:
    """A track as `tracking.linked` takes it."""
    value, speed, (a, b, c) = tracks.kept[0][own], tracks.kept[1][own], (x[own] for x in tracks.kept[2])
    state, cov, i = np.concatenate([value, speed]), np.diag(np.concatenate([a, c])), np.arange(4)
    cov[i, i + 4] = cov[i + 4, i] = b
    best = int(tracks.best[own])
    seen = float(tracks.obs[rows[-1], k.T])
    return k.Fragment(order, int(tracks.need[own]), list(tracks.obs[rows]), frames[best].as_py(), tracks.obs[best], state, cov, state, cov, seen, active=bool(tracks.active[own]), parts=[order])


def track_frames(obs: np.ndarray, real: np.ndarray, new_stretch: np.ndarray, new_frame: np.ndarray, early: np.ndarray) -> Tracks:
    """All tracks of ordered detections; marks of the rows that begin a stretch or a frame, and of those in the batch's first frames."""
    tracks = Tracks(obs)
    begin = np.flatnonzero(new_frame | new_stretch)
    size = np.diff(np.r_[begin, len(obs)])
    stretch = (np.cumsum(new_stretch) - 1)[begin]
    n = int(stretch[-1]) + 1
    step = np.arange(len(begin)) - np.flatnonzero(np.r_[True, stretch[1:] != stretch[:-1]])[stretch]
    by_step = np.argsort(step, kind="stable")
    cuts = np.searchsorted(step[by_step], np.arange(int(step.max()) + 2))
    live, now, on, boot, none = np.zeros(0, np.int64), np.zeros(n), np.zeros(n, bool), np.zeros(n, bool), np.zeros(0, np.int64)
    for f in (by_step[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)):
        on[:] = False
        on[stretch[f]], now[stretch[f]], boot[stretch[f]] = True, obs[begin[f], k.T], early[begin[f]]
        rows, which = ragged(begin[f], size[f])
        of = stretch[f][which]
        sure, maybe = real[rows] & (obs[rows, k.CONF] >= k.HIGH), real[rows] & (obs[rows, k.CONF] >= k.LOW) & (obs[rows, k.CONF] < k.HIGH)
        high, high_of, low, low_of = rows[sure], of[sure], rows[maybe], of[maybe]
        live = live[on[tracks.stretch[live]]]
        live = live[now[tracks.stretch[live]] - tracks.seen(live) <= np.where(tracks.active[live], k.ACTIVE_SECONDS, k.TENTATIVE_SECONDS)]
        open_high = np.ones(len(high), bool)
        if len(live):
            tracks.predict(live, now[tracks.stretch[live]])
            i, j = match(tracks, live, high, high_of, n, k.MATCH_COST) if len(high) else (none, none)
            tracks.take(live[i], high[j])
            open_high[j] = False
            free = np.ones(len(live), bool)
            free[i] = False
            rest = live[free & tracks.active[live]]
            if len(rest) and len(low):
                i, j = match(tracks, rest, low, low_of, n, k.RECOVERY_COST)
                tracks.take(rest[i], low[j])
                free = np.ones(len(rest), bool)
                free[i] = False
                rest = rest[free]
                free = np.ones(len(low), bool)
                free[j] = False
                low, low_of = low[free], low_of[free]
            lost = rest[(tracks.count[rest] >= 2) & (now[tracks.stretch[rest]] - tracks.seen(rest) <= k.RESCUE_SECONDS)]
            left = np.flatnonzero(open_high)
            if len(lost) and len(left) + len(low):
                order = np.argsort(np.r_[high_of[left], low_of], kind="stable")  # a stretch's sure ones come first
                spare, spare_of = np.r_[high[left], low][order], np.r_[high_of[left], low_of][order]
                i, j = rescued(tracks, lost, spare, spare_of, n, now)
                tracks.take(lost[i], spare[j])
                open_high &= tracks.of[high] < 0
        if open_high.any():
            s = high_of[open_high]
            fresh = tracks.born(high[open_high], s, np.where(boot[s], k.BOOTSTRAP_HITS, k.LATER_HITS))
            live = np.r_[live, fresh]
            live = live[np.argsort(tracks.stretch[live], kind="stable")]
    return tracks


PLACE = pa.struct([("x", pa.float64()), ("y", pa.float64())])
PATH = pa.list_(pa.struct([("timestamp", pa.float64()), ("centre", PLACE)]))
BOX = pa.struct([(c, pa.float64()) for c in ("x1", "y1", "x2", "y2")])
CROP = pa.struct([("frame_id", pa.string()), ("bbox", BOX)])


def told(device: pa.Array, group: np.ndarray, order: np.ndarray, points: np.ndarray, count: np.ndarray, frame: pa.Array, best: np.ndarray) -> list[pa.Array]:
    """Columns of tracks: their points one after the other, `count` of each."""
    centre = pa.StructArray.from_arrays([pa.array(points[:, k.X]), pa.array(points[:, k.Y])], fields=list(PLACE))
    place = pa.StructArray.from_arrays([pa.array(points[:, k.T]), centre], fields=list(PATH.value_type))
    path = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)], pa.int32()), place).cast(PATH)
    box = pa.StructArray.from_arrays([pa.array(best[:, c]) for c in (k.X1, k.Y1, k.X2, k.Y2)], fields=list(BOX))
    crop = pa.StructArray.from_arrays([frame, box], fields=list(CROP))
    return [device, pa.array(group), pa.array(np.zeros(len(order), np.int64)), pa.array(order), path, crop, pa.array(best[:, k.CONF])]


def track_groups(t: pa.Table, by: str) -> pa.Table:
    """Tracks of whole groups, numbered within their group, and of each group a row without number that tells how many fragments were born."""
    t = t.append_column("_of", t[by].combine_chunks().dictionary_encode(null_encoding="encode").indices)
    t = t.sort_by([(c, "ascending") for c in ("_of", "_group", "timestamp", "_frame", "_detection")]).combine_chunks()
    obs = np.stack([t[c].to_numpy() for c in VALUES], axis=1).astype(float)
    time, frame, device, group = obs[:, k.T], t["_frame"].chunk(0), t["_of"].to_numpy(), t["_group"].to_numpy()
    new_group = np.r_[True, (device[1:] != device[:-1]) | (group[1:] != group[:-1])]
    new_stretch = new_group | np.r_[True, time[1:] - time[:-1] > k.QUIET_SECONDS]
    new_frame = np.r_[True, (time[1:] != time[:-1]) | pc.not_equal(frame[1:], frame[:-1]).to_numpy(zero_copy_only=False)]
    tracks = track_frames(obs, t["_real"].to_numpy(), new_stretch, new_frame, t["_early"].to_numpy())

    n, group_of = tracks.n, np.cumsum(new_group) - 1
    own = np.lexsort((np.arange(n), tracks.stretch[:n]))
    of = group_of[tracks.first[own]]
    born = np.bincount(of, minlength=int(new_group.sum()))
    order = np.empty(n, np.int64)
    order[own] = np.arange(n) - (np.cumsum(born) - born)[of] + 1
    rows = np.argsort(tracks.of, kind="stable")[int((tracks.of < 0).sum()) :]
    count = tracks.count[:n]
    start = np.cumsum(count) - count

    plain = tracks.active[:n].copy()
    linking = np.zeros(int(new_stretch.sum()), bool)
    linking[link_stretches(tracks)] = True
    plain &= ~linking[tracks.stretch[:n]]
    own_plain = np.flatnonzero(plain)
    points, _ = ragged(start[own_plain], count[own_plain])
    at = tracks.first[own_plain]
    parts = [told(t[by].chunk(0).take(pa.array(at)), group[at], order[own_plain], obs[rows[points]], count[own_plain], frame.take(pa.array(tracks.best[own_plain])), obs[tracks.best[own_plain]])]

    begin, end = t["_begin"].to_numpy(), t["_end"].to_numpy()
    lo, hi = (np.searchsorted(tracks.stretch[own], np.flatnonzero(linking), side) for side in ("left", "right"))
    joined = []
    for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
        here = own[a:b].tolist()
        at = int(tracks.first[here[0]])
        every = [fragment(tracks, x, int(order[x]), rows[start[x] : start[x] + count[x]], frame) for x in here]
        joined += [(at, f) for f in k.linked(every, float(begin[at]), float(end[at])) if f.active]
    if joined:
        at = np.array([x for x, _ in joined])
        found = [f for _, f in joined]
        parts.append(told(t[by].chunk(0).take(pa.array(at)), group[at], np.array([f.order for f in found]), np.concatenate([np.stack(f.obs) for f in found]), np.array([len(f.obs) for f in found]), pa.array([f.best_frame for f in found], pa.string()), np.stack([f.best for f in found])))

    heads, none = np.flatnonzero(new_group), len(born)
    parts.append([t[by].chunk(0).take(pa.array(heads)), pa.array(group[heads]), pa.array(born.astype(np.int64)), pa.nulls(none, pa.int64()), pa.nulls(none, PATH), pa.nulls(none, CROP), pa.nulls(none, pa.float64())])
    names = [by, "_group", "_born", "_order", "path", "best_crop", "best_crop_confidence"]
    return pa.concat_tables([pa.Table.from_arrays(p, names=names) for p in parts])


def whole_groups(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[pa.Table]:
    """The rows of whole groups together, some ROWS of them; a partition is sorted by group."""
    held, n, last = [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        head, tail = ((batch[by][x].as_py(), batch["_group"][x].as_py()) for x in (0, batch.num_rows - 1))
        if n >= ROWS and head != last:
            yield pa.Table.from_batches(held)
            held, n = [], 0
        if n + batch.num_rows >= ROWS and tail != head:
            # all but the batch's last group are whole
            code = batch[by].dictionary_encode(null_encoding="encode").indices.to_numpy()
            group = batch["_group"].to_numpy()
            cut = int(np.flatnonzero((code[1:] != code[:-1]) | (group[1:] != group[:-1]))[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            batch = batch.slice(cut)
            held, n = [], 0
        held.append(batch)
        n, last = n + batch.num_rows, tail
    if held:
        yield pa.Table.from_batches(held)
