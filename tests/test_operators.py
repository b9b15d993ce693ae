"""Operators of the footfall half and the tracker on hand-made cases."""

import itertools
import math
import random
from datetime import datetime, timezone

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from portico.functions.ids import age_bucket
from portico.functions.times import frame_time, strict_time
from portico.operators import assemble, crossing, detections, ingest, rollups, tracking, visits
from portico.operators.assignment import assign
from portico.operators.occupancy import quarter_cells, segments
from portico.plans import lifecycle, snapshot
from portico.plans.payload import payload
from portico.plans.store import Conflict, SnapshotStore
from portico.sources import connectors

EVENTS = "event_id long, device_id long, site_id long, event int, t long, sex int, age_bucket int"
HOUR = 3600


def events_of(spark, rows):
    """Rows of (site, event, t) with running ids."""
    return spark.createDataFrame([(k, 10 + k % 2, s, e, t, k % 2, k % 6) for k, (s, e, t) in enumerate(rows)], EVENTS)


def queue(rows):
    """A plain queue for each site: (entry, leave, dwell) of all entries, and the times of lonely exits."""
    out, lonely = [], []
    for site in {r[0] for r in rows}:
        inside = []
        for _, e, t in sorted((r for r in rows if r[0] == site), key=lambda r: (r[2], -r[1])):
            while inside and inside[0] + 4 * HOUR < t:
                gone = inside.pop(0)
                out.append((site, gone, gone + 4 * HOUR, None))
            if e:
                inside.append(t)
            elif inside:
                entry = inside.pop(0)
                out.append((site, entry, t, t - entry))
            else:
                lonely.append((site, t))
        out += [(site, i, i + 4 * HOUR, None) for i in inside]
    key = lambda x: tuple(-1 if v is None else v for v in x)
    return sorted(out, key=key), sorted(lonely)


def random_rows(seed, n=400, span=4 * 86400, sites=3):
    r = random.Random(seed)
    return [(r.randrange(sites), r.randrange(2), 1_700_000_000 + r.randrange(span) // 600 * 600) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_visits_equal_a_queue(spark, seed):
    rows = random_rows(seed)
    df = events_of(spark, rows)
    want, lonely = queue(rows)
    got = [(r["site_id"], r["entry"], r["leave"], r["dwell"]) for r in visits.visits(df).collect()]
    assert sorted(got, key=lambda x: tuple(-1 if v is None else v for v in x)) == want
    assert sorted((r["site_id"], r["t"]) for r in visits.orphan_exits(df).collect()) == lonely


def test_visit_edges(spark):
    t = 1_700_006_400
    rows = [(1, 1, t), (1, 0, t + 4 * HOUR), (2, 1, t), (2, 0, t + 4 * HOUR + 1), (3, 0, t), (3, 1, t)]
    got = {r["site_id"]: r["dwell"] for r in visits.visits(events_of(spark, rows)).collect()}
    assert got == {1: 4 * HOUR, 2: None, 3: 0}
    assert visits.visits(events_of(spark, [])).count() == 0


def level_cells(stays):
    """Occupancy of each quarter hour second by second."""
    cells = {}
    for t in range(min(s[0] for s in stays), max(s[1] for s in stays)):
        n = sum(a <= t < b for a, b in stays)
        if n:
            cells.setdefault(t // 900 * 900, []).append(n)
    return {q: (sum(v), len(v), min(v), max(v)) for q, v in cells.items()}


def test_occupancy_cells(spark):
    r = random.Random(3)
    stays = [(a, a + r.randrange(0, 5000)) for a in (1_699_999_200 + r.randrange(9000) for _ in range(25))]
    df = spark.createDataFrame([(7, a, b) for a, b in stays], "site_id long, entry long, leave long")
    got = {x["q"]: (x["area"], x["seconds"], x["min_pos"], x["max_occ"]) for x in quarter_cells(segments(df), ["site_id"]).collect()}
    assert got == level_cells(stays)
    assert {x["q"]: x["area"] for x in quarter_cells(segments(df, None), []).collect()} == {q: v[0] for q, v in got.items()}


def test_organisation_level_is_that_of_all_sites_together(spark):
    df = spark.createDataFrame([(1, 900, 1000), (2, 1000, 1100)], "site_id long, entry long, leave long")
    assert [x["max_occ"] for x in quarter_cells(segments(df, None), []).collect()] == [1]


def test_ranges(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 5, 7), ("a", 9, 9), ("a", 8, 12), ("b", 2, 3), ("a", 2, 3)], "k string, start long, end long")
    assert sorted((r["k"], r["start"], r["end"]) for r in ingest.coalesce_ranges(df, ["k"]).collect()) == [("a", 1, 7), ("a", 8, 12), ("b", 2, 3)]
    e = spark.createDataFrame([("a", t) for t in range(15)], "k string, t long")
    got = ingest.scan_ranges(e, ingest.coalesce_ranges(df, ["k"]), ["k"])
    assert sorted(r["t"] for r in got.collect()) == [1, 2, 3, 4, 5, 6, 8, 9, 10, 11]
    assert ingest.scan_ranges(e, df.limit(0), ["k"]).count() == 0


def test_scan_bounds_reach_the_files(spark, tmp_path):
    spark.range(100).select(F.lit("a").alias("k"), F.col("id").alias("t")).write.parquet(str(tmp_path / "e"))
    ranges = spark.createDataFrame([("a", 10, 20)], "k string, start long, end long")
    plan = ingest.scan_ranges(spark.read.parquet(str(tmp_path / "e")), ranges, ["k"])._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(t,10)" in plan
    assert "LessThan(t,20)" in plan


def test_conflicting_identities_are_an_error(spark):
    e = events_of(spark, [(1, 1, 5), (1, 1, 5)]).withColumn("event_id", F.lit(3).cast("long")).withColumn("device_id", F.lit(1).cast("long"))
    with pytest.raises(PySparkException, match="conflicting event identity"):
        ingest.dedup_identity(e, ["device_id", "event_id"]).collect()
    assert ingest.dedup_identity(e.withColumn("sex", F.lit(0)).withColumn("age_bucket", F.lit(0)), ["device_id", "event_id"]).count() == 1
    with pytest.raises(PySparkException, match="out of domain"):
        ingest.normalise(e.withColumn("sex", F.lit(2))).collect()


def test_two_sites_of_a_device_are_an_error(spark):
    r = spark.createDataFrame([("d", 1, 5), ("d", 2, 5)], "destination string, site_id long, device_id long")
    with pytest.raises(PySparkException, match="more than one site"):
        ingest.one_site_each(r).collect()


def test_age_buckets(spark):
    ages = [4, 5, 13, 14, 25, 26, 45, 46, 65, 66]
    got = spark.createDataFrame([(a,) for a in ages], "a int").select(age_bucket(F.col("a")).alias("b")).collect()
    assert [r["b"] for r in got] == [0, 1, 1, 2, 2, 3, 3, 4, 4, 5]


def test_times(spark):
    names = ["2024-01-30T12-07-30.5Z.jpg", "x/2024-01-30T12-07-30.123456Z.jpg", "notes.txt", "2024-13-30T12-07-30.5Z.jpg", "2024-01-30T12-07-30Z.jpg"]
    got = [r["m"] for r in spark.createDataFrame([(n,) for n in names], "n string").select(F.unix_micros(frame_time(F.col("n"))).alias("m")).collect()]
    base = 1706616450
    assert got == [base * 1_000_000 + 500_000, base * 1_000_000 + 123_456, None, None, None]
    with pytest.raises(PySparkException):
        spark.createDataFrame([("soon",)], "n string").select(strict_time(F.col("n"))).collect()


def test_frames(spark, tmp_path):
    for n in ("2024-01-30T12-07-30.5Z.jpg", "2024-01-30T12-08-30.0Z.jpg", "readme.txt"):
        (tmp_path / n).write_bytes(b"x")
    at = lambda s: F.to_timestamp(F.lit(s))
    got = connectors.select_frames(connectors.list_frames(spark, str(tmp_path)), at("2024-01-30 12:07:30"), at("2024-01-30 12:08:30"))
    assert [(r["frame_id"], r["timestamp"]) for r in got.select("frame_id", "timestamp").collect()] == [("2024-01-30T12-07-30.5Z.jpg", 0.5)]


def test_destinations(spark):
    links = ["p.d.t", "https://c.example/x?ws=!1m5!1m4!4m3!1sp-1!2sd!3st_2", "https://c.example/x?ws=no", "p.d", None]
    got = spark.createDataFrame([(x,) for x in links], "u string").select(connectors.parse_destination(F.col("u")).alias("d")).collect()
    assert [r["d"] for r in got] == ["p.d.t", "p-1.d.t_2", None, None, None]
    with pytest.raises(PySparkException):
        spark.createDataFrame([("s3://b/x",)], "u string").select(connectors.bucket_and_prefix(F.col("u"))).collect()


def test_append_is_idempotent(spark, tmp_path):
    rows = spark.createDataFrame([(1, 5, 1, "t", 0, 0), (1, 6, 1, "t", 0, 0)], "device_id long, event_id long, event int, timestamp string, sex int, age_bucket int")
    path = str(tmp_path / "out")
    assert connectors.append_new(rows.limit(0), path) == 0
    assert connectors.append_new(rows.limit(1), path) == 1
    assert connectors.append_new(rows.unionByName(rows), path) == 1
    assert spark.read.parquet(path).count() == 2
    connectors.write_events_csv(rows, str(tmp_path / "csv"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "csv")).columns == ["device_id", "event_id", "event", "timestamp", "sex", "age_bucket"]


def run_machine(path):
    """Crossings of a path point by point."""
    if len(path) < 6:
        return []
    settled, run, out = None, [], []
    for t, x in path:
        s = 1 if -(x - 50) > 2 else -1 if -(x - 50) < -2 else 0
        if not s:
            continue
        run = [*run, (t, s)] if run and run[-1][1] == s else [(t, s)]
        if len(run) == 3:
            if settled not in (None, s):
                out.append((run[0][0], int(s == 1)))
            settled = s
    return out


def test_crossings(spark):
    r = random.Random(5)
    runs = lambda: [x for _ in range(20) for x in [r.choice([0, 49, 80])] * r.randint(1, 5)]
    paths = {k: list(enumerate(runs()[: r.choice([5, 6, 8, 40])])) for k in range(60)}
    df = spark.createDataFrame([(k, n, t, float(x), 0.0) for k, p in paths.items() for n, (t, x) in enumerate(p)], "track_id long, pos int, t long, x double, y double")
    got = sorted((c["track_id"], c["t"], c["event_type"]) for c in crossing.crossings(df, (50.0, 0.0), (50.0, 100.0)).collect())
    assert got == sorted((k, *e) for k, p in paths.items() for e in run_machine(p))
    assert len(got) > 10
    short = df.where("track_id < 0")
    assert crossing.crossings(short, (5.0, 5.0), (5.0, 5.0)).count() == 0
    with pytest.raises(PySparkException, match="no length"):
        crossing.crossings(df, (5.0, 5.0), (5.0, 5.0)).collect()
    assert crossing.frame_rate(spark.createDataFrame([(0,), (2,), (4,), (4,), (9,)], "t int")).first()["fps"] == 0.5
    uneven = sorted({round(k * 0.04 + (k % 7) * 0.003, 3) for k in range(6000)} | {1e6, 1e6 + 1})
    gaps = sorted(b - x for x, b in zip(uneven, uneven[1:]))
    want = (gaps[(len(gaps) - 1) // 2] + gaps[len(gaps) // 2]) / 2
    got = crossing.frame_rate(spark.createDataFrame([(t,) for t in uneven[::-1]] + [(None,)], "t double").repartition(5)).first()["fps"]
    assert abs(got * want - 1) < 1e-6


def test_assembled_ids_are_stable_and_tell_repeats_apart(spark):
    e = spark.createDataFrame([("1", 0.5, 1, 0), ("1", 0.5, 1, 1), ("2", 1.0009, 0, 2)], "track_id string, timestamp double, event_type int, pos int")
    people = spark.createDataFrame([("1", 30, 1), ("2", 66, 0)], "track_id string, age int, sex int")
    start = F.to_timestamp(F.lit("2024-01-30 12:07:30"))
    rows = assemble.assemble(e, people, start, 7).orderBy("pos").collect()
    assert [r["timestamp"] for r in rows] == ["2024-01-30T12:07:30.500Z"] * 2 + ["2024-01-30T12:07:31.000Z"]
    assert [r["age_bucket"] for r in rows] == [3, 3, 5]
    assert len({r["event_id"] for r in rows}) == 3
    assert all(0 < r["event_id"] < 2**63 for r in rows)
    assert rows == assemble.assemble(e, people, start, 7).orderBy("pos").collect()
    with pytest.raises(PySparkException, match="no demographics"):
        assemble.assemble(e, people.where("track_id = '1'"), start, 7).collect()


@pytest.mark.parametrize("shape", [(1, 1), (3, 3), (2, 5), (5, 3), (4, 4)])
def test_assignment_is_optimal(shape):
    r = np.random.default_rng(shape[0] * 10 + shape[1])
    for _ in range(20):
        cost = r.random(shape)
        got = assign(cost)
        rows, columns = sorted(shape)
        c = cost if shape[0] <= shape[1] else cost.T
        best = min(sum(c[i, p[i]] for i in range(rows)) for p in itertools.permutations(range(columns), rows))
        assert len(got) == rows
        assert math.isclose(sum(cost[i, j] for i, j in got), best)


def walk(name, t0, n, x0, y0, vx, conf=0.9, gap=()):
    return [{"frame_id": f"f{t0 + k:03d}", "timestamp": (t0 + k) / 5, "detection_id": f"{name}:{k}", "cx": x0 + vx * k, "cy": y0, "x1": x0 + vx * k - 10, "x2": x0 + vx * k + 10, "y1": y0 - 20, "y2": y0 + 20, "confidence": conf} for k in range(n) if k not in gap]


def test_tracks():
    two = pd.DataFrame(walk("a", 0, 20, 0, 0, 4) + walk("b", 0, 20, 300, 200, -4))
    found = tracking.track(two)
    assert [(f.order, len(f.obs)) for f in found] == [(1, 20), (2, 20)]
    assert np.allclose([o[tracking.X] for o in found[0].obs], [4 * k for k in range(20)])
    assert tracking.track(pd.DataFrame(walk("a", 0, 1, 0, 0, 4))) == []
    bridged = tracking.track(pd.DataFrame(walk("a", 0, 24, 0, 0, 4, gap=range(10, 16))))
    assert [len(f.obs) for f in bridged] == [18]
    apart = tracking.track(pd.DataFrame(walk("a", 0, 8, 0, 0, 4) + walk("b", 40, 8, 0, 0, 4)))
    assert len(apart) == 2
    weak = tracking.track(pd.DataFrame(walk("a", 0, 6, 0, 0, 4) + walk("a2", 6, 6, 24, 0, 4, conf=0.3)))
    assert [len(f.obs) for f in weak] == [12]
    with pytest.raises(ValueError, match="finite"):
        tracking.track(two.assign(timestamp=float("nan")))


def test_tracks_of_devices(spark):
    d = pd.DataFrame(walk("a", 0, 8, 0, 0, 4)).assign(device_id=1)
    got = tracking.track_devices(spark.createDataFrame(pd.concat([d, d.assign(device_id=2)]))).collect()
    assert sorted((r["device_id"], r["track_id"], len(r["path"])) for r in got) == [(1, "1", 8), (2, "1", 8)]
    assert got[0]["best_crop"]["frame_id"] == "f000"


def test_detections(spark):
    raw = spark.createDataFrame([("f", 0, -5.0, 1.0, 20.0, 9.0, 0.6, 10, 10), ("f", 1, 3.0, 3.0, 3.0, 9.0, 0.6, 10, 10), ("f", 2, 0.1, 0.1, 5.0, 5.0, 0.3, 10, 10)], "frame_id string, idx int, x1 double, y1 double, x2 double, y2 double, confidence double, width int, height int")
    got = {r["detection_id"]: (r["x1"], r["x2"], r["cx"]) for r in detections.post_project(raw).collect()}
    assert got["f:det:0"] == (0.0, 10.0, 5.0)
    assert got["f:det:1"][0] == float(np.float32(0.1))
    model = detections.apply_model(raw.select("frame_id", "idx"), "twice", lambda: lambda p: p.assign(idx=p["idx"] * 2), "frame_id string, idx int")
    assert sorted(r["idx"] for r in model.collect()) == [0, 2, 4]
    people = detections.decode_demographics(spark.createDataFrame([("1", 0.7, 0.3, 0.5)], "track_id string, out0 double, out1 double, out2 double"), 1.0, 95.0, 48.0)
    assert tuple(people.first()) == ("1", 95, 1)
    points = spark.createDataFrame([(1.0, 5.0, 5.0, "1", 0), (1.0, 5.0000000001, 5.0, "2", 1)], "timestamp double, x double, y double, track_id string, ordinal int")
    boxes = spark.createDataFrame([(1.0, 5.0, 5.0), (2.0, 5.0, 5.0)], "timestamp double, cx double, cy double")
    over = detections.overlay(boxes, points, spark.createDataFrame([("2",)], "track_id string")).collect()
    assert [(r["track_id"], r["colour"]) for r in over] == [("2", "green")]


def test_reactivation_errors(spark):
    site = "site_id long, status string, destination string, max_capacity long, created_at long"
    device = "site_id long, device_id long, name string, status string, created_at long, analyzed_until long, analysis_config string"
    state = spark.createDataFrame([(1, 100, 90, "enabled", "d", 5, None)], "site_id long, view_until long, stable_until long, status string, destination string, max_capacity long, next_pending long")
    sites = spark.createDataFrame([(1, "enabled", "d", 5, 0)], site)
    old = spark.createDataFrame([(1, 1, "n", "disabled", 0, 95, "{}")], device)
    change = lambda new, now=100: lifecycle.classify_sites(state, sites, old, spark.createDataFrame([new], device), F.lit(now)).first()["change"]
    assert change((1, 1, "n", "enabled", 0, 95, "{}")) == "SOURCE_ACTIVATION"
    with pytest.raises(PySparkException, match="cannot activate"):
        change((1, 1, "n", "enabled", 0, 99, "{}"))
    assert change((1, 1, "n", "disabled", 0, 95, "{}"), 101) == "PROMOTE_ONLY"
    assert lifecycle.classify_organisation(spark.createDataFrame([("NO_OP",), ("INCREMENTAL",)], "change string"), sites, sites).first()["change"] == "INCREMENTAL"
    assert lifecycle.classify_organisation(spark.createDataFrame([("NO_OP",)], "change string"), sites, sites.limit(0)).first()["change"] == "REBUILD"
    assert lifecycle.fingerprint(sites, old).first() == lifecycle.fingerprint(sites, old.withColumn("name", F.lit("x"))).first()


def test_store_commits_all_or_nothing(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    assert store.version() == 0
    assert store.commit({"a": spark.range(3)}, 0) == 1
    assert store.commit({"b": spark.range(2)}, 1) == 2
    assert (store.read("a").count(), store.read("b").count()) == (3, 2)
    with pytest.raises(Conflict):
        store.commit({"a": spark.range(1)}, 1)
    assert store.read("a").count() == 3


def test_incremental_equals_rebuild(spark, tmp_path):
    """Three steps with late and provisional events give what one rebuild gives."""
    rows = random_rows(11, 150, 2 * 86400, 2)
    all_ = events_of(spark, rows).persist()
    base = 1_700_000_000
    sites = spark.createDataFrame([(s, base - 1000) for s in range(3)], "site_id long, created_at long")
    mark = lambda *m: spark.createDataFrame(list(enumerate(m)), "site_id long, stable long")
    store = SnapshotStore(spark, str(tmp_path / "a"))
    seen = base - 1000
    for now, marks in ((base + 60000, (base + 40000, base + 55000)), (base + 61000, (base + 40000, base + 55000)), (base + 172800, (base + 172800, base + 150000))):
        snapshot.refresh(store, all_.where((F.col("t") >= seen) & (F.col("t") < now)), sites, mark(*marks), now)
        seen = now
    other = SnapshotStore(spark, str(tmp_path / "b"))
    snapshot.refresh(other, all_, sites, mark(base + 172800, base + 150000), base + 172800, rebuild=True)
    for name in ("q15", "view"):
        got, want = ({tuple(r) for r in s.read(name).select(sorted(s.read(name).columns)).collect()} for s in (store, other))
        assert got == want
    direct = rollups.q15_partials(all_.where(F.col("t") < base + 172800), F.lit(base + 172800))
    view = other.read("view")
    assert {tuple(r) for r in view.select(sorted(direct.columns)).collect()} == {tuple(r) for r in direct.select(sorted(direct.columns)).collect()}
    with pytest.raises(ValueError, match="went back"):
        snapshot.refresh(other, all_, sites, mark(base, base), base + 172900)


def test_stream_takes_the_incremental_path(spark, tmp_path):
    from portico.streaming.front import quarter_counts, snapshot_stream

    rows = random_rows(12, 60, 86400, 2)
    events = events_of(spark, rows)
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    sites = spark.createDataFrame([(s, 1_699_999_000) for s in range(2)], "site_id long, created_at long")
    now = 1_700_086_400
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    folder = str(tmp_path / "store")
    snapshot_stream(stream, folder, sites, lambda s: (s.createDataFrame([(0, now), (1, now)], "site_id long, stable long"), now), str(tmp_path / "cp")).awaitTermination()
    got = SnapshotStore(spark, folder).read("view")
    assert got.agg(F.sum("entrances"), F.sum("exits")).first() == (sum(r[1] for r in rows), sum(1 - r[1] for r in rows))
    counted = quarter_counts(stream.withColumn("ts", F.timestamp_seconds("t")))
    q = counted.writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("counted").agg(F.sum("entrances")).first()[0] == sum(r[1] for r in rows)


def test_payload(spark):
    now = int(datetime(2024, 1, 30, 12, 7, 30, tzinfo=timezone.utc).timestamp())
    t = now - now % 900
    rows = [(1, 1, t - 900), (1, 0, t - 600), (1, 1, t + 10), (2, 0, t)]
    sites = spark.createDataFrame([(1, 10), (2, 10), (3, 10)], "site_id long, max_capacity long")
    axes = spark.createDataFrame([(10, "a"), (11, "b")], "axis_id long, name string")
    out = {r["site_id"]: r for r in payload(events_of(spark, rows), sites, axes, now).collect()}
    last, before = out[1]["last_24h"][95], out[1]["last_24h"][94]
    assert (last["entrances"], last["occupancy"], last["footfall"]) == (1, 1.0, 1)
    assert (before["entrances"], before["exits"], before["dwell_time"]) == (1, 1, 300.0)
    assert before["capacity"] == [10.0, 10.0]
    assert len(out[1]["today"]["cells"]) == 13
    assert sum(c["entrances"] for c in out[1]["today"]["cells"]) == 2
    assert sum(out[1]["today"]["age_pct"]) == pytest.approx(100)
    assert len(out[3]["last_24h"]) == 96
    org = payload(events_of(spark, rows), sites, axes, now, organisation=True).collect()
    assert len(org) == 1
    assert org[0]["last_24h"][95]["exits"] == 1


def test_destinations(spark):
    good = {"p-1.d_a.t": "p-1.d_a.t", "https://c.example/x?p=1&ws=%211m5%211s" + "pr-o%212sda%213stab": "pr-o.da.tab", "https://c.example/x?ws=1sp%212sd%213st%211m1#f": "p.d.t"}
    bad = ["p.d-a.t", "p.d", "https://c.example/x?ws=%211sp%212sd-a%213st", "https://c.example/x", "", "p.d.t.u"]
    df = spark.createDataFrame([(v,) for v in [*good, *bad]], "v string")
    found = {r[0]: r[1] for r in df.select("v", connectors.parse_destination(F.col("v"))).collect()}
    assert found == good | dict.fromkeys(bad)
    strict = df.select(connectors.parse_destination(F.col("v"), strict=True).alias("d"))
    with pytest.raises(Exception, match="not a destination"):
        strict.collect()


def test_undecodable_frames(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(b"no image")
    with pytest.raises(Exception, match="not an image"):
        connectors.decoded_frames(spark, str(tmp_path)).collect()
