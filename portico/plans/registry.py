"""All queries of the library by name, and their SQL.

Queries run over the whole `events` table (or the tables they name) through the operators of this package; see
`portico.sources.footfall` for how plain events are read as footfall and paths.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portico.functions.ids import age_bucket, event_payload, positive_hash
from portico.functions.times import LONGEST_VISIT, QUARTER, frame_time, milli_text, quarter, second_text, week_of
from portico.operators import assemble, crossing, detections, ingest, rollups, tracking, visits
from portico.operators.occupancy import quarter_cells, segments
from portico.sources import connectors, footfall
from portico.sources.footfall import CREATED, NOW

from . import lifecycle
from .payload import payload

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

LINE = ((50.0, 0.0), (50.0, 100.0))

#: Footfall in DuckDB, as `portico.sources.footfall` makes it.
FOOT = """f AS (SELECT event_id, user_id % 8 AS device_id, user_id % 8 % 4 AS site_id, CASE WHEN event_type IN ('click', 'signup') THEN 1 ELSE 0 END AS event, CAST(floor(epoch(ts)) AS BIGINT) AS t, CAST(event_id % 2 AS INT) AS sex,
  CASE WHEN k <= 4 THEN 0 WHEN k <= 13 THEN 1 WHEN k <= 25 THEN 2 WHEN k <= 45 THEN 3 WHEN k <= 65 THEN 4 ELSE 5 END AS age_bucket
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events) WHERE event_type <> 'error')"""
#: Matched visits: the closed form of first in, first out with a timeout.
VISITS = """en AS (SELECT site_id, event_id, t, row_number() OVER (PARTITION BY site_id ORDER BY t, device_id, event_id) AS r FROM f WHERE event = 1),
xt AS (SELECT site_id, event_id, t, row_number() OVER (PARTITION BY site_id ORDER BY t, device_id, event_id) AS j FROM f WHERE event = 0),
nx AS (SELECT site_id, t, sum(n) OVER (PARTITION BY site_id ORDER BY t) AS c FROM (SELECT site_id, t, count(*) AS n FROM en GROUP BY site_id, t)),
ab AS (SELECT x.site_id, x.event_id, x.t, x.j, coalesce(a.c, 0) AS a FROM xt x ASOF LEFT JOIN nx a ON x.site_id = a.site_id AND x.t >= a.t),
bd AS (SELECT ab.*, coalesce(e.c, 0) AS e FROM ab ASOF LEFT JOIN nx e ON ab.site_id = e.site_id AND ab.t > e.t + 14400),
lu AS (SELECT *, e + 1 - j AS lo, a - j AS up FROM bd),
kn AS (SELECT n.site_id, n.j, k.lo, min(k.up) OVER (PARTITION BY n.site_id, n.j ORDER BY k.j DESC) AS mu FROM lu n JOIN lu k ON n.site_id = k.site_id AND k.j <= n.j),
qq AS (SELECT site_id, j, greatest(max(least(lo, mu)), least(0, min(mu))) AS q FROM kn GROUP BY site_id, j),
pp AS (SELECT lu.*, CAST(q + lu.j AS BIGINT) AS p, coalesce(lag(CAST(q + lu.j AS BIGINT)) OVER (PARTITION BY lu.site_id ORDER BY lu.j), 0) AS p0 FROM lu JOIN qq USING (site_id, j)),
mx AS (SELECT site_id, event_id, t, CASE WHEN greatest(p0, e) < a THEN p ELSE 0 END AS partner FROM pp),
v AS (SELECT en.site_id, en.r AS ordinal, en.event_id AS entry_id, en.t AS entry, coalesce(mx.t, en.t + 14400) AS leave, mx.event_id AS exit_id, mx.t - en.t AS dwell FROM en LEFT JOIN mx ON en.site_id = mx.site_id AND en.r = mx.partner)"""


def _segments_sql(source: str = "v", scope: str = "site_id") -> str:
    return f"""dl AS (SELECT site_id, t, sum(d) AS d FROM (SELECT {scope} AS site_id, entry AS t, 1 AS d FROM {source} UNION ALL SELECT {scope}, leave, -1 FROM {source}) GROUP BY site_id, t),
sg AS (SELECT * FROM (SELECT site_id, t AS "start", lead(t) OVER (PARTITION BY site_id ORDER BY t) AS "end", CAST(sum(d) OVER (PARTITION BY site_id ORDER BY t) AS BIGINT) AS occupancy FROM dl) WHERE occupancy > 0 AND "end" IS NOT NULL),
cl AS (SELECT site_id, q, occupancy, least("end", q + 900) - greatest("start", q) AS sec FROM (SELECT *, unnest(generate_series("start" // 900 * 900, ("end" - 1) // 900 * 900, 900)) AS q FROM sg)),
oc AS (SELECT site_id, q, CAST(sum(occupancy * sec) AS BIGINT) AS area, CAST(sum(sec) AS BIGINT) AS seconds, min(occupancy) AS min_pos, max(occupancy) AS max_occ FROM cl GROUP BY site_id, q)"""


#: Quarter-hour partials of the sites.
PARTIALS = f"""{FOOT},
{VISITS},
{_segments_sql()},
ct AS (SELECT site_id, t // 900 * 900 AS q, CAST(sum(event) AS BIGINT) AS entrances, CAST(sum(1 - event) AS BIGINT) AS exits FROM f GROUP BY ALL),
dw AS (SELECT site_id, leave // 900 * 900 AS q, CAST(sum(dwell) AS BIGINT) AS dwell_sum, count(*) AS dwell_count FROM v WHERE dwell IS NOT NULL GROUP BY ALL),
p AS (SELECT coalesce(ct.site_id, oc.site_id, dw.site_id) AS site_id, coalesce(ct.q, oc.q, dw.q) AS q, coalesce(entrances, 0) AS entrances, coalesce(exits, 0) AS exits, coalesce(area, 0) AS area, coalesce(seconds, 0) AS seconds, coalesce(min_pos, 0) AS min_pos, coalesce(max_occ, 0) AS max_occ, coalesce(dwell_sum, 0) AS dwell_sum, coalesce(dwell_count, 0) AS dwell_count
  FROM ct FULL JOIN oc ON ct.site_id = oc.site_id AND ct.q = oc.q FULL JOIN dw ON coalesce(ct.site_id, oc.site_id) = dw.site_id AND coalesce(ct.q, oc.q) = dw.q)"""


def _merged_sql(cell: str, where: str) -> str:
    return f"""WITH {PARTIALS} SELECT site_id, CAST({cell} AS INT) AS cell, CAST(sum(entrances) AS BIGINT) AS entrances, CAST(sum(exits) AS BIGINT) AS exits, CAST(sum(area) AS BIGINT) AS area, CAST(sum(seconds) AS BIGINT) AS seconds, CAST(coalesce(min(CASE WHEN min_pos > 0 THEN min_pos END), 0) AS BIGINT) AS min_pos, CAST(max(max_occ) AS BIGINT) AS max_occ FROM p WHERE {where} GROUP BY ALL"""


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


# -- scans, predicates, text ---------------------------------------------------------------------


@query("SELECT event_id, user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts < TIMESTAMP '2024-01-20 18:30:00'")
def frame_window_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-open time window; both bounds reach the scan."""
    e = footfall.events_table(spark, sf_dir)
    kind = dict(e.dtypes)["ts"]
    lit = lambda s: F.lit(s).cast(kind)
    return e.where((F.col("ts") >= lit("2024-01-10 06:00:00")) & (F.col("ts") < lit("2024-01-20 18:30:00"))).select("event_id", "user_id", "event_type")


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H-%M-%S.000Z.jpg') AS name, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS captured FROM events WHERE event_id % 7 <> 0
UNION ALL SELECT event_id, 'notes-' || event_id || '.txt', NULL FROM events WHERE event_id % 7 = 0""")
def frame_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture times out of object names; names without one give null."""
    e = footfall.events_table(spark, sf_dir)
    name = F.when(F.pmod("event_id", F.lit(7)) == 0, F.concat(F.lit("notes-"), F.col("event_id").cast("string"), F.lit(".txt"))).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH-mm-ss.'000Z.jpg'"))
    return e.select("event_id", name.alias("name")).withColumn("captured", F.unix_timestamp(frame_time(F.concat(F.lit("gs://b/x/"), F.col("name")))).cast("long"))


@query("""WITH d AS (SELECT user_id % 8 AS device_id, user_id % 8 % 4 AS site_id, event_id FROM events)
SELECT d.device_id, d.site_id, 'site ' || d.site_id AS site_name, 10 + d.site_id AS max_capacity, count(*) AS n FROM d GROUP BY ALL""")
def device_site_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = footfall.events_table(spark, sf_dir).groupBy(F.pmod("user_id", F.lit(8)).alias("device_id")).agg(F.count("*").alias("n"))
    d = footfall.devices(spark).select("device_id", "site_id")
    s = footfall.sites(spark).select("site_id", F.col("name").alias("site_name"), "max_capacity")
    return e.join(d, "device_id").join(s, "site_id").select("device_id", "site_id", "site_name", "max_capacity", "n")


@query("SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)")
def missing_rows_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return connectors.missing_rows(read("customer"), read("orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("SELECT c_custkey, c_name FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 200000)")
def present_rows_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return read("customer").join(read("orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("""WITH k AS (SELECT DISTINCT user_id FROM events),
o AS (SELECT user_id, CASE WHEN user_id % 5 = 0 THEN NULL ELSE 1000 + user_id END AS mark FROM k WHERE user_id % 7 <> 0),
n AS (SELECT user_id, CASE WHEN user_id % 3 = 0 THEN 2000 + user_id WHEN user_id % 5 = 0 THEN NULL ELSE 1000 + user_id END AS mark FROM k WHERE user_id % 11 <> 0)
SELECT coalesce(o.user_id, n.user_id) AS device_id, o.mark AS old_mark, n.mark AS new_mark, CASE WHEN o.user_id IS NULL THEN 'added' WHEN n.user_id IS NULL THEN 'removed' WHEN o.mark IS DISTINCT FROM n.mark THEN 'changed' ELSE 'same' END AS status FROM o FULL JOIN n ON o.user_id = n.user_id""")
def watermark_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old and new marks of devices side by side, compared null-safely."""
    k = footfall.events_table(spark, sf_dir).select(F.col("user_id").alias("device_id")).distinct()
    d = F.col("device_id")
    old = k.where(d % 7 != 0).withColumn("old_mark", F.when(d % 5 != 0, d + 1000)).withColumn("_o", F.lit(1))
    new = k.where(d % 11 != 0).withColumn("new_mark", F.when(d % 3 == 0, d + 2000).when(d % 5 != 0, d + 1000)).withColumn("_n", F.lit(1))
    status = F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").when(~F.col("old_mark").eqNullSafe(F.col("new_mark")), "changed").otherwise("same")
    return old.join(new, "device_id", "full").select("device_id", "old_mark", "new_mark", status.alias("status"))


@query(r"""WITH u AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'proj-' || user_id || '.data_set.events' WHEN 1 THEN 'https://console.example/bigquery?p=x&ws=%211m5%211m4%214m3%211sproj-' || user_id || '%212sdata_set%213sevents' WHEN 2 THEN 'https://console.example/bigquery?ws=none' ELSE 'two.parts' END AS link FROM events),
w AS (SELECT *, replace(regexp_extract(link, '[?&]ws=([^&#]*)', 1), '%21', '!') AS ws FROM u)
SELECT event_id, link, CASE WHEN regexp_matches(link, '^[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+$') THEN link WHEN regexp_matches(ws, '(?:^|!)1s([^!]+)!2s([^!]+)!3s([^!]+)') THEN regexp_extract(ws, '(?:^|!)1s([^!]+)!2s([^!]+)!3s([^!]+)', 1) || '.' || regexp_extract(ws, '(?:^|!)1s([^!]+)!2s([^!]+)!3s([^!]+)', 2) || '.' || regexp_extract(ws, '(?:^|!)1s([^!]+)!2s([^!]+)!3s([^!]+)', 3) END AS destination FROM w""")
def destination_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = footfall.events_table(spark, sf_dir)
    name = F.concat(F.lit("proj-"), F.col("user_id").cast("string"))
    kind = F.pmod("event_id", F.lit(4))
    link = F.when(kind == 0, F.concat(name, F.lit(".data_set.events"))).when(kind == 1, F.concat(F.lit("https://console.example/bigquery?p=x&ws=%211m5%211m4%214m3%211s"), name, F.lit("%212sdata_set%213sevents"))).when(kind == 2, F.lit("https://console.example/bigquery?ws=none")).otherwise(F.lit("two.parts"))
    return e.select("event_id", link.alias("link")).withColumn("destination", connectors.parse_destination(F.col("link")))


@query("SELECT event_id, 'bucket-' || user_id AS bucket, 'cam/' || event_type AS prefix FROM events")
def bucket_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = F.concat(F.lit("gs://bucket-"), F.col("user_id").cast("string"), F.lit("/cam/"), "event_type")
    return footfall.events_table(spark, sf_dir).select("event_id", connectors.bucket_and_prefix(uri).alias("a")).select("event_id", "a.bucket", "a.prefix")


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS stamp, translate(strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ'), '-:.', '') AS folder FROM events")
def millisecond_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = footfall.events_table(spark, sf_dir).select("event_id", milli_text(F.col("ts")).alias("stamp"))
    return e.withColumn("folder", connectors.window_name(F.col("stamp")))


# -- ingestion -----------------------------------------------------------------------------------


@query("""WITH r AS (SELECT o_custkey, CAST(epoch(o_orderdate) AS BIGINT) AS s, CAST(epoch(o_orderdate) AS BIGINT) + (o_orderkey % 40) * 86400 AS e FROM orders),
m AS (SELECT *, max(e) OVER (PARTITION BY o_custkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM r WHERE s < e),
i AS (SELECT *, sum(CASE WHEN seen IS NULL OR s > seen THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM m)
SELECT o_custkey, min(s) AS "start", max(e) AS "end" FROM i GROUP BY o_custkey, k""")
def range_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    start = F.unix_timestamp("o_orderdate").cast("long")
    r = o.select("o_custkey", start.alias("start"), (start + F.pmod("o_orderkey", F.lit(40)) * 86400).alias("end"))
    return ingest.coalesce_ranges(r, ["o_custkey"])


@query(f"""WITH {FOOT}, r(device_id, s, e) AS (SELECT i % 8, {CREATED} + i * 86400, {CREATED} + i * 86400 + 50000 + i * 700 FROM range(20) x(i))
SELECT f.event_id, f.device_id, f.t FROM f JOIN r ON f.device_id = r.device_id AND f.t >= r.s AND f.t < r.e""")
def range_join_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("id")
    r = spark.range(20).select(F.pmod(i, F.lit(8)).alias("device_id"), (F.lit(CREATED) + i * 86400).alias("start"), (F.lit(CREATED) + i * 86400 + 50000 + i * 700).alias("end"))
    return ingest.scan_ranges(footfall.footfall(spark, sf_dir), ingest.coalesce_ranges(r, ["device_id"]), ["device_id"]).select("event_id", "device_id", "t")


@query(f"WITH {FOOT} SELECT DISTINCT event_id, device_id, site_id, event, t, sex, age_bucket FROM (SELECT * FROM f UNION ALL SELECT * FROM f WHERE event_id % 3 = 0)")
def event_dedup_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = ingest.normalise(footfall.footfall(spark, sf_dir))
    out = ingest.dedup_identity(f.unionByName(f.where(F.pmod("event_id", F.lit(3)) == 0)), ["device_id", "event_id"])
    return out.select("event_id", "device_id", "site_id", "event", "t", "sex", "age_bucket")


@query(f"WITH {FOOT} SELECT event_id, site_id, row_number() OVER (PARTITION BY site_id ORDER BY t, event DESC, device_id, event_id) AS place FROM f")
def event_total_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("site_id").orderBy(*ingest.total_order())
    return footfall.footfall(spark, sf_dir).select("event_id", "site_id", F.row_number().over(w).alias("place"))


@query("SELECT event_id, k AS age, CASE WHEN k <= 4 THEN 0 WHEN k <= 13 THEN 1 WHEN k <= 25 THEN 2 WHEN k <= 45 THEN 3 WHEN k <= 65 THEN 4 ELSE 5 END AS bucket FROM (SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events)")
def age_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.from_json("props", "k int")["k"]
    return footfall.events_table(spark, sf_dir).select("event_id", k.alias("age"), age_bucket(k).alias("bucket"))


@query(f"""WITH {FOOT}, h AS (SELECT event_id, sha256('[' || device_id || ',"' || strftime(make_timestamp(t * 1000000), '%Y-%m-%dT%H:%M:%SZ') || '",' || event || ',' || sex || ',' || age_bucket || ',"' || event_id || '"]') AS h FROM f)
SELECT event_id, CAST(CAST('0x' || substr(h, 1, 16) AS UBIGINT) % 9223372036854775807 + 1 AS BIGINT) AS hash_id FROM h""")
def event_id_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = footfall.footfall(spark, sf_dir)
    text = event_payload(F.col("device_id"), second_text(F.col("t")), F.col("event"), F.col("sex"), F.col("age_bucket"), F.col("event_id").cast("string"), F.lit(None).cast("long"))
    return f.select("event_id", positive_hash(text).alias("hash_id"))


@query(f"""WITH {FOOT}, r AS (SELECT *, 0 AS k FROM f UNION ALL SELECT *, 1 FROM f WHERE event_id % 5 = 0)
SELECT event_id, k, CASE WHEN count(*) OVER (PARTITION BY event_id, device_id, t, event) > 1 THEN row_number() OVER (PARTITION BY event_id, device_id, t, event ORDER BY k) - 1 END AS occurrence FROM r""")
def duplicate_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = footfall.footfall(spark, sf_dir)
    r = f.withColumn("k", F.lit(0)).unionByName(f.where(F.pmod("event_id", F.lit(5)) == 0).withColumn("k", F.lit(1)))
    return assemble.with_occurrence(r, ["event_id", "device_id", "t", "event"], ["k"]).select("event_id", "k", "occurrence")


# -- visits and occupancy ------------------------------------------------------------------------


@query(f"WITH {FOOT} SELECT site_id, t // 900 * 900 AS q, CAST(sum(event) AS BIGINT) AS entrances, CAST(sum(1 - event) AS BIGINT) AS exits FROM f GROUP BY ALL")
def q15_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.q15_counts(footfall.footfall(spark, sf_dir), ["site_id"])


@query(f"WITH {FOOT}, {VISITS} SELECT site_id, entry_id, entry, leave, exit_id, dwell FROM v")
def fifo_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.visits(footfall.footfall(spark, sf_dir)).drop("ordinal")


@query(f"WITH {FOOT}, {VISITS} SELECT site_id, event_id AS exit_id, t FROM mx WHERE partner = 0")
def orphan_exits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.orphan_exits(footfall.footfall(spark, sf_dir))


@query(f"WITH {FOOT}, {VISITS} SELECT site_id, entry_id, entry, leave FROM v WHERE exit_id IS NULL")
def expired_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.visits(footfall.footfall(spark, sf_dir)).where("exit_id is null").select("site_id", "entry_id", "entry", "leave")


@query(f"WITH {FOOT}, {VISITS} SELECT site_id, leave // 900 * 900 AS q, CAST(sum(dwell) AS BIGINT) AS dwell_sum, count(*) AS dwell_count FROM v WHERE dwell IS NOT NULL GROUP BY ALL")
def dwell_q15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.q15_dwell(visits.visits(footfall.footfall(spark, sf_dir)), ["site_id"])


@query(f'WITH {FOOT}, {VISITS}, {_segments_sql()} SELECT site_id, "start", "end", occupancy FROM sg')
def occupancy_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(visits.visits(footfall.footfall(spark, sf_dir)))


@query(f"WITH {PARTIALS} SELECT * FROM p")
def occupancy_q15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.q15_partials(footfall.footfall(spark, sf_dir))


LAST = NOW // QUARTER * QUARTER


@query(f"""WITH {PARTIALS}, s AS (SELECT i AS site_id, c AS cell, {LAST} - (95 - c) * 900 AS q FROM range(4) x(i), range(96) y(c))
SELECT s.site_id, CAST(s.cell AS INT) AS cell, s.q, max(coalesce(p.max_occ, 0)) OVER (PARTITION BY s.site_id ORDER BY s.q) AS rolling_peak FROM s LEFT JOIN p ON s.site_id = p.site_id AND s.q = p.q""")
def rolling_peak_96(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = rollups.q15_partials(footfall.footfall(spark, sf_dir))
    spined = rollups.spine(spark, footfall.sites(spark).select("site_id"), NOW).join(p, ["site_id", "q"], "left").fillna(0, ["max_occ"])
    return rollups.rolling_peak(spined).select("site_id", "cell", "q", "rolling_peak")


@query(f"""WITH {PARTIALS}, s AS (SELECT i AS site_id, c AS cell, {LAST} - (95 - c) * 900 AS q FROM range(4) x(i), range(96) y(c)),
j AS (SELECT s.site_id, s.cell, s.q, coalesce(area, 0) AS area, coalesce(seconds, 0) AS seconds, coalesce(max_occ, 0) AS max_occ FROM s LEFT JOIN p ON s.site_id = p.site_id AND s.q = p.q)
SELECT site_id, CAST(cell AS INT) AS cell, round(CASE WHEN seconds > 0 THEN area / seconds ELSE 0.0 END * 100 / (10 + site_id), 6) AS mean_pct, round(max(max_occ) OVER (PARTITION BY site_id ORDER BY q) * 100.0::DOUBLE / (10 + site_id), 6) AS peak_pct FROM j""")
def capacity_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = rollups.q15_partials(footfall.footfall(spark, sf_dir))
    spined = rollups.spine(spark, footfall.sites(spark).select("site_id", "max_capacity"), NOW).join(p, ["site_id", "q"], "left").fillna(0, ["max_occ", "area", "seconds"])
    peak = rollups.rolling_peak(spined)
    return peak.select("site_id", "cell", F.round(rollups.mean_occupancy() * 100 / F.col("max_capacity"), 6).alias("mean_pct"), F.round(F.col("rolling_peak") * 100 / F.col("max_capacity"), 6).alias("peak_pct"))


@query(f"WITH {FOOT}, c AS (SELECT site_id, t // 900 * 900 AS q, device_id, count(*) AS n FROM f GROUP BY ALL) SELECT site_id, q, device_id, n, round(n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY site_id, q), 6) AS pct FROM c")
def traffic_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = footfall.footfall(spark, sf_dir).groupBy("site_id", quarter(F.col("t")).alias("q"), "device_id").agg(F.count("*").alias("n"))
    return c.withColumn("pct", F.round(rollups.share(F.col("n"), "site_id", "q"), 6))


@query(f"WITH {FOOT}, c AS (SELECT t // 900 * 900 AS q, site_id, count(*) AS n FROM f GROUP BY ALL) SELECT q, site_id, n, round(n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY q), 6) AS pct FROM c")
def org_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = footfall.footfall(spark, sf_dir).groupBy(quarter(F.col("t")).alias("q"), "site_id").agg(F.count("*").alias("n"))
    return c.withColumn("pct", F.round(rollups.share(F.col("n"), "q"), 6))


@query(f"WITH {FOOT}, {VISITS}, {_segments_sql(scope='1')} SELECT q, area, seconds, min_pos, max_occ FROM oc")
def org_occupancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels of all sites together, from the union of their visits."""
    return quarter_cells(segments(visits.visits(footfall.footfall(spark, sf_dir)), None), [])


# -- calendar grains -----------------------------------------------------------------------------


def _q15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.q15_partials(footfall.footfall(spark, sf_dir))


DAY, WEEK = NOW // 86400, (NOW // 86400 + 3) // 7


@query(_merged_sql("q // 3600 % 24", f"q // 86400 = {DAY}"))
def today(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.today(_q15(spark, sf_dir), NOW)


@query(_merged_sql("q // 3600 % 24", f"q // 86400 = {DAY} - 1"))
def yesterday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.yesterday(_q15(spark, sf_dir), NOW)


@query(_merged_sql("(q // 86400 + 3) % 7", f"(q // 86400 + 3) // 7 = {WEEK}"))
def week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.week(_q15(spark, sf_dir), NOW)


@query(_merged_sql(f"(q // 86400 + 3) // 7 - {WEEK} + 3", f"(q // 86400 + 3) // 7 BETWEEN {WEEK} - 3 AND {WEEK}"))
def month_4w(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.trailing_weeks(_q15(spark, sf_dir), NOW, 4)


@query(_merged_sql(f"(q // 86400 + 3) // 7 - {WEEK} + 11", f"(q // 86400 + 3) // 7 BETWEEN {WEEK} - 11 AND {WEEK}"))
def quarter_12w(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.trailing_weeks(_q15(spark, sf_dir), NOW, 12)


@query(_merged_sql("month(make_timestamp(q * 1000000)) - 1", "year(make_timestamp(q * 1000000)) = 2024"))
def year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.year(_q15(spark, sf_dir), NOW)


@query(_merged_sql("year(make_timestamp(q * 1000000))", "true"))
def all_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.all_time(_q15(spark, sf_dir))


@query(f"""WITH {FOOT}, g AS (SELECT site_id, (t // 86400 + 3) // 7 AS week, age_bucket, sex FROM f WHERE event = 1), c AS (SELECT site_id, week, age_bucket, count(*) AS n, sum(sex) AS s FROM g GROUP BY ALL)
SELECT site_id, week, age_bucket, n, round(n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY site_id, week), 6) AS age_pct, round(s * 100.0::DOUBLE / n, 6) AS sex1_pct FROM c""")
def demographic_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of age buckets among a week's entries, and of sex 1 within each."""
    c = footfall.footfall(spark, sf_dir).where("event = 1").groupBy("site_id", week_of(F.col("t")).alias("week"), "age_bucket").agg(F.count("*").alias("n"), F.sum("sex").alias("s"))
    return c.select("site_id", "week", "age_bucket", "n", F.round(rollups.share(F.col("n"), "site_id", "week"), 6).alias("age_pct"), F.round(F.col("s") * 100 / F.col("n"), 6).alias("sex1_pct"))


@query(f"""WITH {FOOT}, c AS (SELECT site_id, t // 86400 AS day, (t // 86400 + 3) // 7 AS week, event FROM f)
SELECT site_id, day, week, CAST(grouping(site_id, day, week) AS INT) AS grain, CAST(sum(event) AS BIGINT) AS entrances, CAST(sum(1 - event) AS BIGINT) AS exits FROM c GROUP BY GROUPING SETS ((site_id, day), (site_id, week), (site_id), (week), ())""")
def grain_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several grains of counts in one pass."""
    c = footfall.footfall(spark, sf_dir).select("site_id", F.floor(F.col("t") / 86400).alias("day"), week_of(F.col("t")).alias("week"), "event")
    sets = [[F.col("site_id"), F.col("day")], [F.col("site_id"), F.col("week")], [F.col("site_id")], [F.col("week")], []]
    out = c.groupingSets(sets, "site_id", "day", "week").agg(F.grouping_id("site_id", "day", "week").cast("int").alias("grain"), F.sum("event").cast("long").alias("entrances"), F.sum(1 - F.col("event")).cast("long").alias("exits"))
    return out.select("site_id", "day", "week", "grain", "entrances", "exits")


# -- lifecycle -----------------------------------------------------------------------------------


@query(f"""WITH {FOOT}, h AS (SELECT i AS device_id, i % 4 AS site_id, 1706601600 + i * 3600 AS mark FROM range(8) x(i)), s AS (SELECT site_id, least(min(mark), {NOW}) AS stable FROM h GROUP BY site_id)
SELECT f.site_id, CASE WHEN t < s.stable THEN 'stable' WHEN t < {NOW} THEN 'provisional' ELSE 'pending' END AS part, count(*) AS n, CAST(sum(event) AS BIGINT) AS entrances FROM f JOIN h ON f.device_id = h.device_id AND f.t < h.mark JOIN s ON f.site_id = s.site_id GROUP BY ALL""")
def stable_provisional_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = footfall.devices(spark)
    seen = ingest.half_open(footfall.footfall(spark, sf_dir), d, F.lit(CREATED), None)
    parts = lifecycle.split_events(seen, lifecycle.site_horizons(footfall.sites(spark), d), F.lit(NOW))
    return parts.groupBy("site_id", "part").agg(F.count("*").alias("n"), F.sum("event").cast("long").alias("entrances"))


@query(f"WITH h AS (SELECT i % 4 AS site_id, 1706601600 + i * 3600 AS mark FROM range(8) x(i)), s AS (SELECT site_id, max(mark) AS latest, min(mark) AS stable FROM h GROUP BY site_id) SELECT site_id, latest, stable, least(min(stable) OVER (), {NOW}) AS organisation_stable FROM s")
def horizons(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = lifecycle.site_horizons(footfall.sites(spark), footfall.devices(spark))
    return h.join(lifecycle.organisation_stable(h, F.lit(NOW)).select(F.col("stable").alias("organisation_stable")))  # one row


def _states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """A made-up old and new state for each user as a site, with cases dealt by the user's number."""
    u = footfall.events_table(spark, sf_dir).groupBy("user_id").agg(F.count("*").alias("n"), F.max(F.unix_timestamp(F.date_trunc("second", "ts"))).alias("last"))
    s = u.withColumnRenamed("user_id", "site_id")
    c = F.pmod("site_id", F.lit(11))
    state = s.where(c != 0).select("site_id", F.when(c == 9, NOW).otherwise(NOW - 60).cast("long").alias("view_until"), F.lit(NOW - 7200).cast("long").alias("stable_until"), F.lit("enabled").alias("status"), F.when(c == 1, "p.d.old").otherwise("p.d.new").alias("destination"), F.lit(10).cast("long").alias("max_capacity"), F.when(c == 10, NOW - 30).cast("long").alias("next_pending"))
    sites = s.select("site_id", F.when(c == 5, "disabled").otherwise("enabled").alias("status"), F.lit("p.d.new").alias("destination"), F.when(c == 8, 12).otherwise(10).cast("long").alias("max_capacity"), F.lit(CREATED).cast("long").alias("created_at"))
    device = lambda status, mark, config: s.select("site_id", F.col("site_id").alias("device_id"), F.lit("d").alias("name"), status.alias("status"), F.lit(CREATED).cast("long").alias("created_at"), mark.cast("long").alias("analyzed_until"), config.alias("analysis_config"))
    old = device(F.when(c == 4, "disabled").otherwise("enabled"), F.when(c == 7, NOW - 9000).otherwise(NOW - 7200), F.lit("{}"))
    new = device(F.lit("enabled"), F.when(c == 3, NOW - 8000).when(c == 6, NOW - 3600).when(c == 7, NOW - 600).otherwise(NOW - 7200), F.when(c == 2, '{"x":1}').otherwise("{}"))
    return state, sites, old, new


@query("""WITH s AS (SELECT DISTINCT user_id AS site_id FROM events)
SELECT site_id, CASE site_id % 11 WHEN 0 THEN 'REBUILD' WHEN 1 THEN 'REBUILD' WHEN 2 THEN 'REBUILD' WHEN 3 THEN 'REBUILD' WHEN 4 THEN 'SOURCE_ACTIVATION' WHEN 5 THEN 'SOURCE_RETIREMENT' WHEN 6 THEN 'INCREMENTAL' WHEN 7 THEN 'REBUILD' WHEN 8 THEN 'METADATA_ONLY' WHEN 9 THEN 'NO_OP' ELSE 'PROMOTE_ONLY' END AS change FROM s""")
def classify_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.classify_sites(*_states(spark, sf_dir), F.lit(NOW))


@query(f"""WITH s AS (SELECT DISTINCT user_id AS site_id, user_id % 11 AS c FROM events)
SELECT 'p.d.new' AS destination, site_id, site_id AS device_id, CASE WHEN c = 6 THEN {NOW} - 7200 ELSE {CREATED} END AS "start", CASE c WHEN 3 THEN {NOW} - 8000 WHEN 6 THEN {NOW} - 3600 WHEN 7 THEN {NOW} - 600 ELSE {NOW} - 7200 END AS "end" FROM s WHERE c IN (0, 1, 2, 3, 6, 7)""")
def plan_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    state, sites, old, new = _states(spark, sf_dir)
    changes = lifecycle.classify_sites(state, sites, old, new, F.lit(NOW))
    return lifecycle.plan_ranges(changes, sites, old, new)


# -- paths ---------------------------------------------------------------------------------------


@query("SELECT event_id, user_id AS track_id, round(-(value - 50), 6) AS distance, CASE WHEN -(value - 50) > 2 THEN 1 WHEN -(value - 50) < -2 THEN -1 ELSE 0 END AS side FROM events")
def line_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = footfall.path_points(spark, sf_dir)
    d = crossing.signed_distance(F.col("x"), F.col("y"), *LINE)
    return p.select("event_id", "track_id", F.round(d, 6).alias("distance"), crossing.side(d).alias("side"))


CROSSED = """pt AS (SELECT user_id AS track_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos, CAST(floor(epoch(ts)) AS BIGINT) AS t, count(*) OVER (PARTITION BY user_id) AS n, CASE WHEN -(value - 50) > 2 THEN 1 WHEN -(value - 50) < -2 THEN -1 ELSE 0 END AS side FROM events),
sd AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY pos) - row_number() OVER (PARTITION BY track_id, side ORDER BY pos) AS g FROM pt WHERE n >= 6 AND side <> 0),
rn AS (SELECT track_id, side, g, count(*) AS c, min(pos) AS pos, arg_min(t, pos) AS t FROM sd GROUP BY track_id, side, g),
cr AS (SELECT track_id, t, pos, CASE WHEN side = 1 THEN 1 ELSE 0 END AS event_type FROM (SELECT *, lag(side) OVER (PARTITION BY track_id ORDER BY pos) AS b FROM rn WHERE c >= 3) WHERE b IS NOT NULL AND b <> side)"""


@query(f"WITH {CROSSED} SELECT track_id, t, event_type FROM cr")
def line_crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crossing.crossings(footfall.path_points(spark, sf_dir), *LINE)


@query(f"WITH {CROSSED} SELECT track_id, t, event_type FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY t, pos) AS k FROM cr) WHERE k = 1")
def first_event_argmin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crossing.first_of(crossing.crossings(footfall.path_points(spark, sf_dir), *LINE), "track_id", F.col("t"), F.col("event_type"))


@query(f"""WITH {CROSSED}, o AS (SELECT track_id, event_type, CASE WHEN track_id <= 4 THEN 0 WHEN track_id <= 13 THEN 1 WHEN track_id <= 25 THEN 2 WHEN track_id <= 45 THEN 3 WHEN track_id <= 65 THEN 4 ELSE 5 END AS age_bucket, track_id % 2 AS sex, strftime(make_timestamp(t * 1000000), '%Y-%m-%dT%H:%M:%S.000Z') AS stamp FROM cr)
SELECT 7::BIGINT AS device_id, CAST(CAST('0x' || substr(sha256('[7,"' || stamp || '",' || event_type || ',' || sex || ',' || age_bucket || ',"' || track_id || '"]'), 1, 16) AS UBIGINT) % 9223372036854775807 + 1 AS BIGINT) AS event_id, event_type AS event, stamp AS "timestamp", CAST(sex AS INT) AS sex, age_bucket FROM o""")
def assembled_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crossings as output rows, with made-up demographics for each track."""
    c = crossing.crossings(footfall.path_points(spark, sf_dir), *LINE).select("track_id", "event_type", (F.col("t") - CREATED).cast("double").alias("timestamp"), F.col("t").alias("pos"))
    people = c.select("track_id").distinct().select("track_id", F.col("track_id").cast("int").alias("age"), F.pmod("track_id", F.lit(2)).cast("int").alias("sex"))
    return assemble.assemble(c, people, F.timestamp_seconds(F.lit(CREATED)), 7).drop("pos")


@query("SELECT user_id AS track_id, event_id, round(value, 6) AS confidence FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, ts, event_id) AS k FROM events) WHERE k = 1")
def best_crop_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crossing.best_crop(footfall.path_points(spark, sf_dir), "x").select("track_id", "event_id", F.round("x", 6).alias("confidence"))


FRAGMENTS = """fr AS (SELECT user_id AS track, k, min(t) AS first, max(t) AS last FROM (SELECT user_id, t, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) // 3 AS k FROM (SELECT user_id, event_id, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events)) GROUP BY user_id, k)"""


@query(f"WITH {FRAGMENTS} SELECT a.track AS track, a.k AS earlier, b.k AS later, b.first - a.last AS gap FROM fr a JOIN fr b ON a.track = b.track AND b.first > a.last AND b.first <= a.last + 86400")
def fragment_band_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments of three points and those that begin within a day after their end."""
    e = footfall.path_points(spark, sf_dir).withColumn("k", F.floor(F.row_number().over(Window.partitionBy("track_id").orderBy("t", "event_id")) / 3))
    f = e.groupBy(F.col("track_id").alias("by"), F.col("k").alias("fragment")).agg(F.min("t").alias("first"), F.max("t").alias("last"))
    return detections.link_candidates(f, 86400).select(F.col("by").alias("track"), "earlier", "later", (F.col("first") - F.col("last")).alias("gap"))


@query("SELECT user_id AS track_id, round(median(d), 6) AS median_gap, round(1.0::DOUBLE / median(d), 9) AS rate FROM (SELECT user_id, t - lag(t) OVER (PARTITION BY user_id ORDER BY t) AS d FROM (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events)) WHERE d > 0 GROUP BY user_id")
def median_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = footfall.path_points(spark, sf_dir)
    gaps = p.select("track_id", (F.col("t") - F.lag("t").over(Window.partitionBy("track_id").orderBy("t"))).alias("d")).where("d > 0")
    return gaps.groupBy("track_id").agg(F.round(F.median("d"), 6).alias("median_gap"), F.round(1 / F.median("d"), 9).alias("rate"))


BOXES = "bx AS (SELECT l_orderkey, l_linenumber, l_quantity AS x1, l_discount * 100 AS y1, l_quantity + 10 + l_tax * 100 AS x2, l_discount * 100 + 5 + l_linenumber AS y2 FROM lineitem)"


@query(f"""WITH {BOXES}, p AS (SELECT a.l_orderkey, a.l_linenumber AS a_line, b.l_linenumber AS b_line, greatest(least(a.x2, b.x2) - greatest(a.x1, b.x1), 0) * greatest(least(a.y2, b.y2) - greatest(a.y1, b.y1), 0) AS i, (a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) AS u FROM bx a JOIN bx b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber)
SELECT l_orderkey, a_line, b_line, round(CASE WHEN u - i > 0 THEN i / (u - i) ELSE 0.0 END, 6) AS iou FROM p""")
def iou_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlap of an order's lines read as boxes."""
    l = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    b = l.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("x1"), (F.col("l_discount") * 100).alias("y1"), (F.col("l_quantity") + 10 + F.col("l_tax") * 100).alias("x2"), (F.col("l_discount") * 100 + 5 + F.col("l_linenumber")).alias("y2"))
    other = b.select("l_orderkey", *[F.col(c).alias(f"b_{c}") for c in b.columns[1:]])
    pairs = b.join(other, "l_orderkey").where("l_linenumber < b_l_linenumber")
    box = lambda p: [F.col(f"{p}{c}") for c in ("x1", "y1", "x2", "y2")]
    return pairs.select("l_orderkey", F.col("l_linenumber").alias("a_line"), F.col("b_l_linenumber").alias("b_line"), F.round(detections.iou(box(""), box("b_")), 6).alias("iou"))


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, greatest(l_quantity - 5, 0.0) AS a, greatest(l_discount * 100 - 1, 0.0) AS b, least(l_quantity * 2, 60.0) AS c, least(l_discount * 300, 25.0) AS d, l_extendedprice / 100000 AS conf, l_extendedprice FROM lineitem),
f AS (SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(CAST(least(a, 60.0) AS FLOAT) AS DOUBLE) AS x1, CAST(CAST(least(b, 25.0) AS FLOAT) AS DOUBLE) AS y1, CAST(CAST(c AS FLOAT) AS DOUBLE) AS x2, CAST(CAST(d AS FLOAT) AS DOUBLE) AS y2, CAST(CAST(conf AS FLOAT) AS DOUBLE) AS confidence FROM r),
k AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice, x1, y1) - 1 AS n FROM f WHERE x1 < x2 AND y1 < y2)
SELECT 'f' || l_orderkey || ':det:' || n AS detection_id, round(CAST(CAST((x1 + x2) / 2 AS FLOAT) AS DOUBLE), 4) AS cx, round(CAST(CAST((y1 + y2) / 2 AS FLOAT) AS DOUBLE), 4) AS cy, CASE WHEN confidence >= 0.5 THEN 'high' WHEN confidence >= 0.25 THEN 'low' END AS class FROM k""")
def detection_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model boxes clipped to the image, empty ones dropped, ids dealt over the kept ones."""
    l = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    raw = l.select(F.concat(F.lit("f"), F.col("l_orderkey").cast("string")).alias("frame_id"), F.struct("l_linenumber", "l_extendedprice", "l_quantity", "l_discount").alias("idx"), (F.col("l_quantity") - 5).alias("x1"), (F.col("l_discount") * 100 - 1).alias("y1"), (F.col("l_quantity") * 2).alias("x2"), (F.col("l_discount") * 300).alias("y2"), (F.col("l_extendedprice") / 100000).alias("confidence"), F.lit(60).alias("width"), F.lit(25).alias("height"))
    d = detections.post_project(raw)
    return d.select("detection_id", F.round("cx", 4).alias("cx"), F.round("cy", 4).alias("cy"), detections.confidence_class(F.col("confidence")).alias("class"))


@query()
def track(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks of made-up detections: at each event its user walks ten frames, five a second, in the field of one of eight cameras."""
    e = footfall.events_table(spark, sf_dir)
    step = F.posexplode(F.sequence(F.lit(0), F.lit(9))).alias("i", "s")
    walk = e.select(F.pmod("user_id", F.lit(8)).alias("device_id"), "event_id", (F.unix_timestamp(F.date_trunc("second", "ts")) - CREATED).alias("t0"), "value", step)
    x, y = F.col("value") * 5 + F.col("s") * 4, F.pmod("event_id", F.lit(40)) * 10 + F.col("s") * 2
    box = walk.select("device_id", (F.col("t0") + F.col("s") / 5).alias("timestamp"), "event_id", "s", x.cast("double").alias("cx"), y.cast("double").alias("cy"))
    d = box.select("device_id", "timestamp", F.format_string("%.1f", "timestamp").alias("frame_id"), F.format_string("%d:%d", "event_id", "s").alias("detection_id"), "cx", "cy", (F.col("cx") - 10).alias("x1"), (F.col("cy") - 20).alias("y1"), (F.col("cx") + 10).alias("x2"), (F.col("cy") + 20).alias("y2"), F.lit(0.9).alias("confidence"))
    t = tracking.track_devices(d)
    return t.select("device_id", "track_id", F.size("path").alias("n_points"), F.round("best_crop_confidence", 6).alias("confidence"), "path", "best_crop")


def _seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.half_open(footfall.footfall(spark, sf_dir), footfall.devices(spark), F.lit(CREATED), F.lit(NOW))


@query()
def payload_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each site's whole answer, nested."""
    return payload(_seen(spark, sf_dir), footfall.sites(spark), footfall.devices(spark).select(F.col("device_id").alias("axis_id"), "name"), NOW)


@query()
def payload_org(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload(_seen(spark, sf_dir), footfall.sites(spark), footfall.sites(spark).select(F.col("site_id").alias("axis_id"), "name"), NOW, organisation=True)


__all__ = ["QUERIES", "ORACLES", "LONGEST_VISIT"]
