"""Each operator of the engine as a query over the driver's tables, beside the same in SQL for another engine to check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caloris.functions import geometry as G
from caloris.functions import text as X
from caloris.functions.scale import ScaleOptions, valid_pair
from caloris.operators import candidates as C
from caloris.operators import dataset as D
from caloris.operators import fold
from caloris.operators import matching as M
from caloris.operators import provenance as P
from caloris.operators import readings as R
from caloris.operators import statistics as S
from caloris.operators import windows as W

from .tables import READINGS, readings, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


#: Means of cents often end in a 5 at the last place kept; this moves them off it, the same way in both engines.
NUDGE = 1e-9


def r6(c: Column | str, name: str) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c) + NUDGE, 6).alias(name)


# --- statistics -------------------------------------------------------------------------------------------------------------

_STATS = """SELECT region, CAST(ts AS DATE) AS day, min(temperature) AS min_temp, avg(temperature) AS avg_temp, max(temperature) AS max_temp,
  quantile_cont(temperature, 0.5) AS median_temp, quantile_cont(temperature, 0.95) AS p95_temp, quantile_cont(temperature, 0.99) AS p99_temp,
  count(*) AS valid_pixel_count FROM readings GROUP BY ALL"""


def _by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    # frames are not needed here, so neither is the window that numbers them
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("region"), F.to_date("ts").alias("day"), F.col("value").alias("temperature"))
    return S.region_statistics(rows, ["region", "day"])


@query(f"WITH {READINGS}, s AS ({_STATS}) SELECT region, day, round(min_temp + 1e-9, 6) AS min_temp, round(avg_temp + 1e-9, 6) AS avg_temp, round(max_temp + 1e-9, 6) AS max_temp, round(median_temp + 1e-9, 6) AS median_temp, round(p95_temp + 1e-9, 6) AS p95_temp, round(p99_temp + 1e-9, 6) AS p99_temp, valid_pixel_count FROM s")
def region_stats(spark, sf_dir):
    names = ("min_temp", "avg_temp", "max_temp", "median_temp", "p95_temp", "p99_temp")
    return _by_day(spark, sf_dir).select("region", "day", *(r6(n, n) for n in names), "valid_pixel_count")


@query("""WITH p AS (SELECT 'all' AS region, l_extendedprice / 100 AS t FROM lineitem UNION ALL SELECT l_returnflag || l_linestatus, l_extendedprice / 100 FROM lineitem)
SELECT region, round(min(t) + 1e-9, 6) AS min_temp, round(avg(t) + 1e-9, 6) AS avg_temp, round(max(t) + 1e-9, 6) AS max_temp, round(quantile_cont(t, 0.5) + 1e-9, 6) AS median_temp,
  round(quantile_cont(t, 0.95) + 1e-9, 6) AS p95_temp, round(quantile_cont(t, 0.99) + 1e-9, 6) AS p99_temp, count(*) AS valid_pixel_count FROM p GROUP BY region""")
def region_stats_large(spark, sf_dir):
    """All line items as one region, and as a few: groups that no task could hold."""
    lines = table(spark, sf_dir, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("region"), (F.col("l_extendedprice") / 100).alias("temperature"))
    found = S.large_region_statistics(lines.union(lines.select(F.lit("all"), "temperature")), ["region"])
    return found.select("region", *(r6(n, n) for n in ("min_temp", "avg_temp", "max_temp", "median_temp", "p95_temp", "p99_temp")), "valid_pixel_count")


@query(f"WITH {READINGS}, s AS ({_STATS}) SELECT region AS region_name, round(min(min_temp) + 1e-9, 6) AS lowest_frame_min, round(avg(avg_temp) + 1e-9, 6) AS mean_of_frame_averages, round(max(max_temp) + 1e-9, 6) AS highest_frame_max, round(avg(p95_temp) + 1e-9, 6) AS mean_p95, round(max(p99_temp) + 1e-9, 6) AS highest_p99 FROM s GROUP BY region")
def region_summary(spark, sf_dir):
    found = S.video_summary(_by_day(spark, sf_dir).withColumnRenamed("region", "region_name"))
    return found.select("region_name", *(r6(c, c) for c in found.columns[1:]))


@query(f"WITH {READINGS} SELECT region, CAST(ts AS DATE) AS day, round(min(temperature) + 1e-9, 6) AS min_temp, round(avg(temperature) + 1e-9, 6) AS avg_temp, round(max(temperature) + 1e-9, 6) AS max_temp, first(frame ORDER BY temperature DESC, frame) AS hotspot, count(*) AS valid_pixel_count FROM readings GROUP BY ALL")
def hotspot(spark, sf_dir):
    rows = readings(spark, sf_dir).withColumn("day", F.to_date("ts"))
    found = S.hotspots(rows, ["region", "day"], "temperature", "frame")
    return found.select("region", "day", r6("min_temp", "min_temp"), r6("avg_temp", "avg_temp"), r6("max_temp", "max_temp"), "hotspot", "valid_pixel_count")


@query(f"WITH {READINGS} SELECT region, count(*) AS sampled, count(*) FILTER (kind = 'view') AS primary_accepted, count(*) FILTER (kind = 'click') AS retry_accepted, count(*) FILTER (kind = 'purchase') AS held, round(100.0 * count(*) FILTER (kind IN ('view', 'click')) / count(*) + 1e-9, 6) AS acceptance_rate FROM readings WHERE kind <> 'error' GROUP BY region")
def ocr_counters(spark, sf_dir):
    names = {"view": "ACCEPT_PRIMARY", "click": "ACCEPT_RETRY", "purchase": "HOLD_PREVIOUS", "error": "UNSAMPLED"}
    status = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in names.items() for x in kv)), F.col("event_type")), F.lit("OTHER"))
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("region"), status.alias("status"))
    found = S.sample_counters(rows, ["region"])
    return found.withColumn("acceptance_rate", F.round(F.col("acceptance_rate") + NUDGE, 6))


@query("SELECT event_type AS status, count(*) AS n FROM events GROUP BY event_type")
def status_counts(spark, sf_dir):
    return S.counts_by(table(spark, sf_dir, "events").select(F.col("event_type").alias("status")), "status")


@query(f"WITH {READINGS}, r AS (SELECT *, epoch_us(ts) / 1e6 AS s FROM readings), w AS (SELECT *, count(*) OVER f AS n, s - first_value(s) OVER f AS span FROM r WINDOW f AS (PARTITION BY region ORDER BY frame ROWS BETWEEN 179 PRECEDING AND CURRENT ROW)) SELECT region, frame, round(CASE WHEN n >= 2 AND span > 0 THEN (n - 1) / span ELSE 0 END, 9) AS receive_fps FROM w")
def receive_fps(spark, sf_dir):
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    found = S.receive_rate(readings(spark, sf_dir), "region", "frame", seconds)
    return found.select("region", "frame", F.round("receive_fps", 9).alias("receive_fps"))


@query("SELECT user_id AS camera, max(event_id) AS frame_id, arg_max(value, event_id) AS temperature FROM events GROUP BY user_id")
def latest_frame(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("camera"), F.col("event_id").alias("frame_id"), F.col("value").alias("temperature"))
    return S.latest_frames(rows, "camera", "frame_id", ["temperature"])


@query("SELECT l_returnflag AS view, l_linestatus AS method, count(*) AS matches, count(*) FILTER (l_discount <= 0.05) AS inliers, round(count(*) FILTER (l_discount <= 0.05) / count(*), 9) AS ratio, round(count(*) FILTER (l_discount <= 0.05) * (count(*) FILTER (l_discount <= 0.05) / count(*)) + 1e-9, 6) AS score FROM lineitem GROUP BY ALL")
def inlier_score(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("view"), F.col("l_linestatus").alias("method"), "l_discount")
    found = S.inlier_ratio(rows, ["view", "method"], F.col("l_discount") <= 0.05)
    return found.select("view", "method", "matches", "inliers", F.round("ratio", 9).alias("ratio"), r6("score", "score"))


@query("""WITH g AS (SELECT l_orderkey AS frame, l_linenumber AS x, CAST(l_quantity AS INTEGER) % 3 AS y, avg(l_extendedprice) AS t FROM lineitem GROUP BY ALL),
p AS (SELECT o_orderkey AS probe_id, o_orderkey AS frame, 2 AS x, 1 AS y FROM orders)
SELECT p.probe_id, count(g.t) > 0 AS valid, round(avg(t) + 1e-9, 4) AS temperature, round(min(t) + 1e-9, 4) AS minimum, round(max(t) + 1e-9, 4) AS maximum, count(t) AS sample_count
FROM p LEFT JOIN g ON g.frame = p.frame AND abs(g.x - p.x) <= 1 AND abs(g.y - p.y) <= 1 GROUP BY p.probe_id""")
def probe_3x3(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    pixels = lines.groupBy(F.col("l_orderkey").alias("frame"), F.col("l_linenumber").alias("x"), (F.col("l_quantity").cast("int") % 3).alias("y")).agg(F.avg("l_extendedprice").alias("temperature"))
    probes = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("probe_id"), F.col("o_orderkey").alias("frame"), F.lit(2).alias("x"), F.lit(1).alias("y"))
    found = S.probe(pixels, probes)
    return found.select("probe_id", "valid", *(F.round(F.col(c) + NUDGE, 4).alias(c) for c in ("temperature", "minimum", "maximum")), "sample_count")


# --- ordered operators ------------------------------------------------------------------------------------------------------

_GATE = fold.ScaleGate(min_allowed=0.0, max_allowed=1000.0, min_span=5.0, max_jump=150.0, confirm_tolerance=60.0)
_PAIRS = f"""{READINGS}, p AS (SELECT region, frame, CASE WHEN kind = 'error' THEN NULL ELSE temperature END AS low, temperature + gray AS high,
 (kind <> 'error' AND temperature + gray <= 1000 AND temperature >= 0 AND (temperature + gray) - temperature >= 5) AS ok, gray % 20 = 0 AS reseed FROM readings)"""


def _pairs(spark, sf_dir) -> DataFrame:
    rows = readings(spark, sf_dir)
    return rows.select("region", "frame", F.when(F.col("kind") != "error", F.col("temperature")).alias("low"), (F.col("temperature") + F.col("gray")).alias("high"), (F.col("gray") % 20 == 0).alias("reseed"))


def _scale(spark, sf_dir, step, inputs=("low", "high")) -> DataFrame:
    found = fold.ordered_fold(_pairs(spark, sf_dir), "region", ["frame"], list(inputs), step, fold.SCALE_FIELDS)
    return found.select("region", "frame", r6("scale_min", "scale_min"), r6("scale_max", "scale_max"), "status")


def _hold_sql(free: str) -> str:
    accept = f"p.ok AND (f.scale_min IS NULL OR {free} (abs(p.low - f.scale_min) <= 150 AND abs(p.high - f.scale_max) <= 150))"
    return f"""WITH RECURSIVE {_PAIRS}, f AS (
  SELECT region, frame, CASE WHEN ok THEN low END AS scale_min, CASE WHEN ok THEN high END AS scale_max, CASE WHEN ok THEN 'ACCEPT_PRIMARY' ELSE 'HOLD_PREVIOUS' END AS status FROM p WHERE frame = 0
  UNION ALL
  SELECT p.region, p.frame, CASE WHEN {accept} THEN p.low ELSE f.scale_min END, CASE WHEN {accept} THEN p.high ELSE f.scale_max END, CASE WHEN {accept} THEN 'ACCEPT_PRIMARY' ELSE 'HOLD_PREVIOUS' END
  FROM f JOIN p ON p.region = f.region AND p.frame = f.frame + 1)
SELECT region, frame, round(scale_min + 1e-9, 6) AS scale_min, round(scale_max + 1e-9, 6) AS scale_max, status FROM f"""


@query(_hold_sql(""))
def scale_hold(spark, sf_dir):
    return _scale(spark, sf_dir, fold.hold_step(_GATE))


@query(_hold_sql("p.reseed OR"))
def scale_viewer(spark, sf_dir):
    return _scale(spark, sf_dir, fold.hold_step(_GATE, clip=False), ("low", "high", "reseed"))


@query(f"""WITH RECURSIVE {_PAIRS}, f AS (
  SELECT region, frame, CASE WHEN ok THEN low END AS a, CASE WHEN ok THEN high END AS b, CAST(NULL AS DOUBLE) AS pa, CAST(NULL AS DOUBLE) AS pb, CASE WHEN ok THEN 'ACCEPT_PRIMARY' ELSE 'HOLD_PREVIOUS' END AS status FROM p WHERE frame = 0
  UNION ALL
  SELECT region, frame, CASE WHEN c IN (1, 2) THEN low ELSE a END, CASE WHEN c IN (1, 2) THEN high ELSE b END, CASE WHEN c = 3 THEN low END, CASE WHEN c = 3 THEN high END,
    CASE c WHEN 0 THEN 'HOLD_PREVIOUS' WHEN 1 THEN 'ACCEPT_PRIMARY' WHEN 2 THEN 'ACCEPT_CONFIRMED' ELSE 'PENDING_JUMP' END
  FROM (SELECT p.region, p.frame, p.low, p.high, f.a, f.b, CASE WHEN NOT p.ok THEN 0 WHEN f.a IS NULL OR (abs(p.low - f.a) <= 150 AND abs(p.high - f.b) <= 150) THEN 1
    WHEN f.pa IS NOT NULL AND abs(p.low - f.pa) <= 60 AND abs(p.high - f.pb) <= 60 THEN 2 ELSE 3 END AS c FROM f JOIN p ON p.region = f.region AND p.frame = f.frame + 1))
SELECT region, frame, round(a + 1e-9, 6) AS scale_min, round(b + 1e-9, 6) AS scale_max, status FROM f""")
def scale_jump_confirm(spark, sf_dir):
    return _scale(spark, sf_dir, fold.confirm_step(_GATE))


@query(f"WITH {READINGS}, n AS (SELECT *, max(frame) OVER (PARTITION BY region) AS last FROM readings), s AS (SELECT *, CASE WHEN frame % 8 = 0 OR frame = last THEN temperature END AS seen FROM n) SELECT region, frame, seen IS NOT NULL AS was_sampled, round(last_value(seen IGNORE NULLS) OVER (PARTITION BY region ORDER BY frame ROWS UNBOUNDED PRECEDING) + 1e-9, 6) AS temperature FROM s")
def carry_forward(spark, sf_dir):
    rows = readings(spark, sf_dir).withColumn("last", F.max("frame").over(Window.partitionBy("region")))
    seen = F.when(W.sampled(F.col("frame"), F.lit(0), F.col("last"), 8), F.col("temperature"))
    rows = rows.select("region", "frame", seen.alias("temperature"), seen.isNotNull().alias("was_sampled"))
    found = W.carry_forward(rows, "region", "frame", ["temperature"])
    return found.select("region", "frame", "was_sampled", r6("temperature", "temperature"))


@query(f"WITH {READINGS}, i AS (SELECT *, sum(CASE WHEN temperature > 100 THEN 0 ELSE 1 END) OVER (PARTITION BY region ORDER BY frame) AS island FROM readings) SELECT region, frame, CAST(sum(CASE WHEN temperature > 100 THEN 1 ELSE 0 END) OVER (PARTITION BY region, island ORDER BY frame) AS BIGINT) AS streak FROM i")
def streak_confirm(spark, sf_dir):
    found = W.streak(readings(spark, sf_dir), "region", "frame", F.col("temperature") > 100, "streak")
    return found.select("region", "frame", "streak")


@query(f"WITH {READINGS}, i AS (SELECT *, sum(CASE WHEN kind IN ('error', 'signup') THEN 0 ELSE 1 END) OVER (PARTITION BY region ORDER BY frame) AS island FROM readings), s AS (SELECT *, CAST(sum(CASE WHEN kind IN ('error', 'signup') THEN 1 ELSE 0 END) OVER (PARTITION BY region, island ORDER BY frame) AS BIGINT) AS failures FROM i) SELECT region, frame, failures, CASE WHEN failures >= 3 THEN 'SCENE_CHANGE_SUSPECTED' WHEN failures > 0 THEN 'HOLD_LAST_GOOD' ELSE 'TRACKED' END AS status FROM s")
def failure_streak(spark, sf_dir):
    found = W.streak(readings(spark, sf_dir), "region", "frame", F.col("kind").isin("error", "signup"), "failures")
    status = F.when(F.col("failures") >= 3, "SCENE_CHANGE_SUSPECTED").when(F.col("failures") > 0, "HOLD_LAST_GOOD").otherwise("TRACKED")
    return found.select("region", "frame", "failures", status.alias("status"))


_RULES = fold.SceneRules(moving_frames=2, stable_frames=3, banner_frames=5)
_FSM = f"""{READINGS}, e AS (SELECT region, frame, temperature >= 80 AS moving, temperature <= 120 AS stable FROM readings), f AS (
  SELECT region, frame, 'STABLE' AS state, CASE WHEN moving THEN 1 ELSE 0 END AS run, CASE WHEN moving THEN 1 ELSE 0 END AS moving_evidence, 0 AS stable_evidence, CAST(NULL AS VARCHAR) AS event FROM e WHERE frame = 0
  UNION ALL
  SELECT region, frame, CASE WHEN done THEN CASE state WHEN 'STABLE' THEN 'MOVING' ELSE 'STABLE' END ELSE state END, CASE WHEN done THEN 0 ELSE n END,
    CASE WHEN state = 'STABLE' THEN n ELSE 0 END, CASE WHEN state = 'MOVING' THEN n ELSE 0 END, CASE WHEN done THEN CASE state WHEN 'STABLE' THEN 'MOVEMENT_STARTED' ELSE 'SETTLED' END END
  FROM (SELECT *, n >= CASE state WHEN 'STABLE' THEN 2 ELSE 3 END AS done FROM (
    SELECT e.region, e.frame, f.state, CASE WHEN CASE f.state WHEN 'STABLE' THEN e.moving ELSE e.stable END THEN f.run + 1 ELSE 0 END AS n FROM f JOIN e ON e.region = f.region AND e.frame = f.frame + 1)))"""


def _scene(spark, sf_dir) -> DataFrame:
    rows = readings(spark, sf_dir).select("region", "frame", (F.col("temperature") >= 80).alias("moving"), (F.col("temperature") <= 120).alias("stable"))
    return fold.ordered_fold(rows, "region", ["frame"], ["moving", "stable"], fold.scene_step(_RULES), fold.SCENE_FIELDS)


@query(f"WITH RECURSIVE {_FSM} SELECT region, frame, state, moving_evidence, stable_evidence, event FROM f")
def scene_fsm(spark, sf_dir):
    return _scene(spark, sf_dir).select("region", "frame", "state", "moving_evidence", "stable_evidence", "event")


@query(f"WITH RECURSIVE {_FSM}, w AS (SELECT *, lag(state) OVER (PARTITION BY region ORDER BY frame) AS from_state FROM f) SELECT region, frame, event, from_state, state AS to_state FROM w WHERE from_state <> state")
def scene_events(spark, sf_dir):
    found = W.changes(_scene(spark, sf_dir), "region", "frame", "state")
    return found.select("region", "frame", "event", "from_state", F.col("state").alias("to_state"))


@query(f"""WITH RECURSIVE {_FSM}, b AS (SELECT *, frame - max(CASE WHEN event = 'SETTLED' THEN frame END) OVER (PARTITION BY region ORDER BY frame) < 5 AS shown FROM f),
d AS (SELECT region, CASE WHEN shown THEN 'NEW_STABLE_VIEW' ELSE state END AS state, event FROM b)
SELECT region, count(*) FILTER (state = 'STABLE') AS stable, count(*) FILTER (state = 'MOVING') AS moving, count(*) FILTER (state = 'NEW_STABLE_VIEW') AS new_stable_view, count(*) FILTER (event = 'MOVEMENT_STARTED') AS movements, count(*) FILTER (event = 'SETTLED') AS settled FROM d GROUP BY region""")
def state_counts(spark, sf_dir):
    rows = _scene(spark, sf_dir)
    shown = W.banner(rows, "region", "frame", F.col("event") == "SETTLED", _RULES.banner_frames, "state", "NEW_STABLE_VIEW")
    rows = rows.select("region", shown.alias("state"), "event")
    of = lambda c, v, n: F.count_if(F.col(c) == v).alias(n)
    return rows.groupBy("region").agg(of("state", "STABLE", "stable"), of("state", "MOVING", "moving"), of("state", "NEW_STABLE_VIEW", "new_stable_view"), of("event", "MOVEMENT_STARTED", "movements"), of("event", "SETTLED", "settled"))


@query(f"""WITH RECURSIVE {READINGS}, e AS (SELECT region, frame, CASE WHEN kind = 'error' THEN [] ELSE [CASE WHEN gray % 3 = 0 THEN 20.0 + gray END, CASE WHEN gray % 2 = 0 THEN 30.0 + gray END] END AS scores FROM readings),
f AS (SELECT region, frame, 1 AS n, 1 AS view_id, 'INITIAL_VIEW' AS view_event FROM e WHERE frame = 0
 UNION ALL
 SELECT region, frame, CASE WHEN v IS NULL THEN n + 1 ELSE n END, coalesce(v, n + 1), CASE WHEN v IS NULL THEN 'NEW_STABLE_VIEW' WHEN v = now THEN 'SAME_VIEW_RESTABILIZED' ELSE 'RETURN_TO_KNOWN_VIEW' END
 FROM (SELECT e.region, e.frame, f.n, f.view_id AS now, CASE WHEN s1 IS NOT NULL AND (s2 IS NULL OR s1 >= s2) THEN 1 WHEN s2 IS NOT NULL THEN 2 END AS v
  FROM f JOIN (SELECT *, CASE WHEN scores[1] >= 40 THEN scores[1] END AS s1, CASE WHEN scores[2] >= 40 THEN scores[2] END AS s2a FROM e) e ON e.region = f.region AND e.frame = f.frame + 1, LATERAL (SELECT CASE WHEN f.n >= 2 THEN e.s2a END AS s2)))
SELECT region, frame, view_id, view_event FROM f""")
def view_library(spark, sf_dir):
    g = F.col("gray")
    scores = F.when(F.col("kind") == "error", F.expr("cast(array() as array<double>)")).otherwise(F.array(F.when(g % 3 == 0, 20.0 + g), F.when(g % 2 == 0, 30.0 + g)))
    rows = readings(spark, sf_dir).withColumn("scores", scores)
    found = fold.ordered_fold(rows, "region", ["frame"], ["scores"], fold.identify_views(40.0), fold.VIEW_FIELDS)
    return found.select("region", "frame", "view_id", "view_event")


# --- label readings ---------------------------------------------------------------------------------------------------------

_PARSE = """CASE WHEN contains(n, '.') THEN TRY_CAST(n AS DOUBLE) WHEN length(regexp_replace(n, '[^0-9]', '', 'g')) >= 3 THEN TRY_CAST(n AS DOUBLE) / 10 END"""
_TEXTS = r"""t AS (SELECT event_id, user_id, event_type, value, CASE event_id % 5 WHEN 0 THEN CAST(CAST(floor(value * 10) AS BIGINT) AS VARCHAR) WHEN 1 THEN 'T ' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || '.' || CAST(event_id % 10 AS VARCHAR) || ' C' WHEN 2 THEN '-' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) WHEN 3 THEN props ELSE event_type END AS text FROM events),
n AS (SELECT *, regexp_extract(regexp_replace(text, '[^0-9.\-]', '', 'g'), '-?[0-9]+(\.[0-9]+)?') AS n FROM t)"""


def _texts(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    whole = lambda c: F.floor(c).cast("string")
    text = F.when(F.col("event_id") % 5 == 0, whole(F.col("value") * 10)).when(F.col("event_id") % 5 == 1, F.concat(F.lit("T "), whole(F.col("value")), F.lit("."), (F.col("event_id") % 10).cast("string"), F.lit(" C")))
    text = text.when(F.col("event_id") % 5 == 2, F.concat(F.lit("-"), whole(F.col("value")))).when(F.col("event_id") % 5 == 3, F.col("props")).otherwise(F.col("event_type"))
    return e.select("event_id", "user_id", "event_type", "value", text.alias("text"))


@query(f"WITH {_TEXTS} SELECT event_id, text, {_PARSE} AS parsed, CAST(2 * CAST(contains(text, '.') AS INTEGER) + 0.25 * least(length(regexp_replace(text, '[^0-9]', '', 'g')), 4) AS DOUBLE) AS scan_quality, CAST(4 * CAST(contains(text, '.') AS INTEGER) + least(length(regexp_replace(text, '[^0-9]', '', 'g')), 4) AS DOUBLE) AS setup_quality FROM n")
def ocr_parse(spark, sf_dir):
    t = F.col("text")
    return _texts(spark, sf_dir).select("event_id", "text", X.parse_temperature(t).alias("parsed"), X.scan_quality(t).alias("scan_quality"), X.setup_quality(t).alias("setup_quality"))


def _candidates(spark, sf_dir) -> DataFrame:
    rows = _texts(spark, sf_dir).withColumn("grp", F.floor(F.col("event_id") / 8))
    label = F.when(F.col("event_id") % 2 == 0, "MIN").otherwise("MAX")
    return rows.select("grp", (F.col("event_id") % 8).alias("ord"), X.parse_temperature(F.col("text")).alias("value"), "text", F.col("event_type").alias("method"), (F.col("event_id") % 3).alias("psm"), (F.col("event_id") % 8 < 2).alias("is_primary"), label.alias("label"))


_CANDIDATES = f"""{_TEXTS}, c AS (SELECT event_id // 8 AS grp, event_id % 8 AS ord, {_PARSE} AS value, text, event_type AS method, event_id % 3 AS psm, event_id % 8 < 2 AS is_primary, CASE WHEN event_id % 2 = 0 THEN 'MIN' ELSE 'MAX' END AS label FROM n),
q AS (SELECT a.grp, a.value AS min_value, a.text AS min_text, a.method AS min_method, a.psm AS min_psm, b.value AS max_value, b.text AS max_text, b.method AS max_method, b.psm AS max_psm, a.ord AS ao, b.ord AS bo, CASE WHEN a.is_primary THEN 0 ELSE 1 END + CASE WHEN b.is_primary THEN 0 ELSE 1 END AS penalty
 FROM c a JOIN c b ON a.grp = b.grp AND a.label = 'MIN' AND b.label = 'MAX' WHERE a.value BETWEEN -100 AND 1000 AND b.value BETWEEN -100 AND 1000 AND b.value > a.value AND b.value - a.value >= 5)"""
_OUT = "grp, min_value, min_text, min_method, min_psm, max_value, max_text, max_method, max_psm"


@query(f"""WITH {_CANDIDATES}, r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY abs(min_value - 50) + abs(max_value - 150),
  -(2 * CAST(contains(min_text, '.') AS INTEGER) + 0.25 * least(length(regexp_replace(min_text, '[^0-9]', '', 'g')), 4) + 2 * CAST(contains(max_text, '.') AS INTEGER) + 0.25 * least(length(regexp_replace(max_text, '[^0-9]', '', 'g')), 4)), penalty, ao, bo) AS k
  FROM q WHERE abs(min_value - 50) <= 120 AND abs(max_value - 150) <= 120) SELECT {_OUT} FROM r WHERE k = 1""")
def ocr_best_pair(spark, sf_dir):
    options = ScaleOptions(max_jump=120.0)
    return C.best_pair(_candidates(spark, sf_dir), ["grp"], options, (F.lit(50.0), F.lit(150.0)))


@query(f"""WITH {_CANDIDATES}, r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY
  -(4 * CAST(contains(min_text, '.') AS INTEGER) + least(length(regexp_replace(min_text, '[^0-9]', '', 'g')), 4) + 4 * CAST(contains(max_text, '.') AS INTEGER) + least(length(regexp_replace(max_text, '[^0-9]', '', 'g')), 4) + CASE WHEN min_method = max_method AND min_psm = max_psm THEN 1 ELSE 0 END), ao, bo) AS k FROM q)
SELECT {_OUT} FROM r WHERE k = 1""")
def ocr_recipe(spark, sf_dir):
    return C.recipe_pair(_candidates(spark, sf_dir), ["grp"], ScaleOptions(), strict=False)


_READS = f"{_TEXTS}, c AS (SELECT user_id, event_id AS ord, text, {_PARSE} AS value, round(value / 500, 2) AS confidence FROM n)"


def _reads(spark, sf_dir) -> DataFrame:
    # in binary as SQL rounds it: Spark's round to a place goes by the shortest decimal, which lifts 0.57499999999999996 to 0.58
    confidence = F.round(F.col("value") / 500 * 100) / 100
    return _texts(spark, sf_dir).select("user_id", F.col("event_id").alias("ord"), "text", X.parse_temperature(F.col("text")).alias("value"), confidence.alias("confidence"))


@query(f"""WITH {_READS}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value IS NULL, -confidence, CASE WHEN value IS NOT NULL THEN CASE WHEN contains(text, '.') THEN -1 ELSE 0 END ELSE 0 END, CASE WHEN value IS NOT NULL THEN -length(text) ELSE 0 END, ord) AS k FROM c WHERE confidence >= 0.25)
SELECT user_id, text, value, confidence FROM r WHERE k = 1""")
def ocr_best_reading(spark, sf_dir):
    return C.best_reading(_reads(spark, sf_dir), ["user_id"])


@query(f"WITH {_READS} SELECT user_id, ord // 500 AS label, string_agg(text, '' ORDER BY ord) AS text, min(confidence) AS confidence FROM c GROUP BY ALL HAVING count(*) > 1")
def ocr_joined_text(spark, sf_dir):
    return C.joined_text(_reads(spark, sf_dir).withColumn("label", F.floor(F.col("ord") / 500)), ["user_id", "label"])


@query("""WITH m AS (SELECT user_id, arg_max(event_type, event_id) AS own, list_sort(list_distinct(list(event_type))) AS rest FROM events GROUP BY user_id)
SELECT user_id, array_to_string(list_concat([own], list_filter(rest, lambda x: x <> own)), ',') AS methods FROM m""")
def recipe_union(spark, sf_dir):
    """The recipe in use first, then the others, each once."""
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("own"), F.array_sort(F.collect_set("event_type")).alias("rest"))
    return rows.select("user_id", F.array_join(C.recipes(F.col("own"), F.col("rest")), ",").alias("methods"))


@query("SELECT count(*) FILTER (c_acctbal > 0 AND c_acctbal + 500 - c_acctbal >= 5 AND c_acctbal <= 1000 AND c_acctbal + 500 <= 1000) AS valid, count(*) AS n FROM customer")
def pair_validity(spark, sf_dir):
    low = F.col("c_acctbal")
    ok = valid_pair(low, low + 500, ScaleOptions(min_allowed=1e-9))
    return table(spark, sf_dir, "customer").agg(F.count_if(ok).alias("valid"), F.count("*").alias("n"))


@query("SELECT o_orderkey, round(CASE WHEN m.v IS NULL THEN o_totalprice ELSE m.v END + 1e-9, 6) AS scale, CASE WHEN m.v IS NULL THEN 'LIVE' ELSE 'CACHE' END AS source FROM orders LEFT JOIN (SELECT l_orderkey, first(l_extendedprice ORDER BY l_linenumber DESC, l_extendedprice DESC) AS v FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey) m ON m.l_orderkey = o_orderkey")
def scale_provider(spark, sf_dir):
    from caloris.sources.readings import last_wins

    cache = last_wins(table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey", "l_extendedprice", F.struct("l_linenumber", "l_extendedprice").alias("place")), ["l_orderkey"], "place")
    frames = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    found = R.provided_scale(frames, cache.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"], "o_totalprice", "l_extendedprice")
    return found.select("o_orderkey", r6("scale", "scale"), "source")


# --- pixels -----------------------------------------------------------------------------------------------------------------

_CHANNELS = "SELECT l_orderkey, l_linenumber, CAST(l_quantity * 5 AS INTEGER) % 256 AS b, CAST(l_quantity * 5 + l_discount * 300 AS INTEGER) % 256 AS g, CAST(l_quantity * 5 + l_tax * 300 AS INTEGER) % 256 AS r FROM lineitem"


def _channels(spark, sf_dir) -> DataFrame:
    q = F.col("l_quantity") * 5
    # halves to even, as the other side's casts do
    channel = lambda c: (F.rint(c).cast("int") % 256)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", channel(q).alias("b"), channel(q + F.col("l_discount") * 300).alias("g"), channel(q + F.col("l_tax") * 300).alias("r"))


@query(f"WITH c AS ({_CHANNELS}) SELECT l_orderkey, l_linenumber, (3735 * b + 19235 * g + 9798 * r + 16384) >> 15 AS gray, greatest(b, g, r) - least(b, g, r) <= 18 AS neutral FROM c")
def neutral_mask(spark, sf_dir):
    from caloris.operators.thermal import gray_level, is_neutral

    b, g, r = (F.col(c) for c in "bgr")
    return _channels(spark, sf_dir).select("l_orderkey", "l_linenumber", gray_level(b, g, r).alias("gray"), is_neutral(b, g, r, 18).alias("neutral"))


@query("""WITH palette AS (SELECT p_partkey - 1 AS row, CAST(p_size * 10 + p_partkey % 7 AS DOUBLE) / 2 AS gray, p_retailprice / 40 AS temp FROM part),
g AS (SELECT CAST(range AS INTEGER) AS intensity FROM range(256)), k AS (SELECT intensity, temp, row_number() OVER (PARTITION BY intensity ORDER BY abs(gray - intensity), row) AS k FROM g, palette)
SELECT intensity, round(temp + 1e-9, 6) AS temperature FROM k WHERE k = 1""")
def lut_nearest(spark, sf_dir):
    from caloris.operators.thermal import nearest_levels

    k = F.col("p_partkey")
    palette = table(spark, sf_dir, "part").select((k - 1).alias("row"), ((F.col("p_size") * 10 + k % 7).cast("double") / 2).alias("gray"), (F.col("p_retailprice") / 40).alias("temp"))
    return nearest_levels(palette).select("intensity", r6("temp", "temperature"))


@query("SELECT l_orderkey, round(median(l_quantity) + 1e-9, 6) AS level FROM lineitem GROUP BY l_orderkey")
def row_median(spark, sf_dir):
    from caloris.operators.thermal import row_medians

    return row_medians(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_quantity").select("l_orderkey", r6("level", "level"))


# --- geometry and motion ----------------------------------------------------------------------------------------------------

_H = """h AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'LK_OPTICAL_FLOW' ELSE 'ORB_FALLBACK' END AS method, 1 + (o_orderkey % 11 - 5) / 100.0 AS s, (o_orderkey % 7 - 3) / 2.0 AS d, CAST(o_custkey % 41 - 20 AS DOUBLE) AS dx, CAST(o_custkey % 23 - 11 AS DOUBLE) AS dy FROM orders),
m AS (SELECT *, s * cos(radians(d)) AS a, s * sin(radians(d)) AS b FROM h),
t AS (SELECT o_orderkey, method, a AS h0, b AS h1, (1 - a) * 320 - b * 240 + dx AS h2, -b AS h3, a AS h4, b * 320 + (1 - a) * 240 + dy AS h5 FROM m),
z AS (SELECT *, h0 * 320 + h1 * 240 + h2 - 320 AS mx, h3 * 320 + h4 * 240 + h5 - 240 AS my, sqrt(h0 * h0 + h3 * h3) AS scale, degrees(atan2(h3, h0)) AS rot FROM t)"""


def _transforms(spark, sf_dir) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    h = G.similarity((c % 41 - 20).cast("double"), (c % 23 - 11).cast("double"), (k % 7 - 3) / 2.0, 1 + (k % 11 - 5) / 100.0, F.lit(640.0), F.lit(480.0))
    method = F.when(F.col("o_orderstatus") == "F", "LK_OPTICAL_FLOW").otherwise("ORB_FALLBACK")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", method.alias("method"), h.alias("h"))
    return rows.withColumn("m", G.metrics(F.col("h"), F.lit(640.0), F.lit(480.0)))


@query(f"WITH {_H} SELECT o_orderkey, round(scale + 1e-9, 6) AS scale, round(rot + 1e-9, 6) + 0.0 AS rotation_deg, round(mx + 1e-9, 6) + 0.0 AS dx, round(my + 1e-9, 6) + 0.0 AS dy, round(sqrt(mx * mx + my * my) + 1e-9, 6) AS translation FROM z")
def motion_metrics(spark, sf_dir):
    plain = lambda c: (F.round(F.col(f"m.{c}") + NUDGE, 6) + 0.0).alias(c)
    return _transforms(spark, sf_dir).select("o_orderkey", *(plain(c) for c in ("scale", "rotation_deg", "dx", "dy", "translation")))


@query(f"WITH {_H} SELECT method, count(*) AS frames, round(max(abs(mx)) + 1e-9, 6) AS max_abs_dx, round(max(abs(my)) + 1e-9, 6) AS max_abs_dy, round(max(sqrt(mx * mx + my * my)) + 1e-9, 6) AS max_translation, round(max(abs(rot)) + 1e-9, 6) AS max_abs_rotation, round(min(scale) + 1e-9, 6) AS min_scale, round(max(scale) + 1e-9, 6) AS max_scale FROM z GROUP BY method")
def motion_summary(spark, sf_dir):
    found = S.motion_summary(_transforms(spark, sf_dir).select("method", "m.*"), ["method"])
    return found.select("method", "frames", *(r6(c, c) for c in found.columns[2:]))


@query("""WITH c AS (SELECT l_orderkey, l_linenumber, l_returnflag <> 'N' OR l_linenumber < 6 AS found, CAST(l_quantity AS INTEGER) AS matches, CAST(l_quantity * (1 - l_discount * 5) AS INTEGER) AS inliers, l_quantity * 3 AS pixels, l_tax * 80 AS degrees, 1 + l_discount AS scale FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN NOT found THEN 'NO_TRANSFORM' WHEN matches <= 0 THEN 'NO_MATCHES' WHEN inliers < 12 THEN 'TOO_FEW_INLIERS' WHEN inliers / matches < 0.7 THEN 'LOW_INLIER_RATIO' WHEN pixels > 100 THEN 'DELTA_TRANSLATION_TOO_LARGE'
 WHEN degrees > 5 THEN 'DELTA_ROTATION_TOO_LARGE' WHEN scale < 0.92 OR scale > 1.08 THEN 'DELTA_SCALE_IMPLAUSIBLE' WHEN pixels * 2 > 180 THEN 'CUMULATIVE_TRANSLATION_TOO_LARGE' WHEN degrees * 3 > 10 THEN 'CUMULATIVE_ROTATION_TOO_LARGE' WHEN scale * scale > 1.15 THEN 'CUMULATIVE_SCALE_IMPLAUSIBLE' ELSE 'OK' END AS reason FROM c""")
def candidate_validation(spark, sf_dir):
    q = F.col("l_quantity")
    part = lambda p, d, s: F.struct(p.alias("translation"), d.alias("rotation_deg"), s.alias("scale"))
    pixels, turn, scale = q * 3, F.col("l_tax") * 80, 1 + F.col("l_discount")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", ((F.col("l_returnflag") != "N") | (F.col("l_linenumber") < 6)).alias("found"), F.rint(q).cast("int").alias("matches"), F.rint(q * (1 - F.col("l_discount") * 5)).cast("int").alias("inliers"), part(pixels, turn, scale).alias("delta"), part(pixels * 2, turn * 3, scale * scale).alias("total"))
    rows = rows.withColumn("ratio", F.when(F.col("matches") > 0, F.col("inliers") / F.col("matches")).otherwise(0.0))
    options = M.TrackingOptions(min_ratio=0.7, total_pixels=180.0)
    return rows.select("l_orderkey", "l_linenumber", M.verdict(options).alias("reason"))


@query("""WITH v AS (SELECT vec_id, label, list_sum(list_transform(range(1, 65), lambda i: CASE WHEN embedding[i] > 0 THEN CAST(1 AS UBIGINT) << CAST(i - 1 AS UBIGINT) ELSE 0 END))::UBIGINT AS bits FROM embeddings),
d AS (SELECT a.label, a.vec_id AS query_id, b.vec_id AS train_id, bit_count(xor(a.bits, b.bits)) AS d FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, train_id) AS k FROM d), p AS (SELECT label, query_id, max(CASE WHEN k = 1 THEN train_id END) AS train_id, max(CASE WHEN k = 1 THEN d END) AS d1, max(CASE WHEN k = 2 THEN d END) AS d2 FROM r WHERE k <= 2 GROUP BY ALL)
SELECT label, query_id, train_id, CAST(d1 AS INTEGER) AS d1, CAST(d2 AS INTEGER) AS d2 FROM p WHERE d1 < 0.95 * d2""")
def knn_ratio_match(spark, sf_dir):
    signs = F.aggregate(F.transform("embedding", lambda x, i: F.when(x > 0, F.expr("1L")).otherwise(F.expr("0L"))), F.struct(F.lit(0).alias("i"), F.expr("0L").alias("v")), lambda acc, b: F.struct((acc["i"] + 1).alias("i"), acc["v"].bitwiseOR(F.call_function("shiftleft", b, acc["i"])).alias("v")), lambda acc: acc["v"])
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.array(signs).alias("bits"))
    left = rows.filter("vec_id % 100 = 0").select("label", F.col("vec_id").alias("query_id"), "bits")
    right = rows.select("label", F.col("vec_id").alias("train_id"), "bits")
    found = M.two_nearest(left, right, ["label"], "query_id", "train_id", "bits", others=True)
    return M.unambiguous(found, 0.95).select("label", "query_id", "train_id", "d1", "d2")


@query("""WITH s AS (SELECT l_orderkey AS frame, l_linenumber AS view_id, CAST(l_quantity AS INTEGER) AS matches, CAST(l_quantity * (1 - l_discount * 4) AS INTEGER) AS inliers FROM lineitem),
r AS (SELECT *, inliers / matches AS ratio, inliers * (inliers / matches) AS score FROM s), k AS (SELECT *, row_number() OVER (PARTITION BY frame ORDER BY score DESC, view_id) AS k FROM r WHERE matches >= 20 AND inliers >= 12 AND ratio >= 0.3)
SELECT frame, view_id, round(score + 1e-9, 6) AS score FROM k WHERE k = 1""")
def view_identify(spark, sf_dir):
    q = F.col("l_quantity")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("frame"), F.col("l_linenumber").alias("view_id"), F.rint(q).cast("int").alias("matches"), F.rint(q * (1 - F.col("l_discount") * 4)).cast("int").alias("inliers"))
    rows = rows.withColumn("ratio", F.col("inliers") / F.col("matches")).withColumn("score", F.col("inliers") * F.col("ratio"))
    return M.best_view(rows, ["frame"], M.SceneOptions()).select("frame", "view_id", r6("score", "score"))


@query("""WITH e AS (SELECT event_id, value / 100 AS t, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events), c AS (SELECT event_id, t, k / 400.0 AS rot, k % 30 AS inliers, (k % 30) / 30.0 AS ratio, k / 500.0 AS edge FROM e)
SELECT event_id, CASE WHEN inliers >= 10 AND ratio >= 0.35 THEN t >= 2 OR rot >= 0.12 OR edge >= 0.12 ELSE edge >= 0.1 END AS moving, CASE WHEN inliers >= 10 AND ratio >= 0.35 THEN t <= 0.8 AND rot <= 0.06 AND edge <= 0.07 ELSE false END AS stable FROM c""")
def motion_evidence(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("int")
    rows = table(spark, sf_dir, "events").select("event_id", (F.col("value") / 100).alias("translation"), (k / 400.0).alias("rotation_deg"), (k % 30).alias("inliers"), ((k % 30) / 30.0).alias("ratio"), (k / 500.0).alias("edge_change"))
    return rows.select("event_id", M.evidence(M.SceneOptions()).alias("e")).select("event_id", "e.*")


_POLYGON = """g AS (SELECT p_partkey, p_size, CAST([[p_size, 10.0], [p_size + 40.0, 12.0 + p_partkey % 5], [p_size + 30.0, 60.0], [p_size - 5.0, 50.0 + p_partkey % 9]] AS DOUBLE[][]) AS pts FROM part)"""


def _polygons(spark, sf_dir) -> DataFrame:
    s, k = F.col("p_size"), F.col("p_partkey")
    pts = F.array(G.point(s, F.lit(10.0)), G.point(s + 40.0, 12.0 + k % 5), G.point(s + 30.0, F.lit(60.0)), G.point(s - 5.0, 50.0 + k % 9))
    return table(spark, sf_dir, "part").select("p_partkey", "p_size", pts.alias("pts"))


_AREA = "abs(list_sum(list_transform(range(1, 5), lambda i: pts[i][1] * pts[i % 4 + 1][2] - pts[i % 4 + 1][1] * pts[i][2]))) / 2"


@query(f"""WITH {_POLYGON}, b AS (SELECT p_partkey, pts, {_AREA} AS area, list_min(list_transform(pts, lambda p: p[1])) AS x0, list_max(list_transform(pts, lambda p: p[1])) AS x1, list_min(list_transform(pts, lambda p: p[2])) AS y0, list_max(list_transform(pts, lambda p: p[2])) AS y1 FROM g)
SELECT p_partkey, round(area + 1e-9, 6) AS area, x0 AS box_x, y0 AS box_y, x1 - x0 AS box_w, y1 - y0 AS box_h, area >= 10 AND x0 >= 3 AND y0 >= 3 AND x1 < 77 AND y1 < 61 AS fits, array_to_string(list_transform(flatten(pts), lambda v: CAST(CAST(v AS INTEGER) AS VARCHAR)), ' ') AS segmentation FROM b""")
def polygon_geometry(spark, sf_dir):
    p = F.col("pts")
    rows = _polygons(spark, sf_dir).withColumn("box", G.bounding_box(p))
    names = ("box_x", "box_y", "box_w", "box_h")
    text = F.array_join(F.transform(G.flat(p), lambda v: v.cast("int").cast("string")), " ")
    return rows.select("p_partkey", r6(G.area(p), "area"), *(F.col("box")[i].alias(n) for i, n in enumerate(names)), G.fits(p, F.lit(80), F.lit(64)).alias("fits"), text.alias("segmentation"))


@query(f"""WITH {_POLYGON}, m AS (SELECT p_partkey, pts, 1.01 * cos(radians(1.0)) AS a, 1.01 * sin(radians(1.0)) AS b FROM g), t AS (SELECT p_partkey, unnest(pts) AS p, unnest(range(1, 5)) AS i, a, b FROM m),
q AS (SELECT p_partkey, i, round_even(a * p[1] + b * p[2] + (1 - a) * 40 - b * 32 + 20, 0) AS x, round_even(-b * p[1] + a * p[2] + b * 40 + (1 - a) * 32 - 10, 0) AS y FROM t)
SELECT p_partkey, i AS point, x, y + 0.0 AS y, round(x / 80, 9) AS nx, round(y / 64, 9) + 0.0 AS ny FROM q""")
def polygon_transform(spark, sf_dir):
    h = G.similarity(F.lit(20.0), F.lit(-10.0), F.lit(1.0), F.lit(1.01), F.lit(80.0), F.lit(64.0))
    moved = G.rounded(G.apply(h, F.col("pts")))
    rows = _polygons(spark, sf_dir).select("p_partkey", F.posexplode(F.arrays_zip(moved.alias("m"), G.normalised(moved, F.lit(80.0), F.lit(64.0)).alias("n"))).alias("i", "z"))
    return rows.select("p_partkey", (F.col("i") + 1).cast("long").alias("point"), F.col("z.m.x").alias("x"), (F.col("z.m.y") + 0.0).alias("y"), F.round("z.n.x", 9).alias("nx"), (F.round("z.n.y", 9) + 0.0).alias("ny"))


_EDGE = "(q[{b}][1] - q[{a}][1]) * (y - q[{a}][2]) - (q[{b}][2] - q[{a}][2]) * (x - q[{a}][1]) >= 0"


@query(f"""WITH {_POLYGON}, s AS (SELECT p_partkey, list_transform(pts, lambda p: [p[1] * (1 + p_size % 5) + p_partkey % 40 * 100, p[2] * (1 + p_size % 5) + p_partkey // 40 * 100]) AS q FROM g),
b AS (SELECT *, list_min(list_transform(q, lambda p: p[1])) AS x0, list_max(list_transform(q, lambda p: p[1])) AS x1, list_min(list_transform(q, lambda p: p[2])) AS y0, list_max(list_transform(q, lambda p: p[2])) AS y1 FROM s),
l AS (SELECT l_orderkey, l_linenumber, (l_orderkey * 37 + l_linenumber * 11) % 4200 AS x, (l_partkey * 13 + l_suppkey * 7) % 1200 AS y FROM lineitem)
SELECT l_orderkey, l_linenumber, p_partkey FROM l JOIN b ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 WHERE """ + " AND ".join(_EDGE.format(a=a, b=a % 4 + 1) for a in range(1, 5)))
def points_in_regions(spark, sf_dir):
    """Line items as points on a plane, parts as regions of many sizes: which regions hold each."""
    from caloris.operators.spatial import points_in_polygons

    k, grow = F.col("p_partkey"), 1 + F.col("p_size") % 5
    pts = F.transform("pts", lambda p: G.point(p["x"] * grow + k % 40 * 100, p["y"] * grow + F.floor(k / 40) * 100))
    regions = _polygons(spark, sf_dir).select("p_partkey", pts.alias("shape"))
    x, y = (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 11) % 4200, (F.col("l_partkey") * 13 + F.col("l_suppkey") * 7) % 1200
    points = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", x.cast("double").alias("x"), y.cast("double").alias("y"))
    return points_in_polygons(points, regions, [], "x", "y", "shape").select("l_orderkey", "l_linenumber", "p_partkey")


@query("SELECT p_partkey, p_size >= 10 AND p_size < 30 AND p_partkey % 50 >= 5 AND p_partkey % 50 < 25 AS inside, greatest(0, p_size - 6) AS pad_x, least(48, p_size + 10 + 6) - greatest(0, p_size - 6) AS pad_w FROM part")
def point_in_box(spark, sf_dir):
    k = F.col("p_partkey") % 50
    box = F.struct(F.lit(10).alias("x"), F.lit(5).alias("y"), F.lit(20).alias("w"), F.lit(20).alias("h"))
    own = F.struct(F.col("p_size").alias("x"), F.lit(0).alias("y"), F.lit(10).alias("w"), F.lit(10).alias("h"))
    rows = table(spark, sf_dir, "part").select("p_partkey", G.in_box(F.col("p_size"), k, box).alias("inside"), G.padded(own, 6, F.lit(48), F.lit(48)).alias("p"))
    return rows.select("p_partkey", "inside", F.col("p.x").alias("pad_x"), F.col("p.w").alias("pad_w"))


@query("SELECT p_partkey, CAST(least(p_size, p_partkey % 40) AS DOUBLE) AS left_x, CAST(greatest(p_size, p_partkey % 40) AS DOUBLE) AS right_x, round(least(40.0 / (p_size + 20), 1.0), 9) AS scale, least(greatest(round_even(17 / least(40.0 / (p_size + 20), 1.0), 0), 0), p_size + 20 - 1) AS pointed FROM part")
def display_mapping(spark, sf_dir):
    corners = G.rectangle(F.col("p_size"), F.lit(0), F.col("p_partkey") % 40, F.lit(9))
    size = F.col("p_size") + 20
    scale = G.display_scale(size, size, 40, 40)
    return table(spark, sf_dir, "part").select("p_partkey", corners[0]["x"].alias("left_x"), corners[1]["x"].alias("right_x"), F.round(scale, 9).alias("scale"), G.from_display(F.lit(17), scale, size).alias("pointed"))


# --- datasets and clips -----------------------------------------------------------------------------------------------------

@query("WITH v AS (SELECT s_suppkey AS video_id, 24 + s_suppkey % 7 / 3.0 AS fps, 500 + s_suppkey * 3 AS total FROM supplier) SELECT video_id, unnest(generate_series(0, total - 1, greatest(1, CAST(round_even(fps * 5, 0) AS BIGINT)))) AS frame FROM v")
def sample_steps(spark, sf_dir):
    s = F.col("s_suppkey")
    videos = table(spark, sf_dir, "supplier").select(s.alias("video_id"), (24 + s % 7 / 3.0).alias("fps"), (500 + s * 3).alias("total_frames"))
    return D.sampled_frames(videos, 5.0).select("video_id", "frame")


@query(f"""WITH {_POLYGON}, a AS (SELECT *, {_AREA} AS area FROM g), i AS (SELECT row_number() OVER (ORDER BY p_partkey) AS image_id, * FROM a)
SELECT image_id AS id, image_id, 1 AS category_id, round(area + 1e-9, 6) AS area, list_max(list_transform(pts, lambda p: p[1])) - list_min(list_transform(pts, lambda p: p[1])) AS box_w FROM i""")
def coco_annotations(spark, sf_dir):
    images = D.numbered(_polygons(spark, sf_dir), ["p_partkey"], "image_id").select("image_id", F.array("pts").alias("polygons"))
    found = D.annotations(images)
    return found.select(F.col("id").cast("long").alias("id"), "image_id", "category_id", r6("area", "area"), F.col("bbox")[2].alias("box_w"))


@query(None)
def augment_variants(spark, sf_dir):
    frames = _polygons(spark, sf_dir).select(F.format_string("part_%06d", "p_partkey").alias("source_group"), F.lit(120).alias("width"), F.lit(100).alias("height"), F.array("pts").alias("polygons"))
    found = D.augmentations(frames, D.DatasetOptions())
    return found.select("source_group", "augmentation", "dx_pixels", "dy_pixels", "rotation_deg", "scale", F.size("polygons").alias("instance_count"))


@query("SELECT o_orderstatus AS source, count(DISTINCT o_orderkey) AS images, count(l_orderkey) AS instances FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderstatus")
def dataset_totals(spark, sf_dir):
    images = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image"), F.col("o_orderstatus").alias("source"))
    return D.totals(images, table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("image")), "image", "source")


@query("""WITH v AS (SELECT s_suppkey AS video, 20 + s_suppkey % 11 + 0.31192660550459::DOUBLE AS fps FROM supplier), s AS (SELECT video, unnest(range(5)) AS no, round_even(4.0 * fps, 0)::INTEGER AS stable, greatest(1, round_even(1.2::DOUBLE * fps, 0))::INTEGER AS pan FROM v),
f AS (SELECT video, no, ['A', 'A_TO_B', 'B', 'B_TO_A', 'A'][no + 1] AS segment, CASE WHEN no % 2 = 1 THEN pan ELSE stable END AS length, (no + 1) // 2 * stable + no // 2 * pan AS begin FROM s), r AS (SELECT *, unnest(range(length)) AS local FROM f)
SELECT video, (begin + local)::INTEGER AS frame, segment, round(CASE WHEN contains(segment, '_TO_') THEN CASE WHEN length > 1 THEN local / (length - 1) ELSE 1.0 END END, 9) AS fraction FROM r""")
def pan_timeline(spark, sf_dir):
    """Suppliers as clips of a rate of their own."""
    clips = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("video"), (20 + F.col("s_suppkey") % 11 + F.lit(0.31192660550459)).alias("fps"))
    return D.pan_frames_of(clips, "video").select("video", "frame", "segment", F.round("fraction", 9).alias("fraction"))


@query("SELECT o_orderkey, round(CASE WHEN o_orderkey % 50 < 20 THEN 0 ELSE least(1.0, (o_orderkey % 50 - 20 + 1) / 4.0) END, 9) AS progress, CAST(greatest(1, round_even(o_totalprice / 1000 / 3, 0)) AS INTEGER) AS interval_frames FROM orders")
def motion_ramp(spark, sf_dir):
    f = F.col("o_orderkey") % 50
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(G.ramp(f, F.lit(20), F.lit(4)), 9).alias("progress"), X.ocr_interval(F.col("o_totalprice") / 1000, F.lit(3)).alias("interval_frames"))


@query(f"WITH {READINGS}, b AS (SELECT region, max(frame) AS last FROM readings GROUP BY region) SELECT r.region, r.frame, round(r.temperature + 1e-9, 6) AS temperature FROM readings r JOIN b USING (region) WHERE r.frame BETWEEN least(greatest(5, 0), last) AND least(last, 5 + 20 - 1)")
def frame_range(spark, sf_dir):
    from caloris.sources.frames import clamp_range

    rows = readings(spark, sf_dir).withColumn("total", F.max("frame").over(Window.partitionBy("region")) + 1)
    first, last = clamp_range(F.lit(5), F.lit(None).cast("int"), F.lit(20), F.col("total"))
    return rows.filter(F.col("frame").between(first, last)).select("region", "frame", r6("temperature", "temperature"))


# --- names, settings and provenance -----------------------------------------------------------------------------------------

@query(r"SELECT p_partkey, regexp_replace(regexp_replace(p_name || ' / ' || p_type, '[^\p{L}\p{N}]+', '_', 'g'), '^_+|_+$', '', 'g') AS safe, printf('%02d:%05.2f', CAST(floor(p_retailprice / 60) AS BIGINT), p_retailprice - floor(p_retailprice / 60) * 60) AS time, regexp_replace(p_type || '/' || p_name, '\.[^./]*$', '') AS mirrored FROM part")
def path_names(spark, sf_dir):
    name = F.concat_ws(" / ", "p_name", "p_type")
    path = F.concat(F.lit("/data/Raw-Videos/"), F.col("p_type"), F.lit("/"), F.col("p_name"), F.lit(".mp4"))
    mirrored = X.mirrored(path, "raw-videos")
    return table(spark, sf_dir, "part").select("p_partkey", X.safe_name(name).alias("safe"), X.human_time(F.col("p_retailprice")).alias("time"), F.regexp_replace(mirrored, r"\.[^./]*$", "").alias("mirrored"))


@query("""WITH r AS (SELECT o_orderkey AS k, unnest(['status', 'priority', 'clerk']) AS setting, unnest([o_orderstatus, o_orderpriority, 'x']) AS value FROM orders),
s AS (SELECT l_orderkey AS k, 'status' AS setting, max(l_linestatus) AS value FROM lineitem GROUP BY l_orderkey UNION ALL SELECT o_orderkey, 'clerk', 'x' FROM orders WHERE o_orderstatus = 'F')
SELECT r.k, r.setting, r.value, s.value AS old_value FROM r LEFT JOIN s ON s.k = r.k AND s.setting = r.setting WHERE r.value IS DISTINCT FROM s.value""")
def settings_stale(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    item = lambda n, v: F.struct(F.lit(n).alias("setting"), v.alias("value"))
    asked = orders.select(F.col("o_orderkey").alias("k"), F.inline(F.array(item("status", F.col("o_orderstatus")), item("priority", F.col("o_orderpriority")), item("clerk", F.lit("x")))))
    held = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.max("l_linestatus").alias("value")).select("k", F.lit("status").alias("setting"), "value")
    held = held.unionByName(orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k"), F.lit("clerk").alias("setting"), F.lit("x").alias("value")))
    return P.stale_settings(asked, held, ["k"])


@query("SELECT c_custkey, CASE WHEN o AND mc AND NOT st THEN 'CURRENT' WHEN o AND mc THEN 'STALE' WHEN o AND NOT hm THEN 'LEGACY / UNTRACKED' WHEN anyc THEN 'PARTIAL' ELSE 'NEW' END AS status FROM (SELECT c_custkey, c_custkey % 2 = 0 AS o, c_custkey % 3 <> 0 AS hm, c_custkey % 3 = 1 AS mc, c_acctbal < 1000 AS st, c_custkey % 5 <> 0 AS anyc FROM customer)")
def stage_status(spark, sf_dir):
    k = F.col("c_custkey")
    status = P.stage_status(k % 2 == 0, k % 3 != 0, k % 3 == 1, F.col("c_acctbal") < 1000, k % 5 != 0)
    return table(spark, sf_dir, "customer").select("c_custkey", status.alias("status"))


@query("""WITH req AS (SELECT DISTINCT o_custkey AS video, sha256(o_orderpriority)[1:16] AS signature FROM orders), led AS (SELECT o_custkey AS video, sha256(o_orderpriority)[1:16] AS signature, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS id FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F')),
m AS (SELECT video, max(id) AS last FROM led GROUP BY video), b AS (SELECT req.video, req.signature, led.id, coalesce(m.last, 0) AS last FROM req LEFT JOIN led ON led.video = req.video AND led.signature = req.signature LEFT JOIN m ON m.video = req.video)
SELECT video, signature, CAST(coalesce(id, last + sum(CASE WHEN id IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY video ORDER BY signature)) AS BIGINT) AS id, id IS NOT NULL AS reused FROM b""")
def variant_reuse(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("video"), "o_orderpriority", "o_orderstatus")
    mark = F.substring(F.sha2("o_orderpriority", 256), 1, 16)
    asked = orders.select("video", mark.alias("signature")).distinct()
    made = orders.filter("o_orderstatus = 'F'").select("video", "o_orderpriority").distinct()
    ledger = made.select("video", mark.alias("signature"), F.row_number().over(Window.partitionBy("video").orderBy("o_orderpriority")).alias("id"))
    return P.reuse_or_new(asked, ledger, "video")


@query("SELECT p_partkey, sha256(p_name || '|' || p_type) AS sha256, sha256(p_name || '|' || p_type)[1:16] AS signature FROM part")
def fingerprint(spark, sf_dir):
    whole, signature = P.text_fingerprint(F.col("p_name"), F.col("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", whole.alias("sha256"), signature.alias("signature"))


@query("SELECT n_nationkey, n_name || ' | ' || printf('%.1f', round(min(c_acctbal), 1)) || ' | ' || printf('%.1f', round(max(c_acctbal), 1)) AS label FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name")
def overlay_labels(spark, sf_dir):
    from caloris.operators.thermal import overlay_label

    stats = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.min("c_acctbal").alias("lo"), F.max("c_acctbal").alias("hi"))
    rows = stats.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select("n_nationkey", overlay_label(F.col("n_name"), F.col("lo"), F.col("hi")).alias("label"))


@query(f"""WITH {READINGS}, a AS (SELECT *, kind <> 'error' AND frame > 0 AS good FROM readings),
i AS (SELECT *, max(CASE WHEN good OR frame = 0 THEN frame END) OVER w AS anchor_frame, sum(CASE WHEN good THEN gray ELSE 0 END) OVER w AS h02 FROM a WINDOW w AS (PARTITION BY region ORDER BY frame))
SELECT region, frame, CASE WHEN frame = 0 THEN 'REFERENCE' WHEN good THEN 'TRACKED' WHEN frame - anchor_frame >= 3 THEN 'SCENE_CHANGE_SUSPECTED' ELSE 'HOLD_LAST_GOOD' END AS status,
 CAST(anchor_frame AS BIGINT) AS anchor_frame, CAST(frame - anchor_frame AS INTEGER) AS failures, CAST(h02 AS DOUBLE) AS h02 FROM i""")
def camera_track(spark, sf_dir):
    one, none = F.lit(1.0), F.lit(0.0)
    rows = readings(spark, sf_dir).withColumns({"accepted": F.col("kind") != "error", "delta": F.array(one, none, F.col("gray").cast("double"), none, one, none)})
    found = fold.ordered_fold(rows, "region", ["frame"], ["frame", "accepted", "delta"], fold.track_step(warn_after=3), fold.TRACK_FIELDS)
    return found.select("region", "frame", "status", "anchor_frame", "failures", F.col("transform")[2].alias("h02"))


@query("""WITH a AS (SELECT event_id AS frame, event_type, event_type <> 'error' AND event_id > 0 AS good, CAST(json_extract_string(props, '$.k') AS INTEGER) AS gray FROM events),
i AS (SELECT *, max(CASE WHEN good OR frame = 0 THEN frame END) OVER w AS anchor_frame, row_number() OVER w AS k, sum(CASE WHEN good THEN gray ELSE 0 END) OVER w AS h02 FROM a WINDOW w AS (ORDER BY frame)),
j AS (SELECT *, k - max(CASE WHEN good OR frame = 0 THEN k END) OVER (ORDER BY frame) AS failures FROM i)
SELECT frame, CASE WHEN frame = 0 THEN 'REFERENCE' WHEN good THEN 'TRACKED' WHEN failures >= 3 THEN 'SCENE_CHANGE_SUSPECTED' ELSE 'HOLD_LAST_GOOD' END AS status, anchor_frame, CAST(failures AS INTEGER) AS failures, CAST(h02 AS DOUBLE) AS h02 FROM j""")
def camera_track_long(spark, sf_dir):
    """All events as one recording, tracked in blocks of frames."""
    from caloris.operators.scan import TrackScan, block_fold

    one, none = F.lit(1.0), F.lit(0.0)
    gray = F.get_json_object("props", "$.k").try_cast("int").cast("double")
    rows = table(spark, sf_dir, "events").select(F.lit("all").alias("video"), F.col("event_id").alias("frame"), (F.col("event_type") != "error").alias("accepted"), F.array(one, none, gray, none, one, none).alias("delta"))
    found = block_fold(rows, "video", "frame", TrackScan(warn_after=3), fold.TRACK_FIELDS, size=1024, fan=64)
    return found.select("frame", "status", "anchor_frame", "failures", F.col("transform")[2].alias("h02"))


@query(f"""WITH RECURSIVE e AS (SELECT event_id AS frame, value >= 80 AS moving, value <= 120 AS stable FROM events), f AS (
  SELECT frame, 'STABLE' AS state, CASE WHEN moving THEN 1 ELSE 0 END AS run, CASE WHEN moving THEN 1 ELSE 0 END AS moving_evidence, 0 AS stable_evidence, CAST(NULL AS VARCHAR) AS event FROM e WHERE frame = (SELECT min(frame) FROM e)
  UNION ALL
  SELECT frame, CASE WHEN done THEN CASE state WHEN 'STABLE' THEN 'MOVING' ELSE 'STABLE' END ELSE state END, CASE WHEN done THEN 0 ELSE n END,
    CASE WHEN state = 'STABLE' THEN n ELSE 0 END, CASE WHEN state = 'MOVING' THEN n ELSE 0 END, CASE WHEN done THEN CASE state WHEN 'STABLE' THEN 'MOVEMENT_STARTED' ELSE 'SETTLED' END END
  FROM (SELECT *, n >= CASE state WHEN 'STABLE' THEN 2 ELSE 3 END AS done FROM (
    SELECT e.frame, f.state, CASE WHEN CASE f.state WHEN 'STABLE' THEN e.moving ELSE e.stable END THEN f.run + 1 ELSE 0 END AS n FROM f JOIN e ON e.frame = f.frame + 1)))
SELECT frame, state, moving_evidence, stable_evidence, event FROM f""")
def scene_fsm_long(spark, sf_dir):
    """All events as one recording, its scene states found in blocks of frames."""
    from caloris.operators.scan import SceneScan, block_fold

    rows = table(spark, sf_dir, "events").select(F.lit("all").alias("video"), F.col("event_id").alias("frame"), (F.col("value") >= 80).alias("moving"), (F.col("value") <= 120).alias("stable"))
    found = block_fold(rows, "video", "frame", SceneScan(_RULES), fold.SCENE_FIELDS, size=1024, fan=64)
    return found.select("frame", "state", "moving_evidence", "stable_evidence", "event")


@query("""WITH c AS (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'OK' WHEN 1 THEN 'NO_MATCHES' ELSE 'TOO_FEW_INLIERS' END AS flow, CASE o_custkey % 2 WHEN 0 THEN 'OK' ELSE 'NO_TRANSFORM' END AS features FROM orders)
SELECT o_orderkey, CASE WHEN flow = 'OK' THEN 'LK_OPTICAL_FLOW' WHEN features = 'OK' THEN 'ORB_FALLBACK' ELSE 'NONE' END AS method,
 CASE WHEN flow = 'OK' THEN 'LK_ACCEPTED' WHEN features = 'OK' THEN 'ORB_RECOVERY_AFTER_' || flow ELSE 'TRACKING_FAILED:LK=' || flow || ';ORB=' || features END AS reason FROM c""")
def method_choice(spark, sf_dir):
    k = F.col("o_orderkey") % 3
    flow = F.when(k == 0, "OK").when(k == 1, "NO_MATCHES").otherwise("TOO_FEW_INLIERS")
    features = F.when(F.col("o_custkey") % 2 == 0, "OK").otherwise("NO_TRANSFORM")
    return table(spark, sf_dir, "orders").select("o_orderkey", M.choose_method(flow, features).alias("c")).select("o_orderkey", "c.*")


@query("WITH r AS (SELECT o_orderkey AS video, unnest(['log', 'summary', 'manifest']) AS name FROM orders), p AS (SELECT l_orderkey AS video, CASE l_linenumber WHEN 1 THEN 'log' WHEN 2 THEN 'summary' WHEN 3 THEN 'manifest' ELSE 'extra' END AS name, l_quantity AS size_bytes FROM lineitem) SELECT r.video, r.name FROM r WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.video = r.video AND p.name = r.name AND p.size_bytes > 10)")
def missing_outputs(spark, sf_dir):
    required = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("video"), F.explode(F.array(F.lit("log"), F.lit("summary"), F.lit("manifest"))).alias("name"))
    n = F.col("l_linenumber")
    present = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("video"), F.when(n == 1, "log").when(n == 2, "summary").when(n == 3, "manifest").otherwise("extra").alias("name"), (F.col("l_quantity") - 10).alias("size_bytes"))
    return P.missing_files(required, present, ["video"])


@query("SELECT o_orderkey, least(greatest(CAST(round_even(((o_orderkey % 97) * CAST(0.31 AS DOUBLE)) % CAST(4.1 AS DOUBLE) * CAST(24.5 AS DOUBLE), 0) AS INTEGER), 0), 99) AS frame FROM orders")
def looped_frames(spark, sf_dir):
    from caloris.sources.frames import looped_frame

    seconds = (F.col("o_orderkey") % 97).cast("double") * 0.31
    return table(spark, sf_dir, "orders").select("o_orderkey", looped_frame(seconds, F.lit(4.1), F.lit(24.5), F.lit(100)).alias("frame"))


_LOG = """v AS (SELECT label::VARCHAR AS video_id, vec_id::INTEGER AS frame, 1 + vec_id % 5 AS step, vec_id % 7 AS dark, vec_id % 10 <> 0 AS scaled, list_transform(embedding, lambda x: ((floor(x::DOUBLE * 64)::BIGINT % 256) + 256) % 256) AS levels FROM embeddings WHERE label IS NOT NULL),
x AS (SELECT *, unnest(levels) AS level, unnest(range(64)) AS i FROM v), t AS (
  SELECT *, 10.0 + 7 * step - step * list_min(list_filter(range(8), lambda r: abs(255 - 32 * r - dark - level) = list_min(list_transform(range(8), lambda q: abs(255 - 32 * q - dark - level))))) AS t FROM x WHERE level % 5 <> 0 AND scaled),
g(region_id, region_name, x0, x1) AS (VALUES (1, 'left', 0, 3), (2, 'right', 4, 7)),
s AS (SELECT video_id, frame, region_id, min(t) AS min_temp, avg(t) AS avg_temp, max(t) AS max_temp, quantile_cont(t, 0.5) AS median_temp, quantile_cont(t, 0.95) AS p95_temp, quantile_cont(t, 0.99) AS p99_temp, count(*) AS n, arg_max(i, (t, -i)) AS hot FROM t JOIN g ON i % 8 BETWEEN x0 AND x1 GROUP BY ALL),
log AS (SELECT v.video_id, v.frame, region_id, region_name, CASE WHEN scaled THEN 10.0 END AS scale_min_temp, CASE WHEN scaled THEN 10.0 + 7 * step END AS scale_max_temp, min_temp, avg_temp, max_temp, median_temp, p95_temp, p99_temp, coalesce(n, 0)::BIGINT AS valid_pixel_count, (hot % 8)::INTEGER AS hotspot_x, (hot // 8)::INTEGER AS hotspot_y
  FROM v CROSS JOIN g LEFT JOIN s USING (video_id, frame, region_id))"""
_TEMPS = ("min_temp", "avg_temp", "max_temp", "median_temp", "p95_temp", "p99_temp")


def _temperatures(spark, sf_dir) -> DataFrame:
    """Vectors as frames of 8 x 8 levels of gray beside a colour bar of four columns; every fifth level is a coloured overlay."""
    from caloris.operators.thermal import temperature_log

    k = F.col("vec_id")
    two = lambda v: F.lpad(F.hex(v.cast("long")), 2, "0")
    level = lambda x: F.pmod(F.floor(x.cast("double") * 64), F.lit(256))
    pixel = lambda v: F.when(v % 5 == 0, F.concat(two(v), two(v), two((v + 128) % 256))).otherwise(F.repeat(two(v), 3))
    line = lambda y: F.concat(F.array_join(F.transform(F.slice("embedding", y * 8 + 1, 8), lambda x: pixel(level(x))), ""), F.repeat(two(255 - 32 * y - k % 7), 12))
    rows = table(spark, sf_dir, "embeddings").filter("label IS NOT NULL").select(
        F.col("label").cast("string").alias("video_id"), k.cast("int").alias("frame"), (k / 25).alias("timestamp_seconds"), F.lit(12).alias("width"), F.lit(8).alias("height"),
        F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), line), "")).alias("bgr"),
        F.when(k % 10 != 0, 10.0).alias("scale_min_temp"), F.when(k % 10 != 0, 10.0 + 7 * (1 + k % 5)).alias("scale_max_temp"),
    )
    regions = [{"id": 1, "name": "left", "points": [(0, 0), (3, 0), (3, 7), (0, 7)]}, {"id": 2, "name": "right", "points": [(4, 0), (7, 0), (7, 7), (4, 7)]}]
    # SQL's temperatures are decimals of one place, so are the percentiles between them
    return temperature_log(rows, regions, {"x": 8, "y": 0, "w": 4, "h": 8}, decimals=1)


@query(f"WITH {_LOG} SELECT video_id, frame, region_id, region_name, scale_min_temp, scale_max_temp, " + ", ".join(f"round({c} + 1e-9, 6) AS {c}" for c in _TEMPS) + ", valid_pixel_count, hotspot_x, hotspot_y FROM log")
def frame_temperatures(spark, sf_dir):
    """The whole path from frames to region statistics: colour bar, intensity table, neutral pixels, polygons."""
    found = _temperatures(spark, sf_dir)
    return found.select("video_id", "frame", "region_id", "region_name", "scale_min_temp", "scale_max_temp", *(r6(c, c) for c in _TEMPS), "valid_pixel_count", "hotspot_x", "hotspot_y")


@query(f"WITH {_LOG} SELECT region_name, round(min(min_temp) + 1e-9, 6) AS lowest_frame_min, round(avg(avg_temp) + 1e-9, 6) AS mean_of_frame_averages, round(max(max_temp) + 1e-9, 6) AS highest_frame_max, round(avg(p95_temp) + 1e-9, 6) AS mean_p95, round(max(p99_temp) + 1e-9, 6) AS highest_p99 FROM log WHERE valid_pixel_count > 0 GROUP BY region_name")
def video_summaries(spark, sf_dir):
    """The video summary over frame_temperatures."""
    found = S.video_summary(_temperatures(spark, sf_dir))
    return found.select("region_name", *(r6(c, c) for c in found.columns[1:]))


# --- recorded clips ---------------------------------------------------------------------------------------------------------

_CLIP = f"""{READINGS}, p AS (SELECT region, frame, frame // 2 AS n, CASE WHEN kind <> 'error' THEN temperature END AS low, temperature + gray AS high, temperature * 0.75 AS alt FROM readings),
j AS (SELECT *, low IS NOT NULL AND low BETWEEN 0 AND 1000 AND high BETWEEN 0 AND 1000 AND high - low >= 5 AS ok, alt BETWEEN 0 AND 1000 AND high BETWEEN 0 AND 1000 AND high - alt >= 5 AS alt_ok FROM p),
f AS (
  SELECT DISTINCT region, -1 AS n, 100.0::DOUBLE AS a, 150.0::DOUBLE AS b, CAST(NULL AS VARCHAR) AS status FROM j
  UNION ALL
  SELECT j.region, j.n, CASE WHEN j.ok AND abs(j.low - f.a) <= 150 AND abs(j.high - f.b) <= 150 THEN j.low WHEN j.alt_ok AND abs(j.alt - f.a) <= 150 AND abs(j.high - f.b) <= 150 THEN j.alt ELSE f.a END,
    CASE WHEN (j.ok AND abs(j.low - f.a) <= 150 OR j.alt_ok AND abs(j.alt - f.a) <= 150) AND abs(j.high - f.b) <= 150 THEN j.high ELSE f.b END,
    CASE WHEN j.ok AND abs(j.low - f.a) <= 150 AND abs(j.high - f.b) <= 150 THEN 'ACCEPT_PRIMARY' WHEN j.alt_ok AND abs(j.alt - f.a) <= 150 AND abs(j.high - f.b) <= 150 THEN 'ACCEPT_RETRY' ELSE 'HOLD_PREVIOUS' END
  FROM f JOIN j ON j.region = f.region AND j.n = f.n + 1 AND j.frame % 2 = 0)"""


@query(f"""WITH RECURSIVE {_CLIP}, c AS (SELECT j.*, f.a, f.b, j.frame % 2 = 0 AS sampled, CASE WHEN j.frame % 2 = 0 THEN f.status ELSE 'UNSAMPLED' END AS status FROM j JOIN f ON f.region = j.region AND f.n = j.n)
SELECT CAST(region AS VARCHAR) AS video_id, frame, frame / 10.0 AS timestamp_seconds, sampled::INTEGER AS was_ocr_sampled, CASE WHEN sampled THEN round(low + 1e-9, 6) END AS primary_min_temp, CASE WHEN sampled THEN round(high + 1e-9, 6) END AS primary_max_temp,
  CASE WHEN sampled THEN '5.0' END AS primary_min_text, CASE WHEN sampled THEN '5.0' END AS primary_max_text, CASE WHEN status LIKE 'ACCEPT%' THEN round(a + 1e-9, 6) END AS accepted_sample_min_temp, CASE WHEN status LIKE 'ACCEPT%' THEN round(b + 1e-9, 6) END AS accepted_sample_max_temp,
  CASE WHEN status LIKE 'ACCEPT%' THEN '5.0' END AS accepted_min_text, CASE WHEN status LIKE 'ACCEPT%' THEN '5.0' END AS accepted_max_text, CASE status WHEN 'ACCEPT_PRIMARY' THEN 'own/PSM7' WHEN 'ACCEPT_RETRY' THEN 'other/PSM8' END AS accepted_min_method,
  CASE WHEN status LIKE 'ACCEPT%' THEN 'own/PSM7' END AS accepted_max_method, round(a + 1e-9, 6) AS clean_min_temp_used, round(b + 1e-9, 6) AS clean_max_temp_used, status, (status IN ('ACCEPT_RETRY', 'HOLD_PREVIOUS'))::INTEGER AS retry_attempted FROM c""")
def scale_readings(spark, sf_dir):
    """A clip's scale log from labels read by one recipe, and by another where the first fails."""
    from caloris.sources.store import stored

    rows = readings(spark, sf_dir).select(F.col("region").cast("string").alias("video_id"), "frame", (F.col("frame") / 10.0).alias("timestamp_seconds"), "kind", "temperature", "gray")
    rows = stored(rows)  # each round of retries reads it
    sampled = rows.filter(W.sampled(F.col("frame"), F.lit(0), F.lit(-1), 2))

    def label(name: str, k: int, value: Column, method: str, mode: int) -> Column:
        return F.struct(F.lit(name).alias("label"), F.lit(k).alias("ord"), value.alias("value"), F.lit("5.0").alias("text"), F.lit(method).alias("method"), F.lit(mode).alias("psm"), F.lit(k == 0).alias("is_primary"))

    low, high = F.when(F.col("kind") != "error", F.col("temperature")), F.col("temperature") + F.col("gray")
    own = [label("MIN", 0, low, "own", 7), label("MAX", 0, high, "own", 7)]
    candidates = lambda df, items: df.select("video_id", "frame", F.inline(F.array(*items)))
    again = lambda needed: candidates(sampled.join(needed, ["video_id", "frame"], "left_semi"), [*own, label("MIN", 1, F.col("temperature") * 0.75, "other", 8)])
    seeds = rows.select("video_id").distinct().select("video_id", F.lit(100.0).alias("seed_low"), F.lit(150.0).alias("seed_high"))
    found = R.scale_readings(rows.select("video_id", "frame", "timestamp_seconds"), candidates(sampled, own), again, _GATE, seeds)
    temps = [c for c in found.columns if "_temp" in c]
    return found.withColumns({c: F.round(F.col(c) + NUDGE, 6) for c in temps})


@query("""WITH p AS (SELECT l_orderkey, l_linenumber, l_linenumber * 20 - 40 AS x, CAST(l_quantity AS INTEGER) - 5 AS y, CAST(l_quantity AS INTEGER) % 4 AS valid FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN x < 0 OR y < 0 OR x >= 90 OR y >= 40 THEN 'OUTSIDE FRAME' WHEN x BETWEEN 40 AND 64 AND y BETWEEN 10 AND 19 THEN 'THERMAL SCALE / UI' WHEN valid <= 0 THEN 'NO VALID THERMAL PIXELS' END AS reason FROM p""")
def probe_reasons(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    x, y = F.col("l_linenumber") * 20 - 40, F.col("l_quantity").cast("int") - 5
    box = F.struct(F.lit(40).alias("x"), F.lit(10).alias("y"), F.lit(25).alias("w"), F.lit(10).alias("h"))
    return lines.select("l_orderkey", "l_linenumber", S.probe_reason(x, y, F.lit(90), F.lit(40), [box], F.col("l_quantity").cast("int") % 4).alias("reason"))


@query("""WITH m AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_orderpriority AS q FROM orders)
SELECT CAST(k AS VARCHAR) AS stage, CASE WHEN k % 5 = 0 THEN 'INPUT_MISSING' ELSE 'INPUT_CHANGED' END AS reason, 'video' AS name FROM m WHERE k % 5 = 0 OR k % 3 = 0
UNION ALL SELECT CAST(k AS VARCHAR), 'SETTING_CHANGED', 'priority' FROM m WHERE q <> '1-URGENT'""")
def stale_reasons(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("stage"), F.col("o_orderkey").alias("k"), "o_orderpriority", "o_orderstatus")
    manifests = orders.select("stage", F.create_map(F.lit("video"), F.col("o_orderstatus")).alias("inputs"), F.create_map(F.lit("priority"), F.col("o_orderpriority")).alias("settings"))
    current = orders.filter("k % 5 <> 0").select("stage", F.lit("video").alias("name"), F.when(F.col("k") % 3 == 0, F.lit("other")).otherwise(F.col("o_orderstatus")).alias("sha256"))
    asked = orders.select("stage", F.lit("priority").alias("setting"), F.lit("1-URGENT").alias("value"))
    return P.stale_reasons(manifests, current, asked)


@query("""WITH RECURSIVE s AS (SELECT o_orderkey AS k, n, (o_orderkey + n) % 7 = 0 AS own FROM orders, range(4) t(n)),
e AS (SELECT k * 4 + n AS stage, k * 4 + n - 1 AS upstream FROM s WHERE n > 0 UNION ALL SELECT k * 4 + 3, k * 4 FROM s WHERE n = 3),
c AS (SELECT k * 4 + n AS stage, k * 4 + n AS cause, 0 AS hops FROM s WHERE own UNION ALL SELECT e.stage, c.cause, c.hops + 1 FROM c JOIN e ON e.upstream = c.stage)
SELECT stage, cause, min(hops)::INTEGER AS hops FROM c GROUP BY stage, cause""")
def stale_causes(spark, sf_dir):
    """Chains of four stages an order, the last resting on the first as well: whose staleness reaches whom."""
    stages = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("n"))
    stage = F.col("k") * 4 + F.col("n")
    chain = stages.filter("n > 0").select(stage.alias("stage"), (stage - 1).alias("upstream"))
    edges = chain.union(stages.filter("n = 3").select(stage, F.col("k") * 4))
    return P.stale_causes(edges, stages.filter((F.col("k") + F.col("n")) % 7 == 0).select(stage.alias("stage")))


@query("""WITH m AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS stage, ['annotation', 'scale', 'temperature', 'motion', 'scene', 'dataset'][o_orderkey % 6 + 1] AS kind FROM orders),
i AS (SELECT k, stage, kind, name FROM m, (VALUES ('video', 3), ('regions', 4), ('scale', 5), ('motion_video', 7)) t(name, d) WHERE k % d = 0
  AND name IN (SELECT unnest(CASE kind WHEN 'temperature' THEN ['video', 'regions', 'scale'] WHEN 'motion' THEN ['regions', 'motion_video'] WHEN 'dataset' THEN [] ELSE ['video'] END)))
SELECT stage, 'INPUT_CHANGED' AS reason, name FROM i UNION ALL SELECT stage, 'SETTING_CHANGED', 'hz' FROM m WHERE kind <> 'dataset' AND k % 2 = 0
UNION ALL SELECT stage, 'OUTPUT_EDITED', 'own' FROM m WHERE kind IN ('annotation', 'scale') AND k % 5 = 0""")
def stage_reasons(spark, sf_dir):
    kinds = F.get(F.array(*map(F.lit, ["annotation", "scale", "temperature", "motion", "scene", "dataset"])), (F.col("k") % 6).cast("int"))
    runs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderkey").cast("string").alias("stage")).withColumn("kind", kinds)
    changed = {"video": 3, "regions": 4, "scale": 5, "motion_video": 7}
    held = F.create_map(*(x for n in changed for x in (F.lit(n), F.lit("old"))))
    manifests = runs.select("stage", "kind", held.alias("inputs"), F.create_map(F.lit("hz"), F.lit("3")).alias("settings"), F.create_map(F.lit("own"), F.lit("made")).alias("outputs"))
    now = lambda n, d: F.struct(F.lit(n).alias("name"), F.when(F.col("k") % d == 0, "new").otherwise("old").alias("sha256"))
    current = runs.select("stage", F.inline(F.array(*(now(n, d) for n, d in changed.items()))))
    asked = runs.select("stage", F.lit("hz").alias("setting"), F.when(F.col("k") % 2 == 0, "4").otherwise("3").alias("value"))
    outputs = runs.select("stage", F.lit("own").alias("name"), F.when(F.col("k") % 5 == 0, "edited").otherwise("made").alias("sha256"))
    return P.stage_reasons(manifests, current, asked, outputs)


@query("""WITH p AS (SELECT c_custkey, ('0x' || substr(md5('42:' || c_nationkey), 1, 8))::BIGINT / 4294967296.0 AS place FROM customer)
SELECT c_custkey, CASE WHEN place < 0.7::DOUBLE THEN 'train' WHEN place < 0.7::DOUBLE + 0.2::DOUBLE THEN 'valid' ELSE 'test' END AS part FROM p""")
def dataset_split(spark, sf_dir):
    """Customers as variants of their nation's frame: a nation is never parted."""
    return table(spark, sf_dir, "customer").select("c_custkey", D.split(F.col("c_nationkey"), {"train": 0.7, "valid": 0.2, "test": 0.1}).alias("part"))


@query(f"""WITH {READINGS}, r AS (SELECT *, row_number() OVER (PARTITION BY region, gray ORDER BY event_id) AS nth FROM readings), f AS (SELECT region, gray, temperature, kind FROM r WHERE nth = 1)
SELECT r.event_id, r.region, r.gray, CASE WHEN f.kind <> 'error' THEN round(f.temperature + 1e-9, 6) END AS scale, CASE WHEN f.kind = 'error' THEN 'READ_FAILED' END AS error, r.nth > 1 AS remembered FROM r JOIN f ON f.region = r.region AND f.gray = r.gray""")
def paused_viewer(spark, sf_dir):
    """Events as looks at paused frames: a frame's first reading holds, and so does its first error."""
    failed = F.col("event_type") == "error"
    looks = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("region"), F.get_json_object("props", "$.k").try_cast("int").alias("gray"), F.when(~failed, F.col("value")).alias("scale"), F.when(failed, "READ_FAILED").alias("error"))
    found, _ = R.memoised(looks, ["region", "gray"], "event_id", ["scale", "error"])
    return found.select("event_id", "region", "gray", r6("scale", "scale"), "error", "remembered")


@query(f"WITH {READINGS}, r AS (SELECT region, frame, row_number() OVER (PARTITION BY region ORDER BY frame) AS nth FROM readings WHERE frame % 2 = 0 AND kind <> 'view') SELECT CAST(region AS VARCHAR) AS video_id, frame FROM r WHERE nth <= 30")
def debug_frames(spark, sf_dir):
    from caloris.sources.pictures import rejected_frames

    status = F.when(F.col("kind") == "view", "ACCEPT_PRIMARY").otherwise("HOLD_PREVIOUS")
    log = readings(spark, sf_dir).select(F.col("region").cast("string").alias("video_id"), "frame", (F.col("frame") % 2 == 0).cast("int").alias("was_ocr_sampled"), status.alias("status"))
    return rejected_frames(log, 30).select("video_id", "frame")


@query("SELECT vec_id::VARCHAR AS name, 8 AS width, 8 AS height, array_to_string(list_transform(embedding, lambda x: ((floor(x::DOUBLE * 64)::BIGINT % 256) + 256) % 256), ' ') AS levels FROM embeddings")
def embedding_pictures(spark, sf_dir):
    """Vectors as pictures of 8 x 8 levels of gray, written as PNG files and read back."""
    from caloris.sources.pictures import read_pictures, write_pictures
    from caloris.sources.store import own_folder

    level = lambda x: F.unhex(F.lpad(F.hex(F.pmod(F.floor(x.cast("double") * 64), F.lit(256)).cast("long")), 2, "0"))
    bytes_of = F.aggregate(F.transform("embedding", level), F.lit(b""), lambda a, b: F.concat(a, b))
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("name"), F.lit(8).alias("width"), F.lit(8).alias("height"), bytes_of.alias("pixels"))
    folder = own_folder(spark, "pictures")
    write_pictures(rows, folder)
    digits = F.hex("pixels")
    levels = F.transform(F.sequence(F.lit(1), F.length("pixels") * 2, F.lit(2)), lambda i: F.conv(F.substr(digits, i, F.lit(2)), 16, 10))
    return read_pictures(spark, folder).select("name", "width", "height", F.array_join(levels, " ").alias("levels"))


_OUTPUTS = [(k, f) for k, files in P.STAGE_FILES.items() for f in files]
_STAGES = list(P.STAGE_FILES)


@query("SELECT CAST(o_orderkey AS VARCHAR) AS video_id, stage, filename FROM orders JOIN (VALUES " + ", ".join(f"('{k}', '{f}', {_STAGES.index(k)})" for k, f in _OUTPUTS) + f") t(stage, filename, n) ON n = o_orderkey % {len(_STAGES)}")
def required_outputs(spark, sf_dir):
    runs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("video_id"), F.get(F.array(*map(F.lit, _STAGES)), (F.col("o_orderkey") % len(_STAGES)).cast("int")).alias("stage"))
    return P.required_files(runs)


# --- pictures of places in the tables -----------------------------------------------------------------------------------------


@query("""WITH p AS (SELECT s_suppkey // 8 AS v, s_suppkey % 8 AS f, (floor(s_acctbal)::BIGINT % 13 + 13) % 13 - 6 AS x, s_nationkey % 7 - 3 AS y, s_acctbal < 2500 AS dark FROM supplier),
n AS (SELECT v, f, x, y, row_number() OVER (PARTITION BY v ORDER BY f) AS n, dark FROM p),
g AS (SELECT v, f, n, x, y, n = 1 OR NOT dark AS good FROM n),
h AS (SELECT *, first_value(x) OVER w AS x0, first_value(y) OVER w AS y0, last_value(CASE WHEN good THEN x END IGNORE NULLS) OVER w AS x1, last_value(CASE WHEN good THEN y END IGNORE NULLS) OVER w AS y1,
  n - max(CASE WHEN good THEN n END) OVER w AS failed FROM g WINDOW w AS (PARTITION BY v ORDER BY f))
SELECT v::VARCHAR AS video_id, f::INTEGER AS frame, CASE WHEN n = 1 THEN 'REFERENCE' WHEN good THEN 'TRACKED' WHEN failed >= 2 THEN 'SCENE_CHANGE_SUSPECTED' ELSE 'HOLD_LAST_GOOD' END AS status,
  CASE WHEN n = 1 THEN 'REFERENCE' WHEN good THEN 'LK_OPTICAL_FLOW' ELSE 'NONE' END AS method, CASE WHEN n = 1 THEN 'REFERENCE' WHEN good THEN 'LK_ACCEPTED' ELSE 'TRACKING_FAILED' END AS reason,
  (x0 - x1)::INTEGER AS dx, (y0 - y1)::INTEGER AS dy, 0 AS turn, 100 AS scale FROM h""")
def motion_log(spark, sf_dir):
    """Eight suppliers as a video: the camera's place is told by account and nation, low accounts are dark; tracked from pictures alone."""
    from caloris.operators.motion import motion_log as log
    from caloris.operators.simulate import seen

    first = F.row_number().over(Window.partitionBy("video_id").orderBy("frame")) == 1
    rows = table(spark, sf_dir, "supplier").select(F.floor(F.col("s_suppkey") / 8).alias("video_id"), (F.col("s_suppkey") % 8).alias("frame"), F.pmod(F.floor("s_acctbal"), F.lit(13)).alias("x"), (F.col("s_nationkey") % 7 - 3).alias("y"), (F.col("s_acctbal") < 2500).alias("dark"))
    frames = seen(rows.withColumns({"scene": F.col("video_id"), "x": F.col("x") - 6, "dark": F.col("dark") & ~first}))
    found = log(frames, [], options=M.TrackingOptions(warn_after=2), grouped=True)
    whole = lambda c, times=1: F.round(F.col(c) * times).cast("int")
    return found.select(
        "video_id", "frame", "status", "method", F.split("reason", ":")[0].alias("reason"), whole("camera_dx_pixels").alias("dx"), whole("camera_dy_pixels").alias("dy"), whole("camera_rotation_deg").alias("turn"),
        whole("camera_scale", 100).alias("scale"),
    )


_VIEWS = """WITH p AS (SELECT s_suppkey // 20 AS v, s_suppkey % 20 AS f, s_nationkey FROM supplier),
q AS (SELECT v, f, first_value(s_nationkey) OVER (PARTITION BY v, f // 5 ORDER BY f) % 3 AS scene FROM p),
r AS (SELECT *, coalesce(scene <> lag(scene) OVER (PARTITION BY v ORDER BY f), FALSE) AS cut FROM q),
s AS (SELECT *, count(*) FILTER (cut) OVER (PARTITION BY v ORDER BY f) AS part FROM r),
t AS (SELECT *, row_number() OVER (PARTITION BY v, part ORDER BY f) - 1 AS k FROM s),
u AS (SELECT *, CASE WHEN part = 0 THEN k = 0 ELSE k = 2 END AS settles FROM t),
known AS (SELECT v, scene, min(f) AS since, row_number() OVER (PARTITION BY v ORDER BY min(f)) AS view FROM u WHERE settles GROUP BY v, scene),
j AS (SELECT u.*, since = f AS fresh, last_value(CASE WHEN settles THEN view END IGNORE NULLS) OVER (PARTITION BY v ORDER BY f) AS now, max(CASE WHEN settles AND since = f AND part > 0 THEN f END) OVER (PARTITION BY v ORDER BY f) AS told FROM u LEFT JOIN known USING (v, scene)),
l AS (SELECT *, lag(now) OVER (PARTITION BY v ORDER BY f) AS before, CASE WHEN part > 0 AND k = 0 THEN 'MOVEMENT_STARTED' WHEN NOT settles THEN NULL WHEN part = 0 THEN 'INITIAL_VIEW' WHEN fresh THEN 'NEW_STABLE_VIEW'
  WHEN now = lag(now) OVER (PARTITION BY v ORDER BY f) THEN 'SAME_VIEW_RESTABILIZED' ELSE 'RETURN_TO_KNOWN_VIEW' END AS event FROM j)"""


def _views(spark, sf_dir):
    """Twenty suppliers as a video: five in a row see the scene of the first one's nation; a log of states and one of events."""
    from caloris.operators.motion import scene_log
    from caloris.operators.simulate import seen

    rows = table(spark, sf_dir, "supplier").select(F.floor(F.col("s_suppkey") / 20).alias("video_id"), (F.col("s_suppkey") % 20).alias("frame"), "s_nationkey")
    scene = F.first("s_nationkey").over(Window.partitionBy("video_id", F.floor(F.col("frame") / 5)).orderBy("frame")) % 3
    frames = seen(rows.withColumns({"scene": scene, "x": F.lit(0), "y": F.lit(0), "dark": F.lit(False)}))
    return scene_log(frames, M.SceneOptions(moving_frames=1, stable_frames=2, banner_frames=2), grouped=True)


@query(_VIEWS + """ SELECT v::VARCHAR AS video_id, f::INTEGER AS frame, CASE WHEN part > 0 AND k < 2 THEN 'MOVING' WHEN f - told < 2 THEN 'NEW_STABLE_VIEW' ELSE 'STABLE' END AS state, printf('VIEW_%03d', now) AS view_name,
  (part > 0 AND k = 0)::INTEGER AS moving_evidence, event FROM l""")
def scene_state_log(spark, sf_dir):
    return _views(spark, sf_dir)[0].select("video_id", "frame", "state", "view_name", "moving_evidence", "event")


@query(_VIEWS + """ SELECT v::VARCHAR AS video_id, f::INTEGER AS frame, event, CASE WHEN k = 0 THEN 'STABLE' ELSE 'MOVING' END AS from_state, CASE WHEN k = 0 THEN 'MOVING' ELSE 'STABLE' END AS to_state,
  printf('VIEW_%03d', before) AS previous_view, printf('VIEW_%03d', now) AS current_view, CASE WHEN event IN ('RETURN_TO_KNOWN_VIEW', 'SAME_VIEW_RESTABILIZED') THEN printf('VIEW_%03d', now) END AS matched_known_view
  FROM l WHERE event <> 'INITIAL_VIEW'""")
def scene_event_log(spark, sf_dir):
    return _views(spark, sf_dir)[1].select("video_id", "frame", "event", "from_state", "to_state", "previous_view", "current_view", "matched_known_view")


from . import live  # noqa: E402, F401  (registers its queries)
