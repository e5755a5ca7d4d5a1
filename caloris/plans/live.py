"""The stream operators over events that arrive late and out of order, in several micro-batches, beside the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caloris.operators import fold, machines
from caloris.operators.machines import Machine, ReadingMachine, StatusMachine, StepMachine

from .queries import _GATE, query, r6
from .tables import table

#: Micro-batches of arrivals; each event arrives up to a day after its time, by its id.
BATCHES, DAY, SPREAD = 4, 86_400_000, 62_710_561

_ARRIVED = f"""e AS (SELECT event_id, user_id AS region, epoch_us(ts) // 1000 AS ms, event_type AS kind, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS gray, epoch_us(ts) // 1000 + event_id * {SPREAD} % {DAY} AS arrival FROM events),
d AS (SELECT *, (arrival - min(arrival) OVER ()) * {BATCHES} // (max(arrival) OVER () - min(arrival) OVER () + 1) AS batch FROM e),
m AS (SELECT batch, max(max(ms)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM d GROUP BY batch),
g AS (SELECT d.*, coalesce(ms <= seen - $delay, false) AS late FROM d JOIN m USING (batch)),
p AS (SELECT *, CAST(row_number() OVER (PARTITION BY region ORDER BY ms, event_id) - 1 AS INTEGER) AS frame, CASE WHEN kind <> 'error' THEN value END AS low, value + gray AS high FROM g WHERE NOT late)"""


def _sql(body: str, delay: int = DAY) -> str:
    return f"WITH RECURSIVE {_ARRIVED}, {body}".replace("$delay", str(delay))


def _stream(spark: SparkSession, sf_dir: str, machine: Machine, inputs: list[str], delay: int = DAY, seeds: DataFrame | None = None) -> DataFrame:
    """The machine's rows over events as they arrive; a last row of no camera moves the watermark past all others."""
    from caloris.sources.store import drained
    from caloris.streaming.event_time import stream_machine, streaming_session
    from caloris.streaming.replay import arrivals, replayed

    e = table(spark, sf_dir, "events")
    value, kind = F.col("value"), F.col("event_type")
    rows = e.select(
        F.col("user_id").alias("region"), "event_id", F.col("ts").cast("timestamp").alias("ts"), F.when(kind != "error", value).alias("low"), (value + F.get_json_object("props", "$.k").try_cast("int")).alias("high"),
        ((F.col("event_id") % 7 + 1) * 10_800_000).alias("latency"), (kind == "signup").alias("raised"), (~kind.isin("error", "signup")).alias("ok"),
    )
    rows = rows.withColumn("arrival", F.unix_millis("ts") + F.col("event_id") * SPREAD % DAY)
    low, high = rows.agg(F.min("arrival"), F.max("arrival")).first()
    if low is None:
        low = high = 0
    batch = F.floor((F.col("arrival") - low) * BATCHES / (high - low + 1)).cast("int")
    last = {"region": -1, "event_id": -1, "ts": "2100-01-01 00:00:00", "ok": False}
    end = spark.range(1).select(*(F.lit(last.get(f.name)).cast(f.dataType).alias(f.name) for f in rows.schema))
    rows = rows.withColumn("batch", batch).union(end.withColumn("batch", F.lit(BATCHES)))
    stream = replayed(streaming_session(spark), arrivals(rows, F.col("batch"), BATCHES + 1), rows)
    found = drained(stream_machine(stream, "region", "ts", "event_id", inputs, machine, f"{delay} milliseconds", seeds, slot=delay // 4))
    return spark.read.schema(found.schema).parquet(*found.inputFiles()).filter("region >= 0")


_CONFIRMED = """f AS (
  SELECT region, frame, event_id, CASE WHEN ok THEN low END AS a, CASE WHEN ok THEN high END AS b, CAST(NULL AS DOUBLE) AS pa, CAST(NULL AS DOUBLE) AS pb, CASE WHEN ok THEN 'ACCEPT_PRIMARY' ELSE 'HOLD_PREVIOUS' END AS status FROM v WHERE frame = 0
  UNION ALL
  SELECT region, frame, event_id, CASE WHEN c IN (1, 2) THEN low ELSE a END, CASE WHEN c IN (1, 2) THEN high ELSE b END, CASE WHEN c = 3 THEN low END, CASE WHEN c = 3 THEN high END,
    CASE c WHEN 0 THEN 'HOLD_PREVIOUS' WHEN 1 THEN 'ACCEPT_PRIMARY' WHEN 2 THEN 'ACCEPT_CONFIRMED' ELSE 'PENDING_JUMP' END
  FROM (SELECT v.region, v.frame, v.event_id, v.low, v.high, f.a, f.b, CASE WHEN NOT v.ok THEN 0 WHEN f.a IS NULL OR (abs(v.low - f.a) <= 150 AND abs(v.high - f.b) <= 150) THEN 1
    WHEN f.pa IS NOT NULL AND abs(v.low - f.pa) <= 60 AND abs(v.high - f.pb) <= 60 THEN 2 ELSE 3 END AS c FROM f JOIN v ON v.region = f.region AND v.frame = f.frame + 1))"""
_VALID = "low IS NOT NULL AND low BETWEEN 0 AND 1000 AND high BETWEEN 0 AND 1000 AND high - low >= 5"
_JUMPS = StepMachine(fold.confirm_step(_GATE), fold.SCALE_FIELDS)


@query(_sql(f"v AS (SELECT *, {_VALID} AS ok FROM p), {_CONFIRMED} SELECT region, event_id, round(a + 1e-9, 6) AS scale_min, round(b + 1e-9, 6) AS scale_max, status FROM f"))
def stream_scale(spark, sf_dir):
    """Confirmed jumps in event-time order, whatever the order of arrival: a watermark a day behind loses no event."""
    found = _stream(spark, sf_dir, _JUMPS, ["low", "high"])
    return found.filter("NOT late").select("region", "event_id", r6("scale_min", "scale_min"), r6("scale_max", "scale_max"), "status")


@query(_sql(f"v AS (SELECT *, {_VALID} AS ok FROM p), {_CONFIRMED} SELECT region, event_id, round(a + 1e-9, 6) AS scale_min, round(b + 1e-9, 6) AS scale_max, status, FALSE AS late FROM f UNION ALL SELECT region, event_id, NULL, NULL, NULL, TRUE FROM g WHERE late", DAY // 8))
def stream_late(spark, sf_dir):
    """The same with a watermark three hours behind: events that come later are told apart and change nothing."""
    found = _stream(spark, sf_dir, _JUMPS, ["low", "high"], DAY // 8)
    return found.select("region", "event_id", r6("scale_min", "scale_min"), r6("scale_max", "scale_max"), "status", "late")


_HALF_DAY = DAY // 2
_READINGS = f"""v AS (SELECT *, (event_id % 7 + 1) * 10800000 AS latency, kind = 'signup' AS raised FROM p),
r AS (
  SELECT v.region, frame, event_id, ms, s.low AS a, s.high AS b, CAST(NULL AS DOUBLE) AS pa, CAST(NULL AS DOUBLE) AS pb, CASE WHEN s.low IS NULL THEN 'WAITING' ELSE 'REFERENCE_SCALE' END AS status,
    ms + latency AS done, v.low AS fl, v.high AS fh, raised AS fr, ms AS last, TRUE AS submitted FROM v LEFT JOIN s ON s.region = v.region WHERE frame = 0
  UNION ALL
  SELECT region, frame, event_id, ms, CASE WHEN c IN (1, 2) THEN fl ELSE a END, CASE WHEN c IN (1, 2) THEN fh ELSE b END, CASE WHEN c = 3 THEN fl WHEN c >= 8 THEN pa END, CASE WHEN c = 3 THEN fh WHEN c >= 8 THEN pb END,
    CASE c WHEN 9 THEN status WHEN 8 THEN 'ERROR_HOLD_PREVIOUS' WHEN 0 THEN 'HOLD_PREVIOUS' WHEN 1 THEN 'ACCEPT_PRIMARY' WHEN 2 THEN 'ACCEPT_CONFIRMED' ELSE 'PENDING_JUMP' END,
    CASE WHEN sub THEN ms + latency WHEN c < 9 THEN NULL ELSE done END, CASE WHEN sub THEN low ELSE fl END, CASE WHEN sub THEN high ELSE fh END, CASE WHEN sub THEN raised ELSE fr END, CASE WHEN sub THEN ms ELSE last END, sub
  FROM (SELECT *, (done IS NULL OR c < 9) AND ms - last >= {_HALF_DAY} AS sub FROM (
    SELECT v.region, v.frame, v.event_id, v.ms, v.low, v.high, v.latency, v.raised, r.a, r.b, r.pa, r.pb, r.status, r.done, r.fl, r.fh, r.fr, r.last,
      CASE WHEN r.done IS NULL OR r.done > v.ms THEN 9 WHEN r.fr THEN 8 WHEN r.fl IS NULL OR NOT (r.fl BETWEEN 0 AND 1000 AND r.fh BETWEEN 0 AND 1000 AND r.fh - r.fl >= 5) THEN 0
        WHEN r.a IS NULL OR (abs(r.fl - r.a) <= 150 AND abs(r.fh - r.b) <= 150) THEN 1 WHEN r.pa IS NOT NULL AND abs(r.fl - r.pa) <= 60 AND abs(r.fh - r.pb) <= 60 THEN 2 ELSE 3 END AS c
    FROM r JOIN v ON v.region = r.region AND v.frame = r.frame + 1)))
SELECT region, event_id, round(a + 1e-9, 6) AS scale_min, round(b + 1e-9, 6) AS scale_max, status, submitted FROM r"""
_READ = ReadingMachine(_GATE, 1000.0 / _HALF_DAY)


def _read(found: DataFrame) -> DataFrame:
    return found.filter("event_id IS NOT NULL").select("region", "event_id", r6("scale_min", "scale_min"), r6("scale_max", "scale_max"), "status", "submitted")


@query(_sql(f"s AS (SELECT -1 AS region, 0.0::DOUBLE AS low, 0.0::DOUBLE AS high), {_READINGS}"))
def stream_readings(spark, sf_dir):
    """A reader that takes 3 to 21 hours, begins once in half a day ms most, and whose results hold from their arrival on."""
    return _read(_stream(spark, sf_dir, _READ, ["low", "high", "latency", "raised"]))


@query(_sql(f"s AS (SELECT DISTINCT region, 100.0::DOUBLE + region % 7 * 10 AS low, 160.0::DOUBLE + region % 7 * 10 AS high FROM e WHERE region % 3 = 0), {_READINGS}"))
def stream_seeded(spark, sf_dir):
    """The same from the scales that a preset holds: those of this reader's own kind and finite; others wait for a first reading."""
    from caloris.streaming.event_time import sound_seeds

    r = F.col("region")
    low = F.lit(100.0) + r % 7 * 10
    presets = table(spark, sf_dir, "events").select(F.col("user_id").alias("region")).distinct()
    engine = F.when(r % 3 == 2, "TESSERACT").otherwise("RapidOCR_OpenVINO")
    presets = presets.select("region", F.when(r % 3 != 1, low).otherwise(F.lit(float("nan"))).alias("low"), (low + 60).alias("high"), engine.alias("engine"))
    return _read(_stream(spark, sf_dir, _READ, ["low", "high", "latency", "raised"], seeds=sound_seeds(presets, "rapidocr_openvino")))


_DELAY, _SILENCE = DAY // 4, 2 * DAY


def _event(ms: str, status: str, reason: str, n: str) -> str:
    return f"{{'ms': {ms}, 'status': {status}, 'reason': {reason}, 'n': {n}}}"


_OPENING = _event("ms", "CASE WHEN ok THEN 'CONNECTED' ELSE 'RECONNECTING' END", "CASE WHEN ok THEN 'READ' ELSE 'OPEN_FAILED' END", "n")


@query(_sql(f"""w AS (SELECT region, frame, ms, kind NOT IN ('error', 'signup') AS ok, FALSE AS fin FROM p UNION ALL SELECT region, max(frame) + 1, {10**15}, FALSE, TRUE FROM p GROUP BY region),
c AS (
  SELECT region, frame, CASE WHEN ok THEN 'CONNECTED' ELSE 'RECONNECTING' END AS st, 0 AS failed, n, ms AS since, [{_event("ms", "'CONNECTING'", "'OPENED'", "n")}, {_OPENING}] AS ev FROM (SELECT *, 0 AS n FROM w WHERE frame = 0)
  UNION ALL
  SELECT region, frame, CASE WHEN now = 'RECONNECTING' THEN now WHEN now = 'CONNECTED' THEN CASE WHEN drop THEN 'RECONNECTING' ELSE now END WHEN ok THEN 'CONNECTED' ELSE 'RECONNECTING' END,
    CASE WHEN now = 'CONNECTED' AND NOT ok AND NOT drop THEN failed + 1 ELSE 0 END, CASE WHEN drop THEN n + 1 ELSE n END, CASE WHEN now = 'RECONNECTING' THEN since ELSE ms END,
    list_concat(
      CASE WHEN over THEN [{_event(f"since + {_DELAY}", "'CONNECTING'", "'DELAY_PASSED'", "n")}] ELSE [] END,
      CASE WHEN halt THEN [{_event("stop", "'STOPPED'", "'SILENT'", "n")}] ELSE [] END,
      CASE WHEN fin OR now = 'RECONNECTING' THEN [] WHEN now = 'STOPPED' THEN [{_event("ms", "'CONNECTING'", "'OPENED'", "n")}, {_OPENING}] WHEN now = 'CONNECTING' THEN [{_OPENING}] WHEN drop THEN [{_event("ms", "'RECONNECTING'", "'READ_FAILED'", "n + 1")}] ELSE [] END)
  FROM (SELECT *, now = 'CONNECTED' AND NOT ok AND failed >= 2 AND NOT fin AS drop FROM (SELECT *, CASE WHEN halt THEN 'STOPPED' WHEN over THEN 'CONNECTING' ELSE st END AS now FROM (SELECT *, coalesce(stop <= ms, false) AS halt FROM (
    SELECT w.region, w.frame, w.ms, w.ok, w.fin, c.st, c.failed, c.n, c.since, c.st = 'RECONNECTING' AND c.since + {_DELAY} <= w.ms AS over,
      CASE WHEN c.st = 'CONNECTED' THEN c.since + {_SILENCE} WHEN c.since + {_DELAY} <= w.ms THEN c.since + {_DELAY} + {_SILENCE} END AS stop
    FROM c JOIN w ON w.region = c.region AND w.frame = c.frame + 1)))))
SELECT region, u.ms::BIGINT AS ms, u.status AS status, u.reason AS reason, u.n AS reconnects FROM (SELECT region, unnest(ev) AS u FROM c)"""))
def camera_status(spark, sf_dir):
    """Cameras by their reads: three failed ones in a row drop a connection, six hours later it is tried anew, two silent days stop it."""
    found = _stream(spark, sf_dir, StatusMachine(3, _DELAY, _SILENCE), ["ok"])
    return found.select("region", F.col("at").alias("ms"), "status", "reason", "reconnects")
