"""Provenance: content hashes, stage status, stale settings and reuse of made variants."""

from __future__ import annotations

import hashlib
import json
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# What a stage's outputs can be, in the order of the checks.
STATUSES = ("CURRENT", "STALE", "LEGACY / UNTRACKED", "PARTIAL", "NEW")
ACTIONS = {"CURRENT": "SKIP", "STALE": "PROCESS", "LEGACY / UNTRACKED": "SKIP", "PARTIAL": "RESTART", "NEW": "PROCESS"}


def canonical_hash(value: Any) -> str:
    """SHA-256 of the value as JSON with sorted keys and no blanks; numbers that are none are refused."""
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return hashlib.sha256(text.encode()).hexdigest()


def signature(value: Any) -> str:
    return canonical_hash(value)[:16]


def fingerprints(files: DataFrame) -> DataFrame:
    """path, size and content hash of the rows of a binaryFile source."""
    return files.select("path", F.regexp_extract("path", "[^/]*$", 0).alias("filename"), F.col("length").alias("size_bytes"), F.unix_micros(F.col("modificationTime").cast("timestamp")).alias("mtime_us"), F.sha2("content", 256).alias("sha256"))


def same_content(a: Column, b: Column) -> Column:
    """Whether two fingerprints agree: by hash where both have one, else by size and time."""
    return F.when(a["sha256"].isNotNull() & b["sha256"].isNotNull(), a["sha256"] == b["sha256"]).otherwise(F.coalesce((a["size_bytes"] == b["size_bytes"]) & (a["mtime_us"] == b["mtime_us"]), F.lit(False)))


def stale_settings(requested: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each requested setting (keys, setting, value) that the stored ones lack or hold otherwise. Settings that were
    only stored don't count."""
    old = stored.select(*keys, "setting", F.col("value").alias("old_value"))
    both = requested.join(old, [*keys, "setting"], "left")
    return both.filter(~F.col("value").eqNullSafe(F.col("old_value"))).select(*keys, "setting", "value", "old_value")


def stage_status(outputs_complete: Column, has_manifest: Column, manifest_complete: Column, stale: Column, any_content: Column) -> Column:
    done = outputs_complete & manifest_complete
    return F.when(done & ~stale, STATUSES[0]).when(done, STATUSES[1]).when(outputs_complete & ~has_manifest, STATUSES[2]).when(any_content, STATUSES[3]).otherwise(STATUSES[4])


def missing_files(required: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Required files (keys, name) that are absent or empty."""
    return required.join(present.filter("size_bytes > 0").select(*keys, "name"), [*keys, "name"], "left_anti")


def reuse_or_new(requests: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """Each requested variant (key, signature) with the id it has in the ledger, or the next free ids of its key, in signature order."""
    known = ledger.select(key, "signature", F.col("id").alias("known_id"))
    last = ledger.groupBy(key).agg(F.max("id").alias("last_id"))
    both = requests.join(known, [key, "signature"], "left").join(last, key, "left")
    fresh = F.col("known_id").isNull()
    nth = F.sum(fresh.cast("int")).over(Window.partitionBy(key).orderBy("signature"))
    return both.select(key, "signature", F.coalesce("known_id", F.coalesce("last_id", F.lit(0)) + nth).cast("long").alias("id"), (~fresh).alias("reused"))


def resolved_settings(defaults: dict[str, str], overrides: DataFrame, key: str) -> DataFrame:
    """For each key the defaults with its own values (a map in column settings) over them."""
    base = F.create_map(*(F.lit(x) for kv in sorted(defaults.items()) for x in kv))
    own = F.coalesce("settings", F.expr("cast(map() as map<string,string>)"))
    kept = F.map_filter(base, lambda k, v: ~F.map_contains_key(own, k))
    return overrides.select(key, F.map_concat(kept, own).alias("settings"))


def canonical_hashes(document: Column) -> Column:
    """canonical_hash of JSON texts, an Arrow batch at a time; null where a text is no JSON or holds numbers that are none."""
    def one(text: str | None) -> str | None:
        try:
            return canonical_hash(json.loads(text)) if text is not None else None
        except ValueError:
            return None

    @F.pandas_udf("string")
    def hashes(texts: pd.Series) -> pd.Series:
        return texts.map(one)

    return hashes(document)


def upstream_warnings(used: DataFrame, current: DataFrame) -> DataFrame:
    """Inputs that a stage used, used(stage, input, sha256), whose content has changed since or is gone; current(input, sha256)."""
    now = current.select("input", F.col("sha256").alias("current_sha256"))
    both = used.join(now, "input", "left").filter(~F.col("sha256").eqNullSafe(F.col("current_sha256")))
    return both.select("stage", "input", F.when(F.col("current_sha256").isNull(), "MISSING").otherwise("CHANGED").alias("warning"))


# The outputs that each stage must have.
STAGE_FILES = {
    "scale_readings": ("scale_readings.csv",),
    "temperature": ("temperature_log.csv", "temperature_summary.csv"),
    "motion": ("motion_log.csv", "tracked_regions.json", "motion_summary.json"),
    "scene": ("scene_state_log.csv", "scene_events.csv", "view_library.json", "scene_summary.json"),
    "dataset": ("annotations.json", "classes.json", "dataset_summary.json", "dataset_manifest.csv"),
}


def required_files(runs: DataFrame) -> DataFrame:
    """(video_id, stage, filename): what each of runs(video_id, stage) must have made."""
    files = F.create_map(*(x for k, v in STAGE_FILES.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    return runs.select("video_id", "stage", F.explode(F.try_element_at(files, F.col("stage"))).alias("filename"))


def stale_reasons(manifests: DataFrame, current: DataFrame, settings: DataFrame) -> DataFrame:
    """(stage, reason, name): why a finished stage has to run again.

    manifests: stage, inputs (map of name to sha256), settings (map). current: stage, name, sha256 of the inputs as they are now.
    settings: stage, setting, value as they are asked for. An input that is gone, one that has changed, a setting that differs.
    """
    used = manifests.select("stage", F.explode("inputs").alias("name", "sha256"))
    now = current.select("stage", "name", F.col("sha256").alias("now"))
    inputs = used.join(now, ["stage", "name"], "left").filter(~F.col("now").eqNullSafe(F.col("sha256")))
    inputs = inputs.select("stage", F.when(F.col("now").isNull(), "INPUT_MISSING").otherwise("INPUT_CHANGED").alias("reason"), "name")
    held = manifests.select("stage", F.explode("settings").alias("setting", "value"))
    return inputs.unionByName(stale_settings(settings, held, ["stage"]).select("stage", F.lit("SETTING_CHANGED").alias("reason"), F.col("setting").alias("name")))


# The inputs whose change makes a stage stale, and the stages that an edit of their own output makes stale. The set-up of the
# scale does not rest on the regions; motion does not need the video that was annotated; datasets keep no record.
STAGE_INPUTS = {"annotation": ("video",), "scale": ("video",), "temperature": ("video", "regions", "scale"), "motion": ("regions", "motion_video"), "scene": ("video",)}
EDITED_OUTPUTS = ("annotation", "scale")


def stage_reasons(manifests: DataFrame, current: DataFrame, settings: DataFrame, outputs: DataFrame) -> DataFrame:
    """stale_reasons by the rules of each stage's kind. manifests has kind and outputs (map of name to sha256) besides; outputs: stage, name,
    sha256 as they are now. An input that a kind does not rest on gives no reason, an output that was edited gives OUTPUT_EDITED where
    that counts; an output that is gone is no reason, as the stage is then incomplete. Kinds without rules give none."""
    rules = F.create_map(*(x for k, v in STAGE_INPUTS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    ruled = manifests.filter(F.col("kind").isin(*STAGE_INPUTS))
    counted = ruled.withColumn("inputs", F.map_filter("inputs", lambda k, v: F.array_contains(F.try_element_at(rules, F.col("kind")), k)))
    asked = settings.join(ruled.select("stage"), "stage", "left_semi")
    made = ruled.filter(F.col("kind").isin(*EDITED_OUTPUTS)).select("stage", F.explode("outputs").alias("name", "held"))
    edited = made.join(outputs, ["stage", "name"]).filter(F.col("held") != F.col("sha256"))
    return stale_reasons(counted, current, asked).unionByName(edited.select("stage", F.lit("OUTPUT_EDITED").alias("reason"), "name"))


def stale_causes(edges: DataFrame, own: DataFrame) -> DataFrame:
    """(stage, cause, hops): the stages with reasons of their own that each stage rests on, itself included, by the shortest way.

    edges: stage, upstream. own: stage. One join for each step of the longest chain, however wide the graph; a pair that is known is
    not followed again, so diamonds don't multiply and circles end.
    """
    from caloris.sources.store import stored

    links = edges.select(F.col("stage").alias("next"), F.col("upstream").alias("stage")).distinct()
    newest = stored(own.select("stage", F.col("stage").alias("cause"), F.lit(0).alias("hops")).distinct())
    found = newest
    while newest.head(1):
        reached = newest.join(links, "stage").select(F.col("next").alias("stage"), "cause", F.col("hops") + 1).toDF("stage", "cause", "hops").distinct()
        newest = stored(reached.join(found.select("stage", "cause"), ["stage", "cause"], "left_anti"))
        found = found.union(newest)
    return found


def view_pictures(views: DataFrame) -> DataFrame:
    """(video_id, stage, filename): the pictures that a scene run must have, one for each view of views(video_id, name)."""
    return views.select("video_id", F.lit("scene").alias("stage"), F.concat("name", F.lit("_reference.png")).alias("filename"))


def text_fingerprint(*parts: Column) -> tuple[Column, Column]:
    """SHA-256 of texts joined by bars, and its first 16 digits, which sign a variant."""
    whole = F.sha2(F.concat_ws("|", *parts), 256)
    return whole, F.substring(whole, 1, 16)


def load_manifests(spark: SparkSession, path: str) -> DataFrame:
    """The manifests below a path, a row each; files that are no JSON or of another version are left out."""
    fields = "manifest_version int, stage string, status string, created_at_utc string, source_video map<string,string>, inputs map<string,string>, settings map<string,string>, outputs map<string,string>"
    return spark.read.schema(fields).option("multiLine", True).json(path).filter("manifest_version = 1")


def load_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The variants of the ledgers below a path: generator, id, signature, created_at_utc, output_filename, parameters."""
    fields = "manifest_version int, generator string, variants array<struct<id:int,signature:string,created_at_utc:string,output_filename:string,parameters:map<string,string>>>"
    return spark.read.schema(fields).option("multiLine", True).json(path).select("generator", F.inline("variants"))


def manifest(stage: str, source: dict, inputs: dict, settings: dict, outputs: dict, created_at: str) -> dict:
    """The record of a finished stage: what it read, how it ran and what it made."""
    return {"manifest_version": 1, "stage": stage, "status": "COMPLETE", "created_at_utc": created_at, "source_video": source, "inputs": inputs, "settings": settings, "outputs": outputs}
