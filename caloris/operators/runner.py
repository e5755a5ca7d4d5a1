"""Stages that run when they have to: status, work in a folder of its own, record, and a place taken only when all is there."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import SparkSession

from caloris.sources.store import _files, promote, read_json, write_json

from .provenance import STAGE_FILES, STATUSES, manifest

MANIFEST = "stage_manifest.json"
# What is done with each status unless asked otherwise.
ACTIONS = dict(zip(STATUSES, ("SKIP", "REPROCESS", "SKIP", "RESTART", "PROCESS"), strict=True))


@dataclass(frozen=True)
class Outcome:
    """status: that before the run. action: what was done; SKIP leaves the folder as it was. reasons: why a finished stage was stale."""

    status: str
    action: str
    reasons: list[str]


def _present(spark: SparkSession, folder: str, names: tuple[str, ...]) -> bool:
    """Whether each output is there: a file with content, or a folder that a Spark writer has finished."""
    def whole(name: str) -> bool:
        fs, at = _files(spark, f"{folder}/{name}")
        if not fs.exists(at):
            return False
        status = fs.getFileStatus(at)
        return bool(len(fs.listStatus(at))) if status.isDirectory() else status.getLen() > 0

    return all(map(whole, names))


def stage_state(spark: SparkSession, folder: str, files: tuple[str, ...], source: dict, inputs: dict, settings: dict) -> tuple[str, list[str]]:
    """A stage's status and, where it is finished but stale, the reasons: what it read or how it was asked to run has changed."""
    fs, at = _files(spark, folder)
    if not fs.exists(at) or not len(fs.listStatus(at)):
        return STATUSES[4], []
    complete, held = _present(spark, folder, files), read_json(spark, f"{folder}/{MANIFEST}")
    if complete and held is None:
        return STATUSES[2], []
    if not complete or held.get("status") != "COMPLETE":
        return STATUSES[3], []
    wanted = {"source_video": source, "inputs": inputs, "settings": settings}
    reasons = sorted(f"{part}.{k}" for part, now in wanted.items() for k in now if held.get(part, {}).get(k) != now[k])
    return (STATUSES[1] if reasons else STATUSES[0]), reasons


def run_stage(spark: SparkSession, stage: str, target: str, work: Callable[[str], dict | None], source: dict, inputs: dict[str, Any] | None = None, settings: dict[str, Any] | None = None, files: tuple[str, ...] | None = None, force: bool = False) -> Outcome:
    """Run work(folder) if the stage's status asks for it (or by force), and put what it made in the place of `target`.

    work writes into a fresh folder beside the target and may return more for the record's outputs. Only when every required file is there
    and the record is written does the folder take the target's place; the old results stay until then. An error in work, or a file that
    is missing, leaves the target as it was and the fresh folder for inspection; KeyboardInterrupt (a run that was called off) removes it.
    inputs, source: fingerprints; a setting or input that only the record has is no reason to run again.
    """
    inputs, settings, files = dict(inputs or {}), dict(settings or {}), STAGE_FILES[stage] if files is None else files
    status, reasons = stage_state(spark, target, files, source, inputs, settings)
    action = ACTIONS[status]
    if action == "SKIP" and not force:
        return Outcome(status, action, reasons)
    folder = f"{target.rstrip('/')}.{uuid.uuid4().hex}.work"
    fs, at = _files(spark, folder)
    fs.mkdirs(at)
    try:
        outputs = work(folder) or {}
        if not _present(spark, folder, files):
            raise ValueError(f"{stage} lacks some of {', '.join(files)}; what it made is in {folder}")
        write_json(spark, manifest(stage, source, inputs, settings, {"files": list(files), **outputs}, datetime.now(timezone.utc).isoformat(timespec="seconds")), f"{folder}/{MANIFEST}")
        promote(spark, folder, target)
    except KeyboardInterrupt:
        fs.delete(at, True)
        raise
    return Outcome(status, "REPROCESS" if action == "SKIP" else action, reasons)
