"""What was submitted, has ended and was fetched: a small state on the driver."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.sources.batches import in_order, number_of
from tallyfold.sources.writers import atomic

COUNTS = ("processing", "succeeded", "errored", "canceled", "expired")
_DEFAULTS = {"total_requests": 0, "total_batches": 0, "batches": []}
BATCH_SCHEMA = "batch_num int, batch_id string, request_file string, status string, submitted_at string, ended_at string, results_url string, results_downloaded boolean"


def load(path: str) -> dict:
    """The state, with defaults for what is missing."""
    p = Path(path)
    return {k: (list(v) if isinstance(v, list) else v) for k, v in _DEFAULTS.items()} | (json.loads(p.read_text()) if p.exists() else {})


def save(path: str, state: dict) -> None:
    atomic(path, json.dumps(state, indent=2))


def table(spark: SparkSession, state: dict) -> DataFrame:
    names = [x.split()[0] for x in BATCH_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(b.get(n) for n in names) for b in state["batches"]], BATCH_SCHEMA)


def pending(batches: DataFrame) -> DataFrame:
    return batches.where(~F.col("status").eqNullSafe("ended"))


def downloadable(batches: DataFrame) -> DataFrame:
    return batches.where(F.col("status").eqNullSafe("ended") & ~F.coalesce("results_downloaded", F.lit(False)))


def to_submit(files: DataFrame, batches: DataFrame) -> DataFrame:
    """Request files (``request_file``) that no batch has."""
    return files.join(batches.select("request_file"), "request_file", "left_anti")


def complete(state: dict) -> bool:
    """Whether the fact table may be built: all batches have ended and are fetched."""
    return bool(state["batches"]) and all(b.get("status") == "ended" and b.get("results_downloaded") for b in state["batches"])


def entry(state: dict, name: str) -> dict:
    """A file that is sent now, as the state holds it."""
    number = number_of(name)
    if number is None:
        number = max((b["batch_num"] or 0 for b in state["batches"]), default=0) + 1
    now = datetime.now(UTC).isoformat()
    return {"batch_num": number, "batch_id": None, "request_file": name, "status": "in_progress", "submitted_at": now, "ended_at": None, "results_url": None, "request_counts": dict.fromkeys(COUNTS, 0), "results_downloaded": False}


def submit(path: str, files: list[str], send: Callable[[str], str], limit: int | None = None) -> list[str]:
    """Sends files that weren't sent yet, in the order of their batch numbers; the state is saved after each, so a failure loses none.

    ``batch_num`` is the number in the file's name; a name without one gets the next after the highest.
    """
    state = load(path)
    sent = {b["request_file"] for b in state["batches"]}
    done = []
    for name in [f for f in in_order(files) if f not in sent][:limit]:
        try:
            batch_id = send(name)
        finally:
            save(path, state)
        state["batches"].append(entry(state, name) | {"batch_id": batch_id})
        state["total_batches"] = len(state["batches"])
        save(path, state)
        done.append(name)
    return done


def collect(path: str, poll: Callable[[str], dict], fetch: Callable[[dict], None], sleep: Callable[[float], None], interval: float = 60, most: float = 3600) -> bool:
    """Asks after batches and fetches those that ended, until all are there (True) or ``most`` seconds are over."""
    waited = 0.0
    while True:
        state = load(path)
        for b in state["batches"]:
            if b["status"] != "ended" and b["batch_id"]:
                b.update(poll(b["batch_id"]))
            if b["status"] == "ended" and not b["results_downloaded"]:
                fetch(b)
                b["results_downloaded"] = True
            save(path, state)
        if complete(state):
            return True
        if waited >= most:
            return False
        sleep(interval)
        waited += interval
