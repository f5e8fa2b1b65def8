"""Request files to a batch service as they arrive, each once whatever fails in between."""

from __future__ import annotations

import posixpath
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold import state
from tallyfold.sources.batches import in_order


class Service(Protocol):
    """``send`` gives a batch's id and remembers the key; ``find`` gives the id of the batch that came with a key, if there is one."""

    def send(self, name: str, key: str) -> str: ...

    def find(self, key: str) -> str | None: ...

    def poll(self, batch_id: str) -> dict: ...

    def fetch(self, batch: dict) -> None: ...


def arriving(spark: SparkSession, folder: str, files_at_once: int = 100) -> DataFrame:
    """(file, requests) of the request files that come into a folder; a row for each request, as their lines are counted by the batch."""
    lines = spark.readStream.option("pathGlobFilter", "batch_*.jsonl").option("maxFilesPerTrigger", files_at_once).text(folder)
    return lines.where(F.trim("value") != "").select(F.col("_metadata.file_path").alias("file"))


def sending(service: Service, state_path: str) -> Callable[[DataFrame, int], None]:
    """What a batch of the stream does: its files go to the service in the order of their numbers.

    A file's key is the number of the stream's batch and its name; a batch that
    is run again has both.  The state says that a file is being sent before it
    is, and the service's id after.  So a file that a run before this one may
    have sent is looked up by its key, and sent only if it isn't there.
    """

    def run(rows: DataFrame, stream_batch: int) -> None:
        # one row for each file of the batch, of which there are as many as a trigger takes
        found = {r["file"]: r["count"] for r in rows.groupBy("file").count().collect()}
        for name in in_order(list(found)):
            _send(service, state_path, name, f"{stream_batch}:{posixpath.basename(name)}", found[name])

    return run


def _send(service: Service, state_path: str, name: str, key: str, requests: int) -> None:
    known = state.load(state_path)
    entry = next((b for b in known["batches"] if b["request_file"] == name), None)
    if entry and entry["batch_id"]:
        return
    batch_id = None
    if entry is None:
        entry = state.entry(known, name) | {"key": key, "requests": requests, "status": "sending"}
        known["batches"].append(entry)
        known["total_requests"] += requests
        known["total_batches"] = len(known["batches"])
        state.save(state_path, known)
    else:
        batch_id = service.find(entry["key"])
    entry.update(batch_id=batch_id or service.send(name, entry["key"]), status="in_progress")
    state.save(state_path, known)


def run_once(spark: SparkSession, folder: str, service: Service, state_path: str, checkpoint: str, files_at_once: int = 100) -> None:
    """Sends the files that have come since the last run."""
    found = arriving(spark, folder, files_at_once)
    query = found.writeStream.foreachBatch(sending(service, state_path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def collect(service: Service, state_path: str, sleep: Callable[[float], None], **wait: float) -> bool:
    """Fetches the results of what was sent; whether all are there (see ``state.collect``)."""
    return state.collect(state_path, service.poll, service.fetch, sleep, **wait)
