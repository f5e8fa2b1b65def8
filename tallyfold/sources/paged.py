"""A paged HTTP source as a Python data source: read by time slices in parallel, or as a stream that goes on where it broke off."""

from __future__ import annotations

import json
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tallyfold.schemas import COMMENT, POST
from tallyfold.sources.budget import Gate, OwnGate, SharedGate

PAGE = 100
#: Seconds of the source's time that a batch of the stream covers.
SPAN = 86_400


def http(url: str) -> tuple[list[dict], dict[str, str]]:
    with urllib.request.urlopen(url, timeout=60) as r:
        return json.load(r).get("data") or [], dict(r.headers)


def pages(get: Callable[[str], tuple[list[dict], dict[str, str]]], base: str, params: dict, after: int, before: int, gate: Gate) -> Iterator[dict]:
    """Items of [after, before) in order of time, each once.

    The cursor overlaps the last second of a page, so items of one second that
    two pages share aren't lost; what the overlap brings again is left out.
    """
    cursor, recent = after - 1, {}
    while cursor < before:
        query = urllib.parse.urlencode(params | {"after": cursor, "before": before, "sort": "asc", "limit": PAGE})
        gate.enter()
        items, headers = get(f"{base}?{query}")
        gate.seen(headers)
        fresh = [x for x in items if x.get("id") not in recent]
        if not fresh:
            # a full page of one second that is known already: go on behind it
            if len(items) < PAGE:
                return
            cursor = int(items[-1]["created_utc"])
            continue
        yield from fresh
        last = int(fresh[-1]["created_utc"])
        recent = {k: t for k, t in recent.items() if t >= last - 1} | {x.get("id"): int(x["created_utc"]) for x in fresh if int(x["created_utc"]) >= last - 1}
        cursor = last - 1


@dataclass
class Slice(InputPartition):
    after: int
    before: int


def slices(after: int, before: int, n: int) -> list[Slice]:
    edges = [after + (before - after) * k // n for k in range(n + 1)]
    return [Slice(a, b) for a, b in zip(edges, edges[1:], strict=False) if a < b]


class PagedSource(DataSource):
    """``spark.read.format("paged")``, or ``spark.readStream``, with base, kind (comments or posts), subreddit, after, before (epoch seconds) and slices.

    ``budget`` is the address of a ``budget.Budget``, which all slices of all
    reads share.  Without it each slice takes its part of one budget, by the
    number of slices.

    As a stream, a batch covers ``span`` seconds of the source's time, and the
    offset is the second up to which all is read; so a query that is started
    again from its checkpoint asks for the batch that broke off, not for those
    before it, and a sink that takes each batch once has each item once.
    """

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> T.StructType:
        return POST if self.options.get("kind") == "posts" else COMMENT

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PagedReader(dict(self.options), schema)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return PagedStream(dict(self.options), schema)


class _Reads:
    """What the batch reader and the stream reader share."""

    def __init__(self, options: dict[str, str], schema: T.StructType, get: Callable = http):
        self.options, self.schema, self.get = options, schema, get
        self.after, self.before, self.n = int(options["after"]), int(options["before"]), int(options.get("slices", 1))

    def gate(self) -> Gate:
        return SharedGate(self.options["budget"]) if "budget" in self.options else OwnGate(self.n)

    def read(self, partition: Slice) -> Iterator[tuple]:
        params = {k: self.options[k] for k in ("subreddit",) if k in self.options}
        for item in pages(self.get, self.options["base"], params, partition.after, partition.before, self.gate()):
            if partition.after <= int(item["created_utc"]) < partition.before:
                yield tuple(item.get(f.name) for f in self.schema.fields)


class PagedReader(_Reads, DataSourceReader):
    def partitions(self) -> list[Slice]:
        return slices(self.after, self.before, self.n)


class PagedStream(_Reads, DataSourceStreamReader):
    def __init__(self, options: dict[str, str], schema: T.StructType, get: Callable = http):
        super().__init__(options, schema, get)
        self.span, self.reached = int(options.get("span", SPAN)), None

    def initialOffset(self) -> dict:
        return {"after": self.after}

    def latestOffset(self) -> dict:
        start = self.after if self.reached is None else self.reached
        self.reached = min(start + self.span, max(self.before, start))
        return {"after": self.reached}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        # a query that goes on from its checkpoint plans its last batch first
        if self.reached is None:
            self.reached = end["after"]
        return slices(start["after"], end["after"], self.n)

    def commit(self, end: dict) -> None:
        self.reached = end["after"] if self.reached is None else self.reached


def stream(spark: SparkSession, options: dict[str, object]) -> DataFrame:
    spark.dataSource.register(PagedSource)
    return spark.readStream.format("paged").options(**options).load()


def download(spark: SparkSession, options: dict[str, object], sources: list[str], out: str, checkpoints: str) -> None:
    """All items of each source to Parquet in ``out/source=...``, each once.

    ``options`` are those of ``PagedSource`` but for the name of the source.  A
    call after one that broke off goes on with the batch that it left; a source
    that is complete asks for nothing.
    """
    for source in sources:
        found = stream(spark, options | {"subreddit": source})
        writer = found.writeStream.format("parquet").option("path", f"{out}/source={source}").option("checkpointLocation", f"{checkpoints}/{source}")
        query = writer.trigger(processingTime="0 seconds").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
