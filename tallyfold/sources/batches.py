"""Request files ``batch_001.jsonl``, ``batch_002.jsonl``, ...: one for each batch, whole or not there."""

from __future__ import annotations

import posixpath
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tallyfold.operators.labels import BATCH_ROWS, numbered
from tallyfold.sources.paths import at

_NAME = re.compile(r"batch_(\d+)")


def file_name(number: int) -> str:
    return f"batch_{number:03d}.jsonl"


def number_of(name: str) -> int | None:
    """1 of batch_001.jsonl, in any folder; None where there is no number."""
    found = _NAME.search(posixpath.basename(name))
    return int(found[1]) if found else None


def in_order(names: list[str]) -> list[str]:
    """By batch number; names without one come last, by name."""
    numbered_ = {n: number_of(n) for n in names}
    return sorted(names, key=lambda n: (numbered_[n] is None, numbered_[n] or 0, n))


def files(path: str) -> list[str]:
    """The request files of a folder, in the order of their numbers."""
    system, root = at(path)
    found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return in_order([f.path for f in found if f.is_file and number_of(f.path) is not None and f.path.endswith(".jsonl")])


@dataclass
class Staged(WriterCommitMessage):
    """The batches that a task has written: number, file, rows."""

    batches: list[tuple[int, str, int]]


class BatchFiles(DataSource):
    """``df.write.format("batch_files")`` of (batch_num, value), where a batch's rows are together and in order.

    ``path`` is a folder that all executors share.  Batch files that are there
    are replaced.
    """

    @classmethod
    def name(cls) -> str:
        return "batch_files"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return BatchFileWriter(self.options["path"])


class BatchFileWriter(DataSourceArrowWriter):
    """Each attempt of a task writes files of its own; the commit gives those of the attempts that count their names."""

    def __init__(self, path: str):
        self.path, self.staging = path, f"_staging-{uuid.uuid4().hex[:12]}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        system, root = at(self.path)
        folder = posixpath.join(root, self.staging)
        system.create_dir(folder)
        attempt, done, out = uuid.uuid4().hex, [], None
        try:
            for batch in iterator:
                numbers = batch.column(0).to_pylist()
                for number, line in zip(numbers, batch.column(1).to_pylist(), strict=True):
                    if not done or done[-1][0] != number:
                        if any(d[0] == number for d in done):
                            raise ValueError(f"the rows of batch {number} aren't together")
                        if out is not None:
                            out.close()
                        done.append([number, posixpath.join(folder, f"{number}-{attempt}"), 0])
                        out = system.open_output_stream(done[-1][1], compression=None)
                    out.write(line.encode() + b"\n")
                    done[-1][2] += 1
        finally:
            if out is not None:
                out.close()
        return Staged([tuple(d) for d in done])

    def commit(self, messages: list[Staged | None]) -> None:
        system, root = at(self.path)
        made = {}
        for number, staged, rows in (b for m in messages if m for b in m.batches):
            if number in made:
                self.abort(messages)
                raise ValueError(f"batch {number} was written by two tasks")
            made[number] = staged
        system.create_dir(root)
        for old in files(self.path):
            if number_of(old) not in made:
                system.delete_file(old)
        for number, staged in made.items():
            system.move(staged, posixpath.join(root, file_name(number)))
        self.abort(messages)

    def abort(self, messages: list[Staged | None]) -> None:
        """What attempts have left goes."""
        system, root = at(self.path)
        folder = posixpath.join(root, self.staging)
        if system.get_file_info(folder).type != fs.FileType.NotFound:
            system.delete_dir(folder)


def write(rows: DataFrame, path: str, order: str, size: int = BATCH_ROWS) -> None:
    """Rows as JSON lines in ``batch_001.jsonl``, ..., at most ``size`` in each, in the order of the column."""
    rows.sparkSession.dataSource.register(BatchFiles)
    lines = numbered(rows, order, size).select("batch_num", F.to_json(F.struct(*rows.columns)).alias("value"), F.col(order).alias("__order"))
    dealt = lines.repartition("batch_num").sortWithinPartitions("batch_num", "__order").drop("__order")
    dealt.write.format("batch_files").mode("append").save(path)
