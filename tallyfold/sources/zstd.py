"""Lines of zstd files, read by runs of frames in parallel, and written in frames."""

from __future__ import annotations

import io
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from tallyfold.sources.paths import at, matching

#: Bytes of text that are held at once, and compressed bytes that a partition is meant to have.
CHUNK, RUN = 4 << 20, 64 << 20
#: Bytes of text in a frame that is written.
FRAME = 8 << 20
_MAGIC, _SKIPPABLE = 0xFD2FB528, 0x184D2A50


@dataclass
class Run(InputPartition):
    """Frames of a file from ``start`` to ``end``; ``size`` is the file's."""

    path: str
    start: int
    end: int
    size: int


@dataclass
class Part(WriterCommitMessage):
    staged: str | None


def frame_ends(file, size: int) -> Iterator[int]:
    """Where each frame of a file ends, by the headers of frames and blocks alone; what isn't a frame is one with the rest."""
    import zstandard

    pos = 0
    while pos < size:
        file.seek(pos)
        head = file.read(18)
        magic = int.from_bytes(head[:4], "little")
        if magic & 0xFFFFFFF0 == _SKIPPABLE and len(head) >= 8:
            pos += 8 + int.from_bytes(head[4:8], "little")
        elif magic == _MAGIC and len(head) > 5:
            checksum = head[4] >> 2 & 1
            pos += zstandard.frame_header_size(head)
            last = False
            while not last and pos < size:
                file.seek(pos)
                block = int.from_bytes(file.read(3), "little")
                last, kind, length = block & 1 == 1, block >> 1 & 3, block >> 3
                pos += 3 + (1 if kind == 1 else length)
            pos += 4 * checksum
        else:
            pos = size
        yield min(pos, size)


def runs(file, path: str, size: int, most: int = RUN) -> list[Run]:
    """Partitions of whole frames of about ``most`` bytes; a larger frame is one by itself."""
    out, start, last = [], 0, 0
    for end in frame_ends(file, size):
        if last > start and end - start > most:
            out.append(Run(path, start, last, size))
            start = last
        last = end
    return [*out, Run(path, start, size, size)] if size else []


class _Slice(io.RawIOBase):
    """The bytes of a file from ``start`` to ``end``."""

    def __init__(self, file, start: int, end: int):
        self.file, self.pos, self.end = file, start, end

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        self.file.seek(self.pos)
        data = self.file.read(min(len(into), self.end - self.pos))
        into[: len(data)] = data
        self.pos += len(data)
        return len(data)


def _chunks(file, start: int, end: int) -> Iterator[bytes]:
    import zstandard

    if start < end:
        reader = zstandard.ZstdDecompressor(max_window_size=2**31).stream_reader(_Slice(file, start, end), read_across_frames=True)
        while data := reader.read(CHUNK):
            yield data


def lines(file, run: Run) -> Iterator[list[str]]:
    """The lines that begin in a run, some MB at a time; without white space at their ends, and without blank ones.

    A run leaves what is before its first newline to the one before it, and
    reads on behind its end up to a newline.  So a line that begins right where
    a run does belongs to the run before.
    """
    held, skip = b"", run.start > 0
    for data in _chunks(file, run.start, run.end):
        if skip:
            at_ = data.find(b"\n")
            if at_ < 0:
                continue
            data, skip = data[at_ + 1 :], False
        cut = data.rfind(b"\n")
        if cut < 0:
            held += data
            continue
        yield _texts(held + data[:cut])
        held = data[cut + 1 :]
    if skip:
        return
    for data in _chunks(file, run.end, run.size):
        at_ = data.find(b"\n")
        held += data if at_ < 0 else data[:at_]
        if at_ >= 0:
            break
    yield _texts(held)


def _texts(data: bytes) -> list[str]:
    return [x for line in data.decode("utf-8", "replace").split("\n") if (x := line.strip())]


class ZstdLines(DataSource):
    """``spark.read.format("zstd_lines")``: ``value`` of each line of zstd files that isn't blank.

    ``path`` is a file, a folder or a pattern, on a file system that all
    executors reach.  A file of several frames is read in parallel, by runs of
    about ``bytes`` compressed bytes; one of a single frame by one task, as a
    stream.  Memory holds one chunk, or the longest line, and the frame's
    window.  The last line counts without a newline too.

    ``df.write.format("zstd_lines")`` of one text column writes a file for each
    partition, in frames of about ``frame`` bytes of text.
    """

    @classmethod
    def name(cls) -> str:
        return "zstd_lines"

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField("value", T.StringType())])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ZstdReader(self.options["path"], int(self.options.get("bytes", RUN)))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ZstdWriter(self.options["path"], int(self.options.get("frame", FRAME)), overwrite)


class ZstdReader(DataSourceReader):
    def __init__(self, path: str, most: int):
        self.path, self.most = path, most

    def partitions(self) -> list[Run]:
        system, _ = at(self.path)
        out = []
        for info in matching(self.path, ".zst"):
            with system.open_input_file(info.path) as f:
                out += runs(f, info.path, info.size, self.most)
        return out

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        system, _ = at(self.path)
        with system.open_input_file(partition.path) as f:
            for some in lines(f, partition):
                if some:
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.string())], names=["value"])


class ZstdWriter(DataSourceArrowWriter):
    """Attempts write files of their own; the commit moves those that count into the folder."""

    def __init__(self, path: str, frame: int, overwrite: bool):
        self.path, self.frame, self.overwrite, self.staging = path, frame, overwrite, f"_staging-{uuid.uuid4().hex[:12]}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        import zstandard

        system, root = at(self.path)
        folder = posixpath.join(root, self.staging)
        system.create_dir(folder)
        name, held, size = posixpath.join(folder, f"part-{uuid.uuid4().hex}.zst"), [], 0
        packer, any_rows = zstandard.ZstdCompressor(), False
        with system.open_output_stream(name, compression=None) as out:
            for batch in iterator:
                for text in batch.column(0).to_pylist():
                    line = (text or "").encode() + b"\n"
                    held.append(line)
                    size, any_rows = size + len(line), True
                    if size >= self.frame:
                        out.write(packer.compress(b"".join(held)))
                        held, size = [], 0
            if held:
                out.write(packer.compress(b"".join(held)))
        return Part(name if any_rows else None)

    def commit(self, messages: list[Part | None]) -> None:
        system, root = at(self.path)
        system.create_dir(root)
        old = [f.path for f in matching(self.path, ".zst")] if self.overwrite else []
        for m in messages:
            if m and m.staged:
                system.move(m.staged, posixpath.join(root, posixpath.basename(m.staged)))
        for path in old:
            system.delete_file(path)
        self.abort(messages)

    def abort(self, messages: list[Part | None]) -> None:
        system, root = at(self.path)
        folder = posixpath.join(root, self.staging)
        if system.get_file_info(folder).type != fs.FileType.NotFound:
            system.delete_dir(folder)
