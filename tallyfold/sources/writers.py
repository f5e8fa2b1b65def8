"""DataFrames into files."""

from __future__ import annotations

import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.sources import zstd


def parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Never onto a path that ``df`` reads."""
    df.write.mode(mode).parquet(path)


def jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


def zstd_lines(df: DataFrame, path: str, frame: int = zstd.FRAME, append: bool = False) -> None:
    """One text column as lines of zstd files, in frames of about ``frame`` bytes of text that can be read in parallel."""
    df.sparkSession.dataSource.register(zstd.ZstdLines)
    df.write.format("zstd_lines").option("frame", frame).mode("append" if append else "overwrite").save(path)


def csv(df: DataFrame, path: str) -> None:
    """With a header; nulls are empty cells."""
    df.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def split_results(results: DataFrame, good: str, dead: str) -> None:
    """Results that succeeded to ``good``, all others to ``dead``."""
    ok = F.col("result_type").eqNullSafe("succeeded")
    results.where(ok).write.mode("overwrite").parquet(good)
    results.where(~ok).write.mode("overwrite").json(dead)


def document(views: dict[str, DataFrame], path: str, single: tuple[str, ...] = (), limit: int = 100_000) -> None:
    """A JSON document of small views, on the driver; a view of more than ``limit`` rows is refused.

    Views in ``single`` are one row and become an object.  Dates become texts.
    """
    out = {}
    for name, df in views.items():
        rows = [r.asDict(recursive=True) for r in df.limit(limit + 1).collect()]
        if len(rows) > limit:
            raise ValueError(f"{name} has more than {limit} rows; write it as a table")
        out[name] = rows[0] if name in single else rows
    atomic(path, json.dumps(out, indent=2, default=str))


def atomic(path: str, text: str) -> None:
    """All of the text or the file as it was."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    fd, temp = tempfile.mkstemp(dir=target.parent, suffix=".tmp")
    try:
        with os.fdopen(fd, "w", encoding="utf-8") as f:
            f.write(text)
        os.replace(temp, target)
    except BaseException:
        Path(temp).unlink(missing_ok=True)
        raise
