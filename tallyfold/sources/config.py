"""Names, teams and seasons from YAML files, and where a season's data lie."""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tallyfold.operators.matching import Name, collisions
from tallyfold.schemas import ENTITY_DIM, TEAM_DIM


def _load(path: str):
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


@dataclass(frozen=True)
class Entities:
    names: tuple[Name, ...]
    short: frozenset[str]
    details: tuple[dict, ...]

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(d["name"], d.get("team"), d.get("conference"), d.get("player_id", d.get("entity_id")), d.get("headshot_url", d.get("image"))) for d in self.details]
        return spark.createDataFrame(rows, ENTITY_DIM)

    def problems(self) -> list[str]:
        """Keys of several names, and short aliases that no name has."""
        own = {a.lower() for n in self.names for a in n.aliases}
        return [f"{k}: {', '.join(v)}" for k, v in collisions(self.names).items()] + [f"{s}: no name has this alias" for s in sorted(self.short - own)]


@lru_cache
def entities(path: str, key: str = "players") -> Entities:
    """``key`` maps each name to a list of aliases, or to a mapping with ``aliases`` and details; ``short_aliases`` is a list."""
    data = _load(path)
    names, details = [], []
    for name, entry in (data.get(key) or {}).items():
        plain = isinstance(entry, list) or entry is None
        names.append(Name(name, tuple(entry or ()) if plain else tuple(entry.get("aliases") or ())))
        details.append({"name": name} | ({} if plain else {k: v for k, v in entry.items() if k != "aliases"}))
    return Entities(tuple(names), frozenset(str(s).lower() for s in data.get("short_aliases") or ()), tuple(details))


@dataclass(frozen=True)
class Teams:
    names: tuple[Name, ...]
    details: tuple[dict, ...]

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(d["name"], d.get("abbreviation"), d.get("conference"), d.get("team_id"), d.get("logo_url", d.get("logo"))) for d in self.details]
        return spark.createDataFrame(rows, TEAM_DIM)


@lru_cache
def teams(path: str, key: str = "teams") -> Teams:
    data = _load(path).get(key) or {}
    names = tuple(Name(n, tuple(e.get("aliases") or ()), (e["abbreviation"],) if e.get("abbreviation") else ()) for n, e in data.items())
    return Teams(names, tuple({"name": n} | {k: v for k, v in e.items() if k != "aliases"} for n, e in data.items()))


@dataclass(frozen=True)
class Season:
    season: str
    start_date: str
    end_date: str
    sources: tuple[str, ...]


@lru_cache
def season(path: str) -> Season:
    data = _load(path)
    sources = tuple(data.get("subreddits", data.get("sources")) or ())
    missing = [k for k in ("season", "start_date", "end_date") if not data.get(k)]
    if missing or not sources:
        raise ValueError(f"{path} lacks {', '.join(missing + ([] if sources else ['sources']))}")
    return Season(str(data["season"]), str(data["start_date"]), str(data["end_date"]), sources)


class Paths:
    """Folders of a season under DATA_DIR (./data, where it is unset)."""

    KINDS = ("raw", "filtered", "batches", "processed", "dashboard")

    def __init__(self, season_name: str, root: str | None = None):
        self.root = Path(root or os.environ.get("DATA_DIR", "./data")) / season_name

    def folder(self, kind: str) -> Path:
        if kind not in self.KINDS:
            raise ValueError(f"{kind} is none of {', '.join(self.KINDS)}")
        return self.root / kind

    def state(self) -> Path:
        return self.folder("batches") / "state.json"


def epoch_bounds(start: str, end: str) -> tuple[int, int]:
    """Epoch seconds of two ISO dates, in UTC."""
    from datetime import UTC, datetime

    return tuple(int(datetime.fromisoformat(d).replace(tzinfo=UTC).timestamp()) for d in (start, end))
