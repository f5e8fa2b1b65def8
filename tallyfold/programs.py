"""The runs from files to files: clean, mentions, prepare, collect, aggregate, race.

Each is one plan over its input, with counts taken on the way; ``python -m tallyfold.programs <run> --help`` names
its arguments.  A season's default folders are those of ``config.Paths``.
"""

from __future__ import annotations

import argparse
import csv
import io
import json
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyfold import state
from tallyfold.functions.dates import date_of_epoch, week_of
from tallyfold.functions.numbers import token_cost
from tallyfold.operators import labels, matching, metrics, temporal
from tallyfold.operators.records import Step, Steps, extract_fields, from_source, has_valid_body
from tallyfold.schemas import COMMENT, MENTION
from tallyfold.sources import batches, config, readers, writers


def _parsed(found: DataFrame, seen: Observation, schema=COMMENT) -> DataFrame:
    """Rows of the lines, with the counts of lines and of those that are no objects in ``seen``."""
    is_object = F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False))
    return readers.parsed(found.observe(seen, F.count("*").alias("lines"), F.count_if(~is_object).alias("malformed")), schema)


def clean(spark: SparkSession, source: str, target: str, sources: list[str] | None = None) -> dict[str, int]:
    """Raw lines (zstd, where the path ends so) to comments with a body, of ``sources`` if they are given; JSON lines.

    Returns how many lines there were, were malformed, accepted and rejected by each step.
    """
    found = readers.zstd_lines(spark, source) if source.endswith(".zst") else readers.lines(spark, source)
    seen, passed = Observation(), Observation()
    steps = [Step("source", from_source(sources))] if sources else []
    rows = extract_fields(_parsed(found, seen))
    writers.jsonl(Steps(*steps, Step("body", has_valid_body())).accepted(rows, passed), target)
    return seen.get | passed.get


def mentions(spark: SparkSession, source: str, target: str, names: config.Entities, removed: frozenset[str] = frozenset()) -> dict[str, int]:
    """Comments that mention a name, with ``mentioned_entities``; JSON lines."""
    seen, passed = Observation(), Observation()
    rows = _parsed(readers.lines(spark, source), seen)
    found = rows.withColumn("mentioned_entities", matching.mentions(F.col("body"), names.names, names.short, removed))
    writers.jsonl(Steps(Step("mention", F.size("mentioned_entities") > 0)).accepted(found, passed), target)
    return seen.get | passed.get


def prepare(spark: SparkSession, source: str, folder: str, model: str, size: int = labels.BATCH_ROWS, limit: int | None = None) -> dict[str, int]:
    """Request files batch_001.jsonl, ... of at most ``size`` rows for comments with mentions, or the first ``limit`` of them; how many there are."""
    rows = readers.jsonl(spark, source, MENTION, limit)
    batches.write(labels.requests(rows, model), folder, "custom_id", size)
    return {"batches": len(batches.files(folder))}


def collect(spark: SparkSession, results: str, comments: str, target: str, dead: str, state_path: str | None = None) -> dict[str, float] | None:
    """Results and comments with mentions to the fact table (Parquet), the results that failed to ``dead``.

    Nothing is written, and None returned, while ``state_path`` has batches that haven't ended or aren't fetched.
    Returns labels, rows (fewer, where comments are missing), tokens and cost.
    """
    if state_path and not state.complete(state.load(state_path)):
        return None
    seen, kept = Observation(), Observation()
    answers = readers.batch_results(spark, results)
    given = labels.labels_of(answers).observe(
        seen, F.count("*").alias("labels"), F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"), F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens")
    )
    fact = labels.labelled(readers.jsonl(spark, comments, MENTION), given)
    writers.parquet(fact.observe(kept, F.count("*").alias("rows")), target)
    writers.jsonl(labels.dead_letters(answers), dead)
    counts = seen.get | kept.get
    cost = spark.range(1).select(token_cost(F.lit(counts["input_tokens"]), F.lit(counts["output_tokens"]))).first()[0]
    return counts | {"cost": cost}


def facts(spark: SparkSession, source: str, names: config.Entities, teams: config.Teams) -> DataFrame:
    """sentiment, entity, team and week of each row of the fact table."""
    rows = readers.parquet(spark, source)
    resolved = matching.resolve_entity(rows, matching.alias_table(spark, names.names, names.short), "mentioned_entities")
    placed = matching.with_longest_alias(resolved, "author_flair_text", teams.names)
    return placed.select("sentiment", "entity", "team", week_of(date_of_epoch(F.col("created_utc"))).alias("week"))


def aggregate(spark: SparkSession, source: str, views: str, document: str, names: config.Entities, teams: config.Teams, season: str) -> None:
    """The fact table to the four views in one pass (Parquet by ``view`` in the folder ``views``) and a JSON document.

    The document holds entity_overall (highest rate of negative ones first), entity_temporal, entity_team and
    team_overall (with what the configuration says of the team), entity_metadata (of entities seen only) and metadata.
    """
    rows = facts(spark, source, names, teams)
    metrics.all_views(rows).write.mode("overwrite").partitionBy("view").parquet(views)
    made = readers.parquet(spark, views)

    def view(name: str, keys: list[str], *order: Column | str) -> DataFrame:
        counted = [c for c in made.columns if c not in ("view", "entity", "week", "team")]
        return made.where(F.col("view") == name).select(*keys, *counted).orderBy(*order)

    team_dim = teams.table(spark).withColumnRenamed("name", "team")
    overall = view("entity", ["entity"], F.desc("neg_rate"), "entity")
    dim = metrics.enriched(names.table(spark), team_dim, "team", ["logo"]).withColumnRenamed("name", "entity")
    meta = metrics.run_metadata(rows).withColumns({"season": F.lit(season), "generated_at": F.lit(datetime.now(UTC).isoformat())})
    writers.document(
        {
            "entity_overall": overall,
            "entity_temporal": view("entity_week", ["entity", "week"], "entity", "week"),
            "entity_team": view("entity_team", ["entity", "team"], "entity", "team"),
            "team_overall": metrics.enriched(view("team", ["team"], "team"), team_dim, "team", ["abbreviation", "conference", "logo"]),
            "entity_metadata": metrics.seen_only(dim, overall, "entity"),
            "metadata": meta,
        },
        document,
        single=("metadata",),
    )


def race(spark: SparkSession, views: str, target: str, names: config.Entities, top: int = 15, min_ranking: int = 5000, min_entry: int = 1000) -> int:
    """The wide race of the ``top`` entities as one CSV file; returns its rows.  Reads the folder that ``aggregate`` wrote."""
    weekly = readers.parquet(spark, views).where("view = 'entity_week'").select("entity", "week", "neg_count", "comment_count")
    cumulative = temporal.cumulative_metrics(weekly)
    # one row for each week of the season
    weeks = [str(r["week"]) for r in cumulative.select("week").distinct().orderBy("week").collect()]
    dim = names.table(spark).select(F.col("name").alias("entity"), "team", "image")
    wide = temporal.race_wide(cumulative, dim, weeks, top, min_ranking, min_entry).orderBy("Label")
    text = io.StringIO()
    out = csv.writer(text, lineterminator="\n")
    out.writerow(wide.columns)
    rows = wide.collect()
    out.writerows(rows)
    writers.atomic(target, text.getvalue())
    return len(rows)


def submit_all(path: str, files: list[str], send: Callable[[str], str], poll: Callable[[str], dict], fetch: Callable[[dict], None], sleep: Callable[[float], None], at_once: int = 1, **wait: float) -> bool:
    """Sends files, in the order of their batch numbers, ``at_once`` at a time and fetches their results before the next; whether all results are there.

    A second call goes on where the first stopped.
    """
    while True:
        if state.load(path)["batches"] and not state.collect(path, poll, fetch, sleep, **wait):
            return False
        if not state.submit(path, files, send, at_once):
            return state.complete(state.load(path))


def _arguments() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tallyfold")
    runs = top.add_subparsers(dest="run", required=True)
    for run, needed, more in (
        ("clean", ("source", "target"), {"sources": None}),
        ("mentions", ("source", "target", "entities"), {"removed": None}),
        ("prepare", ("source", "folder", "model"), {"size": labels.BATCH_ROWS}),
        ("collect", ("results", "comments", "target", "dead"), {"state": None}),
        ("aggregate", ("source", "views", "document", "entities", "teams", "season"), {}),
        ("race", ("views", "target", "entities"), {"top": 15, "min-ranking": 5000, "min-entry": 1000}),
    ):
        one = runs.add_parser(run)
        for name in needed:
            one.add_argument(f"--{name}", required=True)
        for name, value in more.items():
            one.add_argument(f"--{name}", default=value, **({"nargs": "*"} if name in ("sources", "removed") else {"type": type(value)} if value else {}))
    return top


def main(argv: list[str] | None = None) -> None:
    a = _arguments().parse_args(argv)
    spark = SparkSession.builder.appName(f"tallyfold {a.run}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    match a.run:
        case "clean":
            out = clean(spark, a.source, a.target, a.sources)
        case "mentions":
            out = mentions(spark, a.source, a.target, config.entities(a.entities), frozenset(a.removed or ()))
        case "prepare":
            out = prepare(spark, a.source, a.folder, a.model, a.size)
        case "collect":
            out = collect(spark, a.results, a.comments, a.target, a.dead, a.state)
        case "aggregate":
            out = aggregate(spark, a.source, a.views, a.document, config.entities(a.entities), config.teams(a.teams), a.season)
        case "race":
            out = race(spark, a.views, a.target, config.entities(a.entities), a.top, a.min_ranking, a.min_entry)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
