"""Which known names a text mentions, and which entity a row is attributed to."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.schemas import ALIAS_DIM


#: Characters of a run by which names are looked up in labels.
GRAM = 3


@dataclass(frozen=True)
class Name:
    """A known name with its aliases; ``extra`` are other keys that it is looked up by, such as a code."""

    name: str
    aliases: tuple[str, ...] = ()
    extra: tuple[str, ...] = field(default=())


def alias_map(names: Iterable[Name]) -> dict[str, str]:
    """Lower-cased name, aliases and extra keys to the name; a later entry overwrites."""
    out: dict[str, str] = {}
    for n in names:
        for key in (n.name, *n.extra, *n.aliases):
            out[key.lower()] = n.name
    return out


def collisions(names: Iterable[Name]) -> dict[str, list[str]]:
    """Keys that more than one name claims."""
    seen: dict[str, list[str]] = {}
    for n in names:
        for key in {k.lower() for k in (n.name, *n.extra, *n.aliases)}:
            seen.setdefault(key, []).append(n.name)
    return {k: v for k, v in seen.items() if len(v) > 1}


def alias_table(spark: SparkSession, names: Iterable[Name], short: frozenset[str] = frozenset()) -> DataFrame:
    """The aliases as a table: as many rows as the configuration has aliases."""
    rows = [(k, n, i, k in short) for i, (k, n) in enumerate(alias_map(names).items())]
    return spark.createDataFrame(rows, ALIAS_DIM)


#: What the aliases of an index look like: each alias with the names it stands for, and whether it needs word boundaries.
Aliases = tuple[tuple[str, tuple[tuple[int, bool], ...]], ...]

#: A letter, mark, digit or connector, by Unicode's notion of a word.
_WORD = regex.compile(r"[\p{Alphabetic}\p{M}\p{Nd}\p{Pc}\p{Join_Control}]")


@lru_cache(maxsize=8)
def _automaton(aliases: Aliases):
    """One for each worker and list of aliases; it walks a text once, however many there are."""
    import ahocorasick

    out = ahocorasick.Automaton()
    for alias, owners in aliases:
        out.add_word(alias, (len(alias), owners))
    out.make_automaton()
    return out


def _edge(text: str, at: int) -> bool:
    """Whether a word begins or ends there."""
    before = at > 0 and _WORD.match(text, at - 1) is not None
    return before != (at < len(text) and _WORD.match(text, at) is not None)


def _found(text: str, automaton, most: int) -> list[int]:
    """The places of the names that a lower-cased text mentions, in order."""
    hits: set[int] = set()
    for last, (size, owners) in automaton.iter(text):
        for name, bounded in owners:
            if name not in hits and (not bounded or (_edge(text, last + 1 - size) and _edge(text, last + 1))):
                hits.add(name)
        if len(hits) == most:
            break
    return sorted(hits)


def mentions(text: Column, names: Iterable[Name], short: frozenset[str] = frozenset(), removed: frozenset[str] = frozenset()) -> Column:
    """The names that a text mentions, each once, in their order; null and empty texts mention none.

    A name is mentioned if one of its aliases stands in the text, in any case;
    aliases in ``short`` only between word boundaries, those in ``removed`` not
    at all.  All aliases are one automaton, so a text is read once whether there
    are ten of them or ten thousand.  It is part of the task, as large as the
    configuration.
    """
    names = tuple(names)
    labels = [n.name for n in names]
    owners: dict[str, dict[int, bool]] = {}
    for k, n in enumerate(names):
        for a in (x.lower() for x in n.aliases):
            if a and a not in removed:
                owners.setdefault(a, {})[k] = a in short
    if not owners:
        return F.array().cast("array<string>")
    aliases: Aliases = tuple((a, tuple(of.items())) for a, of in owners.items())
    most = len({k for of in owners.values() for k in of})

    @F.arrow_udf("array<string>")
    def matched(texts: pa.Array) -> pa.Array:
        automaton = _automaton(aliases)
        return pa.array([[labels[k] for k in _found(t, automaton, most)] for t in texts.to_pylist()], pa.list_(pa.string()))

    return matched(F.lower(F.coalesce(text, F.lit(""))))


def longest_alias(tag: Column, names: Iterable[Name]) -> Column:
    """The name whose alias, of those that stand in the tag, is the longest (the first in order, of equal ones); else null."""
    keys = sorted(alias_map(names).items(), key=lambda kv: -len(kv[0]))
    lower = F.lower(tag)
    out = None
    for alias, name in keys:
        out = F.when(lower.contains(alias), name) if out is None else out.when(lower.contains(alias), name)
    return F.lit(None).cast("string") if out is None else out


def with_longest_alias(rows: DataFrame, tag: str, names: Iterable[Name], name: str = "team") -> DataFrame:
    """Rows with the tag's name.  Distinct tags are few, so each is looked at once and joined back."""
    distinct = rows.select(F.col(tag).alias("__tag")).distinct().withColumn(name, longest_alias(F.col("__tag"), names))
    return rows.join(distinct, F.col(tag) == F.col("__tag"), "left").drop("__tag")


def resolve_entity(rows: DataFrame, aliases: DataFrame, mentioned: str = "mentions", label: str = "label_entity", name: str = "entity") -> DataFrame:
    """The entity of each row, by its mentions and the label's own word.

    One mention: itself, by alias if it is one, whatever the label says.  Two or
    more: the label, if it is a known name as written, or an alias in any case;
    else none.  No mention: none.
    """
    keys = F.broadcast(aliases.select(F.col("alias").alias("__a1"), F.col("name").alias("__n1")))
    again = F.broadcast(aliases.select(F.col("alias").alias("__a2"), F.col("name").alias("__n2")))
    known = F.broadcast(aliases.select(F.col("name").alias("__known")).distinct())
    first = F.get(F.col(mentioned), 0)
    joined = (
        rows.join(keys, F.lower(first) == F.col("__a1"), "left")
        .join(again, F.lower(F.col(label)) == F.col("__a2"), "left")
        .join(known, F.col(label) == F.col("__known"), "left")
    )
    n = F.size(F.col(mentioned))
    out = F.when(n == 1, F.coalesce("__n1", first)).when(n >= 2, F.when(F.col(label) != "", F.coalesce("__known", "__n2")))
    return joined.withColumn(name, out).drop("__a1", "__n1", "__a2", "__n2", "__known")


def unresolved(rows: DataFrame, value: str, aliases: DataFrame, top: int) -> DataFrame:
    """Values that are no alias, the most frequent first."""
    keys = F.broadcast(aliases.select("alias"))
    missing = rows.where(F.col(value).isNotNull()).join(keys, F.lower(F.col(value)) == F.col("alias"), "left_anti")
    return missing.groupBy(value).agg(F.count("*").alias("n")).orderBy(F.desc("n"), value).limit(top)


def _grams(text: Column) -> Column:
    """Runs of up to ``GRAM`` characters, each once."""
    runs = lambda q: F.transform(F.sequence(F.lit(1), F.length(text) - q + 1), lambda i: F.substring(text, i, F.lit(q)))
    each = [F.when(F.length(text) >= q, runs(q)).otherwise(F.array().cast("array<string>")) for q in range(1, GRAM + 1)]
    return F.array_distinct(F.concat(*each))


def containment(names: DataFrame, labels: DataFrame, name: str, label: str, count: str) -> DataFrame:
    """For each distinct name, the labels that hold it in any case, and how often they were given.

    A name is looked up by the one of its longest runs (of up to three
    characters) that the fewest labels hold, so that a run which all of them
    share brings no pairs together; those are then tested in full.  A name of no
    characters is held by every label, a null one by none.
    """
    names = names.select(F.col(name).alias("__name")).distinct().withColumn("__low", F.lower("__name"))
    given = labels.where(F.col(label).isNotNull()).select(F.lower(F.col(label)).alias("__in"), F.col(count).alias("__times"))
    held = given.select("__in", "__times", F.explode(_grams(F.col("__in"))).alias("__gram"))
    spread = held.groupBy("__gram").agg(F.count("*").alias("__held"))
    size = F.least(F.lit(GRAM), F.length("__low"))
    own = names.select("__low", F.explode(F.filter(_grams(F.col("__low")), lambda g: F.length(g) == size)).alias("__gram")).distinct()
    # a run that no label holds settles that the name is in none
    anchors = own.join(spread, "__gram", "left").groupBy("__low").agg(F.min_by("__gram", F.coalesce("__held", F.lit(0))).alias("__gram"))
    hits = anchors.join(held, "__gram").where(F.contains("__in", "__low")).groupBy("__low").agg(F.count("*").alias("__n"), F.sum("__times").alias("__sum"))
    everything = given.agg(F.lit("").alias("__low"), F.count("*").alias("__n"), F.sum("__times").alias("__sum"))
    found = hits.union(everything)
    return names.join(found, "__low", "left").select(F.col("__name").alias(name), F.coalesce("__n", F.lit(0)).cast("long").alias("labels"), F.coalesce("__sum", F.lit(0)).alias("times"))
