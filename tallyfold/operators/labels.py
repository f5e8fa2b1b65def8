"""The label plane: requests to a classifier, replies from it, and what it costs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyfold.functions.numbers import rate, token_cost
from tallyfold.functions.text import stripped
from tallyfold.operators.polarity import LEXICON
from tallyfold.operators.ranges import bounds, placed, tie

LABELS = ("pos", "neg", "neu")
BATCH_ROWS = 100_000
_BEFORE = "Read the comment and say how its author feels about the person they talk of.\nComment: "
_AFTER = '\nAnswer with JSON only: {"s": "pos" or "neg" or "neu", "c": how sure you are from 0 to 1, "p": the person or null}'


def prompt(body: Column) -> Column:
    return F.concat(F.lit(_BEFORE), body, F.lit(_AFTER))


def requests(rows: DataFrame, model: str, max_tokens: int = 64, temperature: float = 0.0, key: str = "id", body: str = "body") -> DataFrame:
    """custom_id and params of each row's request."""
    message = F.struct(F.lit("user").alias("role"), prompt(F.col(body)).alias("content"))
    params = F.struct(F.lit(model).alias("model"), F.lit(max_tokens).alias("max_tokens"), F.lit(temperature).alias("temperature"), F.array(message).alias("messages"))
    return rows.select(F.col(key).cast("string").alias("custom_id"), params.alias("params"))


def numbered(rows: DataFrame, order: str, size: int = BATCH_ROWS) -> DataFrame:
    """Rows with ``batch_num`` from 1: ``size`` rows a batch in the order of the column, the last batch what is left.

    Ranges of (column, hash of the row) are counted first and numbered within
    afterwards, so rows of one value are spread over many tasks and no task sees
    all rows; there are as many ranges as shuffle partitions.  Rows of equal
    values are in the order of the hash; nulls come first.  The rows are read
    three times: for the ranges' bounds, the counts, and the result.
    """
    keyed = rows.withColumn("__tie", tie(rows))
    key = F.struct(F.col(order).alias("v"), F.col("__tie").alias("t"))
    ranged = placed(keyed, bounds(keyed, key), key, "__part")
    counts = ranged.groupBy("__part").agg(F.count("*").alias("__n"))
    # one row for each range
    ahead = counts.select(F.col("__part").alias("__of"), (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__ahead"))
    within = F.row_number().over(Window.partitionBy("__part").orderBy(order, "__tie"))
    numbers = ranged.join(F.broadcast(ahead), F.col("__part") == F.col("__of")).withColumn("__row", F.col("__ahead") + within - 1)
    return numbers.withColumn("batch_num", (F.floor(F.col("__row") / size) + 1).cast("int")).drop("__part", "__of", "__ahead", "__row", "__tie")


def unfenced(text: Column) -> Column:
    """A reply without white space at its ends and without a code fence around it."""
    bare = stripped(text)
    opened = F.when(bare.startswith("```json"), F.substr(bare, F.lit(8))).when(bare.startswith("```"), F.substr(bare, F.lit(4))).otherwise(bare)
    return stripped(F.when(opened.endswith("```"), F.substr(opened, F.lit(1), F.length(opened) - 3)).otherwise(opened))


def parse_reply(text: Column) -> Column:
    """struct(sentiment, confidence, label_entity, raw) of a classifier's reply.

    The reply is a JSON object, or a list whose first element is one, perhaps in
    a fence.  Its ``s`` has to be a label as written; ``c`` is a number or the
    text of one, 0 where there is none; ``p`` is passed on.  Whatever is amiss
    gives the label ``error``, confidence 0, no entity, and the reply in ``raw``.
    """
    top = F.try_parse_json(unfenced(text))
    whole = F.when(F.schema_of_variant(top).startswith("ARRAY"), F.try_variant_get(top, "$[0]", "variant")).otherwise(top)
    is_object = F.schema_of_variant(whole).startswith("OBJECT")
    label = F.try_variant_get(whole, "$.s", "string")
    has_c = F.array_contains(F.json_object_keys(F.to_json(whole)), "c")
    sure = F.when(has_c, F.try_variant_get(whole, "$.c", "double")).otherwise(F.lit(0.0))
    good = is_object & label.isin(*LABELS) & sure.isNotNull()
    entity = F.try_variant_get(whole, "$.p", "string")
    return F.when(
        good,
        F.struct(label.alias("sentiment"), sure.alias("confidence"), entity.alias("label_entity"), F.lit(None).cast("string").alias("raw")),
    ).otherwise(F.struct(F.lit("error").alias("sentiment"), F.lit(0.0).alias("confidence"), F.lit(None).cast("string").alias("label_entity"), text.alias("raw")))


def labels_of(results: DataFrame) -> DataFrame:
    """id, label and tokens of the results that succeeded."""
    done = results.where(F.col("result_type") == "succeeded").withColumn("__r", parse_reply(F.col("content")))
    return done.select(
        F.col("custom_id").alias("id"), "__r.sentiment", "__r.confidence", "__r.label_entity", F.coalesce("input_tokens", F.lit(0)).alias("input_tokens"), F.coalesce("output_tokens", F.lit(0)).alias("output_tokens")
    )


def dead_letters(results: DataFrame) -> DataFrame:
    return results.where(~F.col("result_type").eqNullSafe("succeeded"))


def labelled(comments: DataFrame, labels: DataFrame) -> DataFrame:
    """Comments with their label, under the fact table's names; those without one, and labels without a comment, go."""
    kept = comments.select("id", "body", "author", "author_flair_text", "author_flair_css_class", "created_utc", "score", "mentioned_entities")
    return kept.join(labels, "id").select(F.col("id").alias("comment_id"), *[c for c in kept.columns if c != "id"], *[c for c in labels.columns if c != "id"])


def dropped_labels(comments: DataFrame, labels: DataFrame) -> DataFrame:
    return labels.join(comments.select("id"), "id", "left_anti")


def totals(rows: DataFrame) -> DataFrame:
    """Tokens and cost of all rows."""
    summed = rows.agg(F.count("*").alias("requests"), F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"), F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"))
    return summed.withColumn("cost", token_cost(F.col("input_tokens"), F.col("output_tokens")))


def validated(lines: DataFrame, line: str = "value", number: str = "line", by: str = "file") -> DataFrame:
    """For each file of requests: rows, and the first line that isn't a request, with what is wrong."""
    parsed = F.try_parse_json(F.col(line))
    keys = F.json_object_keys(F.col(line))
    wrong = (
        F.when(parsed.isNull() | ~F.schema_of_variant(parsed).startswith("OBJECT"), "invalid JSON")
        .when(~F.array_contains(keys, "custom_id"), "missing custom_id")
        .when(~F.array_contains(keys, "params"), "missing params")
    )
    checked = lines.where(F.trim(line) != "").withColumn("__wrong", wrong)
    return checked.groupBy(by).agg(
        F.count("*").alias("rows"), F.min(F.when(F.col("__wrong").isNotNull(), F.struct(F.col(number).alias("line"), F.col("__wrong").alias("error")))).alias("__first")
    ).select(by, "rows", F.col("__first.line").alias("bad_line"), F.col("__first.error").alias("error"), F.col("__first").isNull().alias("valid"))


def dry_run(lines: DataFrame, answer_tokens: int, line: str = "value", number: str = "line", by: str = "file") -> DataFrame:
    """For each file of requests: what ``validated`` says, and what its rows are estimated to cost if they were sent."""
    sizes = lines.where(F.trim(line) != "").groupBy(by).agg(F.sum(F.length(line) / 4).alias("tokens_in"), (F.count("*") * answer_tokens).alias("tokens_out"))
    return validated(lines, line, number, by).join(sizes, by).withColumn("cost", token_cost(F.col("tokens_in"), F.col("tokens_out")))


def accuracy(rows: DataFrame, predicted: str, expected: str) -> DataFrame:
    """Rows, hits and recall of each expected class."""
    by = rows.groupBy(F.col(expected).alias("expected")).agg(F.count("*").alias("n"), F.count_if(F.col(predicted) == F.col(expected)).alias("hits"))
    return by.withColumn("recall", rate(F.col("hits"), F.col("n")))


def model_comparison(rows: DataFrame, prices: DataFrame, volume: int, baseline: str) -> DataFrame:
    """Accuracy, mean tokens, the projected cost of ``volume`` texts, and what it saves against ``baseline``.

    ``rows(model, correct, input_tokens, output_tokens)``, ``prices(model, price_in, price_out)``.
    """
    by = rows.groupBy("model").agg(
        rate(F.count_if("correct"), F.count("*")).alias("accuracy"), F.avg("input_tokens").alias("mean_in"), F.avg("output_tokens").alias("mean_out")
    )
    priced = by.join(F.broadcast(prices), "model").withColumn("cost", (F.col("mean_in") * F.col("price_in") + F.col("mean_out") * F.col("price_out")) * volume / 1e6)
    base = priced.where(F.col("model") == baseline).select(F.col("cost").alias("base_cost"))
    return priced.crossJoin(F.broadcast(base)).select("model", "accuracy", "mean_in", "mean_out", "cost", rate(100 * (F.col("base_cost") - F.col("cost")), F.col("base_cost"), 2).alias("saving_pct"))


class Classifier(Protocol):
    """What gives a text its raw reply, many texts at a time."""

    def __call__(self, bodies: list[str]) -> list[str]: ...


def classified(requests_: DataFrame, classifier: Callable[[list[str]], list[str]]) -> DataFrame:
    """Results of requests by a classifier that runs in the tasks, one call for each Arrow batch."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            replies = classifier(f["content"].tolist())
            yield pd.DataFrame({"custom_id": f["custom_id"], "result_type": "succeeded", "content": replies, "input_tokens": f["content"].str.len() // 4, "output_tokens": [len(r) // 4 for r in replies], "error": None})

    flat = requests_.select("custom_id", F.col("params.messages")[0]["content"].alias("content"))
    return flat.mapInPandas(run, "custom_id string, result_type string, content string, input_tokens long, output_tokens long, error string")


def offline(bodies: list[str]) -> list[str]:
    """A classifier without a service: the lexicon's label, in the service's form."""
    import json

    out = []
    for body in bodies:
        score = LEXICON.compound(body.removeprefix(_BEFORE).removesuffix(_AFTER))
        out.append(json.dumps({"s": "pos" if score > 0.05 else "neg" if score < -0.05 else "neu", "c": round(min(1.0, abs(score) + 0.5), 2), "p": None}))
    return out
