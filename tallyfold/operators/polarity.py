"""A label without a service: words of praise and blame, weighed from left to right."""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words over which a negation or a booster reaches, what a negated weight is multiplied by, what a booster loses with each
#: word in between, what capitals and each of at most three exclamation marks add.
REACH, NEGATED, FADE, LOUD = 3, -0.5, 0.5, 0.25
#: Rows of a lexicon at most.
MOST = 1_000_000
_WORDS = regex.compile(r"[\p{L}\p{N}']+")


@dataclass(frozen=True)
class Lexicon:
    """Weights of words, words that negate, and words that strengthen (or weaken, below 0) what follows them; all in lower case."""

    weights: dict[str, float]
    negators: frozenset[str] = frozenset()
    boosters: dict[str, float] = field(default_factory=dict)

    def patched(self, weights: dict[str, float]) -> Lexicon:
        """With more words, or other weights."""
        return Lexicon(self.weights | {k.lower(): v for k, v in weights.items()}, self.negators, self.boosters)

    @classmethod
    def of_table(cls, rows: DataFrame, most: int = MOST) -> Lexicon:
        """From (word, role, weight), the role one of word, negator and booster; a table of more than ``most`` rows is refused."""
        found = rows.select(F.lower("word").alias("word"), "role", F.col("weight").cast("double").alias("weight")).limit(most + 1).collect()
        if len(found) > most:
            raise ValueError(f"the lexicon has more than {most} rows")
        by = {role: {r["word"]: r["weight"] for r in found if r["role"] == role} for role in ("word", "negator", "booster")}
        return cls(by["word"], frozenset(by["negator"]), by["booster"])

    def total(self, text: str) -> float:
        """The sum of the words' weights, each as the words before it leave it.

        A word is strengthened by the last booster among the three words before
        it, half as much for each word in between, and by capitals if the text
        isn't all capitals; it is turned, at half its weight, by a negator among
        them.  Exclamation marks strengthen the sum, whichever its sign.
        """
        total, negated, boost, reach = 0.0, 0, 0.0, 0
        shouted = text == text.upper()
        for word in _WORDS.findall(text):
            low = word.lower()
            weight = self.weights.get(low)
            if weight:
                sign = 1.0 if weight > 0 else -1.0
                loud = LOUD if not shouted and len(word) > 1 and word != low and word == word.upper() else 0.0
                value = weight + sign * ((boost if reach else 0.0) + loud)
                total += value * NEGATED if negated else value
            negated = REACH if low in self.negators else max(negated - 1, 0)
            if low in self.boosters:
                boost, reach = self.boosters[low], REACH
            else:
                boost, reach = boost * FADE, max(reach - 1, 0)
        marks = LOUD * min(3, text.count("!"))
        return total + marks if total > 0 else total - marks if total < 0 else 0.0

    def compound(self, text: str) -> float:
        """Between -1 and 1."""
        total = self.total(text)
        return total / (total * total + 15) ** 0.5


#: Words of praise and blame in three grades, negations and boosters; fixed values of our own.
_PRAISE = {1: ("fine", "nice", "solid", "decent"), 2: ("good", "strong", "happy", "impressive"), 3: ("excellent", "brilliant", "wonderful", "superb")}
_BLAME = {1: ("weak", "dull", "shaky", "poor"), 2: ("bad", "sloppy", "angry", "disappointing"), 3: ("terrible", "awful", "horrible", "dreadful")}
LEXICON = Lexicon(
    {w: sign * step / 4 for sign, words in ((1, _PRAISE), (-1, _BLAME)) for step, some in words.items() for w in some},
    frozenset({"not", "no", "never", "hardly", "without", "isn't", "wasn't", "don't", "can't"}),
    {"very": 0.25, "so": 0.25, "truly": 0.5, "absolutely": 0.5, "slightly": -0.25, "somewhat": -0.25},
)


def polarity(text: Column, lexicon: Lexicon = LEXICON) -> Column:
    """``Lexicon.compound`` of each text; a null one has 0.  A word costs one look-up, however large the lexicon, which is part of the task."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array([lexicon.compound(t) for t in texts.to_pylist()], pa.float64())

    return scored(F.coalesce(text, F.lit("")))


def lexicon_label(score: Column) -> Column:
    return F.when(score > 0.05, "pos").when(score < -0.05, "neg").otherwise("neu")
