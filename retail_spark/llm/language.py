"""Language identification by rank-order profiles of n-grams.

A language's profile lists its most frequent character n-grams by rank. A
document's own profile is held against each: an n-gram costs the difference of
its two ranks, or the length of a profile if the language lacks it. The
language with the smallest sum is predicted.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from retail_spark.llm.common import fold, map_arrow

#: N-grams of a profile.
PROFILE = 400
#: The answer for texts without a letter.
UNKNOWN = "und"

_OTHER = re.compile(r"[\W\d_]+")
_SPACE = 32


def grams(text: str | None) -> np.ndarray:
    """The letters, pairs and triples of a text's words, each with a blank at either end, as integers.

    A code point has 21 bits; pairs and triples that reach over a blank into
    the next word are left out.
    """
    words = _OTHER.sub(" ", (text or "").lower())
    if not words.replace(" ", "").isalpha():  # number signs such as a half or a Roman eight are no letters
        words = " ".join("".join(c if c.isalpha() else " " for c in words).split())
    words = words.strip()
    if not words:
        return np.zeros(0, np.uint64)
    c = np.frombuffer(f" {words} ".encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    letter = c != _SPACE
    pairs = (c[:-1] << np.uint64(21)) | c[1:]
    triples = (pairs[:-1] << np.uint64(21)) | c[2:]
    return np.concatenate([c[letter], pairs, triples[letter[1:-1]]])


def ranked(text: str | None, size: int = PROFILE) -> np.ndarray:
    """A text's most frequent n-grams, most frequent first, ties to the smaller integer."""
    keys, counts = np.unique(grams(text), return_counts=True)
    return keys[np.argsort(-counts, kind="stable")[:size]]


class Profiles:
    """Language profiles as one table: for each n-gram its rank in each language."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int = PROFILE):
        self.size, self.languages = size, sorted(profiles)
        self.keys = np.unique(np.concatenate([*profiles.values(), np.zeros(0, np.uint64)]))
        self.ranks = np.full((len(self.keys) + 1, len(self.languages)), -1, dtype=np.int64)
        for k, name in enumerate(self.languages):
            self.ranks[np.searchsorted(self.keys, profiles[name]), k] = np.arange(len(profiles[name]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language (ties: first by name) and how far its distance is below the largest possible."""
        own = ranked(text, self.size)
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.keys, own)
        at[self.keys[np.minimum(at, len(self.keys) - 1)] != own] = len(self.keys)
        places = self.ranks[at]
        cost = np.where(places < 0, self.size, np.abs(places - np.arange(len(own))[:, None])).sum(axis=0)
        k = int(cost.argmin())
        return self.languages[k], float(1 - cost[k] / (self.size * len(own)))


def learn(docs: DataFrame, size: int = PROFILE) -> Profiles:
    """Profiles from all rows of ``docs(text, lang)`` with a lang; counts are summed before and after a shuffle."""

    def count():
        def step(batch):
            texts: dict[str, list[str]] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts.setdefault(lang, []).append(text)
            out = {"lang": [], "gram": [], "n": []}
            for lang, ts in texts.items():
                keys, counts = np.unique(np.concatenate([grams(t) for t in ts]), return_counts=True)
                out["lang"].append(np.full(len(keys), lang, dtype=object))
                out["gram"].append(keys.view(np.int64))
                out["n"].append(counts.astype(np.int64))
            return {k: np.concatenate(v) for k, v in out.items()}

        return step

    rows = docs.select("text", F.col("lang").cast("string").alias("lang")).filter("lang is not null and text is not null")
    counts = map_arrow(rows, count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    # one profile a language: as many numbers as languages times ``size``
    top = counts.withColumn("place", place).filter(F.col("place") <= size).orderBy("lang", "place").toPandas()
    return Profiles({lang: g["gram"].to_numpy().astype(np.int64).view(np.uint64) for lang, g in top.groupby("lang")}, size)


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs(doc_id, text)``; the whole text counts.

    Null, empty and letterless texts, and any text if no language was learned,
    give ``und`` and 0.
    """
    # plain values travel: a broadcast class would need the module on the executors
    held = docs.sparkSession.sparkContext.broadcast(vars(profiles))

    def start():
        own = Profiles.__new__(Profiles)
        vars(own).update(held.value)

        def step(batch):
            found = [own.predict(t) for t in batch.column(1).to_pylist()]
            return {"doc_id": batch.column(0), "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

        return step

    return map_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), start,
                     "doc_id bigint, lang_pred string, score double")


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``.

    Learns from text and lang of the rows outside fold 1 of 3. Rows with a null
    doc_id are in fold 0. An empty table gives an empty result.
    """
    profiles = learn(docs.filter(fold("doc_id", 3) != 1))
    return identify(docs, profiles).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
