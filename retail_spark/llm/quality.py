"""Quality by the votes of a document's nearest labelled neighbours in a latent space.

1. Terms of a whole text: words, shapes of words (letter cases, digits and
   other characters, runs as one) and how much of the text repeats itself, each
   with the root of its share of the text, so that a text's length does not count.
2. Terms weigh by inverse document frequency; a truncated singular value
   decomposition of the labelled texts gives the latent directions.
3. The labelled vectors go to every task. Each document's vector is held
   against all of them, block by block, by exact cosine products; its nearest
   ones vote with their labels, weighted by a power of their similarity.

The model is fitted on ``SAMPLE`` labelled texts at most, taken by a hash of the
id; with ``TERMS`` and ``RANK`` that bounds what the driver and a task hold.
Scoring reads every whole text once, without a shuffle.

Results for odd inputs: null and empty texts have the one term ``<none>``; a
text without any known term, and any text if no neighbour is similar, scores
the labels' mean; without labels every text scores 1; rows with a null doc_id
are held out; repeated rows score alike; an empty table gives an empty result;
columns beyond doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from retail_spark.llm.common import fold, map_arrow

#: Labelled texts to learn from, terms known, and latent directions, at most.
SAMPLE, TERMS, RANK = 4000, 4096, 64
#: Fewest labelled texts that a term must stand in.
SUPPORT = 5
#: Neighbours that vote, and the power of their similarity that they vote with.
NEIGHBOURS, POWER = 15, 8
#: Labelled vectors that are held against a slice of documents at once.
BLOCK = 1024
#: Weight of the terms that tell how a text repeats itself, beside words and shapes.
REPEATS = 3.0

_RUN = re.compile(r"(.)\1+", re.DOTALL)


def shape(word: str) -> str:
    """Cases of a word of letters; else digits as 0, letters as a or A, other characters as they are, runs as one, 8 at most."""
    if word.isalpha():
        return "A" if word.isupper() else "a" if word.islower() else "Aa" if word.istitle() else "aA"
    signs = "".join("0" if c.isdigit() else ("A" if c.isupper() else "a") if c.isalpha() else c for c in word)
    return _RUN.sub(r"\1", signs)[:8]


def terms(text: str | None) -> dict[str, float]:
    """Term -> weight within the text, from all its words and lines."""
    words = (text or "").split()
    if not words:
        return {"<none>": 1.0}
    found, n = Counter(words), len(words)
    shares: dict[str, float] = {}
    for word, k in found.items():
        for name in ("s" + shape(word[:64]), "w" + word[:64].lower()):
            shares[name] = shares.get(name, 0.0) + k / n
    lines = text.split("\n")
    repeats = {"<next>": sum(map(str.__eq__, words, words[1:])) / n, "<pairs>": 1 - (len(set(zip(words, words[1:]))) + 1) / n,
               "<words>": 1 - len(found) / n, "<lines>": 1 - len(set(lines)) / len(lines), "<long>": sum(len(w) > 12 for w in words) / n}
    out = {name: share ** 0.5 for name, share in shares.items()}
    out.update((name, REPEATS * share ** 0.5) for name, share in repeats.items() if share > 0)
    return out


class Space:
    """Known terms with their weights, the latent directions, and the labelled vectors in them."""

    def __init__(self, names: list[str], idf: np.ndarray, directions: np.ndarray, vectors: np.ndarray, labels: np.ndarray):
        self.index = {n: k for k, n in enumerate(names)}
        self.weighted = (idf[:, None] * directions).astype(np.float32)
        self.vectors, self.labels = vectors, labels
        self.names, self.idf, self.directions = names, idf, directions

    def parts(self) -> tuple:
        return self.names, self.idf, self.directions, self.vectors, self.labels

    def embed(self, found: list[dict[str, float]]) -> np.ndarray:
        """The unit vectors of texts, zero for those without a known term."""
        out = np.zeros((len(found), self.weighted.shape[1]), np.float32)
        for k, x in enumerate(found):
            known = [(self.index[name], v) for name, v in x.items() if name in self.index]
            if known:
                at, v = zip(*known)
                out[k] = np.asarray(v, np.float32) @ self.weighted[list(at)]
        return _unit(out)

    def score(self, texts: list[str | None]) -> np.ndarray:
        """The vote of each text's nearest labelled neighbours."""
        if not len(self.labels):
            return np.ones(len(texts))
        own = self.embed([terms(t) for t in texts])
        near, votes = np.full((len(own), 0), 0.0, np.float32), np.full((len(own), 0), 0.0)
        for at in range(0, len(self.labels), BLOCK):
            near = np.hstack([near, own @ self.vectors[at : at + BLOCK].T])
            votes = np.hstack([votes, np.broadcast_to(self.labels[at : at + BLOCK], (len(own), len(self.labels[at : at + BLOCK])))])
            if near.shape[1] > NEIGHBOURS:
                kept = np.argpartition(-near, NEIGHBOURS - 1, axis=1)[:, :NEIGHBOURS]
                near, votes = np.take_along_axis(near, kept, 1), np.take_along_axis(votes, kept, 1)
        weight = np.maximum(near, 0).astype(np.float64) ** POWER
        total = weight.sum(axis=1)
        # a neighbour of weight 1e-6 stands for the mean, so that texts unlike all others score it
        return np.clip(((weight * votes).sum(axis=1) + 1e-6 * self.labels.mean()) / (total + 1e-6), 0.0, 1.0)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(id, text, quality) of the documents of ``sample`` labelled ids, chosen by a hash; the lower label of an id counts."""
    chosen = (labels.filter("doc_id is not null and quality is not null")
              .groupBy(F.col("doc_id").cast("bigint").alias("id")).agg(F.min(F.col("quality").cast("int")).alias("quality"))
              .orderBy(F.xxhash64("id"), "id").limit(sample))
    # bounded by ``sample`` rows of two numbers, so the texts need no shuffle
    return docs.select(F.col("doc_id").cast("bigint").alias("id"), "text").join(F.broadcast(chosen), "id")


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, size: int = TERMS, rank: int = RANK) -> Space:
    """A latent space learned from the labelled rows given. ``docs`` needs doc_id and text, ``labels`` doc_id and quality (0/1)."""
    rows = training_sample(docs, labels, sample)

    def count():
        def step(batch):
            found = Counter(name for t in batch.column("text").to_pylist() for name in terms(t))
            return {"term": list(found), "n": list(found.values())}

        return step

    counts = map_arrow(rows.select("text"), count, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    known = counts.filter(F.col("n") >= SUPPORT).orderBy(F.desc("n"), "term").limit(size).collect()
    names, df = [r["term"] for r in known], np.array([r["n"] for r in known], dtype=np.float64)
    held = docs.sparkSession.sparkContext.broadcast({n: k for k, n in enumerate(names)})

    def sparse():
        def step(batch):
            index, at, value = held.value, [], []
            for t in batch.column("text").to_pylist():
                own = sorted((index[name], v) for name, v in terms(t).items() if name in index)
                at.append([k for k, _ in own])
                value.append([v for _, v in own])
            return {"id": batch.column("id"), "quality": batch.column("quality"), "at": pa.array(at, pa.list_(pa.int32())), "value": pa.array(value, pa.list_(pa.float32()))}

        return step

    taken = map_arrow(rows, sparse, "id bigint, quality int, at array<int>, value array<float>").toPandas()
    # rows come in no fixed order; the decomposition sees them in one
    taken["key"] = [np.asarray(a).tobytes() + np.asarray(v).tobytes() for a, v in zip(taken["at"], taken["value"])]
    taken = taken.sort_values(["id", "quality", "key"])
    if not len(taken) or not names:
        return Space([], np.zeros(0), np.zeros((0, 1)), np.zeros((0, 1), np.float32), np.zeros(0))
    idf = np.log((len(taken) + 1) / (df + 0.5)) + 0.1
    table = np.zeros((len(taken), len(names)), np.float32)
    for k, (a, v) in enumerate(zip(taken["at"], taken["value"])):
        table[k, np.asarray(a, dtype=np.int64)] = v
    table *= idf
    directions = _directions(table, min(rank, *table.shape))
    return Space(names, idf, directions, _unit(table @ directions.astype(np.float32)), taken["quality"].to_numpy(dtype=np.float64))


def _directions(table: np.ndarray, rank: int, rounds: int = 4) -> np.ndarray:
    """The first right singular vectors, by subspace iteration from fixed random directions."""
    q = np.random.default_rng(0).standard_normal((table.shape[1], min(rank + 32, *table.shape))).astype(np.float32)
    for _ in range(rounds):
        q, _ = np.linalg.qr(table.T @ (table @ q))
    _, _, right = np.linalg.svd(table @ q, full_matrices=False)
    return (q @ right.T)[:, :rank]


def score(docs: DataFrame, space: Space) -> DataFrame:
    """(doc_id, score) for every row of ``docs(doc_id, text)``."""
    # plain values travel: a broadcast class would need the module on the executors
    held = docs.sparkSession.sparkContext.broadcast(space.parts())

    def start():
        own = Space(*held.value)

        def step(batch):
            return {"doc_id": batch.column("doc_id"), "score": own.score(batch.column("text").to_pylist())}

        return step

    return map_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), start, "doc_id bigint, score double")


def quality(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; learns from labels outside fold 0 of 5 only."""
    space = fit(docs, labels.filter(fold("doc_id", 5) != 0))
    return score(docs, space).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
