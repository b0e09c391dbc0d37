"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

1. Counts over the training sample say which words and word beginnings stand
   in toxic texts far oftener than in others, or far more rarely; they become
   voters of toxic and of clean (lexicon words and prefix patterns, beside a
   few fixed surface patterns).
2. The label model explains all voters' firings by one hidden label: each
   voter has a rate of firing on toxic and on clean texts, found by expectation
   maximisation, where given labels steer the start and are one more voter
   with estimated rates. Voters that fire together more than their rates explain
   are correlated; their evidence is shared instead of counted several times.
3. A logistic classifier on words and word beginnings learns the posterior
   labels, so it also catches spellings that no voter has.

Only the sample's counts of telling signs and sparse rows reach the driver;
``SAMPLE`` bounds both, and every sign with enough evidence takes part. Scoring
reads every whole text once, without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from retail_spark.llm.common import bound_batches, fold, free_name, give_back, map_arrow

#: Labelled rows that a model learns from, at most; taken by a hash of the id.
SAMPLE = 16_000
#: Characters of the word beginnings that serve as patterns.
PREFIXES = (4, 5, 6)
#: Fewest training texts that a voter or feature must stand in, and the least likelihood ratio statistic that it must
#: have: by chance, one sign in a thousand has 11.
SUPPORT, EVIDENCE = 4, 12.0
#: Log ratio of a sign's shares of toxic and of clean texts from which it is a voter.
LIFT = 1.0

_WORD = re.compile(r"[^\W_]+")
#: Surface patterns, each a voter and a feature.
_SURFACE = {"<shout>": re.compile(r"\b[^\W\d_a-z]{4,}!"), "<bangs>": re.compile(r"!{2,}"), "<masked>": re.compile(r"[^\W\d_][*#@$]{2,}[^\W\d_]")}


def _words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def signs(text: str | None) -> set[str]:
    """Words, word beginnings (with a trailing hyphen) and surface patterns of a whole text."""
    if not text:
        return set()
    words = _words(text)
    out = set(words)
    for n in PREFIXES:
        out.update([w[:n] + "-" for w in words if len(w) >= n])
    out.update(name for name, pattern in _SURFACE.items() if pattern.search(text))
    return out


class LabelModel:
    """A hidden label behind voters that fire or abstain, with shared evidence for correlated ones.

    Expectation maximisation estimates for each voter its rates of firing on
    toxic and on clean texts, and in every round the correlations that the
    label leaves between voters; a voter's evidence is shared with the voters
    it goes along with. A given label is one more voter, whose rates
    are estimated like the others' (``given``: toxic given on toxic, on clean).
    ``side`` is 1 for voters of toxic, -1 for voters of clean.
    """

    #: Correlation from which voters share their evidence.
    COMPANY = 0.3
    #: What is assumed of given labels before any is seen: so many on either side, nine in ten of them right.
    ASSUMED = 10.0

    def __init__(self, fires: np.ndarray | list[np.ndarray], known: np.ndarray, rounds: int = 30, side: np.ndarray | None = None):
        """``fires`` is (texts, voters) of 0/1, or each text's firing voters; ``known`` holds 1, 0 or nan a text."""
        if isinstance(fires, np.ndarray):
            side = np.ones(fires.shape[1]) if side is None else side
            fires = [np.flatnonzero(x) for x in fires]
        n, v = len(fires), len(side)
        at, col = np.repeat(np.arange(n), [len(x) for x in fires]), np.concatenate([*fires, np.zeros(0, int)]).astype(int)
        seen, toxic = ~np.isnan(known), known == 1
        prior = float(np.clip(known[seen].mean() if seen.any() else 0.1, 0.01, 0.99))
        start = np.bincount(at, side[col], n) / max(v, 1)
        q = np.where(seen, known, prior) if seen.any() else np.clip(start, 0.01, 0.99)
        together = self._together(fires, v)
        few = np.where(side > 0, 0.02, 0.5)  # what is added to the counts: little where a voter should be silent
        for _ in range(rounds):
            t, c = q.sum(), (1 - q).sum()
            on1, on0 = np.bincount(col, q[at], v), np.bincount(col, (1 - q)[at], v)
            self.rate1, self.rate0 = (on1 + 0.52 - few) / (t + 1), (on0 + few) / (c + 1)
            self.prior = np.clip(q.mean(), 1e-3, 1 - 1e-3)
            self._correlate(together, on1, on0, q)
            odds = self._odds(at, col, n)
            # given labels are judged by what the other voters decide: by a posterior that holds them they would judge themselves
            others = odds > 0
            known1 = ((others & toxic).sum() + 0.9 * self.ASSUMED) / ((others & seen).sum() + self.ASSUMED)
            known0 = ((~others & toxic).sum() + 0.1 * self.ASSUMED) / ((~others & seen).sum() + self.ASSUMED)
            self.given = (float(known1), float(known0))
            odds += np.where(seen, np.where(toxic, np.log(known1 / known0), np.log((1 - known1) / (1 - known0))), 0)
            new = np.clip(1 / (1 + np.exp(-np.clip(odds, -30, 30))), 1e-6, 1 - 1e-6)
            if np.abs(new - q).max() < 1e-4:
                break
            q = new
        self.labels = q

    @staticmethod
    def _together(fires: list[np.ndarray], voters: int) -> np.ndarray:
        """How many texts each two voters fire in together."""
        out = np.zeros((voters, voters), np.float32)
        for k in range(0, len(fires), 1000):
            some = np.zeros((min(1000, len(fires) - k), voters), np.float32)
            for row, x in zip(some, fires[k : k + 1000]):
                row[x] = 1
            out += some.T @ some
        return out

    def _correlate(self, together: np.ndarray, on1: np.ndarray, on0: np.ndarray, q: np.ndarray) -> None:
        """Correlation left between voters once the label is known; each voter's weight is one by its company."""
        r1, r0 = self.rate1, self.rate0
        a, b, c = (q ** 2).sum(), (q * (1 - q)).sum(), ((1 - q) ** 2).sum()

        def left(rows, cols):
            """Sums over texts of the product of what the rates don't explain, from the counts alone."""
            fitted = r1[rows] * on1[cols] + r0[rows] * on0[cols] + on1[rows] * r1[cols] + on0[rows] * r0[cols]
            return a * r1[rows] * r1[cols] + b * (r1[rows] * r0[cols] + r0[rows] * r1[cols]) + c * r0[rows] * r0[cols] - fitted

        every = np.arange(len(r1))
        scale = np.sqrt(np.maximum(np.diag(together) + left(every, every), 1e-12))
        company = np.ones(len(r1))
        for k in range(0, len(r1), 256):
            rows = every[k : k + 256, None]
            found = (together[k : k + 256] + left(rows, every[None])) / (scale[rows] * scale[None])
            company[k : k + 256] = np.where(found > self.COMPANY, found, 0).sum(axis=1)
        self.share = 1.0 / np.maximum(1.0, company)

    def _odds(self, at: np.ndarray, col: np.ndarray, texts: int) -> np.ndarray:
        """Log odds of toxic by the voters, those that abstain included."""
        on = np.log(self.rate1 / self.rate0) * self.share
        off = np.log((1 - self.rate1) / (1 - self.rate0)) * self.share
        return np.log(self.prior / (1 - self.prior)) + off.sum() + np.bincount(at, (on - off)[col], texts)


class Logistic:
    """Logistic regression on sparse binary rows and soft labels, by averaged gradient steps (Adam)."""

    def __init__(self, rows: list[np.ndarray], labels: np.ndarray, features: int, epochs: int = 60, decay: float = 1e-5):
        at = np.concatenate([np.full(len(r), k) for k, r in enumerate(rows)]) if rows else np.zeros(0, int)
        col = np.concatenate(rows).astype(int) if rows else np.zeros(0, int)
        w, bias = np.zeros(features), float(np.log(np.clip(labels.mean(), 0.01, 0.99) / (1 - np.clip(labels.mean(), 0.01, 0.99))))
        m, s = np.zeros(features + 1), np.zeros(features + 1)
        # toxic and clean texts weigh the same in sum
        weight = np.where(labels > 0.5, 0.5 / max(labels.mean(), 1e-3), 0.5 / max(1 - labels.mean(), 1e-3))
        for t in range(1, epochs * 4 + 1):
            p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(at, w[col], len(rows)), -30, 30)))
            error = weight * (p - labels) / len(rows)
            grad = np.append(np.bincount(col, error[at], features) + decay * w, error.sum())
            m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad ** 2
            step = 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.99 ** t)) + 1e-8)
            w, bias = w - step[:-1], bias - step[-1]
        self.weights, self.bias = w, bias


class ToxicityModel:
    """Weights of signs; ``score`` is the classifier's probability."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self.begin = {n: {s[:-1]: w for s, w in weights.items() if s[-1] == "-" and len(s) == n + 1} for n in PREFIXES}
        self.surface = [(_SURFACE[s], w) for s, w in weights.items() if s in _SURFACE]

    def score(self, text: str | None) -> float:
        odds = self.bias
        if text:
            words = _words(text)
            found = [self.weights[w] for w in words & self.weights.keys()]
            for n, of in self.begin.items():
                found += [of[s] for s in {w[:n] for w in words} & of.keys()]
            found += [w for pattern, w in self.surface if pattern.search(text)]
            odds += sum(sorted(found))
        return float(1 / (1 + np.exp(-np.clip(odds, -30, 30))))


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic) of at most ``sample`` labelled documents, chosen by a hash of doc_id.

    An id with labels that disagree counts as toxic. The chosen ids are few
    enough to send to every task, so the texts need no shuffle.
    """
    chosen = (labels.filter("doc_id is not null and toxic is not null")
              .groupBy(F.col("doc_id").cast("bigint").alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
              .orderBy(F.xxhash64("id"), "id").limit(sample))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text").filter("text is not null")
    return texts.join(F.broadcast(chosen), "id").select("text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> ToxicityModel:
    """A model learned from the labelled rows given; without any, every text scores 0.

    ``docs`` needs doc_id and text, ``labels`` doc_id and toxic (0/1).
    """
    rows = training_sample(docs, labels, sample)

    def count():
        def step(batch):
            toxic, clean = Counter(), Counter()
            totals = [0, 0]
            for text, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                (toxic if t else clean).update(signs(text))
                totals[1 if t else 0] += 1
            names = list(toxic.keys() | clean.keys())
            return {"sign": [*names, ""], "toxic": [*(toxic[n] for n in names), totals[1]], "clean": [*(clean[n] for n in names), totals[0]]}

        return step

    counts = map_arrow(rows, count, "sign string, toxic bigint, clean bigint").groupBy("sign").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    total = counts.filter("sign = ''").first()
    if total is None or not total["toxic"]:
        return ToxicityModel({}, -30.0)
    toxic, clean = float(total["toxic"]), float(total["clean"])
    lift = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    # twice the log likelihood ratio of a sign's texts against the sample's share of toxic ones
    both, share = F.col("toxic") + F.col("clean"), toxic / (toxic + clean)
    power = 2 * sum((F.col(n) * F.log(F.greatest(F.col(n), F.lit(1)) / (both * F.lit(max(q, 1e-9)))) for n, q in (("toxic", share), ("clean", 1 - share))), F.lit(0.0))
    strong = (counts.filter(f"sign <> '' and toxic + clean >= {SUPPORT}").withColumn("lift", lift).withColumn("power", power)
              .filter(F.col("power") >= EVIDENCE).orderBy(F.desc("power"), "sign").collect())
    names = [r["sign"] for r in strong]
    voting = [k for k, r in enumerate(strong) if abs(r["lift"]) > LIFT]
    index = {n: k for k, n in enumerate(names)}

    def sparse():
        def step(batch):
            found = [sorted(index[s] for s in signs(t) & index.keys()) for t in batch.column(0).to_pylist()]
            return {"signs": pa.array(found, pa.list_(pa.int32())), "toxic": batch.column(1)}

        return step

    taken = map_arrow(rows, sparse, "signs array<int>, toxic int").toPandas()
    taken["signs"] = taken["signs"].map(lambda x: np.asarray(x, dtype=np.int64))
    # the rows come in no fixed order; sums are made in one
    taken["key"] = [(x.tobytes(), t) for x, t in zip(taken["signs"], taken["toxic"])]
    taken = taken.sort_values("key")
    lists, known = list(taken["signs"]), taken["toxic"].to_numpy(dtype=float)
    place = np.full(len(names) + 1, -1)
    place[voting] = np.arange(len(voting))
    fires = [votes[votes >= 0] for votes in (place[x] for x in lists)]
    model = LabelModel(fires, known, side=np.sign([strong[k]["lift"] for k in voting]))
    linear = Logistic(lists, model.labels, len(names))
    return ToxicityModel({n: float(linear.weights[k]) for n, k in index.items() if abs(linear.weights[k]) > 1e-3}, linear.bias)


def score(docs: DataFrame, model: ToxicityModel, name: str = "score") -> DataFrame:
    """``docs`` with one more column ``name`` (double): the model's score of ``text``.

    Null and empty texts have no sign and score what the bias alone gives
    (a clean text's score). All columns are kept; the whole text counts.
    """
    # plain values travel: a broadcast class would need the module on the executors
    held = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    fields = [f.simpleString().split(":", 1) for f in docs.schema.fields]
    schema = ", ".join(f"`{n}` {t}" for n, t in fields) + f", `{name}` double"

    def run(batches):
        model = ToxicityModel(*held.value)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            scores = pa.array([model.score(t) for t in batch.column(at).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, name])
        give_back()

    bound_batches(docs.sparkSession)
    return docs.mapInArrow(run, schema)


def train_side(labels: DataFrame, parts: int = 5) -> DataFrame:
    """The labels that a model may learn from: those whose id is not in fold 0."""
    return labels.filter(fold("doc_id", parts) != 0)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Learns from labels outside fold 0 of 5 only. Rows with a null doc_id are
    held out; repeated rows score alike; an empty table gives an empty result.
    """
    model = fit(docs, train_side(labels))
    return (score(docs.select("doc_id", "text"), model)
            .select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def keep_clean(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    model = fit(docs, train_side(labels))
    name = free_name(docs, "toxicity_score")
    return score(docs, model, name).filter(F.col(name) < threshold).select(*docs.columns)
