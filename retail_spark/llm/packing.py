"""Packing token sequences by cutting-stock column generation.

A document's tokens are cut at multiples of the sequence length; the last
pieces are what must be packed. Their lengths form a histogram with one row a
length, so the plan is made over that, whatever the number of documents:

* the master linear program chooses how often to use each pattern (how many
  pieces of each length share a sequence) so that every piece is used and the
  tokens written, padding included, are fewest;
* a knapsack dynamic program over the dual prices finds the pattern that
  lowers the master's cost most (a column), until none does;
* patterns are used a whole number of times, rounded down, and the few pieces
  left over are packed best-fit by decreasing length.

Pieces of a length are ranked by a two-level count, and rank ranges meet the
patterns' table of ranges: each task places its pieces on its own.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left
from functools import lru_cache
from struct import pack as pack_ids
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from retail_spark.llm.common import binary_column, map_arrow, stash

SEQUENCE = 2048
END_ID = 1
#: Rows of the linear program at most; more lengths share a row with the next lengths above (see ``Plan``).
ROWS = 256
#: Columns generated at most; the plan is whole with any number of them, and close to the optimum long before.
COLUMNS = 4000
#: Pieces of one length that one task ranks.
BUCKET = 20_000


@lru_cache(maxsize=1)
def _tokenizers(path: str) -> tuple:
    """The tokenizer and the one for small letters alone, read once a worker.

    A tokenizer that has encoded text leaves memory behind when it goes, so one
    for each task would make a worker grow with the tasks it runs; encoding by
    several threads keeps words for each of them, and a task has one core.
    """
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    lower = Tokenizer.from_file(path)
    lower.normalizer = normalizers.Sequence([])
    lower.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return Tokenizer.from_file(path), lower


class Encoder(dict):
    """Token ids, as little-endian bytes, of words cut at ASCII white space.

    The tokenizer never joins text across white space, so the ids of a text are
    those of its words one after the other. Words keep their ids while a task
    runs, the rarer ones until ``MOST`` others came; a full stop or comma after a letter or digit is a token of its own.
    ``lower`` is the same tokenizer without its normaliser and its split into
    kinds of characters, for words of small letters in normal form alone.
    """

    MOST = 200_000

    def __init__(self, path: str):
        super().__init__()
        self.older: dict[bytes, bytes] = {}
        self.tokenizer, self.lower = _tokenizers(path)
        self.ends = {c: self._ids(chr(c)) for c in b".,"}
        size = self.tokenizer.get_vocab_size()
        self.word_end = np.array([(self.tokenizer.id_to_token(k) or "").endswith("</w>") for k in range(size)])

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        if len(word) > 1 and word[-1] in self.ends and word[:-1].decode()[-1].lower().isalnum():
            value, keep = self[word[:-1]] + self.ends[word[-1]], len(word) < 9
        elif b"<" not in word and word != (low := word.lower()):
            value, keep = self[low], len(word) < 9
        else:
            value, keep = self._ids(word.decode()), len(word) < 40
        if keep and len(self) < self.MOST:
            self[word] = value
        return value

    def learn(self, words: set[bytes]) -> None:
        """Encode the unknown words, those of letters alone as texts that are cut at the ends of words again."""
        new = words.difference(self)
        if len(self) + len(new) > self.MOST:
            self.older = dict(self)
            self.clear()
            new = words
        known = new.intersection(self.older)
        self.update(zip(known, map(self.older.__getitem__, known)))
        plain, rest = [], []
        for w in new.difference(known):
            (plain if w.isalpha() or w.decode().isalpha() else rest).append(w)
        plain.sort()  # words of a script together
        for k in range(0, len(plain), 2_000):
            some = plain[k : k + 2_000]
            text = b" ".join(some).decode()
            if not (is_normalized("NFC", text) and text.lower().replace(" ", "").isalpha()):
                rest += some
                continue
            # Latin, Greek and Cyrillic, where every release of Unicode in use has the same letters
            tokenizer = self.lower if max(text) < "\u0530" and text == text.lower() else self.tokenizer
            ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = (4 * (np.flatnonzero(self.word_end[ids]) + 1)).tolist()
            assert len(cuts) == len(some)
            whole = ids.tobytes()
            self.update(zip(some, [whole[i:j] for i, j in zip([0, *cuts], cuts)]))
        for w, e in zip(rest, self.tokenizer.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False)):
            self[w] = pack_ids(f"<{len(e.ids)}I", *e.ids)

    #: A full stop or comma that isn't the end of a word of ASCII or Latin-1 letters and digits.
    _ODD = re.compile(rb"[.,](?:(?<![0-9a-z].)(?<!\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].)|(?=[^ \t\n\r\x0b\x0c]))")

    @staticmethod
    def _slices(values: pa.Array, at: np.ndarray | slice = slice(None)) -> list[bytes]:
        """The bytes between the places ``at`` of an array of large strings: each value, if none are given."""
        ends = np.frombuffer(values.buffers()[1], np.int64, len(values) + 1, 8 * values.offset)[at].tolist()
        whole = (values.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
        return [whole[i:j] for i, j in zip(ends, ends[1:])]

    def texts(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of each text: words are cut, counted as distinct and put together again by Arrow."""
        parts = []
        for t in texts:
            t = t or b""
            if b"<|" not in t and not self._ODD.search(t := t.lower()):
                t = t.replace(b".", b" .").replace(b",", b" ,")
            parts.append(t)
        cut = pc.ascii_split_whitespace(pa.array(parts, pa.large_binary()).cast(pa.large_string()))
        words = cut.flatten().dictionary_encode()
        distinct = self._slices(words.dictionary)
        self.learn({w for w in (w.rstrip(b".,") for w in distinct) if w and w == w.lower()})
        ids = pa.array(map(self.__getitem__, distinct), pa.large_binary()).take(words.indices)
        return self._slices(ids, cut.offsets.to_numpy())


def token_pieces(docs: DataFrame, tokenizer: str, *, sequence: int = SEQUENCE, end_id: int = END_ID, row: str | None = None) -> DataFrame:
    """(doc_id, row, start, length, ids_crc32, doc_tokens): each document cut at multiples of ``sequence``."""
    end = np.array([end_id], "<u4").tobytes()

    def start():
        encoder = Encoder(tokenizer)

        def step(batch: pa.RecordBatch) -> dict:
            texts = binary_column(batch, "text")
            out = {k: [] for k in ("doc_id", "row", "start", "length", "ids_crc32", "doc_tokens")}
            for doc, r, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), encoder.texts(texts)):
                ids += end
                n = len(ids) // 4
                for at in range(0, n, sequence):
                    piece = ids[4 * at : 4 * (at + sequence)]
                    for k, v in zip(out, (doc, r, at, len(piece) // 4, zlib.crc32(piece), n)):
                        out[k].append(v)
            return out

        return step

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.col(row) if row else F.xxhash64("text")).alias("row"), "text")
    return map_arrow(rows, start, "doc_id bigint, row bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


def padded(used: int, sequence: int = SEQUENCE) -> int:
    """Tokens written for a sequence with ``used`` tokens: powers of two are not padded."""
    return used if used & (used - 1) == 0 else sequence


class Plan:
    """Patterns over a histogram {length: pieces} of lengths up to ``sequence``.

    Lengths in steps of ``unit`` share a row of the program, counted as the
    largest of the step, so every plan fits; the unit is 1 for a few lengths, 4
    for more, and doubles while there are more than ``rows`` rows. A pattern
    is {row: pieces}; ``uses`` lists (pattern, times).
    """

    def __init__(self, histogram: dict[int, int], sequence: int = SEQUENCE, rows: int = ROWS, columns: int = COLUMNS):
        self.sequence = sequence
        self.unit = 1 if len(histogram) <= rows // 4 or sequence % 4 else 4
        while len({-(-l // self.unit) for l in histogram}) > rows:
            self.unit *= 2
        self.capacity = sequence // self.unit
        need: dict[int, int] = {}
        for l, n in histogram.items():
            need[-(-l // self.unit)] = need.get(-(-l // self.unit), 0) + n
        self.size = np.array(sorted(need), dtype=np.int64)
        self.need = np.array([need[s] for s in self.size.tolist()], dtype=np.int64)
        self.columns_made = 0
        self.uses = self._solve(columns) if len(self.size) else []

    def _cost(self, units: int) -> int:
        return padded(units * self.unit, self.sequence)

    def _price(self, prices: np.ndarray) -> tuple[float, np.ndarray]:
        """The pattern with the largest price above its cost, by dynamic programming over filled units."""
        best = np.full(self.capacity + 1, -np.inf)
        best[0], last = 0.0, np.zeros(self.capacity + 1, dtype=np.int64)
        upto = np.searchsorted(self.size, np.arange(self.capacity + 1), side="right")
        for c in range(int(self.size[0]), self.capacity + 1):
            k = upto[c]
            value = best[c - self.size[:k]] + prices[:k]
            j = int(value.argmax())
            best[c], last[c] = value[j], j
        gain = best - self.costs
        c = int(gain[1:].argmax()) + 1
        found, pattern = float(gain[c]), np.zeros(len(self.size))
        while c > 0:
            pattern[last[c]] += 1
            c -= int(self.size[last[c]])
        return found, pattern

    def _solve(self, columns: int) -> list[tuple[dict[int, int], int]]:
        m = len(self.size)
        self.costs = np.array([0.0] + [self._cost(c) for c in range(1, self.capacity + 1)])
        # the first basis: sequences of one length each
        copies = np.minimum(self.capacity // self.size, self.need)
        patterns = [dict([(k, int(n))]) for k, n in enumerate(copies)]
        cost = np.array([self._cost(int(n * s)) for n, s in zip(copies, self.size)], dtype=float)
        inverse, x = np.diag(1.0 / copies), self.need / copies
        for _ in range(columns):
            gain, column = self._price(cost @ inverse)
            if gain <= 1e-4 * self.sequence:
                break
            step = inverse @ column
            rising = np.flatnonzero(step > 1e-9)
            ratio = x[rising] / step[rising]
            out = int(rising[ratio.argmin()])
            x -= ratio.min() * step
            x[out] = ratio.min()
            x = np.maximum(x, 0)
            row = inverse[out] / step[out]
            inverse -= np.outer(step, row)
            inverse[out] = row
            patterns[out] = {int(k): int(column[k]) for k in np.flatnonzero(column)}
            cost[out] = self._cost(int(column @ self.size))
            self.columns_made += 1
        self.bound = float(cost @ x)
        left, uses = self.need.copy(), []
        for p in np.argsort(-x):
            pattern = patterns[p]
            times = min(int(x[p] + 1e-6), *(int(left[k] // n) for k, n in pattern.items()))
            if times > 0:
                uses.append((pattern, times))
                for k, n in pattern.items():
                    left[k] -= n * times
        return uses + [(p, 1) for p in self._best_fit(left)]

    def _best_fit(self, left: np.ndarray) -> list[dict[int, int]]:
        """Sequences for the pieces that rounding leaves, largest first into the fullest that has room."""
        if int((left * self.size).sum()) > 64 * self.capacity * max(1, len(self.size)):
            raise AssertionError("rounding leaves less than one use of each pattern")
        rooms: list[tuple[int, int]] = []
        made: list[dict[int, int]] = []
        for k in range(len(self.size) - 1, -1, -1):
            size = int(self.size[k])
            for _ in range(int(left[k])):
                at = bisect_left(rooms, (size, -1))
                if at < len(rooms):
                    room, which = rooms.pop(at)
                else:
                    room, which = self.capacity, len(made)
                    made.append({})
                made[which][k] = made[which].get(k, 0) + 1
                if room > size:
                    entry = (room - size, which)
                    rooms.insert(bisect_left(rooms, entry), entry)
        return made

    def ranges(self) -> list[tuple[int, int, int, int, int]]:
        """(row, first rank, pieces a sequence, sequences, first sequence): which ranks of a row each pattern takes."""
        out, used, sequence = [], dict.fromkeys(range(len(self.size)), 0), 0
        for pattern, times in self.uses:
            for k, n in sorted(pattern.items(), reverse=True):
                out.append((int(self.size[k]), used[k], n, times, sequence))
                used[k] += n * times
            sequence += times
        return out


RANGES = T.StructType([T.StructField(n, T.LongType(), False) for n in ("units", "first", "each", "times", "base")])


def place(pieces: DataFrame, *, sequence: int = SEQUENCE, rows: int = ROWS, columns: int = COLUMNS) -> DataFrame:
    """``pieces`` with sequence_id and offset added: every piece in exactly one sequence, gapless from 0."""
    spark = pieces.sparkSession
    # at most ``sequence`` rows reach the driver, however many pieces there are
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = Plan(histogram, sequence, rows, columns)
    parts = 1 + max(histogram.values(), default=0) // BUCKET
    ranked = pieces.withColumn("units", F.ceil(F.col("length") / F.lit(plan.unit)).cast("bigint"))
    ranked = ranked.withColumn("part", F.pmod(F.xxhash64("doc_id", "row", "start"), F.lit(parts)).cast("int"))
    sizes = ranked.groupBy("units", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("units").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("units").alias("u"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base_rank"))
    inside = Window.partitionBy("units", "part").orderBy("doc_id", "row", "start")
    ranked = ranked.withColumn("in_part", F.row_number().over(inside) - 1)
    ranked = ranked.join(sizes, (F.col("units") == F.col("u")) & (F.col("part") == F.col("p")))
    ranked = ranked.withColumn("rank", F.col("base_rank") + F.col("in_part")).drop("u", "p", "base_rank", "in_part", "part")
    # ranges of a length follow one another: find a rank's range by binary search in a table bounded by the program's size
    table: dict[int, list] = {}
    for units, first, each, times, base in plan.ranges():
        table.setdefault(units, []).append((first, each, times, base))
    held = spark.sparkContext.broadcast({u: tuple(np.array(x, dtype=np.int64) for x in zip(*v)) for u, v in table.items()})

    def sequences(batches):
        for batch in batches:
            units = batch.column(batch.schema.get_field_index("units")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            out = np.zeros(len(units), dtype=np.int64)
            for u in np.unique(units).tolist():
                first, each, _, base = held.value[u]
                mine = np.flatnonzero(units == u)
                at = np.searchsorted(first, rank[mine], side="right") - 1
                out[mine] = base[at] + (rank[mine] - first[at]) // each[at]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, "sequence_id"])

    schema = T.StructType([*ranked.schema.fields, T.StructField("sequence_id", T.LongType())])
    placed = ranked.mapInArrow(sequences, schema)
    so_far = (Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "row", "start")
              .rowsBetween(Window.unboundedPreceding, -1))
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(so_far), F.lit(0))).drop("units", "rank")


def pack(docs: DataFrame, tokenizer: str, *, sequence: int = SEQUENCE, end_id: int = END_ID, row: str | None = None) -> DataFrame:
    """One row per piece: doc_id, row, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``docs`` needs doc_id and text; the ids of a text (null and empty: none)
    are followed by ``end_id``. ``row`` names a column that tells rows apart
    that share a doc_id; by default it is a hash of the text, and rows alike in
    both are packed separately all the same. Other columns are ignored. A text
    longer than a sequence is cut at its multiples. An empty table gives an
    empty result.
    """
    return place(stash(token_pieces(docs, tokenizer, sequence=sequence, end_id=end_id, row=row), "pieces"), sequence=sequence)
