"""What a Python worker holds doesn't grow with the tasks it runs, nor with the texts of a task."""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import functions as F

from retail_spark.llm import packing, toxicity
from retail_spark.llm.common import MAX_BATCH_BYTES, map_arrow
from retail_spark.llm.queries import tokenizer_path


def test_tasks_share_a_workers_tokenizers():
    first, second = packing.Encoder(tokenizer_path()), packing.Encoder(tokenizer_path())
    assert first.tokenizer is second.tokenizer and first.lower is second.lower
    assert not second.older and len(second) < 10  # words are a task's own


def test_ids_stay_when_words_are_forgotten(monkeypatch):
    """Few words are kept, so they are encoded again and again; the ids are the tokenizer's own."""
    monkeypatch.setattr(packing.Encoder, "MOST", 40)
    r = random.Random(5)
    texts = [" ".join(r.choice(("Word", "été,", "a.b.", "<|x|>", "ß", "中文", "it's")) + str(r.randrange(30)) for _ in range(40)) for _ in range(60)]
    encoder = packing.Encoder(tokenizer_path())
    found = [ids for k in range(0, 60, 10) for ids in encoder.texts([t.encode() for t in texts[k : k + 10]])]
    assert found == [encoder._ids(t) for t in texts]


def test_a_worker_gets_few_texts_at_once(spark):
    spark.conf.unset(MAX_BATCH_BYTES)

    def start():
        return lambda batch: {"n": pa.array([batch.num_rows])}

    rows = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab cd ef "), 2000).alias("text"))
    got = map_arrow(rows, start, "n bigint").collect()
    assert sum(r["n"] for r in got) == 3000
    # without the bound three slices of 1,000 rows come, of one batch of 54 MB
    assert max(r["n"] for r in got) < 1000

    spark.conf.unset(MAX_BATCH_BYTES)
    model = toxicity.ToxicityModel({"ab": 1.0}, -2.0)
    scored = toxicity.score(rows, model).select("doc_id", "score").collect()
    assert len(scored) == 3000 and len({r["score"] for r in scored}) == 1
    assert spark.conf.get(MAX_BATCH_BYTES) == "8m"


def test_a_sessions_own_limit_stays(spark):
    spark.conf.set(MAX_BATCH_BYTES, "1m")
    try:
        map_arrow(spark.range(3), lambda: lambda batch: {"id": batch.column(0)}, "id bigint").collect()
        assert spark.conf.get(MAX_BATCH_BYTES) == "1m"
    finally:
        spark.conf.unset(MAX_BATCH_BYTES)
