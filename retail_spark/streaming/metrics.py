"""What a stream read, kept and dropped, batch by batch (STR-03).

Rows behind the watermark vanish without an error. ``BatchMetrics`` listens to
the progress of queries and keeps, for each batch, the rows read, those that
state operators dropped as late, and whatever the query observes
(``DataFrame.observe``). Late rows are counted by Spark at the operator, so the
figure is exact where that operator gets rows as they came, as a deduplication
does; an aggregation counts its partial rows.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SCHEMA = "query string, run string, batch bigint, input_rows bigint, late_rows bigint, observed map<string,bigint>"


class BatchMetrics(StreamingQueryListener):
    """Rows of ``SCHEMA``, one a batch, of the queries that ran while it listened."""

    def __init__(self) -> None:
        self.batches: dict[tuple[str, int], tuple] = {}
        self.ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        observed = {k: int(v) for row in p.observedMetrics.values() for k, v in row.asDict().items() if v is not None}
        # a batch can report more than once; its last report stands
        self.batches[(str(p.runId), p.batchId)] = (p.name or str(p.id), str(p.runId), p.batchId, p.numInputRows, late, observed)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the reports of ``query``, which has ended, are all here."""
        if not self.ended.setdefault(str(query.runId), threading.Event()).wait(seconds):
            raise TimeoutError(f"no end of query {query.runId} was reported")

    def rows_of(self, query: StreamingQuery) -> list[tuple]:
        return [r for (run, _), r in sorted(self.batches.items()) if run == str(query.runId)]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.batches.values()), SCHEMA)


def run_measured(spark: SparkSession, start) -> list[tuple]:
    """Start a query by ``start()``, wait for its end, and return its batches' rows of ``SCHEMA``."""
    metrics = BatchMetrics()
    spark.streams.addListener(metrics)
    try:
        query = start()
        query.awaitTermination()
        metrics.wait(query)
        return metrics.rows_of(query)
    finally:
        spark.streams.removeListener(metrics)
