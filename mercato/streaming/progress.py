"""Progress of streaming queries as rows of the run log, one per micro-batch.

A listener receives what Spark reports about each micro-batch (a query itself
keeps the last hundred only) and appends it to a parquet table next to the run
log: batch id, rows, input rate, process rate and latency. Rows are held in a
small buffer on the driver, so the log has few files however many batches run.
"""

from __future__ import annotations

import math
import threading
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

# The columns of the progress log.
PROGRESS_SCHEMA = (
    "run_id string NOT NULL, query_name string, batch_id bigint NOT NULL, rows bigint, input_rows_per_second double, "
    "processed_rows_per_second double, latency_ms bigint, at timestamp NOT NULL"
)
# Rows that the driver holds before it writes them.
FLUSH_ROWS = 1000


def _finite(x: float | None) -> float | None:
    return x if x is not None and math.isfinite(x) else None


class ProgressLog(StreamingQueryListener):
    """Appends a row per micro-batch of every query of the session to ``path``."""

    def __init__(self, spark: SparkSession, path: str, flush_rows: int = FLUSH_ROWS):
        super().__init__()
        self.spark, self.path, self.flush_rows = spark, path, flush_rows
        self.rows: list[tuple] = []
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        at = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
        row = (
            str(p.runId), p.name, p.batchId, p.numInputRows, _finite(p.inputRowsPerSecond),
            _finite(p.processedRowsPerSecond), p.durationMs.get("triggerExecution"), at,
        )
        with self.changed:
            self.rows.append(row)
            full = len(self.rows) >= self.flush_rows
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def flush(self) -> None:
        with self.changed:
            rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def wait(self, run_id: str, seconds: float = 120.0) -> None:
        """Until the rows of a finished run are written."""
        with self.changed:
            if not self.changed.wait_for(lambda: run_id in self.ended, seconds):
                raise TimeoutError(f"no end of run {run_id} was reported")

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)
        self.flush()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The progress log, the last report of each batch that had rows."""
    last = Window.partitionBy("run_id", "batch_id").orderBy(F.desc("at"))
    rows = spark.read.parquet(path).where("rows > 0")
    return rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def rates_agree(tolerance: float = 0.05) -> Column:
    """Whether the process rate of a batch is its rows over its latency. Spark
    measures both; a millisecond more or less is allowed beyond the tolerance."""
    rate = F.col("rows") * 1000.0 / F.greatest(F.col("latency_ms"), F.lit(1))
    slack = F.lit(tolerance) + F.lit(2.0) / F.greatest(F.col("latency_ms"), F.lit(1))
    return F.abs(rate - F.col("processed_rows_per_second")) <= slack * F.greatest(rate, F.col("processed_rows_per_second"))


def run_summary(progress: DataFrame) -> DataFrame:
    """Per run: batches, rows, mean rates and the latencies' median and maximum."""
    return progress.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("rows").alias("rows"),
        F.avg("input_rows_per_second").alias("mean_input_rate"),
        F.avg("processed_rows_per_second").alias("mean_process_rate"),
        F.percentile_approx("latency_ms", 0.5).alias("median_latency_ms"),
        F.max("latency_ms").alias("max_latency_ms"),
    )
