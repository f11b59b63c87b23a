"""The batch bronze run: newest landing file of each source, quarantine, bronze
append, contract report and run log.

A source's batch is written under its batch id, good rows and the raw text of bad
ones in one commit (``streaming.ingest.write_split``), so a run that is repeated
after a failure replaces its own batch and adds nothing.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mercato.operators.profile import contract_check
from mercato.sources import files as L
from mercato.streaming import ingest as S

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class BronzeSource:
    """A source that lands as versioned files."""

    name: str
    prefix: str
    extension: str  # csv, or json (envelopes)
    schema: StructType
    required: Sequence[str]
    multiline: bool = False
    data_field: str = "data"


def read_landed(spark: SparkSession, source: BronzeSource, path: str, batch_time: _dt.datetime) -> DataFrame:
    """A landed version as bronze rows with metadata and ``_corrupt_record``."""
    if source.extension == "csv":
        return L.with_ingest_metadata(L.read_csv_bronze(spark, path, source.schema, CORRUPT), "csv", batch_time)
    rows = L.read_json_envelope(spark, path, source.schema, source.data_field, source.multiline)
    return L.with_ingest_metadata(rows, "json_api", batch_time, path_col="_file").withColumn(CORRUPT, F.lit(None).cast("string"))


def run_source(spark: SparkSession, source: BronzeSource, landing: str, warehouse: str, batch_time: _dt.datetime) -> tuple[DataFrame, DataFrame]:
    """Ingest the newest version of a source; (good, bad) rows of all its batches."""
    path = L.latest_path(L.list_landing(spark, landing), source.prefix, source.extension)
    batch = read_landed(spark, source, path, batch_time)
    table = f"{warehouse.rstrip('/')}/bronze/{source.name}"
    S.write_split(batch, table, batch_time.strftime("%Y%m%d%H%M%S"), CORRUPT)
    return S.read_split(spark, table, source.schema, CORRUPT)


def bronze_run(spark: SparkSession, sources: Sequence[BronzeSource], landing: str, warehouse: str, batch_time: _dt.datetime, run_id: str) -> tuple[dict[str, tuple[DataFrame, DataFrame]], DataFrame, DataFrame]:
    """Ingest all sources. Returns the tables by source as (good, bad), the contract
    report and the run log; a source that fails is logged and the others go on."""
    log = f"{warehouse.rstrip('/')}/run_log"

    def note(name: str, status: str, records: int = 0, error: Exception | None = None) -> None:
        began = None if status == "RUNNING" else batch_time
        text, kind = (str(error).split("\n")[0], type(error).__name__) if error else (None, None)
        at = batch_time if began is None else _dt.datetime.now()
        S.append_events(spark, log, [(f"{run_id}-{name}", "bronze_run", "BATCH", status, at, began, records, [name] if records else [], text, kind)])

    tables: dict[str, tuple[DataFrame, DataFrame]] = {}
    report: DataFrame | None = None
    batch_id = batch_time.strftime("%Y%m%d%H%M%S")
    for source in sources:
        note(source.name, "RUNNING")
        try:
            good, bad = run_source(spark, source, landing, warehouse, batch_time)
            checked = contract_check(good.where(F.col("batch") == batch_id), list(source.required)).select(F.lit(source.name).alias("source"), "*")
            report = checked if report is None else report.unionByName(checked)
            tables[source.name] = good, bad
            note(source.name, "SUCCESS", good.where(F.col("batch") == batch_id).count())
        except Exception as e:  # noqa: BLE001 - the failure is what is logged
            note(source.name, "FAILED", error=e)
    if report is None:
        report = spark.createDataFrame([], "source string, column_name string, present boolean, null_count bigint, status string")
    return tables, report, spark.read.parquet(log)
