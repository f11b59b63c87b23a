"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.session import ensure_checkpoint_dir, scratch_dir

#: Words of the text operators: runs without ASCII white space.
WORD_BREAK = r"[\x20\x09-\x0D]+"


class Memo(dict):
    """A bounded memo of a pure function: emptied when full, so that a worker's
    memory stays bounded whatever the number of distinct keys."""

    def __init__(self, fn: Callable, most: int = 300_000):
        super().__init__()
        self.fn, self.most = fn, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.fn(key)
        return value


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator needs, null text as empty text; whatever
    other columns ``docs`` has cannot clash with what the operator adds."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


Batches = Iterator[pa.RecordBatch]

#: How the memos that outlive a task are emptied, and the stage that filled them.
_KEPT_MEMOS: list[Callable[[], object]] = []
_FILLED_BY: list[int] = []


def kept_in_stage(empty: Callable[[], object]) -> None:
    """Has ``empty``, which drops a memo of this worker, called when the worker begins
    with another stage: within one its tasks share the memo."""
    _KEPT_MEMOS.append(empty)


def begin_stage(stage: int) -> None:
    if _FILLED_BY and _FILLED_BY[-1] != stage:
        for empty in _KEPT_MEMOS:
            empty()
        give_back()
    _FILLED_BY[:] = [stage]


def give_back() -> None:
    """Return to the system what has been freed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def gives_back(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run``, the work of a task; before it the worker drops the memos of another
    stage, behind it it returns to the system what it has freed. Workers are reused,
    and without this the largest batch and memo of every stage before would stay with them."""

    @wraps(run)
    def task(batches: Batches) -> Batches:
        context = TaskContext.get()
        if context is not None:
            begin_stage(context.stageId())
        yield from run(batches)
        give_back()

    return task


def arrow_rows(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """``df`` batch by batch through the function that ``make()`` builds once per
    task (compiled tables and memos live as long as the task)."""

    @gives_back
    def run(batches: Batches) -> Batches:
        fn = make()
        for b in batches:
            if b.num_rows:
                yield fn(b)

    return df.mapInArrow(run, schema)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage reliably: into the shared checkpoint folder; partitions stay."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage reliably: written as a table into the shared checkpoint folder
    and read again. The rows are computed once, and plans stay small."""
    path = shared_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, path: str) -> None:
    """Delete a table of this run that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def free_name(taken: list[str], name: str) -> str:
    """``name``, with ``_`` behind it until no column of ``taken`` has it."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name += "_"
    return name


#: Where ``shared_path`` notes the paths it gives out, while a caller wants to know.
_NOTED: list[list[str]] = []


@contextmanager
def noted_paths() -> Iterator[list[str]]:
    """The list of the shared paths given out within the block."""
    paths: list[str] = []
    _NOTED.append(paths)
    try:
        yield paths
    finally:
        _NOTED.remove(paths)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    path = scratch_dir(spark, name)
    for paths in _NOTED:
        paths.append(path)
    return path
