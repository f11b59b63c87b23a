"""Session construction and cluster-safe defaults."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# What the library relies on wherever it runs, and what a local test session
# needs besides. Only keys that the submitter left unset are filled.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}
_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
}


def submitted_keys() -> set[str]:
    """Configuration keys that the submitter has set: through spark-submit, the
    submit arguments of a Python shell, or the defaults file."""
    keys: set[str] = set()
    if "PYSPARK_GATEWAY_PORT" in os.environ:
        SparkContext._ensure_initialized()
        keys |= {k for k, _ in SparkConf().getAll()}
    args = os.environ.get("PYSPARK_SUBMIT_ARGS", "")
    keys |= set(re.findall(r"--conf[ =]+[\"']?(spark\.[\w.]+)=", args))
    if "--driver-memory" in args:
        keys.add("spark.driver.memory")
    if "--master" in args:
        keys.add("spark.master")
    folder = os.environ.get("SPARK_CONF_DIR") or os.path.join(os.environ.get("SPARK_HOME", ""), "conf")
    defaults = os.path.join(folder, "spark-defaults.conf")
    if os.path.isfile(defaults):
        with open(defaults, encoding="utf-8") as f:
            keys |= set(re.findall(r"^\s*(spark\.[\w.]+)", f.read(), re.MULTILINE))
    return keys


def get_session(master: str | None = None, app: str = "mercato", **conf: str) -> SparkSession:
    """The running session, or a new one. ``master`` and ``conf`` are the
    caller's own wishes; of the defaults only unset keys are filled, and sizes
    (shuffle partitions, driver memory) only for a local master."""
    if SparkSession.getActiveSession() is None:
        preset = submitted_keys()
        builder = SparkSession.builder.appName(app)
        if master:
            builder = builder.master(master)
        local = master is not None and master.startswith("local")
        merged = _DEFAULTS | (_LOCAL_DEFAULTS if local else {})
        merged = {k: v for k, v in merged.items() if k not in preset} | conf
        for k, v in merged.items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = SparkSession.getActiveSession()
        for k, v in conf.items():
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


# Most bytes that a task reads of files or of a shuffle, so that its memory does not
# grow with the input; files are cut for all cores; and partitions of a shuffle
# before small ones are put together.
_TASK_BYTES = {"spark.sql.files.maxPartitionBytes": 32 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20, "spark.sql.files.openCostInBytes": 512 << 10}
_SHUFFLE_PARTITIONS = 1000
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def _bytes(text: str) -> int:
    found = re.fullmatch(r"\s*(\d+)\s*([a-z]*)\s*", str(text).lower())
    return int(found[1]) * _UNITS[found[2]] if found and found[2] in _UNITS else 0


def bounded_tasks(spark: SparkSession) -> None:
    """Small tasks for the queries of this session; settings that are smaller yet
    stay. The number of tasks grows with the input, and not what one of them holds."""
    for key, most in _TASK_BYTES.items():
        now = spark.conf.get(key, None)
        if now is None or _bytes(now) > most:
            spark.conf.set(key, str(most))
    # unset, the shuffle begins with spark.sql.shuffle.partitions
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get(key, None) in (None, "", "0", "<undefined>"):
        spark.conf.set(key, str(max(_SHUFFLE_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))))


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that value
    is used as is. Only when it is unset under a local master a fresh scratch
    folder is created for this process; a cluster without it is an error.
    """
    sc = _context(spark)
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="mercato-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    try:
        spark.conf.set("spark.checkpoint.dir", configured)
    except Exception:  # noqa: BLE001 - static under some deployments; already set then
        pass
    return configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for tables a query writes on its own (lineage cuts,
    landing fixtures). It lives next to the checkpoint directory so that it
    is shared storage on a cluster."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/mercato-{name}-{uuid.uuid4().hex[:12]}"


def stored(df, name: str = "step"):
    """``df`` written as a table next to the checkpoints and read again: the lineage
    is cut reliably and the rows are computed once."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
