"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, tempfile.TemporaryDirectory] = {}
_SCOPES: list[list[str]] = []


def local_session(cpus: int | str = "*", app: str = "tillroll", **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder the cluster names in ``spark.checkpoint.dir``.
    Where that is unset a local session gets a temporary folder; on a cluster, whose
    executors would each write to a disk of their own, that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_SCRATCH:
            folder = tempfile.TemporaryDirectory(prefix="tillroll-", ignore_cleanup_errors=True)
            _LOCAL_SCRATCH[app] = folder  # goes with the process
        base = _LOCAL_SCRATCH[app].name
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    for scope in _SCOPES:
        scope.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession, keep: Callable[[str], bool] = lambda purpose: False):
    """Scratch folders made inside the block are deleted when it ends, except those whose
    purpose ``keep`` accepts. What the block returns must not read the others."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        del _SCOPES[next(i for i, x in enumerate(_SCOPES) if x is made)]  # others may hold the same
        for path in made:
            if not keep(path.rsplit("/", 1)[-1].rsplit("-", 1)[0]):
                folder = spark._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once below the scratch folder and read it back.

    Used where several branches of a plan start from the same aggregate of the fact
    table: the fact is then scanned once, the file sizes give Spark a true estimate of
    what it may broadcast, and a lost executor costs no recomputation.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_limit(spark: SparkSession) -> int:
    """Up to how many bytes this session broadcasts on its own; the smaller one if it has a
    limit for adaptive execution as well; -1 for never."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    found = [spark.conf.get(name, None) for name in names]
    parse = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    limits = [-1 if v.startswith("-") else parse(v) for v in found if v and v[-1:] != ">"]
    return min(limits, default=SMALL_BYTES)


#: What counts as small: Spark's default limit for broadcasting on its own.
SMALL_BYTES = 10 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Spark's size estimate for ``df`` (no job is run); None where it is not on offer."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:
        return None


def is_small(df: DataFrame, limit: int = SMALL_BYTES) -> bool:
    """Whether the estimate is known and within ``limit``. Unknown counts as large."""
    size = estimated_bytes(df)
    return size is not None and size <= limit
