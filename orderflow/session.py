"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a job of this package wants; a cluster may override every one of them.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # of a repeated key in a JSON document the last value counts
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # the generated code of the event classification is large; let the JVM compile it
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def build_session(app: str = "orderflow", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    A machine-local folder is only ever used by a local session that has none configured.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    local = getattr(shared_dir, "_local", None)
    if local is None:
        local = shared_dir._local = tempfile.mkdtemp(prefix="orderflow-")
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    path = f"{shared_dir(spark)}/orderflow/{name}-{uuid.uuid4().hex}"
    if _passing:
        _passing[-1].append(path)
    return path


#: The scratch paths made in each ``passing_scratch`` that is open.
_passing: list[list[str]] = []


@contextmanager
def passing_scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are emptied at the end, so results must have been written elsewhere by then."""
    _passing.append([])
    try:
        yield
    finally:
        for path in _passing.pop():
            spark.createDataFrame([], "nothing int").write.mode("overwrite").parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of any executor."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table that several steps of one job read, and read it back.

    Each reader then scans only its columns, and a lost executor costs no recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
