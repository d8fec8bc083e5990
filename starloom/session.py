"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_scope: ContextVar[str | None] = ContextVar("scratch scope", default=None)
_shipped: set[str] = set()

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("starloom")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Needed where it is not installed on them; functions that run in Python
    workers import it by name.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(__file__).resolve().parent
    if root.parent.suffix != ".zip":
        archive = Path(tempfile.mkdtemp(prefix="starloom-code-")) / "starloom_code.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, file.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A scope whose written intermediate tables are deleted at its end, also after a failure.

    Write results elsewhere inside the scope: what reads them lazily reads the
    intermediate tables too.
    """
    path = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    token = _scope.set(path)
    try:
        yield path
    finally:
        _scope.reset(token)
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a folder of its own.
    """
    if _scope.get():
        return _scope.get()
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="starloom-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/starloom-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Unlike cached blocks the table outlives lost executors, and later readers
    still prune its columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_bucketed(df: DataFrame, keys: list[str], buckets: int, order: list[str] | None = None) -> tuple[DataFrame, str]:
    """Like ``materialise``, bucketed by key: later steps by key need no shuffle.

    Returns the table and its name in the catalog; drop it when it is no longer
    read. Files stay in the shared folder.
    """
    spark = df.sparkSession
    name = f"starloom_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*(order or keys))
    writer.option("path", f"{scratch_dir(spark)}/{name}").saveAsTable(name)
    return spark.table(name), name
