"""What every query needs of its session: the package on the executors and tables that outlive a lost executor."""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Bytes of rows that go to Python at once.
MOVED = 4 << 20
#: No checksum file beside each file of a local folder (parquet has checksums of its own). Hadoop starts a process for the mode of
#: every local file, and until that process runs its own program, it counts as another copy of the executor's memory.
_PLAIN = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
_PACKAGE = Path(__file__).resolve().parent
_shipped: set[str] = set()
_written: list[tuple[SparkSession, str]] = []
_at_exit: list[bool] = []


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once an application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(_PACKAGE.rglob("*.py")):
            out.write(path, path.relative_to(_PACKAGE.parent))
    folder = tempfile.mkdtemp(prefix="tracemill-ship-")
    archive = os.path.join(folder, "tracemill-package.zip")
    Path(archive).write_bytes(buffer.getvalue())
    spark.sparkContext.addPyFile(archive)  # the driver serves it; executors that join later fetch it too
    atexit.register(shutil.rmtree, folder, True)
    _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or a folder of our own where that is unset on one machine (tests)."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="tracemill-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
        atexit.register(shutil.rmtree, path.removeprefix("file://"), True)
    return path


def stable(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**_PLAIN).parquet(path)
    _written.append((spark, path))
    if not _at_exit:  # registered after Spark's own hook, so it runs before that
        _at_exit.append(True)
        atexit.register(_release_all)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete what stable() wrote for this session; results that still read it become invalid."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for owner, path in [x for x in _written if x[0] is spark]:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
        _written.remove((owner, path))


def _release_all() -> None:
    for spark in list({id(s): s for s, _ in _written}.values()):
        try:
            release(spark)
        except Exception:  # the session has ended: whoever owns the shared folder clears it
            _written[:] = [x for x in _written if x[0] is not spark]


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows go to Python a few MB at a time; what is run inside has this setting."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(MOVED))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def parallelism(spark: SparkSession) -> int:
    """Partitions for a shuffle that adaptive execution mustn't merge."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
