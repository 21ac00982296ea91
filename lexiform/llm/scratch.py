"""Tables that cut lineage, kept in the folder that the cluster names in ``spark.checkpoint.dir``.

A lost executor then costs the tasks since the last table only, and driver and executors see the same files.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that a worker takes up at once, of an Arrow batch that Spark bounds (maxBytesPerBatch, 64 MB by default).
SLICE_BYTES = 2_000_000
_LIVE: set[str] = set()
_SHIPPED: set[str] = set()
LOCAL_DEFAULT = "/tmp/checkpoints"


def root(spark: SparkSession) -> str:
    """The shared folder. Unset is allowed with a local master only, where one machine holds all the files."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"file://{LOCAL_DEFAULT}/{spark.sparkContext.applicationId}"


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: the same rows without lineage."""
    spark = df.sparkSession
    path = f"{root(spark)}/lexiform/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _LIVE.add(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, deleted when the application ends."""
    path = f"{root(spark)}/lexiform/{name}-{uuid.uuid4().hex}"
    _LIVE.add(path)
    return path


def drop(*tables: DataFrame) -> None:
    """Delete tables made by :func:`save` that no later plan reads."""
    for df in tables:
        path = getattr(df, "_scratch_path", None)
        if path in _LIVE:
            _LIVE.discard(path)
            _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _sweep() -> None:
    spark = SparkSession.getActiveSession() if _LIVE else None
    for path in list(_LIVE) if spark else ():
        try:
            _delete(spark, path)
        except Exception:  # the JVM may be gone by now
            return


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="lexiform-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    target = os.path.join(folder, "lexiform.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for at, _, names in os.walk(home):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(at, n)
                    z.write(full, os.path.join("lexiform", os.path.relpath(full, home)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def slices(batches: Iterator[pa.RecordBatch], text: int | str) -> Iterator[pa.RecordBatch]:
    """The same rows in parts whose texts have SLICE_BYTES together, or one longer text."""
    for b in batches:
        column = b.column(b.schema.get_field_index(text) if isinstance(text, str) else text)
        ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())).to_numpy(zero_copy_only=False)
        at, before = 0, 0
        while at < b.num_rows:
            upto = max(at + 1, int(ends.searchsorted(before + SLICE_BYTES, side="right")))
            yield b.slice(at, upto - at)
            at, before = upto, int(ends[upto - 1])


def partitions(df: DataFrame) -> int:
    """Shuffle partitions to use for explicit repartitioning."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
