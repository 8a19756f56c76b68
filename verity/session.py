"""Session helpers.

Library code never builds its own cluster configuration: it takes the
session it is given.  ``local_session`` exists for tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "verity") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC)."""
    parts = shuffle_partitions or (8 if cores == "*" else max(2, int(cores) * 2))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("VERITY_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory named by the cluster.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is (a cluster without it is an error: a machine-local folder would not
    survive executor loss).  Only a local master without the setting (tests)
    gets a scratch folder, so lineage cutting still works there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="verity-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


#: Folders of the checkpoints made inside ``checkpoints_removed``; None outside of it.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def checkpoint(df, eager: bool = True):
    """Reliable checkpoint (never a local one): cuts lineage, survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=eager)
    made = _made.get()
    if made is not None:
        folder = out._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        if folder.isDefined():
            made.append(folder.get())
    return out


@contextmanager
def checkpoints_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the checkpoints made inside when it ends: for micro-batches, whose outputs are written by then."""
    token = _made.set([])
    try:
        yield
    finally:
        made = _made.get() or []
        _made.reset(token)
        for folder in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def pinned_splits(spark: SparkSession) -> SparkSession:
    """A session like ``spark`` whose file splits stay the same from scan to scan.

    By default Spark sizes splits by the executors there are when a scan is planned; an operator that reads
    files twice and knows rows by their split reads them through this session.
    """
    own = spark.newSession()
    for name, value in dict(spark.conf.getAll).items():
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            own.conf.set(name, value)
    if not own.conf.get("spark.sql.files.minPartitionNum", None):
        own.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return own


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per Spark context.

    Functions of a module are pickled by reference, so workers import it; a session started in
    another folder, or a cluster without the package installed, gets it as a zip file.
    """
    import verity

    root = Path(verity.__file__).resolve().parent
    context = spark.sparkContext
    if getattr(context, "_verity_shipped", False) or not root.is_dir():
        return
    target = Path(tempfile.mkdtemp(prefix="verity-zip-")) / "verity.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, path.relative_to(root.parent))
    context.addPyFile(str(target))
    context._verity_shipped = True
