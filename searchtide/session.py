"""Session helpers: the shared folder for what outlives a task, and its end."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """Name the shared folder for checkpoints and point the session at it.

    The cluster's ``spark.checkpoint.dir`` always wins. A temporary folder is
    made only in local mode, where driver and executors are one machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(
                "set spark.checkpoint.dir to a folder that every executor can reach"
            )
        folder = tempfile.mkdtemp(prefix="searchtide-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return folder


_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared place, for a table that this run alone reads.

    It is deleted when the driver's Python ends, or by ``delete_scratch``.
    """
    if not _SCRATCH:
        atexit.register(delete_scratch)
    path = f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append((spark, path))
    return path


def delete_scratch() -> None:
    """Delete all tables of ``scratch_path``; what reads them can no longer run."""
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        try:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        except Exception:  # The session may be gone, and the folder with it.
            continue
