"""Sessions for tests and benchmarks, and what Python workers need to import this package."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ROOT = str(Path(__file__).resolve().parent.parent)


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where the driver found it.

    On a cluster the package is installed, or shipped with ``--py-files``; the path added
    here does no harm there.
    """
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if _ROOT not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, _ROOT) if x)
    return spark


def local_session(cpus: str = "*", memory: str = "8g", name: str = "corpusflow") -> SparkSession:
    """A local session with the settings that tests and benchmarks share."""
    return importable(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def spread(df: DataFrame) -> DataFrame:
    """Rows of an input of few files over all cores, for work that is heavy in each row.

    An input with at least as many partitions as there are cores, as any large one has, is
    returned as it is: nothing is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df._jdf.queryExecution().toRdd().getNumPartitions() >= cores else df.repartition(cores)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset and the
    session is local (tests, one machine) a temporary folder of this machine is used;
    elsewhere executors could not read it, and its absence is an error.
    """
    context = spark.sparkContext._jsc.sc()
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        current = context.getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="corpusflow-")
    if not context.getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(named)
    return named


def saved(df: DataFrame, hint: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder as Parquet and read it back.

    Unlike a cached or locally checkpointed frame it survives the loss of any executor,
    and it is columnar, so that later passes read only the columns they need.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{hint}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _SAVED.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_path = path
    return out


#: Tables that ``saved`` has written, and other folders named to ``placed``, that nothing has removed yet.
_SAVED: list[str] = []


def placed(path: str) -> str:
    """Record a folder of the shared storage that a query is about to write, so that ``clean`` removes it too."""
    _SAVED.append(path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    if path in _SAVED:
        _SAVED.remove(path)


def forget(df: DataFrame) -> None:
    """Remove the table behind a ``saved`` frame that nothing will read again; other frames are left alone."""
    path = getattr(df, "_saved_path", None)
    if path:
        _remove(df.sparkSession, path)


def saved_alone(make: Callable[[], DataFrame], hint: str) -> DataFrame:
    """``saved`` of what ``make`` gives, without the tables that it has saved on the way."""
    earlier = set(_SAVED)
    out = saved(make(), hint)
    for path in [p for p in _SAVED if p not in earlier and p != out._saved_path]:
        _remove(out.sparkSession, path)
    return out


def clean(spark: SparkSession) -> None:
    """Remove all tables that this process has saved, once the results made from them are written."""
    for path in list(_SAVED):
        _remove(spark, path)
