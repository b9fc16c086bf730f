"""Session settings and cutting of lineage."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: int | str = 8, memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A session on one machine for tests and measurements."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("presslake").config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions).config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the shared folder of ``spark.checkpoint.dir``; only where the cluster
    names none, as in tests on one machine, a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "presslake-checkpoints"))


def cut_lineage(frame: DataFrame) -> DataFrame:
    """``frame`` written to the checkpoint folder and read from there."""
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


def if_small(stored: DataFrame, row_bytes: int) -> DataFrame:
    """A stored frame, marked for broadcast only if its counted rows stay below the session's
    broadcast threshold at ``row_bytes`` each; else marked for a merge."""
    spark = stored.sparkSession
    limit = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    return F.broadcast(stored) if stored.count() * row_bytes <= limit else stored.hint("merge")


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable in Python workers: by their search path on one
    machine, by a zip that Spark distributes on a cluster.  Done once per context."""
    sc = spark.sparkContext
    if getattr(sc, "_presslake_shipped", False):
        return
    package = Path(__file__).resolve().parent
    if re.fullmatch(r"local(\[.*\])?", sc.master):
        paths = [str(package.parent), *filter(None, sc.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep))]
        sc.environment["PYTHONPATH"] = os.pathsep.join(dict.fromkeys(paths))
    else:
        target = Path(tempfile.mkdtemp(prefix="presslake-")) / "presslake.zip"  # on the driver; executors fetch it from there
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, Path("presslake") / f.relative_to(package))
        sc.addPyFile(str(target))
    sc._presslake_shipped = True
