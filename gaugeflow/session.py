"""Session settings the jobs rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import gaugeflow
from gaugeflow.sources.files import delete_folder
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "gaugeflow", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    } | {k: str(v) for k, v in conf.items()}
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def ship_code() -> None:
    """Send the package's functions along with the tasks, so that executors need no copy."""
    cloudpickle.register_pickle_by_value(gaugeflow)


def use_utc(spark: SparkSession) -> SparkSession:
    """Window labels, archive folders and naive timestamps are all UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# folders made since each open ``scratch`` began
_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Own the intermediate folders that are made inside, and delete them at the end.

    Results read them lazily, so whatever is to last has to be written or collected
    before. Several operators write intermediate tables while they are being built.
    """
    folders: list[str] = []
    _SCRATCH.append(folders)
    try:
        yield
    finally:
        _SCRATCH.remove(folders)
        for folder in folders:
            delete_folder(spark, folder)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only a local session without the setting gets a folder of its own; on a
    cluster a machine-local folder would not be visible to the executors.
    """
    base = (spark.conf.get("spark.checkpoint.dir", None)
            or spark.sparkContext.getCheckpointDir())
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="gaugeflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    folder = f"{base.rstrip('/')}/gaugeflow/{name}-{uuid.uuid4().hex}"
    if _SCRATCH:
        _SCRATCH[-1].append(folder)
    return folder


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result once and read it back.

    Cuts the lineage where several later stages read the same rows. The table
    survives lost executors, and its real size is known to the optimizer.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
