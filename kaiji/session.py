"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every kaiji job relies on. Timestamps in the inputs are
# timestamp_ntz; pinning the zone keeps casts and date maths stable.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows of one Arrow batch: bounds what a Python worker holds of long texts
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.legacy.javaCharsets": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "kaiji",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of BASE_CONF to an existing session."""
    for k in ("spark.sql.session.timeZone",
              "spark.sql.sources.partitionOverwriteMode",
              "spark.sql.execution.arrow.maxRecordsPerBatch",
              "spark.sql.execution.arrow.maxBytesPerBatch",
              "spark.sql.legacy.javaCharsets"):
        try:
            spark.conf.set(k, BASE_CONF[k])
        except Exception:  # pragma: no cover - conf locked by the cluster
            pass
    ship_package(spark)


@contextmanager
def with_conf(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Settings (``__`` for ``.``) for the actions of a block."""
    conf = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors once per application.

    Python workers then import it wherever the driver was started from.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="kaiji-src-"), "kaiji-src.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(root)):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("kaiji", os.path.relpath(full, root)))
    sc.addPyFile(path)  # served to the executors by the driver
    _SHIPPED.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Uses the context's checkpoint folder when one is registered, else the
    ``spark.checkpoint.dir`` setting of the session. Only when neither is set
    (local tests) a scratch folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="kaiji-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for staged tables."""
    return f"{checkpoint_dir(spark).rstrip('/')}/kaiji-work/{name}-{uuid.uuid4().hex[:12]}"
