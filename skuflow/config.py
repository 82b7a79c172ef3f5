"""Session and storage-location helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

_FALLBACK_ROOT: str | None = None
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())   # scratch folders of the open scopes


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "skuflow") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint dir) as
    the cluster names it. Only when neither is set on a local master — tests —
    a private folder is created and registered as the context's checkpoint dir;
    on any other master that is an error.
    """
    global _FALLBACK_ROOT
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a local context
        sc = None
    if sc is not None:
        ctx_dir = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
        if ctx_dir:
            return ctx_dir.rstrip("/")
    master = spark.conf.get("spark.master", None) or "local"
    if not re.match(r"local($|\[)", master):
        raise ValueError(f"spark.checkpoint.dir is not set: name a folder that all executors of {master} share")
    if _FALLBACK_ROOT is None:
        _FALLBACK_ROOT = tempfile.mkdtemp(prefix="skuflow-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(_FALLBACK_ROOT)
    return _FALLBACK_ROOT


def default_parallelism(spark: SparkSession) -> int:
    """Cores the cluster offers (fallback: the session's shuffle partitions)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def scratch_path(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A fresh, unique folder under the shared checkpoint root.

    Inside a :func:`scratch_scope` it goes at the scope's end; with ``keep`` at the end of the scope
    around that one, if there is one.
    """
    path = os.path.join(checkpoint_root(spark), "skuflow", f"{name}-{uuid.uuid4().hex[:12]}")
    around = _scopes.get()[:-1] if keep else _scopes.get()
    if around:
        around[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the scratch folders made inside, also after an error.

    Queries read scratch tables lazily: what is to outlive the scope must be written (or collected)
    inside it. Without a scope scratch tables stay, as a later action may still read them.
    """
    mine: list[str] = []
    token = _scopes.set((*_scopes.get(), mine))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in mine:
            _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
