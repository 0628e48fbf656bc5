"""Session bootstrap and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every pipeline session gets unless the caller overrides them.
# Timestamps are stored without zone, but pinning the session zone keeps any
# zoned value that slips in (e.g. from a file written with UTC adjustment)
# rendering identically on every executor.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str = "tierlake", master: str | None = None,
                  conf: dict[str, str] | None = None,
                  catalog: str | None = None, database: str | None = None) -> SparkSession:
    """Create (or reuse) a session with the pipeline defaults.

    ``catalog`` / ``database`` select the current catalog and database, as a
    job would before reading tables by their short names.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    if database:
        spark.catalog.setCurrentDatabase(database)
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path under the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir`` (or an already set RDD
    checkpoint dir). It must be visible to every executor, so on a cluster an unset
    value is an error; only a local session, whose one machine runs all tasks, gets a
    folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base and spark.sparkContext.master.startswith("local"):
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if not base:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return "/".join([base.rstrip("/"), *parts])


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the shared dir for staged intermediate data."""
    return shared_dir(spark, "tierlake", purpose, uuid.uuid4().hex)


def object_store_conf(endpoint: str, access_key: str, secret_key: str,
                      path_style: bool = True) -> dict[str, str]:
    """Builder settings for an S3-compatible object store (``s3a://`` paths).

    Credentials are taken as arguments (read them from the job's environment or
    secret store); they are never written into code or plans.
    """
    return {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
    }


def catalog_conf(name: str, implementation: str, **options: str) -> dict[str, str]:
    """Builder settings for a named catalog: its class and options (``type``, ``uri``,
    ``warehouse`` …), as ``spark.sql.catalog.<name>[.<option>]``.

    Tables in it are then read by three-part names; ``build_session(catalog=name)`` makes it current."""
    return {f"spark.sql.catalog.{name}": implementation,
            **{f"spark.sql.catalog.{name}.{key}": value for key, value in options.items()}}
