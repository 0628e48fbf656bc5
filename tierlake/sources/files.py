"""Scans of monthly trip files whose physical schema drifts between files.

Reader settings cannot reconcile every drift: Parquet widening (int32 file
column read as bigint) works, but narrowing (bigint or double read as int)
fails, and ``mergeSchema`` rejects int + bigint files. So files are grouped by
their physical schema, each group is scanned as stored, conformed with checked
casts to the target schema, and the groups are unioned — still one Spark job,
with column pruning and filter pushdown into every group's scan.

The schemas come from one job over the listing: tasks read the footers, and only
the distinct schemas reach the driver. Folders whose files are all alike are then
scanned as folders; file names are brought in only where schemas differ.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierlake.operators.conform import SchemaMismatch, conform
from tierlake.schemas import BRONZE_KEYS, RAW_TRIP_SCHEMA, UNSTABLE_COLUMN
from tierlake.sources.listing import list_files

log = logging.getLogger(__name__)

# Path schemes whose files tasks open by themselves; the values are pyarrow's names for them.
TASK_SCHEMES = {"": "file", "file": "file", "s3": "s3", "s3a": "s3", "gs": "gs", "hdfs": "hdfs"}


def drop_unstable(df: DataFrame, column: str = UNSTABLE_COLUMN) -> DataFrame:
    """Drop a column that only some files carry. ``drop`` resolves names
    case-insensitively and is a no-op when the column is absent."""
    return df.drop(column)


def _scheme(path: str) -> str:
    return path.split(":", 1)[0] if ":/" in path else ""


def _footer(path: str) -> str:
    """The Spark schema of a Parquet file as JSON, from its footer alone."""
    import pyarrow.parquet as pq
    from pyarrow import fs
    from pyspark.sql.pandas.types import from_arrow_schema

    rest = path.split(":", 1)[1] if _scheme(path) else path
    uri = f"{TASK_SCHEMES[_scheme(path)]}://{'/' + rest.lstrip('/') if _scheme(path) in ('', 'file') else rest.lstrip('/')}"
    system, name = fs.FileSystem.from_uri(uri)
    with system.open_input_file(name) as file:
        parquet = pq.ParquetFile(file)
        written = (parquet.metadata.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
        if written:  # Spark's own account of the columns, which its reader goes by
            return written.decode()
        stored = parquet.schema_arrow
        for k in range(len(parquet.schema)):
            column = parquet.schema.column(k)
            if column.physical_type == "INT96" and column.path in stored.names:  # an instant, to Spark
                at = stored.get_field_index(column.path)
                stored = stored.set(at, stored.field(at).with_type(pa.timestamp("us", tz="UTC")))
    return from_arrow_schema(stored, prefer_timestamp_ntz=True).json()


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = batch.column("path")
        yield pa.RecordBatch.from_arrays([paths, pa.array([_footer(p) for p in paths.to_pylist()], pa.string())],
                                         names=["path", "schema"])


def file_schemas(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """``path, schema`` (JSON) of every file under ``paths``: a lazy job that reads footers in tasks.

    Store credentials for tasks come from the environment or the machine's role, as pyarrow
    finds them. The files are dealt by name, so that one folder's footers are not one task's."""
    listing = list_files(spark, paths, pattern="*").select("path")
    return listing.repartition("path").mapInArrow(_footers, "path string, schema string")


@dataclass(frozen=True)
class FileGroup:
    """Files of one physical schema: their paths, or folders that hold no others."""

    schema: StructType
    paths: tuple[str, ...]


def _signature(schema: StructType) -> str:
    return ",".join(f"{f.name.lower()}:{f.dataType.simpleString()}" for f in schema.fields)


def group_by_physical_schema(spark: SparkSession, paths: list[str] | str) -> list[FileGroup]:
    """Files under ``paths`` grouped by their Parquet schema (names and types).

    Two jobs at most, however many files there are. For stores that tasks can't open by
    themselves (another path scheme) Spark's reader asks for each file's schema instead, from driver threads."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if {_scheme(p) for p in paths} <= set(TASK_SCHEMES):
        found = file_schemas(spark, paths)
        kinds = sorted((r["schema"], r["first"]) for r in found.groupBy("schema").agg(F.min("path").alias("first")).collect())
        if len(kinds) == 1:
            return [FileGroup(StructType.fromJson(json.loads(kinds[0][0])), tuple(paths))]
        by_file = [(r["path"], r["schema"]) for r in found.collect()]
    else:
        names = [r["path"] for r in list_files(spark, paths, pattern="*").select("path").collect()]
        with ThreadPoolExecutor(max_workers=16) as pool:
            by_file = list(zip(names, pool.map(lambda p: spark.read.parquet(p).schema.json(), names)))
    groups: dict[str, tuple[StructType, list[str]]] = {}
    for path, text in sorted(by_file):
        schema = StructType.fromJson(json.loads(text))
        groups.setdefault(_signature(schema), (schema, []))[1].append(path)
    return [FileGroup(schema, tuple(files)) for schema, files in groups.values()]


def read_trip_files(spark: SparkSession, paths: list[str] | str,
                    schema: StructType = RAW_TRIP_SCHEMA, *,
                    lineage_col: str | None = None, fill_missing: bool = True,
                    required: list[str] | None = None) -> DataFrame:
    """All rows of ``paths`` conformed to ``schema`` (``VendorID`` as bigint,
    the unstable fee column dropped, absent columns as typed NULLs).

    Files without one of the ``required`` columns raise :class:`SchemaMismatch`: rows without a
    key would be loaded anew by every batch (by default the bronze key, for trip files). Columns that the
    schema has no place for are named in a warning, with a file that has them.
    ``lineage_col`` adds the source file name of every row (from the scan's
    ``_metadata``), so no per-file loop is needed to know where rows came from.
    """
    target = schema
    if lineage_col:
        target = StructType(schema.fields + [StructField(lineage_col, StringType())])
    if required is None:
        required = BRONZE_KEYS if schema == RAW_TRIP_SCHEMA else []
    wanted = {f.name.lower() for f in target.fields} | {UNSTABLE_COLUMN}
    frames = []
    for group in group_by_physical_schema(spark, paths):
        names = {f.name.lower(): f.name for f in group.schema.fields}
        missing = [c for c in required if c.lower() not in names]
        if missing:
            raise SchemaMismatch(f"{group.paths[0]} and {len(group.paths) - 1} more lack the columns {missing}")
        extra = sorted(names[c] for c in set(names) - wanted)
        if extra:
            log.warning("columns not loaded: %s (%d paths, first %s)", extra, len(group.paths), group.paths[0])
        df = spark.read.schema(group.schema).option("recursiveFileLookup", "true").parquet(*group.paths)
        if lineage_col:
            df = df.withColumn(lineage_col, F.col("_metadata.file_name"))
        frames.append(conform(drop_unstable(df), target, fill_missing=fill_missing))
    if not frames:
        raise ValueError("no input files")
    return reduce(lambda a, b: a.unionByName(b), frames)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """One monthly file as the bronze load expects it."""
    return read_trip_files(spark, [path])
