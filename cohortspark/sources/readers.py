"""Readers. Each returns one lazy frame over a single scan; nothing is listed or unioned by hand."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructField, StructType

from cohortspark.functions.scalars import quote
from cohortspark.schemas import SERIES_FILE_NAMES, SERIES_SCHEMA

__all__ = ["nan_to_null", "read_csv", "read_parquet", "read_participants", "read_series", "read_table", "unreadable_files"]

Filter = tuple[str, str, object]
LISTING_WAVES = 4
_OPERATORS = {
    "=": lambda c, v: c == v,
    "<>": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(list(v)),
}


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in floating columns, so that aggregates skip it."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (FloatType, DoubleType))]
    return df.withColumns({c: F.when(~F.isnan(quote(c)), F.col(quote(c))) for c in floats}) if floats else df


def keep_rows(df: DataFrame, filters: Sequence[Filter]) -> DataFrame:
    """Rows that meet every (column, operator, value); a NaN or NULL meets none.

    Meant for stored columns, before NaN becomes NULL: the comparison stays one of the bare column, which a scan can check against
    its files' statistics, and ``NOT isnan`` beside it takes care of NaN, which SQL orders above all numbers.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    for name, operator, value in filters:
        if operator not in _OPERATORS:
            raise ValueError(f"operator {operator!r} is none of {', '.join(_OPERATORS)}")
        column = F.col(quote(name))
        df = df.where(_OPERATORS[operator](column, value))
        if isinstance(kinds.get(name), (FloatType, DoubleType)):
            df = df.where(~F.isnan(column))
    return df


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | None = None) -> DataFrame:
    """CSV with a header. Types are inferred (one extra pass) unless a schema is declared."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return nan_to_null(reader.csv(path))


def read_parquet(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    merge_schema: bool = False,
    filters: Sequence[Filter] = (),
) -> DataFrame:
    """Parquet file or folder; ``merge_schema`` unites the columns of all files.

    ``filters`` reach the scan on floating columns too, where a later ``where`` meets the column that NaN was taken out of.
    """
    reader = spark.read.option("mergeSchema", merge_schema)
    if schema is not None:
        reader = reader.schema(schema)
    return nan_to_null(keep_rows(reader.parquet(*([path] if isinstance(path, str) else path)), filters))


def read_series(
    spark: SparkSession,
    roots: str | Sequence[str],
    schema: StructType = SERIES_SCHEMA,
    file_names: Mapping[str, str] = SERIES_FILE_NAMES,
    skip_unreadable: bool = False,
    filters: Sequence[Filter] = (),
) -> DataFrame:
    """All ``id=<participant>`` folders below the roots as one frame.

    The participant comes from the folder name and stays a string (``001`` and ``1e5`` are not numbers),
    and filters on it prune folders. ``file_names`` maps spellings inside the files to column names.
    With ``skip_unreadable``, missing roots and missing or corrupt files are left out, and no readable
    root gives an empty frame with the declared schema; without it they raise. ``unreadable_files`` says what was left out.
    ``filters``, on column names, reach the scan.
    """
    paths = [roots] if isinstance(roots, str) else list(roots)
    to_file = {column: spelling for spelling, column in file_names.items()}
    stored = StructType([StructField(to_file.get(f.name, f.name), f.dataType, f.nullable) for f in schema])

    def scan(targets: list[str]) -> DataFrame:
        reader = spark.read.schema(stored)
        if skip_unreadable:
            reader = reader.option("ignoreMissingFiles", True).option("ignoreCorruptFiles", True)
        return reader.parquet(*targets)

    with _few_listing_tasks(spark):
        found = _scan_present(scan, paths)[0] if skip_unreadable else scan(paths)
    if found is None:
        return spark.createDataFrame([], schema)
    loaded = found.withColumnsRenamed(dict(file_names))
    return nan_to_null(keep_rows(loaded.select(*[quote(f.name) for f in schema]), filters))


def unreadable_files(spark: SparkSession, roots: str | Sequence[str]) -> DataFrame:
    """(path, bytes, reason) of the roots and files that ``read_series(skip_unreadable=True)`` gets no row from.

    The manifest of all files is compared with the files whose footers a scan without columns can read, which needs no data. Only
    files without rows are then opened, in tasks: one that doesn't begin and end as Parquet does (truncated, or
    another format), one that does but has no rows or a damaged footer, or one whose bytes fail to arrive (as with a wrong
    checksum). A missing root has no size; files of no bytes at all, which Spark's scans pass over, are not listed.
    """
    paths = [roots] if isinstance(roots, str) else list(roots)

    def listing(targets: list[str]) -> DataFrame:
        return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(targets)

    with _few_listing_tasks(spark):
        listed, present = _scan_present(listing, paths)
    missing = spark.createDataFrame([(p, None, "missing root") for p in paths if p not in present], "path string, bytes long, reason string")
    if not present:
        return missing
    footers = spark.read.schema("step long").option("recursiveFileLookup", True).option("ignoreMissingFiles", True)
    with _few_listing_tasks(spark):
        footers = footers.option("ignoreCorruptFiles", True).parquet(*present)
    read = footers.select(F.col("_metadata.file_path").alias("at")).distinct()
    files = listed.select(F.col("_metadata.file_path").alias("at"), "path", "length")
    suspects = files.join(read, "at", "left_anti").select("path", F.col("length").alias("bytes"))
    paths_ = [r.path for r in suspects.collect()]  # as many as there are such files
    if not paths_:
        return missing
    mark, content = F.lit(b"PAR1"), F.col("content")
    whole = (F.substring(content, 1, 4) == mark) & (F.substring(content, -4, 4) == mark) & (F.col("length") >= 12)
    reason = F.when(~whole, "no Parquet footer").otherwise("no rows or damaged footer")
    opener = spark.read.format("binaryFile").option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    with _few_listing_tasks(spark):
        opened = opener.load(paths_)
    found = suspects.join(opened.select("path", reason.alias("reason")), "path", "left")
    return missing.union(found.select("path", "bytes", F.coalesce("reason", F.lit("bytes cannot be read"))))


@contextmanager
def _few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by some tasks a core, not by up to 10,000: a task costs more than listing many folders does."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, min(int(before), LISTING_WAVES * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _scan_present(scan, paths: list[str]) -> tuple[DataFrame | None, list[str]]:
    """A scan of those paths that exist, and these. The error of a missing path comes before anything is listed and names it, so
    folders are listed once, by the scan that is returned."""
    paths = list(paths)
    while paths:
        try:
            return scan(paths), paths
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            named = error.getMessageParameters().get("path", "").rstrip("/")
        gone = max((p for p in paths if named.endswith(p.rstrip("/"))), key=len, default=None)
        if gone is not None and not _exists(scan, gone):
            paths = [p for p in paths if p != gone]
        else:  # named in another way than it was given
            paths = [p for p in paths if _exists(scan, p)]
    return None, []


def _exists(scan, path: str) -> bool:
    try:
        scan([path])
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def read_participants(spark: SparkSession, roots: str | Sequence[str], ids: Sequence[str], **options) -> DataFrame:
    """Series of the named participants only; ids without a folder contribute no rows."""
    return read_series(spark, roots, **options).where(F.col("id").isin(list(ids)))


def read_table(spark: SparkSession, name: str, filters: Sequence[Filter] = ()) -> DataFrame:
    return nan_to_null(keep_rows(spark.table(name), filters))
