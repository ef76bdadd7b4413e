"""Reading published per-product CSV files back as one wide table."""

from __future__ import annotations

import csv
import io
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplabel.functions import text as X
from shiplabel.operators.publish import attribute_columns, schema_master
from shiplabel.operators.scale import durable
from shiplabel.sources.shipments import CSV_MISSING, require_columns

ANY_CSV = "*.[cC][sS][vV]"
# Rows that a task hands on at once, and most tasks that files are dealt to.
ROWS = 4_096
TASKS = 100_000


def opened(path: str) -> io.IOBase | pa.NativeFile:
    """A file by its full path; also in the object stores Arrow knows."""
    if path.startswith("file:") or "://" not in path:
        return open(path.removeprefix("file:").replace("///", "/", 1), "rb")
    store, inside = pa.fs.FileSystem.from_uri(path)
    return store.open_input_stream(inside)


def _files(spark: SparkSession, folder: str, pattern: str, skip: Sequence[str] = ()) -> DataFrame:
    """``path`` and ``file`` (its name, or that of the output folder it lies in) of the CSV files, each in a task of its own."""
    # The listing that Spark plans from; unlike a scan it names empty files, too.
    listed = spark.read.format("binaryFile").option("pathGlobFilter", ANY_CSV).load(f"{folder}/{pattern}").inputFiles()
    files = spark.createDataFrame([(unquote(path),) for path in sorted(listed)], "path string").select(
        "path", F.regexp_extract("path", r"([^/]+\.[cC][sS][vV])(?:/[^/]*)?$", 1).alias("file")
    )
    if skip:
        files = files.where(~F.col("file").isin(list(skip)))
    return files.repartition(max(1, min(files.count(), TASKS)))


def _records(path: str, open_file: Callable) -> Iterator[list[str]]:
    """The records of a CSV file; lines without anything are none."""
    csv.field_size_limit(1 << 30)
    with open_file(path) as file:
        for cells in csv.reader(io.TextIOWrapper(file, encoding="utf-8", errors="replace", newline="")):
            if cells:
                yield cells


def _header(cells: list[str]) -> list[str]:
    """Column names of a header: nameless ones are numbered, repeated ones (whatever the case) get their number."""
    seen = Counter(c.lower() for c in cells)
    return [f"_c{i}" if not c else f"{c}{i}" if seen[c.lower()] > 1 else c for i, c in enumerate(cells)]


def headers(files: DataFrame, open_file: Callable = opened) -> DataFrame:
    """``path, file, columns`` of all files, from their first records alone: one job, however many files there are."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            columns = [_header(next(_records(path, open_file), [])) for path in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), batch.column("file"), pa.array(columns, pa.list_(pa.string()))], ["path", "file", "columns"]
            )

    return durable(files.mapInArrow(batches, "path string, file string, columns array<string>"))


def _read(known: DataFrame, open_file: Callable = opened) -> DataFrame:
    """The records of files (``headers``) under all their columns, in the order in which the files bring them."""
    named = known.select("path", F.posexplode("columns").alias("place", "name"))
    first = named.groupBy("name").agg(F.min(F.struct("path", "place")).alias("first")).orderBy("first")
    # One row for each column of the result.
    names = [r["name"] for r in first.collect()]
    place = {name: i for i, name in enumerate(names)}
    fields = [T.StructField(n, T.StringType()) for n in [*names, "file", "path"]]
    schema = T.StructType([*fields, T.StructField("row", T.LongType())])

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed(rows: list[list], file: str, path: str, start: int) -> pa.RecordBatch:
            columns = [pa.array(c, pa.string()) for c in zip(*rows, strict=True)] if names else []
            n = len(rows)
            columns += [pa.array([file] * n, pa.string()), pa.array([path] * n, pa.string()), pa.array(range(start, start + n), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, [*names, "file", "path", "row"])

        for batch in found:
            for path, file in zip(batch.column("path").to_pylist(), batch.column("file").to_pylist(), strict=True):
                records = _records(path, open_file)
                at = [place[name] for name in _header(next(records, []))]
                rows, start = [], 0
                for cells in records:
                    row = [None] * len(names)
                    # Cells that a record lacks are empty, cells beyond the header are none.
                    for k, i in enumerate(at):
                        row[i] = cells[k] if k < len(cells) else ""
                    rows.append(row)
                    if len(rows) == ROWS:
                        yield handed(rows, file, path, start)
                        rows, start = [], start + ROWS
                if rows:
                    yield handed(rows, file, path, start)

    spread = known.select("path", "file").repartition(max(1, min(known.count(), TASKS)))
    read = spread.mapInArrow(batches, schema)
    return read.withColumn("ord", F.struct("path", "row")).drop("path", "row")


def read_folder(
    spark: SparkSession, folder: str, pattern: str = ANY_CSV, skip: Sequence[str] = (), open_file: Callable = opened
) -> DataFrame:
    """The CSV files of a folder, not of its sub-folders, as one wide table.

    A file may also be a Spark output folder of that name. ``file`` is its name
    and ``ord`` the place of a row in it. Columns are matched by name, absent ones
    are NULL, empty cells of a file's own columns are ''. Files named in ``skip`` are
    left out; no file at all is an error. Headers are read in one job and records in one, a file
    to a task, however many files and different headers there are.
    """
    known = headers(_files(spark, folder, pattern, skip), open_file).where(F.size("columns") > 0)
    if known.isEmpty():
        raise FileNotFoundError(f"no files in {folder} match {pattern}")
    return _read(known, open_file)


def for_schema_master(wide: DataFrame) -> DataFrame:
    """Cells as the schema summary reads them: every spelling of a missing cell is empty."""
    missing = lambda c: F.when(F.col(f"`{c}`").isin(CSV_MISSING), "").otherwise(F.col(f"`{c}`"))
    return wide.withColumns({c: missing(c) for c in attribute_columns(wide)})


def folder_schema_master(spark: SparkSession, folder: str, open_file: Callable = opened) -> DataFrame:
    """The schema summary of a folder; a file that cannot be read is listed with its error."""
    known = headers(_files(spark, folder, ANY_CSV), open_file)
    errors = known.where(F.size("columns") == 0).select(
        X.product_from_file("file").alias("product"),
        "file",
        F.lit(0).cast("bigint").alias("part"),
        F.lit('{"__error__":["No columns to parse from file"]}').alias("schema_json"),
    )
    sound = known.where(F.size("columns") > 0)
    if sound.isEmpty():
        return errors
    return schema_master(for_schema_master(_read(sound, open_file))).unionByName(errors)


def for_shipment_map(wide: DataFrame, id_column: str = "shipment_id") -> DataFrame:
    """Cells as the shipment map reads them: as they are, under a required id column."""
    return require_columns(wide, [id_column])
