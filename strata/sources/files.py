"""File sources: CSV landing folders (batch and incremental) and header checks.

Columns are assigned by position from an explicit schema; the header line
is skipped, never used for names.  A cell that does not parse becomes NULL
(PERMISSIVE); with ``corrupt_column`` set, the raw text of malformed lines
is kept in that column as well.
"""

from __future__ import annotations

from fnmatch import fnmatch
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.rules import TABLE_LEVEL_ERROR
from strata.schemas import EXTRACT_TIME, with_corrupt_record
from strata.sinks.tables import list_files


def _csv_options(glob: str | None, recursive: bool, corrupt_column: str | None) -> dict[str, str]:
    opts = {"header": "true", "mode": "PERMISSIVE", "enforceSchema": "true"}
    if glob:
        opts["pathGlobFilter"] = glob
    if recursive:
        # Landing keeps one folder per feed below the load path.
        opts["recursiveFileLookup"] = "true"
    if corrupt_column:
        opts["columnNameOfCorruptRecord"] = corrupt_column
    return opts


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    glob: str | None = None,
    recursive: bool = True,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Batch read of CSV files with a fixed, positional schema."""
    sch = with_corrupt_record(schema, corrupt_column) if corrupt_column else schema
    return spark.read.options(**_csv_options(glob, recursive, corrupt_column)).schema(sch).csv(path)


def stream_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    glob: str | None = None,
    recursive: bool = True,
    corrupt_column: str | None = None,
    max_bytes_per_trigger: int | None = None,
    archive: str | None = None,
    max_file_age: str | None = None,
) -> DataFrame:
    """Incremental CSV source: each run reads only files not seen before
    (tracked in the query's checkpoint).

    With ``archive``, a folder outside ``path``, files move there once their
    micro-batch is committed (when the next one is planned), so the listing and
    the checkpoint's file log do not grow forever; ``max_file_age`` (e.g.
    ``"30d"``) is how much older than the newest a file may land and still be read.
    """
    sch = with_corrupt_record(schema, corrupt_column) if corrupt_column else schema
    reader = spark.readStream.options(**_csv_options(glob, recursive, corrupt_column)).schema(sch)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_file_age:
        reader = reader.option("maxFileAge", max_file_age)
    return reader.csv(path)


def with_extract_time(df: DataFrame) -> DataFrame:
    """Ingest audit column (constant within one micro-batch)."""
    return df.withColumn(EXTRACT_TIME, F.current_timestamp())


# A line whose number of fields is not the schema's (a field that does not
# parse is NULL instead, and left to the rules).
LINE_LABEL = "[Line] malformed_csv_line"
CORRUPT = "_corrupt_record"
SOURCE_FILE = "_source_file"


def with_source_file(df: DataFrame) -> DataFrame:
    return df.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def _names(schema: StructType) -> list[str]:
    return [n.strip().lower().replace(" ", "_") for n in schema.fieldNames()]


def _is_header(line: Column, schema: StructType) -> Column:
    """Does a line, parsed as CSV, name the schema's columns in order?  (Blanks
    count as underscores; case, quotes and a byte-order mark do not count.)"""
    names = _names(schema)
    cells = F.from_csv(F.regexp_replace(line, "^\ufeff|\r$", ""), ", ".join(f"c{i} string" for i in range(len(names) + 1)))
    same = [
        F.lower(F.regexp_replace(F.trim(cells[f"c{i}"]), " ", "_")).eqNullSafe(F.lit(name)) for i, name in enumerate(names)
    ]
    return reduce(lambda x, y: x & y, same, cells[f"c{len(names)}"].isNull())


def _first_lines(lines: DataFrame) -> DataFrame:
    """``file_path, first_line`` from text rows with their metadata: the first
    line lies in the block that starts at 0, and rows of a block are in order."""
    start = lines.select("value", "_metadata.file_path", "_metadata.file_block_start").where("file_block_start = 0")
    numbered = start.withColumn("n", F.monotonically_increasing_id())
    return numbered.groupBy("file_path").agg(F.min_by("value", "n").alias("first_line"))


def header_report(spark: SparkSession, path: str, schema: StructType, glob: str | None = None) -> DataFrame:
    """Per landing file: is its first line a header that names the schema's
    columns, and how many rows does the CSV reader load from it.

    Output: ``file_path, header_ok, n_rows``.  An empty file is listed with
    ``header_ok`` false and 0 rows; blank lines are no rows.
    """
    options = {"recursiveFileLookup": "true", **({"pathGlobFilter": glob} if glob else {})}
    # Listed as the file source lists it, on the driver; Spark's readers leave empty files out.
    names = [(f,) for f in list_files(spark, path) if fnmatch(f.rsplit("/", 1)[-1], glob or "*")]
    files = spark.createDataFrame(names, "file_path string").select(_uniform("file_path").alias("file_path"))
    first = _first_lines(spark.read.options(**options).text(path)).select(
        _uniform("file_path").alias("file_path"), _is_header(F.col("first_line"), schema).alias("ok")
    )
    loaded = with_source_file(read_csv(spark, path, schema, glob=glob))
    rows = loaded.groupBy(_uniform(SOURCE_FILE).alias("file_path")).agg(F.count(F.lit(1)).alias("n"))
    return (
        files.join(first, "file_path", "left")
        .join(rows, "file_path", "left")
        .select("file_path", F.coalesce("ok", F.lit(False)).alias("header_ok"), F.coalesce("n", F.lit(0)).alias("n_rows"))
    )


def _uniform(path: str) -> Column:
    """One spelling of ``file:/x`` and ``file:///x``."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def split_landing(batch: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(rows to validate, refused lines) of a batch of landing files.

    ``batch`` holds the schema's columns, ``CORRUPT`` and ``SOURCE_FILE``.
    Columns are matched by position, so a file whose header does not name them
    is refused whole; of other files, lines with too few or too many fields.
    Refused lines are ``label, raw`` (JSON with the line's text).
    """
    spark = batch.sparkSession
    # A micro-batch's file list is on the driver already: the source made it.
    files = [r[0] for r in batch.select(SOURCE_FILE).distinct().collect()]
    if not files:
        none = batch.select(F.lit(LINE_LABEL).alias("label"), F.lit("").alias("raw"))
        return batch.drop(CORRUPT, SOURCE_FILE), none
    lines = spark.read.text(files)
    headers = _first_lines(lines).select(F.col("file_path").alias(SOURCE_FILE), _is_header(F.col("first_line"), schema).alias("_ok"))
    wrong = headers.where("not _ok").select(SOURCE_FILE)
    n_fields = _n_fields(F.col(CORRUPT))
    rows = batch.join(wrong, SOURCE_FILE, "left_anti")
    broken = F.col(CORRUPT).isNotNull() & (n_fields != len(schema))
    refused = rows.where(broken).select(
        F.lit(LINE_LABEL).alias("label"), F.to_json(F.struct(*schema.fieldNames(), CORRUPT, SOURCE_FILE)).alias("raw")
    )
    text = lines.select(F.col("value").alias(CORRUPT), F.col("_metadata.file_path").alias(SOURCE_FILE))
    whole = text.join(wrong, SOURCE_FILE, "left_semi").select(
        F.lit(TABLE_LEVEL_ERROR).alias("label"), F.to_json(F.struct(CORRUPT, SOURCE_FILE)).alias("raw")
    )
    return rows.where(~broken).drop(CORRUPT, SOURCE_FILE), refused.unionByName(whole)


def _n_fields(line: Column) -> Column:
    """Fields of a CSV line: commas outside quotes, and one."""
    bare = F.regexp_replace(line, '"([^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
