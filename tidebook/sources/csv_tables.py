"""Header CSV files: scanned as text for inference, and typed for the load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.functions.numbers import plain_text
from tidebook.operators.schema import infer_types, profile_tables, schemas_of

# A quote inside a quoted field is doubled; blanks are part of the value.
CSV_DIALECT = {
    "header": "true",
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# With the default marker "" a reader could not tell an empty field (null) from a quoted one. A row
# with another number of fields than the header, or a value that does not fit its type, stops the
# job; by default it would be filled up with nulls. A file with another header stops it too; by
# default its columns would be taken by position.
READ_DIALECT = CSV_DIALECT | {
    "nullValue": "\u0000",
    "mode": "FAILFAST",
    "inferSchema": "false",
    "enforceSchema": "false",
}


def find_tables(spark: SparkSession, folder: str) -> dict[str, str]:
    """Table name to path for everything in ``folder``: one file, or one folder of files, each.

    Spark lists the files, so any file system it can read will do; their contents stay unread and
    one row per table reaches the driver.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    root = system.resolvePath(path).toUri().getPath().rstrip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    # Paths come resolved, with the scheme in front; the root is cut off once, at its first place.
    rest = F.substring(F.col("path"), F.locate(root, F.col("path")) + len(root), 1 << 30)
    entry = F.substring_index(rest, "/", 1)
    entries = sorted(row["entry"] for row in files.select(entry.alias("entry")).distinct().collect())
    return {entry.removesuffix(".csv"): f"{folder.rstrip('/')}/{entry}" for entry in entries}


def read_text(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Every column as text; an empty field is null, a quoted empty field an empty text.

    ``multiline`` allows line breaks inside quoted fields. Each file is then read by one task, as
    a line break no longer marks a place where a file can be split.
    """
    return spark.read.options(**READ_DIALECT, multiLine=multiline).csv(path)


def read_typed(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False
) -> DataFrame:
    """The same rows with the types of ``schema``."""
    return spark.read.options(**READ_DIALECT, multiLine=multiline).schema(schema).csv(path)


def infer_schemas(
    spark: SparkSession,
    paths: dict[str, str],
    text_columns: list[str] | None = None,
    multiline: bool = False,
) -> dict[str, T.StructType]:
    """Schema of every table from all its rows; one job scans all tables."""
    texts = {name: read_text(spark, path, multiline) for name, path in paths.items()}
    types = infer_types(profile_tables(texts), text_columns)
    return schemas_of(types, {name: df.columns for name, df in texts.items()})


def read_tables(
    spark: SparkSession,
    paths: dict[str, str],
    schemas: dict[str, T.StructType],
    multiline: bool = False,
) -> dict[str, DataFrame]:
    """Lazy typed scans, one per table."""
    return {name: read_typed(spark, path, schemas[name], multiline) for name, path in paths.items()}


def write_text_table(df: DataFrame, path: str) -> None:
    """Export a table as header CSV files, one per partition."""
    df.write.mode("errorifexists").options(**CSV_DIALECT).csv(path)


def as_exported(df: DataFrame) -> DataFrame:
    """The columns as an export prints them: numbers with all their digits, the rest as is."""
    return df.select(
        [
            (plain_text(F.col(f.name)) if isinstance(f.dataType, T.DoubleType) else F.col(f.name).cast("string"))
            .alias(f.name)
            for f in df.schema.fields
        ]
    )
