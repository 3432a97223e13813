"""Column profiles over all rows, and the types that follow from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.functions.text import has_leading_zero, kind, scale_digits, whole_digits

# A longer run of digits does not fit a bigint, and is an identifier rather than a quantity.
MAX_BIGINT_DIGITS = 18
MAX_DECIMAL_DIGITS = 38

# Columns that hold identifiers whatever their digits look like - taxpayer numbers,
# postal codes, barcodes, invoice keys and telephone numbers.
IDENTIFIERS = (
    "cpf",
    "cnpj",
    "tax_id",
    "postal_code",
    "cep",
    "barcode",
    "ean",
    "gtin",
    "invoice_key",
    "access_key",
    "phone",
)


def profile_columns(df: DataFrame) -> DataFrame:
    """Counters per column over every row of an all-text table, in one pass.

    The columns are unpivoted inside the scan stage and counted there by hash, so each task sends
    one row per column. Only counters and lengths are kept: a text minimum per column would turn
    the counting into a sort of all values (see ``value_ranges``).
    """
    value, sort = F.col("value"), F.col("kind")
    number = sort.isin("int", "dec")
    return (
        _long(df)
        .withColumn("kind", kind(value))
        .groupBy("column_name")
        .agg(
            F.count("*").alias("n"),
            F.count_if(value.isNull()).alias("n_null"),
            F.count_if(sort == "bool").alias("n_bool"),
            F.count_if(sort == "int").alias("n_int"),
            F.count_if(sort == "dec").alias("n_dec"),
            F.count_if(sort == "date").alias("n_date"),
            F.count_if(sort == "ts").alias("n_ts"),
            F.count_if(number & has_leading_zero(value)).alias("n_lead0"),
            F.max(F.length(value)).alias("max_len"),
            F.max(F.when(number, whole_digits(value))).alias("max_whole"),
            F.max(F.when(number, scale_digits(value))).alias("max_scale"),
        )
    )


def value_ranges(df: DataFrame) -> DataFrame:
    """Exact distinct count, smallest and largest text per column.

    Needs the distinct values of every column, which are made unique in every task before the
    shuffle. Type inference does without it.
    """
    distinct = _long(df).filter(F.col("value").isNotNull()).distinct()
    return distinct.groupBy("column_name").agg(
        F.count("*").alias("n_distinct"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    )


def _long(df: DataFrame) -> DataFrame:
    """(column_name, value) rows; ``unpivot`` needs all columns to have one type."""
    names = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
    text = df.select([n.cast("string").alias(c) for n, c in zip(names, df.columns)])
    return text.unpivot([], names, "column_name", "value")


def profile_tables(
    tables: dict[str, DataFrame], profile: Callable[[DataFrame], DataFrame] = profile_columns
) -> DataFrame:
    """The profiles of several tables, with the table name in front."""
    profiles = [
        profile(df).select(F.lit(name).alias("table_name"), "*") for name, df in tables.items()
    ]
    result = profiles[0]
    for other in profiles[1:]:
        result = result.unionByName(other)
    return result


def rows_profiled(profile: DataFrame) -> DataFrame:
    """Rows per profiled table: every column was counted over all of them."""
    return profile.groupBy("table_name").agg(F.max("n").alias("n_source"))


def infer_types(profile: DataFrame, text_columns: list[str] | None = None) -> DataFrame:
    """The narrowest type that holds every value of each profiled column.

    Identifiers stay text: columns called like one of ``IDENTIFIERS``, those named in
    ``text_columns`` (``column`` or ``table.column``), numbers with a leading zero, and digit runs
    too long for a bigint.
    """
    name, listed = F.col("column_name"), text_columns or []
    identifier = F.lower(name).isin(*IDENTIFIERS) | name.isin(listed) | F.concat_ws(".", "table_name", name).isin(listed)
    filled = F.col("n") - F.col("n_null")
    numeric = F.col("n_int") + F.col("n_dec")
    digits = F.col("max_whole") + F.col("max_scale")
    decimal = F.concat(F.lit("decimal("), digits, F.lit(","), F.col("max_scale"), F.lit(")"))
    spark_type = (
        F.when(identifier | (F.col("n_lead0") > 0), "string")
        .when(filled == 0, "string")
        .when(F.col("n_bool") == filled, "boolean")
        .when((F.col("n_int") == filled) & (F.col("max_whole") <= MAX_BIGINT_DIGITS), "bigint")
        .when((F.col("n_dec") > 0) & (numeric == filled) & (digits <= MAX_DECIMAL_DIGITS), decimal)
        .when(F.col("n_date") == filled, "date")
        .when(F.col("n_ts") + F.col("n_date") == filled, "timestamp_ntz")
        .otherwise("string")
    )
    return profile.select("table_name", "column_name", spark_type.alias("spark_type"))


def infer_schema(df: DataFrame, text_columns: list[str] | None = None) -> T.StructType:
    """Profile an all-text table and return its schema, in the table's column order."""
    types = infer_types(profile_tables({"t": df}), text_columns)
    return schemas_of(types, {"t": df.columns})["t"]


def schemas_of(types: DataFrame, columns: dict[str, list[str]]) -> dict[str, T.StructType]:
    """Schemas without constraints: every column may be null.

    Only one row per column reaches the driver. A column without a row (empty table) is text.
    """
    found = {(row["table_name"], row["column_name"]): row["spark_type"] for row in types.collect()}
    return {
        table: T.StructType(
            [T.StructField(c, T.DataType.fromDDL(found.get((table, c), "string")), True) for c in names]
        )
        for table, names in columns.items()
    }


def to_ddl(table: str, schema: T.StructType) -> str:
    """``CREATE TABLE`` text for a schema, without keys or NOT NULL."""
    quoted = [f.name.replace("`", "``") for f in schema.fields]
    types = [f.dataType.simpleString() for f in schema.fields]
    body = ",\n".join(f"  `{name}` {type_name}" for name, type_name in zip(quoted, types))
    return f"CREATE TABLE `{table}` (\n{body}\n)"

