"""Entity-attribute-value tables: values typed by a dictionary, bad ones apart, and wide rows.

A long table has one row for each value: ``entity``, ``attribute``, ``value`` (text). A dictionary
says the type of each attribute: ``attribute``, ``data_type`` (``text``, ``number`` or ``boolean``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TYPES = {"text": "string", "number": "double", "boolean": "boolean"}

# What people type where they have no value.
PLACEHOLDERS = (".", "-", "--", "?", "??", "n/a", "na", "null", "none", "test", "todo", "tbd", "fixme", "xxx", "asdf")

BLANKS = " \t\n\x0b\f\r"
# Java's ``$`` also matches before one of these at the end of a text.
LINE_ENDS = ("\x85", "\u2028", "\u2029")

NUMBER = r"^[+-]?[0-9]+([.][0-9]+)?([eE][+-]?[0-9]+)?$"


def long_values(df: DataFrame, entity: str, columns: dict[str, Column], *keep: str) -> DataFrame:
    """One row for each entity and named value, null values too: entity, attribute, value, kept columns.

    The rows unfold inside the scan stage, without a shuffle.
    """
    named = F.array(*[F.struct(F.lit(n).alias("attribute"), c.cast("string").alias("value")) for n, c in columns.items()])
    rows = df.select(F.col(entity).alias("entity"), *keep, F.explode(named).alias("v"))
    return rows.select("entity", *keep, "v.attribute", "v.value")


def _trimmed(value: Column) -> Column:
    """``value`` without the blanks around it, and without those before a line end that ends it."""
    return F.when(F.right(value, F.lit(1)).isin(*LINE_ENDS), F.trim(F.regexp_replace(value, r"^\s+|\s+$", ""))).otherwise(
        F.btrim(value, F.lit(BLANKS))
    )


def typed_values(values: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``values`` with ``data_type``, ``value_text``, ``value_number``, ``value_boolean``, ``problem``.

    Exactly one of the three is filled where ``problem`` is null, and none where it is not, so good
    and bad rows add up to all rows. Blanks around a value are ignored. A number is written as
    digits with an optional sign, fraction and exponent, and must fit a double; a boolean is
    ``true`` or ``false`` in any case. Problems, the first that applies: ``unknown attribute`` (null
    or not in the dictionary), ``unknown type``, ``missing`` (null or blank), ``placeholder``,
    ``not a number``, ``not a boolean``. An attribute that the dictionary lists twice has its
    alphabetically first type, so no row is doubled. Other columns are kept; those called like a new
    one are replaced.
    """
    new = ("data_type", "value_text", "value_number", "value_boolean", "problem")
    types = dictionary.filter("attribute IS NOT NULL").groupBy("attribute").agg(
        F.min(F.coalesce("data_type", F.lit(""))).alias("data_type")
    )
    rows = values.drop(*new).join(types, "attribute", "left")
    text = _trimmed(F.col("value"))
    kind, low = F.col("data_type"), F.lower(text)
    number = F.when(text.rlike(NUMBER), text.try_cast("double"))
    number = F.when(F.abs(number) < float("inf"), number)
    boolean = F.when(low.isin("true", "false"), low == "true")
    problem = (
        F.when(kind.isNull(), "unknown attribute")
        .when(~kind.isin(*TYPES), "unknown type")
        .when(text.isNull() | (text == ""), "missing")
        .when(low.isin(*PLACEHOLDERS), "placeholder")
        .when((kind == "number") & number.isNull(), "not a number")
        .when((kind == "boolean") & boolean.isNull(), "not a boolean")
    )
    judged = rows.withColumn("problem", problem)
    # The type is asked first: whoever needs texts alone parses no numbers.
    good = F.col("problem").isNull()
    return judged.select(
        *[c for c in values.columns if c not in new],
        "data_type",
        F.when((kind == "text") & good, text).alias("value_text"),
        F.when((kind == "number") & good, number).alias("value_number"),
        F.when((kind == "boolean") & good, boolean).alias("value_boolean"),
        "problem",
    )


def value_problems(typed: DataFrame) -> DataFrame:
    """Rows of each attribute by problem (null: good ones): attribute, problem, n_rows."""
    return typed.groupBy("attribute", "problem").agg(F.count("*").alias("n_rows"))


def usual_spelling(typed: DataFrame) -> DataFrame:
    """For each text value its commonest spelling among those that differ only in case: attribute,
    value_text, n_rows, usual. Ties go to the alphabetically first. Counted per spelling first, so
    a hot value reaches the second step as one row."""
    spelled = typed.filter("value_text IS NOT NULL").groupBy("attribute", "value_text").agg(F.count("*").alias("n_rows"))
    first = F.min(F.struct((-F.col("n_rows")).alias("rank"), "value_text"))
    usual = spelled.groupBy("attribute", F.lower("value_text").alias("folded")).agg(first.alias("first"))
    joined = spelled.withColumn("folded", F.lower("value_text")).join(usual, ["attribute", "folded"])
    return joined.select("attribute", "value_text", "n_rows", F.col("first.value_text").alias("usual"))


def wide_values(typed: DataFrame, types: dict[str, str], order: list[str] | None = None) -> DataFrame:
    """One row for each entity, a null one included, with a column for each attribute of ``types``.

    The names are given, so no job looks for them; attributes beyond them are ignored. Of several
    good values of an entity's attribute, the one that comes first by ``order`` (columns of
    ``typed``, nulls last), then by the value, is taken; bad ones are not. An entity without a good
    value has nulls. Each task keeps one value for an entity and attribute before the shuffle, so an
    entity with very many rows arrives small.
    """
    unknown = {t for t in types.values()} - set(TYPES)
    if unknown:
        raise ValueError(f"unknown types {sorted(unknown)}")
    before = [part for c in order or [] for part in (F.col(c).isNull().alias(f"no_{c}"), F.col(c).alias(f"by_{c}"))]

    def chosen(name: str, kind: str) -> Column:
        value = F.col(f"value_{kind}")
        fits = (F.col("attribute") == name) & value.isNotNull()
        if not before:
            return F.min(F.when(fits, value)).alias(name)
        return F.min(F.when(fits, F.struct(*before, value.alias("value"))))["value"].alias(name)

    return typed.groupBy("entity").agg(*[chosen(name, kind) for name, kind in types.items()])
