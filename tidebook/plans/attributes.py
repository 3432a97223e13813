"""Attribute values of events: JSON properties and columns in long form, typed, and wide by user."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.operators.attributes import long_values, typed_values, wide_values
from tidebook.sources.star import table

# ``ts`` is no number: its rows show the lane of bad values.
EVENT_TYPES = {"k": "number", "value": "number", "event_type": "text", "is_purchase": "boolean", "ts": "number"}
# ``shade`` is not in the dictionary.
EVENT_VALUES = (*EVENT_TYPES, "shade")


def event_values(spark: SparkSession, root: str) -> DataFrame:
    """entity (user), event_id, attribute, value of all events."""
    events = table(spark, root, "events").withColumn("properties", F.from_json("props", "map<string,string>"))
    properties = F.col("properties")
    columns = {
        "k": properties["k"],
        "value": F.col("value"),
        "event_type": F.col("event_type"),
        "is_purchase": (F.col("event_type") == "purchase").cast("string"),
        "ts": F.date_format("ts", "yyyy-MM-dd"),
        "shade": properties["shade"],
    }
    return long_values(events, "user_id", {name: columns[name] for name in EVENT_VALUES}, "event_id")


def event_dictionary(spark: SparkSession) -> DataFrame:
    """The types as literal rows: their size is known to the planner, so they are broadcast and the
    values, of which each attribute has very many, are not shuffled by attribute."""
    rows = ", ".join(f"('{name}', '{kind}')" for name, kind in EVENT_TYPES.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(attribute, data_type)")


def typed_event_values(spark: SparkSession, root: str) -> DataFrame:
    return typed_values(event_values(spark, root), event_dictionary(spark))


def users_wide(spark: SparkSession, root: str) -> DataFrame:
    """One row for each user with the values of the user's first event that has a good one."""
    return wide_values(typed_event_values(spark, root), EVENT_TYPES, ["event_id"])
