"""Drift of payloads, told without knowing the fields beforehand.

The fields of a load and the kinds of value they hold are counted from its payloads, in one
aggregate. Against the profile accepted last, a field is new, gone, or holds a kind of value
that it did not hold before. Null is no kind of its own: a field may always be null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROFILE = "field string, kind string, n bigint"


def kind_of(value: str | Column) -> Column:
    """The JSON kind of a variant value."""
    schema = F.schema_of_variant(value)
    return (
        F.when(schema == "VOID", "null").when(schema == "STRING", "string").when(schema == "BOOLEAN", "boolean")
        .when(schema.startswith("OBJECT"), "object").when(schema.startswith("ARRAY"), "array").otherwise("number")
    )


def profile(events: DataFrame, payload: str = "after_json") -> DataFrame:
    """How many payloads have a field, by the kind of its value.

    Each payload is parsed once; its fields and kinds leave the map tasks as counts. Events
    without a payload, and payloads that are no object, have no fields.
    """
    parsed = events.select(F.parse_json(F.coalesce(payload, F.lit("null"))).alias("_doc"))
    fields = parsed.lateralJoin(
        events.sparkSession.tvf.variant_explode_outer(F.col("_doc").outer()))
    return fields.filter("key IS NOT NULL").groupBy(
        F.col("key").alias("field"), kind_of(F.col("value")).alias("kind")).agg(F.count("*").alias("n"))


def accepted(before: DataFrame, found: DataFrame) -> DataFrame:
    """The profile that later loads are compared with, once ``found`` is accepted."""
    return before.unionByName(found).groupBy("field", "kind").agg(F.sum("n").alias("n"))


def _kinds(side: str) -> Column:
    return F.array_join(F.array_sort(F.collect_set(
        F.when((F.col("side") == side) & (F.col("kind") != "null"), F.col("kind")))), ",")


def drift(before: DataFrame, found: DataFrame) -> DataFrame:
    """(field, change, kinds_before, kinds_found, events): each field of the accepted and the
    found profile, as ``added``, ``gone``, ``retyped`` or ``same``.

    Profiles are as small as the payloads have fields.
    """
    both = before.withColumn("side", F.lit("before")).unionByName(found.withColumn("side", F.lit("found")))
    told = both.groupBy("field").agg(
        _kinds("before").alias("kinds_before"), _kinds("found").alias("kinds_found"),
        F.max(F.col("side") == "before").alias("known"), F.max(F.col("side") == "found").alias("there"),
        F.coalesce(F.sum(F.when(F.col("side") == "found", F.col("n"))), F.lit(0)).alias("events"))
    new = F.array_except(F.split("kinds_found", ","), F.split("kinds_before", ","))
    change = (
        F.when(~F.col("known"), "added").when(~F.col("there"), "gone")
        .when((F.col("kinds_found") != "") & (F.size(new) > 0), "retyped").otherwise("same")
    )
    return told.select("field", change.alias("change"), "kinds_before", "kinds_found", "events")
