"""Column functions on JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bikeflow import schemas


def parse_document(text: Column, station: str, strict: bool = False) -> Column:
    """A whole feed document. A malformed one gives NULL fields, or fails when ``strict``."""
    options = {"mode": "FAILFAST"} if strict else {}
    return F.from_json(text, schemas.document_type(station), options)


def parse_data(text: Column, station: str) -> Column:
    """The ``data`` object of a feed document."""
    return F.from_json(text, schemas.data_type(station))


def infer_json_schema(texts: DataFrame, column: str) -> DataFrame:
    """One row with the schema that fits the JSON text of all rows.

    The schemas are merged map-side, so only schema text is shuffled.
    """
    return texts.agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("json_schema"))


def first_leg_steps(route: Column) -> Column:
    """Steps of the first leg of the first route of a parsed route document."""
    return F.get(F.get(route["routes"], 0)["legs"], 0)["steps"]


def _total(steps: Column, field: str) -> Column:
    return F.aggregate(steps, F.lit(0.0), lambda acc, s: acc + F.coalesce(s[field], F.lit(0.0)))


def route_totals(steps: Column) -> Column:
    """Distance in km (one digit) and duration in seconds over all steps of a route."""
    return F.struct(
        F.round(_total(steps, "distance") / 1000, 1).alias("distance_km"),
        F.round(_total(steps, "duration"), 0).alias("duration_s"),
    )
