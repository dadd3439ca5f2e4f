"""Compact change messages for other systems."""

from pyspark.sql import DataFrame, functions as F

from eventloom.operators.events import exclude_containers, merge_live_and_hints, with_forward_type


def forward_message(df: DataFrame) -> DataFrame:
    """Add the JSON message ``{"id": …, "type": …}`` as ``message``."""
    typed = with_forward_type(df)
    body = F.struct(F.col("uri").alias("id"), F.col("forward_type").alias("type"))
    return typed.withColumn("message", F.to_json(body))


def forward_input(events: DataFrame, hints: DataFrame | None = None, containers=()) -> DataFrame:
    """What gets forwarded: live events and hints; the exclusion list holds for all of them."""
    if hints is not None:
        events = merge_live_and_hints(events, hints)
    return forward_message(exclude_containers(events, containers))
