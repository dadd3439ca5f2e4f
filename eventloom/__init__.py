"""Repository change-event analytics as Spark DataFrame and streaming operators."""
