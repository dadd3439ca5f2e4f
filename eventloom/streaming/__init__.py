"""Stateful indexes, sinks with redelivery, and the continuous services."""
