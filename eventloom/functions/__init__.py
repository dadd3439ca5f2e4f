"""Column helpers: thin names over built-in Spark expressions."""

from eventloom.functions.columns import *  # noqa: F401,F403
