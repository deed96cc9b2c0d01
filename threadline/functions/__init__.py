"""Scalar expression helpers (all built-in Spark expressions)."""

from threadline.functions import hashing, roles, text  # noqa: F401
