"""Fields of nested JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How Spark's readers treat a broken document: end the job, rather than leave it out in silence.
STRICT = "FAILFAST"


def json_field(text: Column, path: str, data_type: str = "string") -> Column:
    """Value at ``path``; null where the path, or the text itself, is absent or malformed."""
    return F.try_variant_get(F.try_parse_json(text), path, data_type)
