"""Role-based masking of tagged text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverloom.functions.exprs import col

# Fixed values.
TAGS = ("NAME", "EMAIL", "PHONE", "NIF", "ADDRESS")
PRIVILEGED = ("ACCOUNTADMIN", "DATA_ENGINEER")
MASK = "***MASKED***"


def mask_columns(df: DataFrame, tags: dict[str, str], role: str) -> DataFrame:
    """``tags`` = {column: tag}. Other than privileged roles see the mask, also instead of NULL."""
    unknown = sorted(set(tags.values()) - set(TAGS))
    if unknown:
        raise ValueError(f"unknown tags {unknown}")
    other = [f.name for f in df.schema if f.name in tags and not isinstance(f.dataType, T.StringType)]
    if other:
        raise ValueError(f"only text columns can be masked, not {other}")
    if role in PRIVILEGED:
        return df
    return df.select(*[F.lit(MASK).alias(c) if c in tags else col(c) for c in df.columns])
