"""Attributes of feature files as typed columns, and back to text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def gff_attribute(attrs: Column, name: str) -> Column:
    """The value of `name=value;`, null if absent. A name counts only at the start of an attribute."""
    return F.nullif(F.regexp_extract(attrs, rf"(?:^|[; ]){name}=([^;]+)", 1), F.lit(""))


def gtf_attribute(attrs: Column, name: str) -> Column:
    """The value of `name "value"`, null if absent."""
    return F.nullif(F.regexp_extract(attrs, rf'{name} "([^"]+)"', 1), F.lit(""))


def rendered(**values: Column) -> Column:
    """`name=value; ` for the values that aren't null, in order; `.` if none is."""
    text = F.concat_ws(" ", *(F.when(v.isNotNull(), F.concat(F.lit(f"{k}="), v.cast("string"), F.lit(";"))) for k, v in values.items()))
    return F.when(text == "", ".").otherwise(text)
