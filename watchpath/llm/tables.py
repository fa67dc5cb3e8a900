"""DataFrame helpers of the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchpath.session import checkpoint_dir, materialize

__all__ = ["checkpoint_dir", "col", "free_name", "materialize", "numbered", "run_path"]


def col(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col(f"`{name.replace('`', '``')}`")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``df`` clashes."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def run_path(df: DataFrame, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def numbered(df: DataFrame, row: str) -> DataFrame:
    """``df`` with a row number that is unique, and fixed once the result is written."""
    return df.withColumn(row, F.monotonically_increasing_id())
