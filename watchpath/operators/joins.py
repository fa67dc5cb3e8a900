"""Joins against a side whose size depends on the data.

Dimension-like sides here (episode->series maps, channel lists, video lookups,
cohort account lists) are small in practice but not bounded by construction.
They are written once as a table in the shared checkpoint folder (cutting
lineage, surviving executor loss), so Spark plans the join by their true bytes: it
broadcasts them under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles
beyond it. Nothing is forced and no mark is kept on a DataFrame.

A cohort that is too large to broadcast still prunes the viewing mart before its
shuffle: Spark's runtime Bloom filter carries the account ids to the scan
(``cohort``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchpath.session import materialize


def bounded(small: DataFrame) -> DataFrame:
    """``small`` written once as a table of known bytes."""
    return materialize(small, "small-side")


def cohort(accounts: DataFrame, key: str) -> DataFrame:
    """Distinct account ids as a written table for semi-joins.

    Spark builds a runtime Bloom filter only from a side that it takes for selective,
    which it reads off a comparison over the scan. Every id passes this one; NULL, which
    no join matches, does not.
    """
    return bounded(accounts.where(F.col(key).isNotNull())).where(F.col(key).cast("string") >= "")


def join_small(big: DataFrame, small: DataFrame, on: str | list[str] | Column, how: str = "inner") -> DataFrame:
    return big.join(bounded(small), on, how)
