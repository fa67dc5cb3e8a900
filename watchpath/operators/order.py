"""Published row order of the reports (the scripts' final ORDER BY).

Ordering is a global sort (a range shuffle), so plans apply it only when
asked (``ordered=True``): a result that is written partitioned or read by
another job does not need it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchpath import columns as C

# --- fixed values: the reports' output order (column, descending) ----------
ORDERS = {
    "attributed": [(C.ACCOUNT, False), (C.DAY, False), (C.TIME, False)],
    "feed_list": [(C.ACCOUNT, False), (C.DAY, False), (C.TIME, False)],
    "share": [(C.DAY, False), ("Unique_Accounts", True)],
    "top_feeders": [(C.DAY, False), ("Total_Unique_Accounts", True)],
    "promo": [("Hours", True)],
}


def published_order(df: DataFrame, report: str, ordered: bool = True) -> DataFrame:
    if not ordered:
        return df
    return df.orderBy(*[F.desc(c) if desc else F.asc(c) for c, desc in ORDERS[report]])
