"""Device family from the raw platform, device code and cast flag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from watchpath.functions.memo import memo_column


@memo_column
def device_family(platform: str | Column = "post_evar37",
                  code: str | Column = "post_evar53",
                  cast: str | Column = "post_evar106") -> Column:
    """Six ordered rules, else the platform unchanged.

    The fourth rule compares a lower-cased value with a mixed-case literal
    and therefore never fires; it is kept as written.
    """
    p = F.col(platform) if isinstance(platform, str) else platform
    c = F.col(code) if isinstance(code, str) else code
    k = F.col(cast) if isinstance(cast, str) else cast
    lp, lk, tail = F.lower(p), F.lower(k), F.right(c, F.lit(5))
    return (
        F.when((lp == "xfinity") & (tail == ":1001"), F.concat(p, F.lit(" Flex")))
        .when((lp == "xfinity") & ((tail != ":1001") | c.isNull()), F.concat(p, F.lit(" X1")))
        .when((lk == "chromecast") & (lp == "android tv"), F.lit("Google TV"))
        .when((lk == "chromecast") & (lp == "Chromecast Receiver App"), F.lit("Chromecast Receiver App"))
        .when(lp.like("%xbox%"), F.lit("xbox"))
        .when(lp == "ps4", F.lit("playstation"))
        .otherwise(p)
    )
