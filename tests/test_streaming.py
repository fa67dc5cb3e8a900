"""The streaming refresh builds the same store as a batch run."""

import tempfile

from conftest import SF_SMALL
from watchpath import columns as C
from watchpath.plans import params as P
from watchpath.plans.registry import attributed, tables
from watchpath.sources.standin import PLAYER_EVENT_BRAND
from watchpath.sources.store import load_attributed
from watchpath.streaming import refresh_attributed


def test_refresh_matches_batch(spark):
    root = tempfile.mkdtemp(prefix="watchpath-stream-")
    store, ckpt = f"{root}/store", f"{root}/ckpt"
    t = tables(spark, SF_SMALL)
    for _ in range(2):          # the second run finds no new files and changes nothing
        q = refresh_attributed(spark, t, store, ckpt, P.TARGET, PLAYER_EVENT_BRAND)
        q.awaitTermination(300)
        got = sorted(tuple(r) for r in load_attributed(spark, store).collect())
        want = sorted(tuple(r) for r in attributed(spark, SF_SMALL, "feeder").select(*C.ATTRIBUTED).collect())
        assert got == want
