"""Every registered query against its DuckDB oracle on the stand-in tables."""

import pytest

from compare import compare
from conftest import SF_MID, SF_SMALL
from oracle_sql import oracle_sql
from watchpath.plans.registry import queries

NAMES = sorted(queries())
HEADLINE = ["attributed_timeline_display", "attributed_timeline_blank", "attributed_timeline_feeder",
            "autoplay_share", "top_feeders_daily", "device_feed_list", "promo_reach_hours"]


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_small(spark, duck_small, name):
    ok, msg = compare(queries()[name](spark, SF_SMALL), duck_small, oracle_sql()[name])
    assert ok, msg


@pytest.mark.parametrize("name", HEADLINE)
def test_query_matches_oracle_mid(spark, duck_mid, name):
    ok, msg = compare(queries()[name](spark, SF_MID), duck_mid, oracle_sql()[name])
    assert ok, msg


DUCK_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
              "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", NAMES)
def test_names_and_types_match_oracle(spark, duck_small, name):
    df = queries()[name](spark, SF_SMALL)
    ours = {f.name: DUCK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
            for f in df.schema.fields}
    theirs = {d[0]: str(d[1]) for d in duck_small.execute(oracle_sql()[name]).description}
    assert ours == theirs
