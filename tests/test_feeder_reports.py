"""The feeder reports on rows of their own: every published rank, and for each click day its own map and channels."""

import datetime as dt

import pytest

from watchpath import columns as C
from watchpath.plans.registry import queries
from watchpath.sources.standin import TITLES

NOON = dt.datetime(2024, 3, 4, 17)             # noon in New York
#: Feeders of one day and the accounts that each moves on: 53 series with 53 totals.
REACH = {f"series {i:02}": i for i in range(1, 54)}


class Events:
    """Rows of the events table whose stand-in rows are Fire TV clicks and viewings."""

    def __init__(self):
        self.rows, self.next = [], 0

    def _add(self, account, ts, kind, k, fits):
        while self.next % 97 == 0 or not fits(self.next):
            self.next += 1
        self.rows.append((self.next, ts, account * 8, kind, 30.0, f'{{"k": {k}}}'))
        self.next += 1

    def moved_on(self, account, feeder, day=0):
        """An auto-play of ``feeder``, then one of another title: ``feeder`` has moved the account on."""
        for minute, title in enumerate((feeder, "Foxtrot")):
            self._add(account, NOON + dt.timedelta(days=day, minutes=minute), "click", TITLES.index(title) * 10,
                      lambda i: i % 8 in (6, 7))

    def viewing(self, title, day=0, channel=False):
        """A viewing of ``title`` with the episode "alpha show", in the linear channel "Bravo Live" or in none."""
        self._add(1, NOON + dt.timedelta(days=day), "view", next(k for k in range(TITLES.index(title) * 10, 100) if k % 3 == 0),
                  lambda i: i % 13 and i % 17 and i % 23 and (i % 6 == 0) == channel)

    def write(self, folder) -> str:
        import pyarrow as pa
        import pyarrow.parquet as pq

        kinds = (("event_id", pa.int64()), ("ts", pa.timestamp("us")), ("user_id", pa.int64()), ("event_type", pa.string()),
                 ("value", pa.float64()), ("props", pa.string()))
        pq.write_table(pa.table({n: pa.array(c, t) for (n, t), c in zip(kinds, zip(*self.rows))}), folder / "events.parquet")
        return str(folder)


def matches_oracle(df, folder, name):
    import duckdb
    from compare import compare
    from oracle_sql import oracle_sql

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{folder}/events.parquet')")
    return compare(df, con, oracle_sql()[name])


@pytest.mark.parametrize("name", ["top_feeders_daily", "device_top_feeders"])
def test_ranks_past_the_third_are_in_the_report(spark, tmp_path, name):
    e, account = Events(), 1
    e.viewing("Delta")                          # the episode "alpha show" is one of the series Delta
    for n, feeder in enumerate(("charlie trailer", "Bravo: Live!", "Echo & Co.", "Foxtrot", "alpha show"), 1):
        for account in range(account, account + n):
            e.moved_on(account, feeder)
        account += 1
    folder = e.write(tmp_path)
    df = queries()[name](spark, folder)
    assert {(r.Daily_Ranks, r.Auto_Binge_Source_Titles, r.Total_Unique_Accounts) for r in df.collect()} == {
        (1, "delta", 5), (2, "foxtrot", 4), (3, "echo  co", 3), (4, "bravo live", 2), (5, "charlie trailer", 1)}
    ok, message = matches_oracle(df, folder, name)
    assert ok, message


def test_report_ends_at_the_published_rank(spark):
    from watchpath.operators.feeders import COMBINATION, top_feeders
    from watchpath.plans import params as P

    rows = [("2024-03-04", series, 0, 0, n) for series, n in REACH.items()] + [("2024-03-04", "tied", 0, 0, 53)]
    reach = spark.createDataFrame(rows, f"{C.DAY} string, {COMBINATION} string, Unique_Auto_Binge_Accounts long, "
                                        "Unique_Click_Next_Accounts long, Total_Unique_Accounts long")
    got = {r.Auto_Binge_Source_Titles: r.Daily_Ranks for r in top_feeders(reach, P.TOP_K).collect()}
    assert got == {s: 54 - n for s, n in REACH.items() if n > 3} | {"tied": 1}


@pytest.fixture
def three_days(tmp_path):
    """The episode "alpha show" is of another series each day; "Bravo: Live!" is a linear channel on the second only."""
    e = Events()
    for day, series in enumerate(("Delta", "Echo & Co.", "Foxtrot")):
        e.viewing(series, day, channel=day == 1)
        e.moved_on(day + 2, "alpha show", day)
        e.moved_on(day + 12, "Bravo: Live!", day)
    return e.write(tmp_path)


def reached(df):
    return {((r.Adobe_Date - NOON.date()).days, r.Auto_Binge_Source_Titles) for r in df.collect()}


OWN_DAYS = {(0, "delta"), (0, "bravo live"), (1, "echo  co"), (2, "foxtrot"), (2, "bravo live")}


@pytest.mark.parametrize("name", ["feeder_destination_pairs", "device_top_feeders"])
def test_each_click_day_has_its_own_map_and_channels(spark, three_days, name):
    df = queries()[name](spark, three_days)
    assert reached(df) == OWN_DAYS
    ok, message = matches_oracle(df, three_days, name)
    assert ok, message


def test_a_named_map_day_and_channel_day_hold_for_all_click_days(spark, three_days):
    from watchpath.plans import params as P
    from watchpath.plans.feeders import device_top_feeders, feeder_destination_pairs
    from watchpath.plans.registry import tables
    from watchpath.sources.standin import PLAYER_EVENT_BRAND as BRAND

    t = tables(spark, three_days)
    first, second = NOON.date(), NOON.date() + dt.timedelta(days=1)
    for channel_day, channels in ((first, {(day, "bravo live") for day in range(3)}), (second, set())):
        want = {(day, "foxtrot") for day in range(3)} | channels
        days = {"map_day": t.scope().end, "channel_day": channel_day}
        assert reached(feeder_destination_pairs(t, *t.scope(), BRAND, device_like=P.DEVICE_LIKE, **days)) == want
        assert reached(device_top_feeders(t, *t.scope(), P.DEVICE_LIKE, BRAND, **days)) == want
