"""watchpath: viewing-attribution analytics on Spark DataFrames.

Two input tables drive everything: player click signals (``clickstream``)
and one row per viewing (``video``). The package builds a per account-day
timeline from them, attributes every viewing to auto-play, an up-next
click, a manual selection or nothing, and reports on top of that
timeline. Every operator is a function from DataFrames to a DataFrame;
Catalyst plans the whole chain.

Layout:
    functions/  Column expressions (rules, title cleaning, devices, hours, dates)
    sources/    table access: stand-in tables, lake tables, the attributed store
    operators/  DataFrame -> DataFrame steps (clicks, plays, timeline, share,
                feeders, promo, skew-safe ordered scans, sized joins)
    plans/      end-to-end compositions and the query registry
    streaming/  incremental daily refresh of the attributed store
"""

from watchpath.session import checkpoint_dir, get_session

__all__ = ["checkpoint_dir", "get_session"]
