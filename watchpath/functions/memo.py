"""Reuse built Column expressions.

A Column is an immutable expression tree on the JVM side; building a large
CASE from Python costs hundreds of gateway round trips. Expressions that
depend only on plain arguments (column names, literals) are built once per
process and shared by every query plan.
"""

from __future__ import annotations

import functools

_PLAIN = (str, int, float, bool, tuple, type(None))


def memo_column(fn):
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        if not all(isinstance(a, _PLAIN) for a in (*args, *kwargs.values())):
            return fn(*args, **kwargs)
        key = (args, tuple(sorted(kwargs.items())))
        col = cache.get(key)
        if col is None:
            col = cache[key] = fn(*args, **kwargs)
        return col

    return wrapper
