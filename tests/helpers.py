from __future__ import annotations

import math


def rows(df, *columns):
    """Sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def one(df):
    found = df.collect()
    assert len(found) == 1
    return found[0]


def close(a, b, eps=1e-9):
    return math.isclose(a, b, rel_tol=eps, abs_tol=eps)
