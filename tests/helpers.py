"""Comparison helpers."""

from collections import Counter


def rows(df, *cols):
    """Rows as a multiset of tuples, columns in the given or their own order."""
    cols = cols or df.columns
    return Counter(tuple(r) for r in df.select(*cols).collect())


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    left, right = rows(a), rows(b, *a.columns)
    assert left == right, f"only left {list((left - right).items())[:3]}, only right {list((right - left).items())[:3]}"
    return sum(left.values())
