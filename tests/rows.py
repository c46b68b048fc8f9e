"""Rows of a frame as plain values."""


def as_set(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.select(*columns).collect())
