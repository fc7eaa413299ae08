"""Helpers shared by the tests."""


def rows(df, *cols):
    """Sorted list of tuples of the given columns."""
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple(map(str, t)))
