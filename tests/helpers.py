"""Small helpers that test modules import by name."""


def rows(df, *cols):
    """Sorted tuples of the given columns (all columns when none given)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((x is not None, x) for x in t))
