"""Helpers the core tests share (in a module of its own name: several folders have a conftest)."""


def rows(df, order=None):
    """Collected rows as plain tuples (sorted when ``order`` is not given)."""
    out = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return out if order else sorted(out, key=lambda r: tuple((True, 0) if x is None else (False, x) for x in r))
