"""Small helpers for the tests."""

import contextlib
import io


def rows(df, *columns):
    """The rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan_of(df):
    """The formatted physical plan as text."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
