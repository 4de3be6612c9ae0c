"""Post filters (empty / blank)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_not_blank

FILTER_MODES = ("blank", "empty")


def keep_post(mode: str = "blank", title: str = "title", selftext: str = "selftext") -> Column:
    """True for posts that survive the filter; never null.

    ``empty``: title and selftext non-empty (null counts as empty).
    ``blank``: also selftext not all whitespace / control chars (the title is not trimmed).
    """
    if mode not in FILTER_MODES:
        raise ValueError(f"unknown filter mode {mode!r}; use one of {FILTER_MODES}")
    t, s = F.col(title), F.col(selftext)
    keep = (t != "") & (s != "")
    if mode == "blank":
        keep = keep & is_not_blank(s)
    return F.coalesce(keep, F.lit(False))


def filter_posts(posts: DataFrame, mode: str = "blank") -> DataFrame:
    """Drop empty (and by default blank) posts; a narrow filter, no shuffle."""
    return posts.filter(keep_post(mode))
