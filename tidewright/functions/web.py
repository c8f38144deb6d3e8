"""Parts of a URL, by plain text rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewright.functions.text import position, replace, right, split_part


def url_host(url: Column) -> Column:
    """Text up to the first ``/`` and ``?`` once the scheme is gone."""
    bare = url
    for scheme in ("android-app://", "http://", "https://"):
        bare = replace(bare, scheme, "")
    return split_part(split_part(bare, "/", 1), "?", 1)


def url_path(url: Column) -> Column:
    """Text after the first ``/`` up to ``?``; without a slash, what follows the ``?`` rule."""
    bare = replace(replace(url, "http://", ""), "https://", "")
    slash = position(F.lit("/"), bare)
    cut = F.when(slash > 0, slash).otherwise(position(F.lit("?"), bare) - 1)
    return split_part(right(bare, F.length(bare) - cut), "?", 1)


def url_parameter(url: Column, name: str) -> Column:
    """Text after the first ``name=`` up to ``&``; null when absent or blank."""
    return F.nullif(split_part(split_part(url, f"{name}=", 2), "&", 1), F.lit(""))
