"""String functions: Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_text(value: Column) -> Column:
    """Value as a string; booleans become ``true`` / ``false``."""
    return value.cast("string")


def concat(*parts: Column) -> Column:
    """Join the parts; null as soon as one part is null."""
    return F.concat(*[as_text(p) for p in parts])


def length(text: Column) -> Column:
    return F.length(text)


def position(needle: Column, text: Column) -> Column:
    """1-based place of ``needle`` in ``text``; 0 when absent."""
    return F.position(needle, text)


def replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def right(text: Column, n: Column | int) -> Column:
    """Last ``n`` characters; '' for 0, the whole text when it is shorter."""
    return F.right(text, n if isinstance(n, Column) else F.lit(n))


def split_part(text: Column, delimiter: str, part: int) -> Column:
    """Part number ``part`` (from 1) between literal delimiters; '' when absent."""
    return F.split_part(text, F.lit(delimiter), F.lit(part))


def safe_cast(value: Column, data_type: str) -> Column:
    """Cast that yields null instead of an error."""
    return value.try_cast(data_type)


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def slugify(text: Column) -> Column:
    """Lower case, runs of blanks and dashes to ``_``, other signs dropped."""
    joined = F.regexp_replace(F.lower(text), "[ -]+", "_")
    return F.regexp_replace(joined, "[^a-z0-9_]+", "")


def slugify_name(name: str) -> str:
    """``slugify`` for a column name known on the driver."""
    import re

    return re.sub("[^a-z0-9_]+", "", re.sub("[ -]+", "_", name.lower()))


def full_name(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" "), last)


def text_or(value: Column, fallback: str = "None") -> Column:
    """Value as text, with a word in place of null."""
    return F.coalesce(as_text(value), F.lit(fallback))


def json_flag(payload: Column, path: str) -> Column:
    """True when the JSON field holds true; absent fields count as false."""
    return F.coalesce(F.get_json_object(payload, path), F.lit("false")) == F.lit("true")


def is_placeholder(text: Column, word: str = "TEST") -> Column:
    return F.upper(text) == F.lit(word)


def is_not_title_case(text: Column) -> Column:
    return text != F.initcap(text)


def starts_non_ascii(text: Column) -> Column:
    return F.ascii(F.left(text, F.lit(1))) > 127


def check_target(node: Column) -> Column:
    """Model a check is attached to: the last dotted part of its node id."""
    return F.substring_index(node, ".", -1)


def check_base_name(name: Column) -> Column:
    """Check name without its last ``__`` suffix."""
    return F.regexp_replace(name, "(?s)^(.*)__.*$", "$1")


def check_kind(name: Column, model: Column) -> Column:
    """Part of the check name before ``_<model>``."""
    base = check_base_name(name)
    at = F.position(F.concat(F.lit("_"), model), base)
    return F.when(at > 0, F.substring(base, F.lit(1), at - 1)).otherwise(base)


def check_column(name: Column, model: Column) -> Column:
    """Column a check is about: what follows ``_<model>``, without the joining underscore.

    When the rest starts with two underscores only one is taken off, as the other belongs to the name.
    """
    base = check_base_name(name)
    marker = F.concat(F.lit("_"), model)
    at = F.position(marker, base)
    rest = F.when(at > 0, F.substring(base, at + F.length(marker), F.length(base))).otherwise(F.lit(""))
    return F.when(rest.startswith("__"), F.substring(rest, F.lit(2), F.length(rest))).otherwise(
        F.regexp_replace(rest, "^_+", "")
    )
