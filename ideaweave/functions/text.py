"""Column -> Column scalar functions (all JVM-side built-ins, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import EMBED_DESCRIPTION_CHARS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def cut(x, chars: int | None) -> Column:
    """The first ``chars`` characters; None: the whole text."""
    return _c(x) if chars is None else F.substring(_c(x), 1, chars)


def strip_tags(x) -> Column:
    """Remove markup tags, then trim all leading/trailing whitespace (incl. tabs, newlines, NBSP)."""
    return js_trim(F.regexp_replace(_c(x), "<[^>]+>", ""))


def js_trim(x) -> Column:
    return F.regexp_replace(_c(x), r"^[\s ﻿]+|[\s ﻿]+$", "")


def collapse_ws(x) -> Column:
    return F.regexp_replace(_c(x), r"\s+", " ")


def empty_to_null(x) -> Column:
    return F.nullif(_c(x), F.lit(""))


def or_default(x, default: str) -> Column:
    """JS ``x || default``: empty string and null both fall back."""
    return F.coalesce(empty_to_null(x), F.lit(default))


def embed_document(title="title", category="category", description="description",
                   chars: int | None = EMBED_DESCRIPTION_CHARS) -> Column:
    """``title + ' ' + category + ' ' + description`` (its first ``chars`` characters; None: all)."""
    return F.concat(
        F.coalesce(_c(title), F.lit("")), F.lit(" "),
        F.coalesce(_c(category), F.lit("")), F.lit(" "),
        cut(F.coalesce(_c(description), F.lit("")), chars),
    )


def tokenize(doc) -> Column:
    """Lowercase, every char outside [a-z0-9] separates, keep tokens longer than 2 chars."""
    return F.filter(F.split(F.lower(_c(doc)), "[^a-z0-9]+"), lambda t: F.length(t) > 2)


def item_line(idea_id="idea_id", title="title", source="source", category="category",
              description="description", chars: int | None = None) -> Column:
    """``[ID:n] "title" (source, category): description`` (fixed line format; ``chars`` None: whole)."""
    return F.concat(
        F.lit("[ID:"), _c(idea_id).cast("string"), F.lit('] "'), F.coalesce(_c(title), F.lit("")),
        F.lit('" ('), F.coalesce(_c(source), F.lit("")), F.lit(", "),
        or_default(category, "uncategorized"), F.lit("): "),
        cut(F.coalesce(_c(description), F.lit("")), chars),
    )


def set_hash(ids) -> Column:
    """Order-free hash of an id array: sort numerically, join with ',', SHA-256 hex."""
    return F.sha2(F.array_join(F.transform(F.array_sort(_c(ids)), lambda x: x.cast("string")), ","), 256)


def round_clamp_1_10(x) -> Column:
    """Round half up, then clamp to 1..10."""
    return F.greatest(F.lit(1), F.least(F.lit(10), F.floor(_c(x) + F.lit(0.5)))).cast("int")


def outer_json_object(text) -> Column:
    """Greedy outermost JSON object: from the first '{' to the last '}' ('' if none)."""
    return F.regexp_extract(_c(text), r"(?s)\{.*\}", 0)
