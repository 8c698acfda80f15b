"""String helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_split(c: Column) -> tuple[Column, Column]:
    """AGG14: rsplit('_', 1) -> (base, label); no underscore -> (c, '')."""
    has = c.contains("_")
    base = F.when(has, F.regexp_extract(c, r"^(.*)_([^_]*)$", 1)).otherwise(c)
    label = F.when(has, F.regexp_extract(c, r"^(.*)_([^_]*)$", 2)).otherwise(F.lit(""))
    return base, label


def normalize_mac(c: Column) -> Column:
    """SCL10: drop ':' and '-', upper case."""
    return F.upper(F.regexp_replace(c, r"[:\-]", ""))


def keyword_columns(columns, include=(), exclude=()) -> list[str]:
    """PRJ27 (plan time): case-insensitive keyword select.

    A column is kept when it matches any include keyword (or no include list
    is given) and matches none of the exclude keywords.
    """
    import re

    inc = [re.compile(k, re.IGNORECASE) for k in include]
    exc = [re.compile(k, re.IGNORECASE) for k in exclude]
    out = []
    for c in columns:
        if inc and not any(p.search(c) for p in inc):
            continue
        if any(p.search(c) for p in exc):
            continue
        out.append(c)
    return out


def keyword_renames(columns, pairs, silent: bool = True) -> dict[str, str]:
    """PRJ28 (plan time): each (keywords, new_name) pair renames the first
    not-yet-used column containing all keywords (case-insensitive).

    Returns {old: new}; pairs that match nothing are skipped (with a warning
    unless ``silent``).
    """
    used: set[str] = set()
    mapping: dict[str, str] = {}
    for keywords, new in pairs:
        kws = [keywords] if isinstance(keywords, str) else list(keywords)
        hit = next((c for c in columns if c not in used
                    and all(k.lower() in c.lower() for k in kws)), None)
        if hit is None:
            if not silent:
                print(f"no column matches {kws}")
            continue
        used.add(hit)
        mapping[hit] = new
    return mapping
