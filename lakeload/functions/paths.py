"""Object-key expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

DATA_SUFFIX = ".csv.gz"
SIDECAR_SUFFIX = ".dfm"
CHANGES_SUFFIX = "__ct"


def dir_name(key: Column) -> Column:
    """Everything before the last slash; ``.`` when there is no slash."""
    return F.when(key.contains("/"), F.regexp_replace(key, r"/[^/]*$", "")).otherwise(F.lit("."))


def base_name(key: Column, suffix: str = "") -> Column:
    """Everything behind the last slash, without ``suffix`` if it ends so."""
    return drop_suffix(F.substring_index(key, "/", -1), suffix)


def root_name(key: Column, suffix: str = DATA_SUFFIX) -> Column:
    return drop_suffix(key, suffix)


def drop_suffix(text: Column, suffix: str) -> Column:
    return swap_suffix(text, suffix, "")


def swap_suffix(text: Column, suffix: str, replacement: str) -> Column:
    """Replace ``suffix`` only where the text ends with it."""
    if not suffix:
        return text
    kept = F.substring(text, F.lit(1), F.length(text) - len(suffix))
    return F.when(text.endswith(suffix), F.concat(kept, F.lit(replacement)) if replacement else kept).otherwise(text)


def drop_prefix(text: Column, prefix: str) -> Column:
    """Remove ``prefix`` only where the text starts with it."""
    if not prefix:
        return text
    return F.when(text.startswith(prefix), F.substring(text, F.lit(len(prefix) + 1), F.length(text))).otherwise(text)


def starts_below(key: Column, prefix: str) -> Column:
    return key.startswith(prefix)


def prefix_of(key: Column) -> Column:
    """The key's folder with its trailing slash; empty for a bare name."""
    return F.regexp_extract(key, r"(?s)^(.*/)", 1)


def first_folder_below(key: Column, root: str) -> Column:
    """``root`` plus the next path segment, as a delimiter listing returns it; NULL if none."""
    found = F.regexp_extract(key, "(?s)^(" + re.escape(root) + "[^/]*/)", 1)
    return F.when(found != "", found)
