"""Text normalising and key expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# They decide the key text, so they must not change between runs.
MISSING_TEXT = "NA"
KEY_SEPARATOR = "|"
NULL_TOKENS = ("", "NULL", "null", "Null")


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise(c: Column | str) -> Column:
    """Lower-case text without any blank; a missing value reads as ``na``."""
    known = F.coalesce(F.trim(_column(c)), F.lit(MISSING_TEXT))
    return F.replace(F.lower(known), F.lit(" "), F.lit(""))


def hash_key(norm_cols: Sequence[Column | str], raw_cols: Sequence[Column | str] = ()) -> Column:
    """md5 over normalised columns followed by columns taken as they are."""
    parts = [normalise(c) for c in norm_cols]
    parts += [F.coalesce(_column(c), F.lit(MISSING_TEXT)) for c in raw_cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def identity_key(
    id_col: Column | str,
    norm_cols: Sequence[Column | str],
    raw_cols: Sequence[Column | str] = (),
) -> Column:
    """The id's text where there is one, else the hash of the descriptive columns."""
    own_id = F.nullif(_column(id_col).cast("string"), F.lit(""))
    return F.coalesce(own_id, hash_key(norm_cols, raw_cols))


def equals_ignoring_case(c: Column | str, value: str) -> Column:
    return F.lower(_column(c)) == F.lit(value.lower())


def contains_ignoring_case(c: Column | str, part: str) -> Column:
    return F.lower(_column(c)).contains(part.lower())
