"""Unicode text rules.

Spark 4.1 has no Unicode normalisation function, so only the normal form of
values that are not plain ASCII is taken in Python (Arrow batches; plain values
pass as nulls and are never looked at there).  All other steps are Catalyst
expressions.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NOT_ASCII = "[^\\x00-\\x7F]"
#: ASCII characters that count as white space.
_ASCII_SPACE = "[\\t-\\r\\x1c-\\x1f ]+"
#: Characters without a glyph: category C, and separators other than the space.
_UNSEEN = "[\\p{C}\\p{Z}&&[^ ]]"


#: Values that a task holds as Python texts at a time.
SLICE_ROWS = 256


def _normal_form(texts: pa.Array, form: str) -> pa.Array:
    """The texts in a normal form; beside the batch and its result, only a slice
    of it is held."""
    parts = []
    for at in range(0, len(texts), SLICE_ROWS):
        part = texts.slice(at, SLICE_ROWS).to_pylist()
        parts.append(pa.array([None if t is None else unicodedata.normalize(form, t) for t in part], texts.type))
    return pa.concat_arrays(parts) if parts else texts


@F.arrow_udf(T.StringType())
def _nfkd(texts: pa.Array) -> pa.Array:
    return _normal_form(texts, "NFKD")


@F.arrow_udf(T.StringType())
def _nfkc(texts: pa.Array) -> pa.Array:
    return _normal_form(texts, "NFKC")


def _normal(c: Column, form) -> Column:
    return F.coalesce(form(F.when(c.rlike(_NOT_ASCII), c)), c)


def compatible(text: str) -> str:
    """NFKC form, for code that already runs in Python."""
    return text if text.isascii() else unicodedata.normalize("NFKC", text)


def seen_text(c: Column) -> Column:
    """The visible part of NFKC text: unseen characters dropped, ends trimmed."""
    return F.trim(F.regexp_replace(c, _UNSEEN, ""))


def normalize_key(c: Column | str) -> Column:
    """Accent- and case-folded comparison key of a text column."""
    c = (F.col(c) if isinstance(c, str) else c).cast("string")
    plain = F.regexp_replace(_normal(c, _nfkd), _NOT_ASCII, "")
    return F.trim(F.regexp_replace(F.lower(plain), _ASCII_SPACE, " "))


def clean_text(c: Column | str) -> Column:
    """Display-text cleaning used for names, ratings and amenity labels; null is
    empty."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(seen_text(_normal(c, _nfkc)), F.lit(""))


def normalize_key_distinct(df: DataFrame, col: str, out: str) -> DataFrame:
    """Add ``out = normalize_key(col)`` computing the rule once per distinct value.

    For label-like columns (area names) the distinct set is tiny next to the
    table; the join back is left to AQE, which broadcasts it when the measured
    size is small and falls back to a shuffle join otherwise.
    """
    keys = (df.select(F.col(col).alias("_nk_raw")).where(F.col("_nk_raw").isNotNull())
            .distinct().withColumn(out, normalize_key("_nk_raw")))
    return df.join(keys, df[col] == keys["_nk_raw"], "left").drop("_nk_raw")
