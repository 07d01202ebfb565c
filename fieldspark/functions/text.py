"""Text normalisation for comparisons. Decomposition (NFD) has no Spark function: Arrow-batched Python does that alone."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf


def _bare(text: str | None) -> str | None:
    if text is None or text.isascii():
        return text
    return "".join(c for c in unicodedata.normalize("NFD", text) if not "̀" <= c <= "ͯ")


@pandas_udf(T.StringType())
def without_accents(texts: pd.Series) -> pd.Series:
    """Texts decomposed and without combining marks (U+0300 to U+036F); null stays null."""
    return texts.map(_bare, na_action="ignore")


def normalize_text(c: Column) -> Column:
    """Lower case without accents; empty for null."""
    return F.lower(F.coalesce(without_accents(c), F.lit("")))


def normalize_name(c: Column) -> Column:
    """Lower-case letters and digits without accents; empty for null."""
    return F.lower(F.regexp_replace(F.coalesce(without_accents(c), F.lit("")), r"[^\p{L}\p{N}]", ""))


def stripped(c: Column) -> Column:
    """Without any white space at both ends (``trim`` takes spaces only)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def first_name(c: Column) -> Column:
    return F.try_element_at(F.split(stripped(c), r"\s+"), F.lit(1))


def other_names(c: Column) -> Column:
    """All names after the first, by single spaces; null where there is none."""
    parts = F.split(stripped(c), r"\s+")
    return F.when(F.size(parts) > 1, F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), " "))
