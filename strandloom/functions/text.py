"""Text functions that Spark has no expression for, as Arrow-batched pandas functions."""

from __future__ import annotations

import unicodedata
from decimal import Decimal

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType, StructField, StructType

ENCODINGS = ("mac_roman", "cp1252")


def repair_text(text: str | None, encodings=ENCODINGS) -> tuple[str | None, str | None]:
    """(repaired text, encoding) if the text is UTF-8 that was read in another encoding, else (None, None)."""
    if not text or text.isascii():
        return None, None
    for encoding in encodings:
        try:
            back = text.encode(encoding).decode("utf-8")
        except (UnicodeEncodeError, UnicodeDecodeError):
            continue
        if back != text:
            return back, encoding
    return None, None


@pandas_udf(StructType([StructField("repaired", StringType()), StructField("encoding", StringType())]))
def repaired(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([repair_text(t) for t in text], columns=["repaired", "encoding"])


@pandas_udf(StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Unicode normal form C."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def number_text(value: float | None) -> str | None:
    """A number with up to 15 significant digits and no exponent."""
    if value is None or value != value:
        return None
    return format(Decimal(f"{value:.15g}"), "f")


@pandas_udf(StringType())
def canonical_number(value: pd.Series) -> pd.Series:
    return value.map(lambda v: number_text(None if pd.isna(v) else float(v)))


@pandas_udf(StringType())
def six_digits(values: pd.Series) -> pd.Series:
    """An array's numbers with six significant digits each, comma-joined; Spark's own formats round other digits."""
    return values.map(lambda v: None if v is None else ",".join(f"{x:.6g}" for x in v))
