"""Column expressions that several operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word is a run of anything but the space and the five ASCII control spaces.
WORD = r"[^\x20\x09-\x0D]+"


def utf8_size(text: str) -> Column:
    """Bytes of the text in UTF-8; a null text has none."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("bigint")


def word_count(text: str) -> Column:
    """Words of the text; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def id_crc(key: str) -> Column:
    """crc32 of the id written as text, unsigned. A null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer: near inputs give unrelated outputs."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
