"""Accent removal without leaving the JVM."""

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Combining marks that are removed after canonical decomposition.
FIRST_MARK, LAST_MARK = 0x0300, 0x036F

# Points scanned for accented letters: the whole basic plane but surrogates.
LETTER_BLOCKS = ((0x00C0, 0xD800), (0xE000, 0x10000))


def _without_marks(text: str) -> str:
    return "".join(
        c
        for c in unicodedata.normalize("NFD", text)
        if not FIRST_MARK <= ord(c) <= LAST_MARK
    )


@lru_cache(maxsize=1)
def _letter_table() -> tuple[str, str]:
    """Accented letters and, at the same positions, their plain letters.

    Characters past the end of the plain letters are the marks to delete.
    """
    accented, plain = [], []
    for start, end in LETTER_BLOCKS:
        for point in range(start, end):
            if FIRST_MARK <= point <= LAST_MARK:
                continue
            bare = _without_marks(chr(point))
            if bare != chr(point) and len(bare) == 1:
                accented.append(chr(point))
                plain.append(bare)
    marks = [chr(point) for point in range(FIRST_MARK, LAST_MARK + 1)]
    return "".join(accented + marks), "".join(plain)


def strip_accents_upper(text: Column) -> Column:
    """Upper case without accents, for letters of any script in the basic plane.

    Text of as many bytes as letters has no accents to look for.
    """
    accented, plain = _letter_table()
    bare = F.when(F.octet_length(text) == F.length(text), text).otherwise(
        F.translate(text, accented, plain)
    )
    return F.upper(bare)


@F.pandas_udf(StringType())
def strip_accents_upper_any_script(text: pd.Series) -> pd.Series:
    """As ``strip_accents_upper``, decomposing every script; slower."""
    return text.map(_without_marks, na_action="ignore").str.upper()
