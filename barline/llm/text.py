"""Word rules shared by the operators, and Arrow-batched functions over a text column."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StructType

# ASCII white space: space and tab to carriage return.
BLANKS = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TO_LOWER = bytes.maketrans(_UPPER.encode(), _LOWER.encode())
# For alphanumeric words: ASCII other than letters and digits separates.
_TO_WORDS = bytes(
    byte if byte > 127 or chr(byte).isalnum() else 32 for byte in (_TO_LOWER[b] for b in range(256))
)


def fresh(name: str) -> str:
    """A column name that no table has."""
    return f"_{name}_{uuid.uuid4().hex}"


def utf8(text: str | None) -> bytes:
    """UTF-8 of a text, null as empty."""
    return (text or "").encode()


def spaced_words(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space; bytes.split() has exactly that rule."""
    return utf8(text).split()


def lower_spaced_words(text: str | None) -> list[bytes]:
    """The same with A-Z lower-cased."""
    return utf8(text).translate(_TO_LOWER).split()


def alnum_words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters (A-Z lower-cased), digits and anything beyond ASCII."""
    return utf8(text).translate(_TO_WORDS).split()


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased and nothing else, on the JVM. Plain ASCII takes the faster function."""
    ascii_only = F.octet_length(column) == F.char_length(column)
    return F.when(ascii_only, F.lower(column)).otherwise(F.translate(column, _UPPER, _LOWER))


def text_udf(fields: str, setup: Callable[[], Callable[[str | None], tuple]]) -> Callable[[Column], Column]:
    """A struct column from a text column, by Arrow batches.

    ``setup`` runs once a task and gives the function from a text to the values of ``fields``. Each row
    is done where it lies, so no other column moves and repeated rows stay apart.
    Not marked deterministic, or filters on the result would make Spark run it twice.
    """
    names = StructType.fromDDL(fields).names

    @F.pandas_udf(f"struct<{','.join(f'{f.name}:{f.dataType.simpleString()}' for f in StructType.fromDDL(fields))}>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        each = setup()
        for texts in batches:
            yield pd.DataFrame([each(x) for x in texts], columns=names, dtype=object)

    return run.asNondeterministic()
