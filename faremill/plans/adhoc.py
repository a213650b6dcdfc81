"""Ad-hoc SQL over the stored tables and the ``areas`` view."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SHOWN_ROWS = 100  # fixed value: most rows shown per statement


# a statement's pieces: quoted text, comments, and anything else but a semicolon
_STATEMENT = re.compile(
    r"""(?:'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/|[^;])+""", re.S)


def statements(text: str) -> list[str]:
    """The ';'-separated statements that hold more than comments."""
    found = [m[0].strip() for m in _STATEMENT.finditer(text)]
    return [s for s in found if re.sub(r"(?s)--[^\n]*|/\*.*?\*/", "", s).strip()]


def run_script(spark: SparkSession, text: str, args: dict | None = None) -> list[DataFrame]:
    """One DataFrame per ';'-separated statement; named parameters are bound, not pasted in."""
    return [spark.sql(statement, args) for statement in statements(text)]


def show_script(spark: SparkSession, text: str, args: dict | None = None) -> None:
    for result in run_script(spark, text, args):
        result.show(SHOWN_ROWS, truncate=False)
