"""Folders of SQL scripts, run in the order of their names on one session.

Statements are ended by semicolons outside quotes and comments. Values come as
named arguments (``:name``), names of tables and columns by ``IDENTIFIER(:name)``;
no text is replaced."""

from __future__ import annotations

import re
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

_PIECE = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/|;|[^'"`;/-]+|.""", re.DOTALL)


class ScriptError(RuntimeError):
    """A statement failed; names the script and the number of the statement."""


def statements(text: str) -> list[str]:
    """The statements of a script, without those that are only blanks and comments."""
    out, now, real = [], [], False
    for piece in _PIECE.findall(text):
        if piece == ";":
            out += ["".join(now).strip()] if real else []
            now, real = [], False
        else:
            now.append(piece)
            real |= bool(piece.strip()) and not piece.startswith(("--", "/*"))
    return out + (["".join(now).strip()] if real else [])


def run_scripts(spark: SparkSession, folder: str, arguments: dict[str, Any] | None = None) -> dict[str, DataFrame | None]:
    """Runs all *.sql files; returns the result of each one's last statement. The first
    that fails stops the run with its name."""
    found = sorted(Path(folder).glob("*.sql"), key=lambda p: p.name)
    if not found:
        raise FileNotFoundError(f"no script in {folder}")
    results: dict[str, DataFrame | None] = {}
    for script in found:
        results[script.name] = None
        for n, statement in enumerate(statements(script.read_text(encoding="utf-8")), 1):
            used = {k: v for k, v in (arguments or {}).items() if re.search(rf":{re.escape(k)}\b", statement)}
            try:
                results[script.name] = spark.sql(statement, args=used)
            except Exception as e:
                raise ScriptError(f"{script.name}, statement {n}: {str(e).splitlines()[0]}") from e
    return results
