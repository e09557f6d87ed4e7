"""SQL text kept in files, run over the domain tables with bound names and parameters."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame

from capstan.sources.tables import Sources

SQL_DIR = Path(__file__).resolve().parent.parent / "sql"

# comments and quoted text stay as they are; names are bound elsewhere
_TOKENS = re.compile(r"--[^\n]*|/\*.*?\*/|'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|\.\s*\w+|[{}]|\w+", re.S)


def query_text(name: str, folder: str | Path | None = None) -> str:
    """Read the text of a ``.sql`` file by name (the reports' ``queryRead``)."""
    return (Path(folder) if folder else SQL_DIR).joinpath(name).read_text()


def bound_text(text: str, tables: Iterable[str]) -> str:
    """``text`` with the names of ``tables`` as ``{name}`` placeholders, and every other brace doubled.

    Names are bound where they stand alone or before a dot, in any case (as SQL compares
    them); not in comments, quoted text or after a dot, where they are columns.
    """
    names = {t.lower(): t for t in tables}

    def bind(m: re.Match) -> str:
        token = m.group()
        if token.lower() in names:
            return f"{{{names[token.lower()]}}}"
        return token.replace("{", "{{").replace("}", "}}")

    return _TOKENS.sub(bind, text)


def run_sql(src: Sources, text: str, tables: Iterable[str], args: Mapping[str, Any] | None = None) -> DataFrame:
    """Run query text over ``tables`` of ``src``; ``:name`` markers take their values from ``args``.

    Tables are bound to the query alone: no view of the session is made or replaced, so
    texts over different sources can run side by side.  Values are passed as typed
    literals, never pasted into the text.
    """
    tables = list(tables)
    text = bound_text(text.strip().rstrip(";"), tables)
    return src.spark.sql(text, args=dict(args or {}), **{t: src[t] for t in tables})


def sql_file_report(src: Sources, name: str, tables: Iterable[str], folder: str | Path | None = None,
                    args: Mapping[str, Any] | None = None) -> DataFrame:
    """Run a SQL file over ``tables`` of ``src`` with parameters ``args``."""
    return run_sql(src, query_text(name, folder), tables, args)
