"""Small helpers to write Catalyst expressions as SQL text.

The mapping compiler emits many expressions per mapping; building them as
SQL text (parsed once on the JVM) instead of as chains of Python ``Column``
calls keeps plan construction fast. The result is the same expression tree.
"""

from __future__ import annotations


def lit(s: str) -> str:
    """A SQL string literal (backslashes and quotes escaped)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
