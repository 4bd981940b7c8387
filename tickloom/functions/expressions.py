"""Lists of SQL expressions given inline or in a file."""

from __future__ import annotations

from pathlib import Path


def read_expressions(script: str | list[str]) -> list[str]:
    """Expressions of a script, top of the stack first.

    ``@file`` and ``%file`` name a text file on the driver. In text, an expression
    ends at the end of its line; blank lines and lines starting with ``--`` are
    skipped.
    """
    if isinstance(script, str):
        if script[:1] in ("@", "%"):
            script = Path(script[1:]).read_text(encoding="utf-8")
        script = script.splitlines()
    lines = [line.strip() for line in script]
    expressions = [line for line in lines if line and not line.startswith("--")]
    if not expressions:
        raise ValueError("the script has no expressions")
    return expressions
