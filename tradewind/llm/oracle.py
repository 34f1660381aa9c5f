"""Reference SQL of those operators that SQL can express."""

from __future__ import annotations


def statements() -> dict[str, str]:
    return {}
