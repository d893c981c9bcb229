"""Tables that a Python worker keeps between tasks.

Workers outlive stages, so each operator claims the worker before it fills its tables, and the tables of
the operator that ran there before are emptied.
"""

from __future__ import annotations

from collections.abc import MutableMapping

_OWNER: list[str] = []
_TABLES: list[MutableMapping] = []


def claim(owner: str, *tables: MutableMapping) -> None:
    """Make the tables those of the worker's present operator."""
    if _OWNER[:1] != [owner]:
        for table in _TABLES:
            table.clear()
        _TABLES.clear()
        _OWNER[:] = [owner]
    _TABLES.extend(t for t in tables if not any(t is x for x in _TABLES))
