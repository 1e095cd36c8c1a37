"""Column names that differ by source: found by pattern, on the driver, before any scan."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping


def plain(name: str, signs: bool = False) -> str:
    """Lower-case letters and digits only; with signs, + and - are spelled out first."""
    if signs:
        name = name.replace("+", "plus").replace("-", "minus")
    return re.sub(r"[^a-z0-9]", "", str(name).lower())


def find_column(columns: Iterable[str], patterns: Iterable[str], exclude: Iterable[str] = (), exact_only: Iterable[str] = (),
        signs: bool = False) -> str | None:
    """The first column that equals a pattern, else the first that contains one. Columns that
    contain an excluded word never count; exact_only patterns aren't looked for inside names."""
    names = {c: plain(c, signs) for c in columns}
    names = {c: n for c, n in names.items() if not any(x in n for x in exclude)}
    for fits in (lambda n, p: n == p, lambda n, p: p in n and p not in set(exact_only)):
        for p in patterns:
            for c, n in names.items():
                if fits(n, p):
                    return c
    return None


def mapping(columns: Iterable[str], wanted: Mapping[str, Iterable[str]], **how) -> dict[str, str | None]:
    columns = list(columns)
    return {name: find_column(columns, patterns, **how) for name, patterns in wanted.items()}


def signal(columns: Iterable[str], groups: Iterable[Iterable[str]]) -> int:
    """How many groups of patterns have a column."""
    columns = list(columns)
    return sum(find_column(columns, g) is not None for g in groups)


def best_table(tables: Mapping[str, Iterable[str]], groups: Iterable[Iterable[str]], least: int, rows: Mapping[str, int] | None = None) -> str | None:
    """The table with the strongest signal, at least `least`; the larger one if two are equal."""
    groups = list(groups)
    found = [(signal(c, groups), (rows or {}).get(t, 0), t) for t, c in tables.items()]
    found = sorted((x for x in found if x[0] >= least), key=lambda x: (-x[0], -x[1], x[2]))
    return found[0][2] if found else None
