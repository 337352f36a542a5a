"""Column names. A table has a bounded number of them, so these are plain string functions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable


def plain(name: str) -> str:
    """Letters and digits only, lower case."""
    return re.sub(r"[^a-z0-9]", "", name.lower())


def violations(name: str) -> list[str]:
    """Naming problems of one column."""
    name = name.strip()
    tests = (
        ("uppercase", name != name.lower()),
        ("space", " " in name),
        ("digit start", name[:1].isdigit()),
        ("special character", any(ch in "%@!#" for ch in name)),
        ("hyphen", "-" in name),
    )
    return [issue for issue, hit in tests if hit]


def is_snake_case(name: str) -> bool:
    return re.fullmatch(r"[a-z][a-z0-9_]*", name) is not None


def snake_case_issues(name: str) -> list[str]:
    """Issue tags of a name that is not snake case; one that shows none of the usual faults (``_x``) is tagged as a whole."""
    if is_snake_case(name):
        return []
    tests = (
        ("starts_with_digit", name[:1].isdigit()),
        ("uppercase", name != name.lower()),
        ("contains_space", " " in name),
        ("contains_hyphen", "-" in name),
        ("special_chars", re.search(r"[^a-zA-Z0-9_ ]", name) is not None),
    )
    return [issue for issue, hit in tests if hit] or ["not_snake_case"]


def snake_case(name: str) -> str:
    """Every run of other characters becomes one underscore."""
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def snake_case_dropping(name: str) -> str:
    """Blanks and hyphens become underscores, other characters go, a leading digit gets a prefix."""
    joined = re.sub(r"[\s\-]+", "_", name.lower())
    kept = re.sub(r"[^a-z0-9_]", "", joined)
    prefixed = "col_" + kept if kept[:1].isdigit() else kept
    return re.sub(r"_+", "_", prefixed).strip("_")


def renames(columns: Iterable[str], rule: Callable[[str], str]) -> dict[str, str]:
    """New name per column; a name already taken gets ``_2``, ``_3`` … in column order."""
    taken: set[str] = set()
    out: dict[str, str] = {}
    for column in columns:
        base = rule(column) or "col"
        name, k = base, 1
        while name in taken:
            k += 1
            name = f"{base}_{k}"
        taken.add(name)
        out[column] = name
    return out


def resolve(column: str, known: Iterable[str]) -> str | None:
    """The known name a column had before a rename: same, hyphenated, or equal once reduced to letters and digits."""
    known = list(known)
    for candidate in (column, column.replace("_", "-")):
        if candidate in known:
            return candidate
    target = plain(column)
    return next((k for k in known if plain(k) == target), None)
