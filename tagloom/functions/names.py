"""Names: type tags, output column names, name matching, quoting."""

from __future__ import annotations

import re
from collections.abc import Iterable

# The type tags of the export format.
SET_TAGS = ("SS", "NS", "BS")
MAP_TAG = "M"
LIST_TAG = "L"
NULL_TAG = "NULL"
TAGS = frozenset(("S", "N", "BOOL", "B", *SET_TAGS, MAP_TAG, LIST_TAG, NULL_TAG))

# Fixed value: capitals that names set off, all but one at the beginning.
_CAPITAL_INSIDE = re.compile(r"(?<!^)([A-Z])")


def column_name(path: tuple[str, ...]) -> str:
    """Output name of an attribute path: joined by ``_``, every capital after
    the first character set off by ``_``, lower case (``cardInfo.issueDate``
    gives ``card_info_issue_date``)."""
    return _CAPITAL_INSIDE.sub(r"_\1", "_".join(path)).lower()


def match_key(name: str) -> str:
    """Key under which names match regardless of case and underscores."""
    return name.lower().replace("_", "")


def quoted(name: str) -> str:
    """Column reference to exactly this name, dots and back-quotes included."""
    return "`" + name.replace("`", "``") + "`"


def listing(names: Iterable[str], suffix: str = "") -> str:
    """The names quoted and separated by commas, each followed by ``suffix``."""
    return ", ".join(quoted(name) + suffix for name in names)


def literal_path(path: str) -> str:
    """Path pattern that matches this path only."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)
