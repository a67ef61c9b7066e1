"""What one run depends on besides the table's spec: date, mode, placeholders."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date, datetime
from typing import Any

_PLACEHOLDER = re.compile(r"\{[A-Za-z_]\w*\}")

# Run modes and the struct each one's records keep their attributes in.
FULL, INC = "FULL", "INC"
ROOTS = {FULL: "Item", INC: "NewImage"}


@dataclass(frozen=True)
class RunContext:
    """Run date, mode, and values for the placeholders of a spec.

    ``ingested_at`` fixes the ingestion instant (it is "now" otherwise).
    """

    run_date: date
    mode: str = FULL
    params: Mapping[str, str] = field(default_factory=dict)
    ingested_at: datetime | None = None

    def __post_init__(self) -> None:
        if self.mode not in ROOTS:
            raise ValueError(f"mode is one of {sorted(ROOTS)}, not {self.mode!r}")

    @classmethod
    def of(cls, process_date: str, mode: str = FULL, **params: str) -> RunContext:
        """Context of a ``YYYY-MM-DD`` text."""
        return cls(datetime.strptime(process_date, "%Y-%m-%d").date(), mode, params)

    @property
    def incremental(self) -> bool:
        return self.mode == INC

    @property
    def root(self) -> str:
        return ROOTS[self.mode]

    def placeholders(self) -> dict[str, str]:
        """Values for ``{name}`` in templates; ``params`` win over the built-in ones."""
        return {
            "process_date": self.run_date.strftime("%Y-%m-%d"),
            "process_year": self.run_date.strftime("%Y"),
            "process_month": self.run_date.strftime("%m"),
            "process_day": self.run_date.strftime("%d"),
            "process_hour": "hour=*/" if self.incremental else "",
            "current_process_type_folder": "incremental" if self.incremental else "full",
            "current_data_folder": "data" if self.incremental else "*/data",
            **self.params,
        }


def unfilled(value: Any) -> list[str]:
    """Placeholders left in the texts of ``value``, at any depth."""
    if isinstance(value, str):
        return _PLACEHOLDER.findall(value)
    items = value.values() if isinstance(value, Mapping) else value if isinstance(value, (list, tuple)) else ()
    return sorted({name for item in items for name in unfilled(item)})


def fill(value: Any, placeholders: Mapping[str, str]) -> Any:
    """``value`` with ``{name}`` replaced in every text, at any depth; unknown names stay."""
    if isinstance(value, str):
        for name, text in placeholders.items():
            value = value.replace("{" + name + "}", str(text))
        return value
    if isinstance(value, Mapping):
        return {key: fill(item, placeholders) for key, item in value.items()}
    if isinstance(value, (list, tuple)):
        return [fill(item, placeholders) for item in value]
    return value
