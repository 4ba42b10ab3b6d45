"""Declarative description of one inventoried resource."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

#: Landed datasets by name; each has account_id, account_name, region and ``doc``.
Raw = Mapping[str, DataFrame]

PROVENANCE = ("account_name", "account_id")


@dataclass(frozen=True)
class ResourceSpec:
    """One resource table: raw documents, flat row, match key and comparison rules.

    ``key``           columns that match a snapshot row to its stored row
    ``compared``      columns whose difference is an update (all non-key columns by default)
    ``comparators``   column -> comparator name, ``text`` where not named
    ``compact_names`` history field names have no underscores (``instance_name`` -> ``instancename``)
    ``history_names`` exceptions to that rule
    ``fixed_region``  region written to history where the table has none
    ``conflict_key``  columns that alone decide whether an insert is ignored (narrower than the match key)
    ``widths``        columns that are cut to so many characters (none by default)
    ``timed``         the flat rows depend on the run time, which ``flatten`` takes as ``run_ts``
    ``latest_lookup`` attribute to the latest event first, without a time bound
    """

    table: str
    service: str
    service_type: str
    columns: str
    key: tuple[str, ...]
    resource_id: str
    raw: Mapping[str, str]
    flatten: Callable[[Raw], DataFrame]
    uncompared: tuple[str, ...] = ()
    comparators: Mapping[str, str] = field(default_factory=dict)
    compact_names: bool = False
    history_names: Mapping[str, str] = field(default_factory=dict)
    fixed_region: str | None = None
    conflict_key: tuple[str, ...] = ()
    latest_lookup: bool = False
    optional_raw: tuple[str, ...] = ()
    widths: Mapping[str, int] = field(default_factory=dict)
    timed: bool = False

    @property
    def column_names(self) -> list[str]:
        depth, names = 0, []
        for part in self.columns.split(","):
            if depth == 0:
                names.append(part.split()[0])
            depth += part.count("<") - part.count(">")
        return names

    @property
    def compared(self) -> list[str]:
        skip = {*self.key, *self.uncompared}
        return [c for c in self.column_names if c not in skip]

    def history_field(self, column: str) -> str:
        default = column.replace("_", "") if self.compact_names else column
        return self.history_names.get(column, default)
