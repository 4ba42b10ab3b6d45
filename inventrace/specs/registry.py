"""All resource specs by service name. Adding a spec here adds a resource."""

from __future__ import annotations

from collections.abc import Iterable

from inventrace.specs import compute, data, delivery, network
from inventrace.specs.model import ResourceSpec

AUDIT = "cloudtrail"
SPECS: dict[str, ResourceSpec] = {
    s.service: s for s in [*compute.SPECS, *network.SPECS, *data.SPECS, *delivery.SPECS]
}
BY_TABLE: dict[str, ResourceSpec] = {s.table: s for s in SPECS.values()}


def select_services(names: Iterable[str]) -> list[str]:
    """Requested services in a fixed order. ``all`` stands for every one; the audit log comes first,
    so that changes of a run can be attributed to events of the same run."""
    wanted = set(names)
    known = [AUDIT, *SPECS]
    unknown = wanted - {*known, "all"}
    if unknown:
        raise ValueError(f"unknown services: {', '.join(sorted(unknown))}")
    return [s for s in known if "all" in wanted or s in wanted]
