"""The column widths and list lengths of tables that earlier loaders fill, for stores that have to agree with them.

By default no column is cut and no list shortened: a change behind a cut would never be seen.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from functools import partial

from inventrace.specs.model import ResourceSpec

# Widths by service and column.
_QUERY = {"domain": 255, "description": 500, "database_name": 255, "tables_used": 500, "owner": 255}
WIDTHS: Mapping[str, Mapping[str, int]] = {
    "apigateway": {"name": 500, "protocol": 100, "endpoint_type": 255},
    "athena": _QUERY,
    "cloudformation": {"stack_status": 50, "description": 500, "capabilities": 255},
    "cloudtrail_trails": {"log_location": 500},
    "codepipeline": {"last_execution_status": 100, "latest_source_revisions": 500},
    "glue": {"glue_version": 50},
    "ssm": {"association_name": 255, "domain": 255},
    "stepfunctions": {"instance_id": 255, "stepfunction_name": 255, "description": 500, "roles_permissions": 255, "status": 50},
    "tax": _QUERY,
    "transfer": {"domain": 255, "endpoint": 500, "state": 50},
}
# List lengths by service, as parameters of the service's flatten function.
LENGTHS: Mapping[str, Mapping[str, int]] = {
    "codepipeline": {"recent_runs": 5, "shown_revisions": 3},
    "ecr": {"shown_images": 5},
    "emr": {"shown_applications": 5},
    "stepfunctions": {"recent_executions": 10},
}


def limited(spec: ResourceSpec, **more: int) -> ResourceSpec:
    """The spec with the widths and lengths above; ``more`` are further parameters of its flatten function."""
    lengths = {**LENGTHS.get(spec.service, {}), **more}
    return replace(spec, widths=WIDTHS.get(spec.service, {}), flatten=partial(spec.flatten, **lengths) if lengths else spec.flatten)
