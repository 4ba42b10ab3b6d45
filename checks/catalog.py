"""Imports every module that registers queries."""

from checks import audit, cells, inventory, landing, reports, state  # noqa: F401
from checks.base import CHECKS  # noqa: F401
