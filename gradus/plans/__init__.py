"""Registered queries of the library's own operators, with SQL for those that SQL can express."""

from . import analysis, controls, tables  # noqa: F401  they register themselves
from .bindings import QUERIES, SQL  # noqa: F401
