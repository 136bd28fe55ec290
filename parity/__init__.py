"""Parity checks: each library operator next to an independent SQL statement.

``parity.warehouse`` maps the given star-schema tables onto the retail
warehouse the library works on; the other modules register cases.
"""

from parity import cases_bi, cases_core, cases_ops, cases_shop, cases_stream  # noqa: F401
from parity.registry import CASES

__all__ = ["CASES"]
