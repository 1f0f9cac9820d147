"""Column-level building blocks: fixed code tables, recodes, strict sums."""

from .aggregates import strict_sum  # noqa: F401
from . import codes, recode  # noqa: F401
