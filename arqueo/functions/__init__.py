"""Column-level functions: null-parity helpers, scalar helpers, code lists."""

from . import codes, nulls, scalars  # noqa: F401
