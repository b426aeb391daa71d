"""Column-expression functions (the reference's scalar helpers)."""

from ratesmith.functions import scalars  # noqa: F401
