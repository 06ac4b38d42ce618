"""Column-level helpers shared by the operators (all JVM-side expressions)."""

from shelfwise.functions.numeric import (  # noqa: F401
    half_even, round_half_up, ratio, pct, money, as_double, avg_money, exact_std,
)
from shelfwise.functions.bands import band, fill  # noqa: F401
from shelfwise.functions.ordering import top_k, prefix_sum  # noqa: F401
