"""Column expressions: everything here returns a ``Column`` and stays JVM-side."""

from ledgerlens.functions.exprs import *  # noqa: F401,F403
from ledgerlens.functions.bins import cut, bin_spine  # noqa: F401
from ledgerlens.functions.rules import (  # noqa: F401
    rfm_segment, vip_tier, two_way_label, wheel_category,
)
