"""standlens: coded land-inventory analytics on Spark DataFrames.

Stand records (a parcel revisited over the years, described by numeric
codes) are decoded against lookup domains, joined to their management
units, turned into latest-condition and rolling annual snapshots and
summarised. Every operator is a ``DataFrame -> DataFrame`` function built
from Spark SQL built-ins, so Catalyst sees the whole plan.
"""

from standlens.config import Params

__all__ = ["Params"]
