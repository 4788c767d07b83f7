"""agroframe: crop-health analytics as Spark DataFrame transformations.

Every public operator is a plain function ``DataFrame -> DataFrame`` (usable
with ``df.transform``); the heavy lifting is left to Catalyst: filters and
projections reach the Parquet scan, aggregations combine map-side, and
small dimension tables are broadcast only behind an explicit size check.
"""

import sys

from pyspark import cloudpickle as _cloudpickle

# Functions shipped to Python workers (grouped pandas functions, Arrow UDFs)
# travel by value, so workers need no installed copy of this package.
_cloudpickle.register_pickle_by_value(sys.modules[__name__])

from agroframe.session import ensure_checkpoint_dir, get_session  # noqa: E402

__all__ = ["get_session", "ensure_checkpoint_dir"]
