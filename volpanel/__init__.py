"""volpanel: panel volatility analytics expressed as Spark DataFrame plans.

Layout
------
sources/    readers and writers (test-table adapters, files, model bundles)
functions/  column-expression helpers (no Python per row)
operators/  panel operators: features, market join, splits, metrics, linear
            solve, GARCH, trees, profiles
plans/      composed jobs: evaluation, publication, request scoring
streaming/  the stream-static form of request scoring
"""

import sys

from pyspark import cloudpickle

from volpanel.schemas import V1, V2, V3, FEATURE_SETS, TARGET, BASELINE  # noqa: F401

__all__ = ["V1", "V2", "V3", "FEATURE_SETS", "TARGET", "BASELINE"]

# Functions that run in Python workers travel with their code, so that executors need no copy of
# the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
