"""Symbol-by-time panel analytics on Spark."""

import sys

from pyspark import cloudpickle

# The helpers that run inside tasks travel with the job, so executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from tidemark.panel import Panel  # noqa: E402
from tidemark.session import build_session, use_utc, work_dir  # noqa: E402

__all__ = ["Panel", "build_session", "use_utc", "work_dir"]
