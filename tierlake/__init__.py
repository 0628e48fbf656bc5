"""tierlake — a bronze → silver → gold lakehouse pipeline written as Spark DataFrame jobs.

Layers:
    sources/    scans of raw monthly files, file listings, test-table mappings
    functions/  column expressions (surrogate key, calendar parts, file names)
    operators/  relational building blocks (upsert, conform, keep-latest, ops log,
                file manifest, data quality)
    plans/      the layer transforms (bronze, silver, gold) and the batch pipeline
    sinks/      partitioned and catalog tables, failure log
    streaming/  the same steps driven incrementally by Structured Streaming
"""

import sys

from pyspark import cloudpickle

from tierlake.session import build_session, shared_dir

# The few functions that run on executors travel with the job, so the cluster's Python
# needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "shared_dir"]
