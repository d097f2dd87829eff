"""Queries over the driver tables, each with the SQL it must agree with where SQL can say it."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

from workloads.base import ORACLES, QUERIES
from workloads import entities, full_job, ingest, jobs, labels, reports, text, vectors  # noqa: F401  (they register themselves)

__all__ = ["ORACLES", "QUERIES"]

register_pickle_by_value(sys.modules[__name__])
