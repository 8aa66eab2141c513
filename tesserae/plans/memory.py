"""The driver's memory, for logs."""

from __future__ import annotations

import logging
import resource

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)


def memory_mb(spark: SparkSession) -> tuple[float, float]:
    """The largest size of this process and the used heap of its JVM, in MB."""
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    return resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024, (heap.totalMemory() - heap.freeMemory()) / 2**20


def report(spark: SparkSession, context: str = "") -> None:
    log.info("%s: %.1f MB of the process, %.1f MB of the JVM's heap", context or "memory", *memory_mb(spark))
