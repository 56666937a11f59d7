"""Objects of bounded size that every worker holds once."""

from __future__ import annotations

import ctypes
import gc
import pickle
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import SparkSession

_sent: list[Broadcast] = []


def share(spark: SparkSession, value) -> Callable[[], object]:
    """A function that gives ``value`` inside tasks.

    It is broadcast with its class, so workers need no copy of this package, and a worker process keeps the
    one object it has unpacked, and what that has learned, over its tasks.
    """
    sent = spark.sparkContext.broadcast([cloudpickle.dumps(value)])
    _sent.append(sent)

    def get():
        held = sent.value
        if type(held[0]) is bytes:
            held[0] = pickle.loads(held[0])
        return held[0]

    return get


def take_back(spark: SparkSession) -> None:
    """Let go of what finished work has left: objects shared so far go from the executors (one that is used again is
    sent again), and the driver drops its references, so that Spark removes shuffle files and broadcasts nobody reads."""
    while _sent:
        _sent.pop().unpersist()
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    give_back()


def give_back() -> None:
    """Return the memory that work in this process has freed to the system, as the process will outlive the task."""
    pa.default_memory_pool().release_unused()
    if sys.platform.startswith("linux"):
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` over batches, with freed memory given back at its end."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return tidied
