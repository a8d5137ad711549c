"""Build a column expression once per Spark JVM and reuse it.

A ``Column`` is an unresolved, immutable expression, so the same object can
be used in any number of DataFrames.  Building the large expression trees of
mediation and pricing costs thousands of driver<->JVM calls; they depend only
on a few parameters, so they are built once per (JVM, parameters).
"""

from __future__ import annotations

import functools

from pyspark.sql import SparkSession


def per_jvm(fn):
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args):
        active = SparkSession.getActiveSession()
        key = (active.conf.get("spark.app.id", None) if active is not None else None, args)
        if key not in cache:
            cache[key] = fn(*args)
        return cache[key]

    return wrapper
