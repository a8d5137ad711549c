"""Double sums in a defined order: the same for any split of the rows."""

import math
import random

import pytest

from cdrflow.operators.stable_sum import CELL, LEVELS, RUN, STEP, stable_sum


def _copies(x, n):
    total, unit = 0.0, x
    while n:
        run = 0.0
        for _ in range(n % RUN):
            run += unit
        total += run
        more = 0.0
        if n >= RUN:
            for _ in range(RUN):
                more += unit
        unit, n = more, n // RUN
    return total


def _model(values):
    """The definition, on one machine."""
    level = sorted((v, _copies(v, values.count(v))) for v in set(values))
    for k in range(LEVELS):
        cells = {}
        for v, s in level:
            at = float(math.floor(v / (STEP if k else CELL)))
            cells[at] = cells.get(at, 0.0) + s
        level = sorted(cells.items())
    total = 0.0
    for _, s in level:
        total += s
    return total


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_same_sum_on_any_number_of_partitions(spark, parts):
    rng = random.Random(5)
    values = [rng.choice([0.1, 0.35, 1e-9, 12.345678901, 4321.1, rng.random() * 1e6]) for _ in range(3000)]
    rows = [("a", v) for v in values] + [("b", 0.1)] * 9 + [("c", None), ("c", 2.5)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(parts)
    got = {r.k: (r.total, r.n) for r in stable_sum(df, ["k"], "v").collect()}
    assert got["a"] == (_model(values), 3000)
    assert got["b"] == (0.8999999999999999, 9)  # nine charges one by one, not 0.9
    assert got["c"] == (2.5, 1)


def test_many_equal_charges(spark):
    df = spark.range(1_234_567).selectExpr("'a' as k", "0.1D as v")
    got = stable_sum(df, ["k"], "v").first()
    assert got.n == 1_234_567 and got.total == _copies(0.1, 1_234_567)
    assert stable_sum(df.filter("false"), ["k"], "v").count() == 0
