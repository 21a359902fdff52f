"""What tasks hold hangs on fixed bounds, not on the rows of a batch; what is read again lies in the shared folder."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from townform.functions import kernels as K
from townform.functions import shapes as H
from townform.operators import distances as D
from townform.plans import typology as Y
from townform.session import cut_lineage


def _peak(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def _boxes(n):
    """Segments of unit squares in a row."""
    x = np.arange(n) * 1.0
    corners = np.stack([np.stack([x, x * 0, x, x * 0 + 1]), np.stack([x, x * 0 + 1, x + 1, x * 0 + 1]),
                        np.stack([x + 1, x * 0 + 1, x + 1, x * 0]), np.stack([x + 1, x * 0, x, x * 0])], axis=2)
    return corners.reshape(4, -1), K.starts(np.full(n, 4))


def test_gaps_of_a_large_batch():
    def run(n):
        seg, offs = _boxes(n + 1)
        dist, shared = K.polygon_gaps(seg, offs, np.arange(n), seg, offs, np.arange(n) + 1, 1e-6)
        assert not dist.any() and (shared == 1).all()

    assert _peak(lambda: run(30_000)) < 2 * _peak(lambda: run(6_000))


def test_distances_of_many_units():
    """Units of 20 buildings: 20 times as many need no more, as they are taken a few at a time."""
    def run(units):
        seg, offs = _boxes(20 * units)
        size = np.full(units, 20)
        D.pair_statistics(seg, offs, size, np.full(20 * units, -1))

    assert _peak(lambda: run(4_000)) < 3 * _peak(lambda: run(400))


def test_slices_give_the_rows_of_the_batch():
    lists = pa.array([None if k % 7 == 0 else [float(k)] * (k % 4) for k in range(2500)], pa.list_(pa.float64()))
    sums = K.sliced(lambda c: pa.array(np.add.reduceat(np.append(c.flatten().to_numpy(), 0.0), K.starts(K.list_sizes(c))[:-1])
                                       * (K.list_sizes(c) > 0)), 100)
    assert sums(lists).to_pylist() == [sum(v or []) for v in lists.to_pylist()]
    assert K.sliced(lambda c: c)(lists.slice(0, 0)).type == lists.type


def test_slices_go_on_over_short_lists():
    met = []

    def kernel(c):
        met.append((len(c), len(c.flatten())))
        return c
    lists = pa.array([[1.0]] * 900 + [[1.0] * 40] * 30 + [None] * 5, pa.list_(pa.float64()))
    assert K.sliced(kernel, 10, 200)(lists).equals(lists) and sum(n for n, _ in met) == 935
    assert all(n <= 10 or size <= 200 for n, size in met) and len(met) <= 10 and max(n for n, _ in met) == 200


def test_kernels_on_slices(spark):
    """Batches of more rows than a slice, null outlines among them."""
    pts = F.array(*[F.struct((F.col("id") * 2 + x).cast("double").alias("x"), F.lit(float(y)).alias("y"))
                    for x, y in ((0, 0), (0, 1), (1, 1), (1, 0), (0, 0))])
    ring = F.struct(F.lit(0).alias("part"), F.lit(False).alias("hole"), pts.alias("pts"))
    rows = spark.range(0, 5000, 1, 1).withColumn("g", F.when(F.col("id") % 5 > 0, F.struct(F.lit(0).alias("srid"), F.array(ring).alias("rings"))))
    found = rows.select("id", H.covered_spans(F.col("g"), F.col("g"), 0.01).alias("spans"), H.hull(F.col("g")).alias("hull"))
    assert found.where("(id % 5 > 0 and (size(spans) <> 4 or hull.area <> 1)) or (id % 5 = 0 and size(spans) <> 0)").count() == 0


def test_fitting_reads_its_rows_once(spark):
    met = spark.sparkContext.accumulator(0)

    def label(k):
        met.add(1)
        return "ba" if k % 2 else "pd"

    rows = cut_lineage(spark.range(200).select("id", *[((F.col("id") * (k + 3)) % 11).cast("double").alias(c) for k, c in enumerate(Y.FEATURES)]))
    rows = rows.withColumn("typo", F.udf(label)("id"))
    Y.train_typology(rows, trees=3, depth=2)
    assert met.value == 200
