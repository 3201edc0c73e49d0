"""Regridding and axes against plain numpy models."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomgrid.functions import arrays
from fathomgrid.functions.regridding import nearest_on_axis


def model(ranges, values, max_depth, bins):
    """Nearest sample per bin: ties go to the shallower one, nothing outside the samples."""
    pairs = {}
    for x, y in zip(ranges or [], values or []):
        if x is not None and not math.isnan(x):
            pairs.setdefault(x, y)
    xs = sorted(pairs)
    stop = float(np.float32(max_depth))
    axis = np.linspace(0, stop, bins)
    out = []
    for d in axis:
        if not xs or d < xs[0] or d > xs[-1]:
            out.append(None)
            continue
        mids = [a / 2.0 + b / 2.0 for a, b in zip(xs, xs[1:])]
        value = pairs[xs[int(np.searchsorted(mids, d, side="left"))]]
        out.append(None if value is None or math.isnan(value) else float(np.float32(value)))
    return out


def regrid(spark, rows):
    df = spark.createDataFrame(
        rows, "id long, x array<double>, y array<double>, max_depth double, bins long"
    ).select(
        "id",
        nearest_on_axis("x", "y", "max_depth", "bins").alias("v"),
    )
    return {r["id"]: r["v"] for r in df.collect()}


CASES = {
    "ties go up": ([0.0, 1.0, 2.0], [1.0, 2.0, 3.0], 2.0, 5),
    "ends are kept": ([1.0, 3.0], [5.0, 6.0], 4.0, 5),
    "outside is missing": ([2.0, 2.5], [5.0, 6.0], 8.0, 9),
    "unsorted": ([3.0, 1.0, 2.0, 0.0], [4.0, 2.0, 3.0, 1.0], 4.0, 9),
    "single sample on a bin": ([2.0], [7.0], 4.0, 5),
    "single sample between bins": ([2.1], [7.0], 4.0, 5),
    "empty": ([], [], 4.0, 5),
    "first sample beyond the grid": ([9.0, 10.0], [1.0, 2.0], 4.0, 5),
    "samples around the whole grid": ([-3.0, 9.0], [1.0, 2.0], 4.0, 5),
    "negative ranges": ([-2.0, -1.0], [1.0, 2.0], 4.0, 5),
    "missing values stay": ([0.0, 1.0, 2.0], [1.0, None, 3.0], 2.0, 5),
    "missing ranges are dropped": ([0.0, None, 2.0], [1.0, 9.0, 3.0], 2.0, 5),
    "nan ranges are dropped": ([0.0, float("nan"), 2.0], [1.0, 9.0, 3.0], 2.0, 5),
    "equal ranges: the first": ([0.0, 1.0, 1.0, 2.0], [1.0, 2.0, 9.0, 3.0], 2.0, 5),
    "all ranges missing": ([None, None], [1.0, 2.0], 4.0, 3),
    "nan values are missing": ([0.0, 1.0, 2.0], [1.0, float("nan"), 3.0], 2.0, 5),
    "no arrays": (None, None, 2.0, 3),
    "one bin": ([0.0, 1.0], [1.0, 2.0], 0.5, 1),
}


def test_regrid_edges(spark):
    got = regrid(spark, [(i, *case) for i, case in enumerate(CASES.values())])
    for i, (name, case) in enumerate(CASES.items()):
        assert got[i] == model(*case), name


def test_regrid_without_a_grid(spark):
    got = regrid(spark, [(0, [0.0, 1.0], [1.0, 2.0], None, None), (1, [0.0, 1.0], [1.0, 2.0], 1.0, 2)])
    assert got == {0: None, 1: [1.0, 2.0]}


def test_regrid_random(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(300):
        n = int(rng.integers(1, 60))
        # Quarter steps make exact ties frequent; 0.192 makes them inexact.
        unit = [0.25, 0.192, 0.1][i % 3]
        xs = rng.permutation(rng.choice(np.arange(-5, 120), n, replace=False)) * unit
        ys = [None if v < 0.1 else float(v) for v in rng.random(n)]
        max_depth = float(np.round(rng.uniform(0.5, 40), 4))
        rows.append((i, [float(x) for x in xs], ys, max_depth, int(rng.integers(1, 200))))
    got = regrid(spark, rows)
    for row in rows:
        assert got[row[0]] == model(*row[1:]), row


@pytest.mark.parametrize("stop,n", [(249.792, 1302), (5.0, 1), (5.0, 2), (0.0, 3), (999.744, 5208)])
def test_linspace(spark, stop, n):
    got = spark.range(1).select(arrays.linspace(F.lit(stop), F.lit(n).cast("long")).alias("a")).first()["a"]
    assert got == np.linspace(0, stop, n).tolist()


@pytest.mark.parametrize(
    "top,step,stored,regridded",
    [(249.792, 0.192, 1302, 1302), (999.744, 0.192, 5208, 5208), (100.0, 0.2, 500, 501), (1000.3, 0.18, 5561, 5558)],
)
def test_heights(spark, top, step, stored, regridded):
    row = spark.range(1).select(
        arrays.stored_height(F.lit(top), F.lit(step)).alias("s"), arrays.depth_bins(F.lit(top), F.lit(step)).alias("r")
    ).first()
    assert (row["s"], row["r"]) == (stored, regridded)
    assert regridded == int(np.float32(top) / np.float32(step)) + 1


def test_stored_axis(spark):
    for step, h in [(0.192, 1302), (0.3, 1), (0.18, 40)]:
        got = spark.range(1).select(
            arrays.stored_depths(F.lit(step), F.lit(h).cast("long")).alias("a")
        ).first()["a"]
        assert got == (np.round(np.linspace(0, step * h, h), 2) + 0.01).tolist()


def test_half_even(spark):
    values = [0.125, 0.375, 2.675, 1.005, -0.125, 0.575, 1e7 + 0.005, 0.19199999]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (2, 4):
        got = [r[0] for r in df.select(arrays.half_even(F.col("v"), digits)).collect()]
        assert got == np.round(values, digits).tolist()


def test_steps_ignore_missing(spark):
    rows = [
        (1, [0.0, 0.2, 0.5]), (2, [0.0, None, 0.5, 0.9]), (3, [0.1]), (4, []),
        (5, [0.0, float("nan"), 0.4]), (6, [0.0, 0.0, 1.0]), (7, None),
    ]
    df = spark.createDataFrame(rows, "id long, r array<double>")
    got = {
        r["id"]: (r["s"], r["m"])
        for r in df.select("id", arrays.smallest_step(F.col("r")).alias("s"), arrays.largest(F.col("r")).alias("m")).collect()
    }
    assert got[1] == (0.2, 0.5)
    assert got[2][0] == pytest.approx(0.4) and got[2][1] == 0.9
    assert got[3] == (None, 0.1) and got[4] == (None, None)
    assert got[5] == (None, 0.4)
    assert got[6] == (0.0, 1.0) and got[7] == (None, None)
