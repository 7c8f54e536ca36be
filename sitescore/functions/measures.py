"""Error measures and aggregates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MEDIAN_ACCURACY = 10000


def mape(label: Column, prediction: Column) -> Column:
    """Mean absolute error in percent of the label; rows with label 0 drop out."""
    return 100 * F.avg(F.try_divide(F.abs(label - prediction), label))


def mae(label: Column, prediction: Column) -> Column:
    return F.avg(F.abs(label - prediction))


def rmse(label: Column, prediction: Column) -> Column:
    return F.sqrt(F.avg((label - prediction) * (label - prediction)))


def approx_median(column: Column) -> Column:
    """Lower median; exact while a group holds fewer rows than the accuracy."""
    return F.percentile_approx(column, 0.5, MEDIAN_ACCURACY)


# Statistic name -> aggregate.
STATISTICS = {
    "avg": F.avg,
    "stddev": F.stddev_samp,
    "min": F.min,
    "max": F.max,
    "median": approx_median,
}
