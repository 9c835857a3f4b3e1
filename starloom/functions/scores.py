"""Presentation rules for ratings and predictions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The lower edge of each star band, the rating range, and the
# label shown for items without a certificate.
STAR_BANDS = ((5, 4.5), (4, 3.5), (3, 2.5), (2, 1.5), (1, 0.5), (0, 0.0))
RATING_RANGE = (0.0, 5.0)
NO_CERTIFICATE = "HD"


def star_band(average: Column) -> Column:
    band = F.lit(None).cast("bigint")
    for star, edge in reversed(STAR_BANDS):
        band = F.when(average >= edge, F.lit(star).cast("bigint")).otherwise(band)
    return band


def clip_rating(score: Column) -> Column:
    low, high = RATING_RANGE
    return F.least(F.greatest(score, F.lit(low)), F.lit(high))


def certificate(mpaa: Column) -> Column:
    return F.coalesce(F.nullif(mpaa, F.lit("")), F.lit(NO_CERTIFICATE))


def shown_average(average: Column) -> Column:
    return F.round(average, 1)


def shown_prediction(score: Column) -> Column:
    return F.round(score, 2)
