"""Age bands and gender labels.

Ages travel through the plans as a band number (0..6, null outside 0..150), which
keeps shuffled rows small and sorts naturally; labels are put on at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Last age of each band, and the two label styles of the results.
BAND_LAST_AGES = (17, 24, 34, 44, 54, 64, 150)
BAND_LABELS = ("<18", "18-24", "25-34", "35-44", "45-54", "55-64", ">=65")
BAND_INTERVALS = ("[0,17]", "(17,24]", "(24,34]", "(34,44]", "(44,54]", "(54,64]", "(64,150]")

# Gender concepts and their labels.
MALE_CONCEPT, FEMALE_CONCEPT = 8507, 8532
MALE, FEMALE, UNKNOWN = "Male", "Female", "Unknown"


def age_band(age: Column) -> Column:
    band = F.when(age < 0, F.lit(None).cast("int"))
    for number, last in enumerate(BAND_LAST_AGES):
        band = band.when(age <= last, F.lit(number))
    return band


def _labelled(band: Column, labels: tuple[str, ...]) -> Column:
    return F.get(F.array(*[F.lit(label) for label in labels]), band)


def band_label(band: Column) -> Column:
    """Short labels, as in the rate results."""
    return _labelled(band, BAND_LABELS)


def band_interval(band: Column) -> Column:
    """Interval labels, as in prepared rows, dose and profile results."""
    return _labelled(band, BAND_INTERVALS)


def gender_label(concept: Column) -> Column:
    return (
        F.when(concept == MALE_CONCEPT, MALE)
        .when(concept == FEMALE_CONCEPT, FEMALE)
        .otherwise(UNKNOWN)
    )
