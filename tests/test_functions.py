from helpers import day, rows

from pyspark.sql import functions as F

from cohortloom.functions import dates, strata
from cohortloom.session import local_frame


def test_age_on_first_of_july(spark):
    born = [
        ("1990-07-01", 2008, 18), ("1990-07-02", 2008, 17), ("1992-02-29", 2009, 17), ("2000-07-01", 2000, 0),
        ("2001-06-30", 2000, 0), ("2001-07-01", 2000, -1), ("2002-01-01", 2000, -1), ("1860-01-01", 2010, 150),
        ("1859-01-01", 2010, 151),
    ]
    df = local_frame(spark, [(day(d), y, a) for d, y, a in born], "dob date, year int, expected int")
    off = df.where(dates.age_in_year(F.col("dob"), F.col("year")) != F.col("expected"))
    assert off.collect() == []


def test_age_bands_and_labels(spark):
    ages = [-1, 0, 17, 18, 24, 25, 34, 35, 44, 45, 54, 55, 64, 65, 150, 151, None]
    df = local_frame(spark, [(a,) for a in ages], "age int").withColumn("band", strata.age_band(F.col("age")))
    found = {
        r.age: (r.short, r.interval)
        for r in df.select(
            "age", strata.band_label(F.col("band")).alias("short"), strata.band_interval(F.col("band")).alias("interval")
        ).collect()
    }
    assert found[-1] == found[151] == found[None] == (None, None)
    assert found[0] == found[17] == ("<18", "[0,17]")
    assert found[18] == found[24] == ("18-24", "(17,24]")
    assert found[25] == found[34] == ("25-34", "(24,34]")
    assert found[35] == found[44] == ("35-44", "(34,44]")
    assert found[45] == found[54] == ("45-54", "(44,54]")
    assert found[55] == found[64] == ("55-64", "(54,64]")
    assert found[65] == found[150] == (">=65", "(64,150]")


def test_birth_date_defaults(spark):
    df = local_frame(spark, [(1980, 3, 4), (1980, None, 4), (1980, 3, None), (1980, None, None)], "y int, m int, d int")
    assert rows(df.select(dates.birth_date(F.col("y"), F.col("m"), F.col("d")))) == [
        (day("1980-03-01"),), (day("1980-03-04"),), (day("1980-07-01"),), (day("1980-07-04"),),
    ]


def test_event_end_takes_the_first_known(spark):
    df = local_frame(
        spark, [(day("2020-01-01"), None, None), (day("2020-01-01"), day("2020-02-01"), 9), (day("2020-01-01"), None, 9)],
        "s date, e date, supply int",
    )
    end = dates.event_end(F.col("s"), F.col("e"), F.date_add("s", F.col("supply")))
    assert rows(df.select(end)) == [(day("2020-01-02"),), (day("2020-01-10"),), (day("2020-02-01"),)]


def test_start_is_moved_up_to_the_floor():
    assert dates.floor_start("2010-05-01") == day("2012-01-01")
    assert dates.floor_start("2014-05-01") == day("2014-05-01")
    assert dates.floor_start("1996-05-01", "1995-01-01") == day("1996-05-01")


def test_gender_labels(spark):
    df = local_frame(spark, [(8507,), (8532,), (0,), (None,)], "g int")
    assert [r[0] for r in df.select(strata.gender_label(F.col("g"))).collect()] == [
        "Male", "Female", "Unknown", "Unknown",
    ]
