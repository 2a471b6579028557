"""Patient-level source tables as DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortloom.schemas import OPTIONAL_COLUMNS, SOURCE_TABLES

Tables = dict[str, DataFrame]


def read_parquet_tables(spark: SparkSession, root: str, names: Iterable[str] = tuple(SOURCE_TABLES)) -> Tables:
    """Tables stored as ``<root>/<name>``, read with their declared schemas."""
    return {
        name: spark.read.schema(SOURCE_TABLES[name]).parquet(f"{root}/{name}")
        for name in names
    }


def jdbc_options(
    url: str,
    table: str,
    *,
    split: tuple[str, int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options of one JDBC scan, in ranges of the column of ``split`` between its bounds if given."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if split is not None:
        column, low, high = split
        options |= {
            "partitionColumn": column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    return options


def split_column(name: str) -> str:
    """The column a table's scan is split by: persons, or concepts in the vocabulary."""
    for column in ("person_id", "concept_id", "descendant_concept_id"):
        if column in SOURCE_TABLES[name].names:
            return column
    raise ValueError(f"table {name!r} has no column to split by")


def even_bounds(ids: DataFrame, column: str, parts: int) -> list[int]:
    """Where to cut ids so that parts have about as many rows each, counted, not guessed from their range.

    The cuts are quantiles of the rows' ids, ascending and all different: an id can't be cut, so one
    with many rows makes fewer parts. Only the cuts reach the driver.
    """
    if parts < 2:
        return []
    shares = [k / parts for k in range(1, parts)]
    found = ids.agg(F.percentile_approx(column, shares, max(10_000, 20 * parts))).first()[0]
    return sorted({int(x) for x in found or []})


def even_predicates(column: str, bounds: Sequence[int]) -> list[str]:
    """Conditions for the parts between bounds; together they take every row once, those of null id too."""
    if not bounds:
        return ["1 = 1"]
    inner = [f"{column} > {a} AND {column} <= {b}" for a, b in zip(bounds, bounds[1:])]
    return [f"{column} <= {bounds[0]} OR {column} IS NULL", *inner, f"{column} > {bounds[-1]}"]


def read_jdbc_evenly(
    spark: SparkSession,
    url: str,
    database_schema: str,
    names: Iterable[str] = tuple(SOURCE_TABLES),
    *,
    partitions: int,
    **extra: str,
) -> Tables:
    """Tables in a site's database, each read in parts of about as many rows.

    A first scan reads the ids alone and counts where to cut; no bounds need to be known.
    """
    tables = {}
    for name in names:
        column, table = split_column(name), f"{database_schema}.{name}"
        ids = spark.read.format("jdbc").options(**jdbc_options(url, table, **extra)).load().select(column)
        parts = even_predicates(column, even_bounds(ids, column, partitions))
        properties = {k: v for k, v in jdbc_options(url, table, **extra).items() if k not in ("url", "dbtable")}
        tables[name] = conform(spark.read.jdbc(url, table, predicates=parts, properties=properties), name)
    return tables


def read_jdbc_tables(
    spark: SparkSession,
    url: str,
    database_schema: str,
    names: Iterable[str] = tuple(SOURCE_TABLES),
    *,
    person_bounds: tuple[int, int] | None = None,
    concept_bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    **extra: str,
) -> Tables:
    """Tables in a site's database. Filters and column lists are pushed to it by Spark.

    Scans are split by ids between the bounds given for persons and for concepts;
    rows outside them are read by the first and last part.
    """
    tables = {}
    for name in names:
        column = split_column(name)
        bounds = person_bounds if column == "person_id" else concept_bounds
        options = jdbc_options(
            url,
            f"{database_schema}.{name}",
            split=bounds and (column, *bounds),
            partitions=partitions,
            **extra,
        )
        scan = spark.read.format("jdbc").options(**options).load()
        tables[name] = conform(scan, name)
    return tables


def conform(df: DataFrame, name: str) -> DataFrame:
    """Columns of ``df`` in the declared order and types; names match without regard to case.

    A missing column is null where the table may lack it, and an error otherwise.
    """
    found = {column.lower(): column for column in df.columns}
    missing = [c for c in SOURCE_TABLES[name].names if c not in found and c not in OPTIONAL_COLUMNS]
    if missing:
        raise ValueError(f"table {name!r} lacks {', '.join(missing)}")
    return df.select(
        *[
            (F.col(found[field.name]) if field.name in found else F.lit(None))
            .cast(field.dataType)
            .alias(field.name)
            for field in SOURCE_TABLES[name]
        ]
    )
