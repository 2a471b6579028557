"""A whole study, from source tables to stored results."""

from __future__ import annotations

import datetime as dt
import hashlib
import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cohortloom.functions.dates import STUDY_FLOOR, as_date, floor_start
from cohortloom.model import DISEASE, CohortDefinition, cohort_ids, rule_words, word_names
from cohortloom.operators import impact, population as pop, rates
from cohortloom.operators.counts import cohort_counts
from cohortloom.operators.disclosure import mask_small_cells
from cohortloom.operators.dose import Strength, dose_summary
from cohortloom.operators.events import DOMAINS, pushed_codes
from cohortloom.operators.margins import add_margins
from cohortloom.operators.profile import diagnosis_profile
from cohortloom.operators.timeline import BYTES_READ, by_person
from cohortloom.plans.cohorts import Codes, cohorts_of, qualified_events
from cohortloom.schemas import COHORT, DATASET_COUNTS, RATES_MONTH, RATES_YEAR
from cohortloom.session import fits_broadcast, local_frame, parts_for
from cohortloom.sources import store
from cohortloom.sources.buckets import BucketedTable
from cohortloom.sources.digest import group_digests, table_digests
from cohortloom.sources.tables import Tables

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class StudyParameters:
    """Windows, stages and disclosure limit of a run.

    Without ``compare_data`` source tables are taken to be those of the run before, and not read for their digests.
    With ``buckets`` cohorts, population and prepared rows are stored in as many buckets of their subjects,
    so that what is done with them afterwards needs no exchange by subject; a folder keeps its number of them.
    """

    database: str = "Unknown"
    create_cohorts: bool = True
    run_prevalence: bool = True
    year_start: dt.date | str = dt.date(2012, 1, 1)
    year_end: dt.date | str = dt.date(2021, 12, 31)
    month_start: dt.date | str = dt.date(2012, 1, 1)
    month_end: dt.date | str = dt.date(2021, 12, 31)
    floor_date: dt.date | str = STUDY_FLOOR
    min_cell_count: int = 0
    rule_impact: bool = False
    compare_data: bool = True
    buckets: int = 0


@dataclass(frozen=True)
class DoseSettings:
    """The cohort of any strength, its name in result files, and the strengths."""

    any_strength: int
    name: str
    strengths: Sequence[Strength]


@dataclass(frozen=True)
class StudyPaths:
    """Where a study's tables and results lie under its output folder."""

    output: str

    def __getitem__(self, name: str) -> str:
        return f"{self.output}/{_FILES[name]}"

    def dose(self, name: str) -> str:
        return f"{self.output}/dose_{name}.csv"

    def demographics(self, name: str) -> str:
        return f"{self.output}/demo_{name}.csv"


_FILES = {
    "marks": "marks",
    "cohort": "cohort",
    "concept_codes": "tmpData/concept_codes",
    "source_codes": "tmpData/source_codes",
    "qualified": "tmpData/qualified",
    "population": "tmpData/population",
    "prepared": "tmpData/prepared",
    "cohort_counts": "CohortCounts.csv",
    "dataset_counts": "DatasetCounts.csv",
    "by_year": "dataYr.csv",
    "by_month": "dataMth.csv",
    "by_year_masked": "dataYrMasked.csv",
    "by_month_masked": "dataMthMasked.csv",
    "display_by_year": "display/dataByYear",
    "display_by_month": "display/dataByMonth",
    "inclusion_result": "cohort_inclusion_result",
    "inclusion_stats": "cohort_inclusion_stats",
    "summary_stats": "cohort_summary_stats",
}


def _stored(df: DataFrame, path: str) -> DataFrame:
    """Writes ``df`` and reads it back, so that what follows starts from files."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class _Marks:
    """What each part of the output was made from; a part whose mark is the one wanted needn't be made again.

    A part is cleared before it is written and marked after, so a run that was cut short leaves no part
    that is taken for whole.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.held = store.read_marks(spark, path)

    def changed(self, stage: str, wanted: dict[int, str]) -> list[int]:
        return [i for i, mark in wanted.items() if self.held.get(f"{stage}/{i}") != mark]

    def gone(self, stage: str, wanted: dict[int, str]) -> list[int]:
        ids = [int(p.partition("/")[2]) for p in self.held if p.startswith(f"{stage}/")]
        return [i for i in ids if i not in wanted]

    def of(self, stage: str) -> list[tuple[str, str]]:
        return sorted((p, m) for p, m in self.held.items() if p.startswith(f"{stage}/"))

    def data(self, tables: Tables, names: set[str], compare: bool) -> dict[str, str]:
        """Digests of source tables; without ``compare`` those of the run before, where it has them."""
        read = {n: tables[n] for n in names if n in tables and (compare or f"data/{n}" not in self.held)}
        self.held |= {f"data/{n}": digest for n, digest in table_digests(read).items()}
        return {n: self.held[f"data/{n}"] for n in sorted(names) if n in tables}

    def make(self, stage: str, wanted: dict[int, str], write: Callable[[list[int]], None]) -> list[int]:
        """Calls ``write`` with the ids whose part is to be replaced, those no longer wanted included.

        Returns the ids that were made anew.
        """
        changed, gone = self.changed(stage, wanted), self.gone(stage, wanted)
        if not changed and not gone:
            return []
        parts = {f"{stage}/{i}" for i in (*changed, *gone)}
        self.held = {p: m for p, m in self.held.items() if p not in parts}
        store.write_marks(self.spark, self.path, self.held)
        write([*changed, *gone])
        self.held |= {f"{stage}/{i}": wanted[i] for i in changed}
        store.write_marks(self.spark, self.path, self.held)
        logger.info("%s: made %s, removed %s", stage, changed, gone)
        return changed


def _layout(name: str) -> tuple[T.StructType, tuple[str, ...]]:
    """Columns of a stored table of subjects, and the keys of its slices."""
    schemas = {"cohort": COHORT, "population": _population_schema(), "prepared": _prepared_schema()}
    return schemas[name], () if name == "population" else tuple(store.COHORT_KEYS)


def _buckets(spark: SparkSession, paths: StudyPaths, name: str, buckets: int) -> BucketedTable:
    schema, keys = _layout(name)
    return BucketedTable(spark, paths[name], schema, "subject_id", buckets, keys)


def stored_table(spark: SparkSession, paths: StudyPaths, name: str, buckets: int = 0) -> DataFrame:
    """Stored cohorts, population or prepared rows."""
    if buckets:
        return _buckets(spark, paths, name, buckets).read()
    return spark.read.schema(_layout(name)[0]).parquet(paths[name])


def _create(spark: SparkSession, paths: StudyPaths, name: str, buckets: int) -> None:
    if buckets:
        _buckets(spark, paths, name, buckets).create()
    else:
        store.create_table(spark, paths[name], _layout(name)[0], list(_layout(name)[1]))


def _replace(rows: DataFrame, paths: StudyPaths, name: str, buckets: int, ids: Sequence[int]) -> None:
    """Replaces cohorts' slices of a stored table, or all of a table without them."""
    schema, keys = _layout(name)
    slices = [(i,) for i in ids]
    if buckets:
        _buckets(rows.sparkSession, paths, name, buckets).replace(rows.select(*schema.names), slices)
    elif keys:
        store.replace_slices(rows.select(*schema.names), paths[name], list(keys), slices)
    else:
        rows.select(*schema.names).write.mode("overwrite").parquet(paths[name])


def store_codes(codes: Codes, paths: StudyPaths) -> Codes:
    """Resolved codes, computed once for all that needs them."""
    stored = [
        None if df is None else _stored(df, paths[name])
        for name, df in (("concept_codes", codes.concepts), ("source_codes", codes.sources))
    ]
    return Codes(
        *stored,
        small=all(fits_broadcast(df) for df in stored if df is not None),
        pushed={
            coded: pushed_codes(df, column)
            for coded, df, column in ((False, stored[0], "concept_id"), (True, stored[1], "source_code"))
            if df is not None
        },
    )


def cohort_marks(
    marks: _Marks, tables: Tables, codes: Codes, definitions: Sequence[CohortDefinition], compare: bool = True
) -> dict[int, str]:
    """Per cohort a fingerprint of all that its rows depend on.

    That is its definition, the codes of the codesets it names, and the rows of the tables it reads.
    """
    read = {d.cohort_id: {c.domain for c in (*d.primary, *d.rules)} for d in definitions}
    domains = set().union(*read.values())
    needed = {DOMAINS[name].table for name in domains} | {"observation_period", "death"}
    data = marks.data(tables, needed, compare)
    of_codes = {
        coded: {} if df is None else group_digests(df, "codeset_id")
        for coded, df in ((False, codes.concepts), (True, codes.sources))
    }
    words = rule_words(definitions)  # a cohort's stored masks have as many

    def mark(d: CohortDefinition) -> str:
        used = sorted({(c.domain, c.codeset_id) for c in (*d.primary, *d.rules)})
        own = [(name, i, of_codes[DOMAINS[name].source_coded].get(i)) for name, i in used]
        names = {DOMAINS[name].table for name in read[d.cohort_id]} | {"observation_period", "death"}
        return _fingerprint(d, own, [(n, data.get(n)) for n in sorted(names)], words)

    return {d.cohort_id: mark(d) for d in definitions}


_QUALIFIED_KEYS = ["cohort_id"]


def _qualified_schema(words: int) -> T.StructType:
    masks = [f"{name} bigint" for mask in ("rule_mask", "full_mask") for name in word_names(mask, words)]
    return T.StructType.fromDDL(
        "person_id bigint, start_date date, op_start_date date, op_end_date date, censor_date date, "
        f"n_events bigint, {', '.join(masks)}, first_only boolean, exit_days int, censored boolean, era_pad int, "
        "cohort_id int"
    )


def store_qualified(
    tables: Tables,
    codes: Codes,
    definitions: Sequence[CohortDefinition],
    marks: _Marks,
    wanted: dict[int, str],
    paths: StudyPaths,
) -> DataFrame:
    """Index events of all cohorts; those of changed cohorts are computed, in one plan for all of these."""
    spark, words = marks.spark, rule_words(definitions)
    schema = _qualified_schema(words)
    if not marks.of("qualified"):
        store.create_table(spark, paths["qualified"], schema, _QUALIFIED_KEYS)

    def write(ids: list[int]) -> None:
        own = [d for d in definitions if d.cohort_id in ids]
        found = qualified_events(tables, codes, own) if own else local_frame(spark, [], schema)
        # Words of other cohorts' rules that these cohorts don't need.
        lacking = [f.name for f in schema if f.name not in found.columns]
        found = found.withColumns({name: F.lit(0).cast("bigint") for name in lacking}).select(*schema.names)
        store.replace_slices(found, paths["qualified"], _QUALIFIED_KEYS, [(i,) for i in ids])

    marks.make("qualified", wanted, write)
    return spark.read.schema(schema).parquet(paths["qualified"])


def _of(df: DataFrame, key: str, ids: Sequence[int]) -> DataFrame:
    return df.where(F.col(key).isin(list(ids)))


def create_all_cohorts(
    tables: Tables,
    qualified: DataFrame,
    definitions: Sequence[CohortDefinition],
    marks: _Marks,
    wanted: dict[int, str],
    paths: StudyPaths,
    parameters: StudyParameters,
) -> list[int]:
    """Cohort table, counts, population and prepared rows; returns the cohorts that were built.

    Rows of cohorts that are as they were stay, and rows of cohorts that the study no longer has go.
    """
    spark, buckets = marks.spark, parameters.buckets
    for name in ("cohort", "prepared", "population"):
        if not marks.of(name):
            _create(spark, paths, name, buckets)
    built = marks.make(
        "cohort", wanted,
        lambda ids: _replace(cohorts_of(_of(qualified, "cohort_id", ids)), paths, "cohort", buckets, ids),
    )
    cohort = stored_table(spark, paths, "cohort", buckets)
    registry = rates.registry_frame(spark, [(d.cohort_id, d.name) for d in definitions])
    store.write_csv(cohort_counts(cohort, registry), paths["cohort_counts"])

    years = (as_date(parameters.year_start).year, as_date(parameters.year_end).year)
    persons = _fingerprint(years, marks.data(tables, {"person", "observation_period"}, parameters.compare_data))
    marks.make(
        "population", {0: persons},
        lambda _: _replace(
            pop.observed_population(tables["person"], tables["observation_period"], *years),
            paths, "population", buckets, (),
        ),
    )
    population = stored_table(spark, paths, "population", buckets)

    def prepare(ids: list[int]) -> None:
        rows = pop.attach_demographics(_of(cohort, "cohort_definition_id", ids), population)
        _replace(rows, paths, "prepared", buckets, ids)

    marks.make("prepared", {i: _fingerprint(mark, persons) for i, mark in wanted.items()}, prepare)
    return built


def write_rule_impact(
    qualified: DataFrame,
    definitions: Sequence[CohortDefinition],
    marks: _Marks,
    wanted: dict[int, str],
    paths: StudyPaths,
) -> None:
    """Counts per rule mask, rule and cohort, for all events and for best events.

    Rows of changed cohorts take the place of those stored for them.
    """
    spark, modes = marks.spark, (impact.ALL_EVENTS, impact.BEST_EVENT)
    ruled = {d.cohort_id: d for d in definitions if d.rules}
    masks = [f"inclusion_{name} bigint" for name in word_names("rule_mask", rule_words(definitions))]
    schema = T.StructType.fromDDL(
        ", ".join(["cohort_definition_id int, mode_id int", *masks, "person_count bigint"])
    )

    def write(ids: list[int]) -> None:
        slices = [(i, mode) for i in ids for mode in modes]
        own = [ruled[i] for i in ids if i in ruled]
        catalogue = impact.rule_catalogue(spark, own)
        events = _of(qualified, "cohort_id", [d.cohort_id for d in own])
        # Best events are sorted; dealt by person, a task's share doesn't grow with the files.
        dealt = by_person(events, parts_for(BYTES_READ, events))

        def save(frames: list[DataFrame], path: str) -> None:
            store.replace_slices(frames[0].unionByName(frames[1]), path, store.IMPACT_KEYS, slices)

        found = [impact.inclusion_result(df, m) for df, m in zip((events, dealt), modes)]
        save(found, paths["inclusion_result"])
        stored = _of(spark.read.schema(schema).parquet(paths["inclusion_result"]), "cohort_definition_id", ids)
        results = {m: stored.where(stored["mode_id"] == m) for m in modes}
        save([impact.inclusion_stats(results[m], catalogue, m) for m in modes], paths["inclusion_stats"])
        save([impact.attrition_summary(results[m], catalogue, m) for m in modes], paths["summary_stats"])

    marks.make("impact", {i: mark for i, mark in wanted.items() if i in ruled}, write)


def _prepared_schema() -> T.StructType:
    return T.StructType.fromDDL(
        "cohort_definition_id int, subject_id bigint, cohort_start_date date, cohort_end_date date, "
        "gender string, dob date, n_periods bigint, start_year int, start_month date, age int, age_band int"
    )


def _population_schema() -> T.StructType:
    return T.StructType.fromDDL(
        "subject_id bigint, gender_concept_id int, gender string, dob date, cohort_start_date date, "
        "cohort_end_date date, start_year int, end_year int, start_month date, end_month date, n_periods bigint"
    )


def _fingerprint(*settings) -> str:
    """A digest of settings; all of them have a repr that says all they hold."""
    return hashlib.sha256(repr(settings).encode()).hexdigest()


def compute_prevalence(
    spark: SparkSession,
    definitions: Sequence[CohortDefinition],
    pairs: Sequence[tuple[int, int]],
    dose: DoseSettings | None,
    marks: _Marks,
    paths: StudyPaths,
    parameters: StudyParameters,
) -> None:
    """Rates, dose, profile, masked and displayed results from the prepared rows."""
    year_start = floor_start(parameters.year_start, parameters.floor_date)
    month_start = floor_start(parameters.month_start, parameters.floor_date)
    year_end, month_end = as_date(parameters.year_end), as_date(parameters.month_end)
    registry = rates.registry_frame(spark, [(d.cohort_id, d.name) for d in definitions])
    population = stored_table(spark, paths, "population", parameters.buckets)
    prepared = rates.within_months(
        stored_table(spark, paths, "prepared", parameters.buckets), month_start, month_end
    )
    years = (as_date(parameters.year_start).year, as_date(parameters.year_end).year)
    persons = marks.of("population")
    store.reuse_or_write_csv(
        spark, paths["dataset_counts"], DATASET_COUNTS, _fingerprint(years, persons), lambda: pop.dataset_counts(population)
    )
    window = (year_start, year_end, month_start, month_end, years)
    settings = _fingerprint(
        parameters.database, window, tuple(definitions), tuple(map(tuple, pairs)), marks.of("prepared"), persons
    )

    in_pairs = list(dict.fromkeys(i for pair in pairs for i in pair))

    def combined(grain: str) -> DataFrame:
        denominator = (
            pop.population_by_year(population, year_start.year, year_end.year)
            if grain == rates.YEAR
            else pop.population_by_month(population, month_start, month_end)
        )
        profiles = rates.stratum_profiles(prepared, in_pairs, grain)
        return rates.combined_rates(denominator, profiles, pairs, registry, parameters.database)

    by_year = store.reuse_or_write_csv(spark, paths["by_year"], RATES_YEAR, settings, lambda: combined(rates.YEAR))
    by_month = store.reuse_or_write_csv(spark, paths["by_month"], RATES_MONTH, settings, lambda: combined(rates.MONTH))

    if dose is not None:
        store.write_csv(dose_summary(prepared, dose.any_strength, dose.strengths), paths.dose(dose.name))
        diseases = [i for i in in_pairs if i in cohort_ids(definitions, DISEASE)]
        store.write_csv(
            diagnosis_profile(prepared, dose.any_strength, diseases), paths.demographics(dose.name)
        )

    least = parameters.min_cell_count
    if least > 0:
        store.write_csv(mask_small_cells(by_year, least), paths["by_year_masked"])
        store.write_csv(mask_small_cells(by_month, least), paths["by_month_masked"])
    for result, path in ((by_year, paths["display_by_year"]), (by_month, paths["display_by_month"])):
        shown = add_margins(result)
        store.write_display(mask_small_cells(shown, least) if least > 0 else shown, path)


def run_study(
    spark: SparkSession,
    tables: Tables,
    codes: Codes,
    definitions: Sequence[CohortDefinition],
    pairs: Sequence[tuple[int, int]],
    output: str,
    parameters: StudyParameters = StudyParameters(),
    dose: DoseSettings | None = None,
) -> StudyPaths:
    """Runs the stages switched on and returns where their results are.

    Each stage reads what the one before has stored, so a run can be taken up again and lost executors never
    cost more than the stage at hand. A run into the same folder builds only cohorts whose definition, codes or
    source tables have changed, and removes those that the study no longer has; yearly, monthly and dataset
    counts are kept as long as windows, definitions, pairs, database name and the rows they are made from are
    the same. Rows are compared by digests of whole tables, so one changed row is noticed.
    """
    paths = StudyPaths(output)
    marks = _Marks(spark, paths["marks"])
    if parameters.create_cohorts or parameters.rule_impact:
        codes = store_codes(codes, paths)
        wanted = cohort_marks(marks, tables, codes, definitions, parameters.compare_data)
        qualified = store_qualified(tables, codes, definitions, marks, wanted, paths)
    if parameters.create_cohorts:
        create_all_cohorts(tables, qualified, definitions, marks, wanted, paths, parameters)
    if parameters.rule_impact:
        write_rule_impact(qualified, definitions, marks, wanted, paths)
    if parameters.run_prevalence:
        compute_prevalence(spark, definitions, pairs, dose, marks, paths, parameters)
    return paths
