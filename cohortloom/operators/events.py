"""Events of each clinical domain in one common shape."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.functions.dates import event_end
from cohortloom.session import beyond_broadcast, parts_for
from cohortloom.sources.tables import Tables


@dataclass(frozen=True)
class Domain:
    """Where a domain's events are stored and which column carries the code."""

    table: str
    code: str
    start: str
    end: str | None = None
    supply: str | None = None
    source_coded: bool = False


CONDITION = "condition"
DRUG_SOURCE = "drug_source"
DRUG = "drug"
OBSERVATION = "observation"
PROCEDURE = "procedure"
# Deaths have no codes; they are events that end stays.
DEATH = "death"

DOMAINS: Mapping[str, Domain] = {
    CONDITION: Domain(
        "condition_occurrence", "condition_concept_id", "condition_start_date", "condition_end_date"
    ),
    DRUG_SOURCE: Domain(
        "drug_exposure", "drug_source_value", "drug_exposure_start_date", "drug_exposure_end_date",
        "days_supply", source_coded=True,
    ),
    DRUG: Domain(
        "drug_exposure", "drug_concept_id", "drug_exposure_start_date", "drug_exposure_end_date",
        "days_supply",
    ),
    OBSERVATION: Domain("observation", "observation_concept_id", "observation_date"),
    PROCEDURE: Domain("procedure_occurrence", "procedure_concept_id", "procedure_date"),
}


# As many codes are listed in a scan's filter; more are filtered by their range.
LISTED_CODES = 1000
# Bytes of a domain's files for each partition that its events are counted in.
BYTES_COUNTED = 16 << 20


@dataclass(frozen=True)
class PushedCodes:
    """What a study knows of its codesets' codes: all of them where they are few, else each set's least and greatest."""

    values: Mapping[int, tuple] | None
    ranges: Mapping[int, tuple]

    def condition(self, code: Column, codesets: set[int]) -> Column:
        """A filter that the source can apply; rows beyond the codesets may still meet it."""
        known = [i for i in sorted(codesets) if i in self.ranges]
        if not known:
            return F.lit(False)
        if self.values is not None:
            return code.isin(sorted({v for i in known for v in self.values[i]}))
        return code.between(min(self.ranges[i][0] for i in known), max(self.ranges[i][1] for i in known))


def pushed_codes(codes: DataFrame, code: str, most: int = LISTED_CODES) -> PushedCodes:
    """Reads from stored codes what scans may be limited to: at most ``most`` codes, and a range for each codeset."""
    ranges = {
        r["codeset_id"]: (r["low"], r["high"], r["n"])
        for r in codes.where(F.col(code).isNotNull())
        .groupBy("codeset_id")
        .agg(F.min(code).alias("low"), F.max(code).alias("high"), F.count(F.lit(1)).alias("n"))
        .collect()
    }
    values = None
    if sum(n for _, _, n in ranges.values()) <= most:
        values = {i: () for i in ranges}
        for r in codes.where(F.col(code).isNotNull()).select("codeset_id", code).collect():
            values[r["codeset_id"]] += (r[code],)
    return PushedCodes(values, {i: (low, high) for i, (low, high, _) in ranges.items()})


def _code_column(domain_name: str) -> str:
    return "source_code" if DOMAINS[domain_name].source_coded else "concept_id"


def _end(domain: Domain) -> Column:
    start = F.col(domain.start)
    candidates = []
    if domain.end:
        candidates.append(F.col(domain.end))
    if domain.supply:
        candidates.append(F.date_add(start, F.col(domain.supply)))
    return event_end(start, *candidates)


def domain_events(tables: Tables, domain_name: str, codes: DataFrame) -> DataFrame:
    """Events of one domain whose code is among ``codes``, with the other columns of ``codes``.

    ``codes`` holds ``concept_id``, or ``source_code`` for source-coded domains, and
    ``codeset_id`` (an event then appears once per codeset) or ``codesets`` (once in
    all). The caller decides whether it is broadcast.
    """
    domain = DOMAINS[domain_name]
    code = _code_column(domain_name)
    return (
        tables[domain.table]
        .join(codes, F.col(domain.code) == codes[code])
        .select(
            F.lit(domain_name).alias("domain"),
            *[codes[column] for column in codes.columns if column != code],
            "person_id",
            F.col(domain.start).alias("start_date"),
            _end(domain).alias("end_date"),
            "visit_occurrence_id",
        )
    )


def death_events(death: DataFrame) -> DataFrame:
    """Deaths as one-day events."""
    return death.select(
        "person_id",
        F.col("death_date").alias("start_date"),
        F.date_add("death_date", 1).alias("end_date"),
    )


def codesets_by_code(codes: DataFrame, domain_name: str) -> DataFrame:
    """Each code once, with the array of codesets it is in (no longer than the study's list)."""
    return codes.groupBy(_code_column(domain_name)).agg(
        F.sort_array(F.collect_set("codeset_id")).alias("codesets")
    )


_COUNTED = ["domain", "codesets", "person_id", "start_date"]


def event_days(events: DataFrame) -> DataFrame:
    """Events counted by person, start date and codesets.

    Everything after entry depends on the start date alone, so equal days are
    added up before any shuffle by person. A person then has at most one row per
    calendar day and combination of codesets, however many events they have. Where tables are too large
    for the session's partitions, events are dealt by person and day into more, so that a task counts as much
    however large they are; events of a day then meet behind that shuffle.
    """
    parts = parts_for(BYTES_COUNTED, events)
    if parts > int(events.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        events = events.select(*_COUNTED).repartition(parts, "person_id", "start_date")
    return events.groupBy(*_COUNTED).agg(F.count(F.lit(1)).alias("n_events"))


def tagged_event_days(
    tables: Tables,
    used: Mapping[str, set[int]],
    concept_codes: DataFrame | None,
    source_codes: DataFrame | None,
    small_codes: bool = False,
    pushed: Mapping[bool, PushedCodes] | None = None,
) -> DataFrame:
    """Event days of every codeset in use, and of deaths, reading each domain's table once.

    ``used`` maps domain names to the codesets needed from that domain. Codes known to
    be few (``small_codes``) are broadcast; otherwise Spark chooses the join, but codes read from more than it would
    broadcast are hashed, so that the events, which are many more, aren't sorted. What is known of the codes
    (``pushed``) reaches the scans as a filter, so files and databases return little else than the study's events.
    """
    found = []
    for domain_name, wanted in sorted(used.items()):
        codes = source_codes if DOMAINS[domain_name].source_coded else concept_codes
        if codes is None:
            raise ValueError(f"domain {domain_name!r} needs codes that were not given")
        codes = codes.where(F.col("codeset_id").isin(sorted(wanted)))
        tagged = codesets_by_code(codes, domain_name)
        domain, read = DOMAINS[domain_name], tables
        if pushed and domain.source_coded in pushed:
            limit = pushed[domain.source_coded].condition(F.col(domain.code), wanted)
            read = {**tables, domain.table: tables[domain.table].where(limit)}
        if small_codes:
            tagged = F.broadcast(tagged)
        elif beyond_broadcast(tagged):
            tagged = tagged.hint("shuffle_hash")
        found.append(event_days(domain_events(read, domain_name, tagged)))
    if "death" in tables:
        deaths = death_events(tables["death"]).select(
            F.lit(DEATH).alias("domain"), F.array().cast("array<bigint>").alias("codesets"), "person_id", "start_date"
        )
        found.append(event_days(deaths))
    return reduce(DataFrame.unionByName, found)
