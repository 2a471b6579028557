"""Cohort definition documents: nested JSON with concept sets, entry criteria and exits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortloom.model import CohortDefinition, Criterion
from cohortloom.operators.events import CONDITION, DRUG, OBSERVATION, PROCEDURE

# Names of the document format.
_CRITERION = (
    "struct<CodesetId: bigint, OccurrenceStartDate: struct<Value: string, Extent: string, Op: string>>"
)
_DOMAIN_OF = {
    "ConditionOccurrence": CONDITION,
    "Observation": OBSERVATION,
    "ProcedureOccurrence": PROCEDURE,
    "DrugExposure": DRUG,
}
DOCUMENT = f"""
    ConceptSets array<struct<
        id: bigint,
        name: string,
        expression: struct<items: array<struct<
            concept: struct<CONCEPT_ID: bigint>, isExcluded: boolean, includeDescendants: boolean>>>>>,
    PrimaryCriteria struct<
        CriteriaList: array<struct<{", ".join(f"{name}: {_CRITERION}" for name in _DOMAIN_OF)}>>,
        ObservationWindow: struct<PriorDays: int, PostDays: int>,
        PrimaryCriteriaLimit: struct<Type: string>>,
    QualifiedLimit struct<Type: string>,
    ExpressionLimit struct<Type: string>,
    InclusionRules array<string>,
    EndStrategy struct<DateOffset: struct<DateField: string, Offset: int>>,
    CensoringCriteria array<struct<Death: map<string, string>>>,
    CollapseSettings struct<CollapseType: string, EraPad: int>
"""
ALL, FIRST, ERA, START_DATE = "All", "First", "ERA", "StartDate"

# The keys a document may have, by level. A list holds objects of one kind, an empty
# object must be empty, False must not be true, and None is any plain value.
_CRITERION_KEYS = {"CodesetId": None, "OccurrenceStartDate": {"Value": None, "Extent": None, "Op": None}}
_CONCEPT_KEYS = dict.fromkeys(
    ("CONCEPT_CLASS_ID", "CONCEPT_CODE", "CONCEPT_ID", "CONCEPT_NAME", "DOMAIN_ID", "INVALID_REASON",
     "INVALID_REASON_CAPTION", "STANDARD_CONCEPT", "STANDARD_CONCEPT_CAPTION", "VOCABULARY_ID")
)
_ITEM_KEYS = {"concept": _CONCEPT_KEYS, "isExcluded": None, "includeDescendants": None, "includeMapped": False}
_KEYS = {
    "ConceptSets": [{"id": None, "name": None, "expression": {"items": [_ITEM_KEYS]}}],
    "PrimaryCriteria": {
        "CriteriaList": [{name: _CRITERION_KEYS for name in _DOMAIN_OF}],
        "ObservationWindow": {"PriorDays": None, "PostDays": None},
        "PrimaryCriteriaLimit": {"Type": None},
    },
    "QualifiedLimit": {"Type": None},
    "ExpressionLimit": {"Type": None},
    "InclusionRules": None,
    "EndStrategy": {"DateOffset": {"DateField": None, "Offset": None}},
    "CensoringCriteria": [{"Death": {}}],
    "CollapseSettings": {"CollapseType": None, "EraPad": None},
    "CensorWindow": {},
    "cdmVersionRange": None,
}
# Codeset ids are local to a document. Within a study the document's id stands above 32 bits of them.
_LOCAL_BITS = 32


def _beyond(known: dict, value: Column, path: str, inside: str = "$") -> Column:
    """Paths of what a parsed document has beyond the known keys, for the object at ``inside`` of ``value``.

    Levels are reached by their path in the one parsed value; only lists are gone through.
    """
    keys = F.map_keys(F.variant_get(value, inside, "map<string,variant>"))
    found = [F.transform(F.filter(keys, lambda key: ~key.isin(list(known))), lambda key: F.concat(F.lit(path), key))]
    for name, inner in known.items():
        at, below = f"{inside}.{name}", f"{path}{name}/"
        if isinstance(inner, dict):
            found.append(_beyond(inner, value, below, at))
        elif isinstance(inner, list):
            objects = F.variant_get(value, at, "array<variant>")
            found.append(F.flatten(F.transform(objects, _beyond_of(inner[0], below))))
        elif inner is False:
            found.append(F.when(F.variant_get(value, at, "boolean"), F.array(F.lit(f"{path}{name}"))))
    return F.concat(*[F.coalesce(x, F.array().cast("array<string>")) for x in found])


def _beyond_of(known: dict, path: str):
    return lambda value: _beyond(known, value, path)


def write_definitions(documents: DataFrame, path: str, text: str = "text") -> None:
    """Stores documents (``name`` and their text) in a shared folder, each in a folder of its name."""
    whole = documents.select("name", F.col(text).alias("value"))
    whole.write.mode("overwrite").option("lineSep", " ").partitionBy("name").text(path)


def read_definitions(spark: SparkSession, path: str) -> DataFrame:
    """Definition files as rows, with the name of each in ``name``.

    That is the name of the folder that ``write_definitions`` gave it, or else the file's without its ending.
    """
    files = spark.read.text(path, wholetext=True)
    if "name" in files.columns:
        return parse_definitions(files.withColumn("name", F.col("name").cast("string")), "value")
    # The file name is percent-encoded, with a plain plus sign for itself.
    file_name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    named = files.select(F.regexp_replace(file_name, r"\.json$", "").alias("name"), "value")
    return parse_definitions(named, "value")


def parse_definitions(documents: DataFrame, text: str) -> DataFrame:
    """Definition documents held as text in a column, other columns kept.

    Each text is parsed once, into a variant that both the settings and the check of its keys are read
    from. Text that isn't a document fails the query. ``unsupported`` lists what a document asks for beyond
    the known settings; documents with any are refused by whatever uses them.
    """
    kept = [c for c in documents.columns if c != text]
    parsed = documents.select(*kept, F.parse_json(F.ltrim(F.col(text), F.lit("\ufeff"))).alias("value"))
    return parsed.select(
        *kept,
        F.variant_get("value", "$", f"struct<{DOCUMENT}>").alias("document"),
        _beyond(_KEYS, F.col("value"), "").alias("unsupported"),
    ).select(*kept, "unsupported", "document.*")


def study_codeset_id(definition_id, local_id):
    """The study's number of a document's codeset, for columns or integers."""
    wide = definition_id.cast("bigint") if isinstance(definition_id, Column) else definition_id
    return wide * (1 << _LOCAL_BITS) + local_id


def definition_items(definitions: DataFrame, definition_id: str = "definition_id") -> DataFrame:
    """Concept set items of all definitions, ready for ``resolve_concept_sets``.

    Flags absent from a document are false.
    """
    of = F.col(definition_id).cast("string")
    sound = F.when(
        F.size("unsupported") > 0,
        F.raise_error(F.concat(F.lit("definition "), of, F.lit(" asks for "), F.array_join("unsupported", ", "))),
    ).when(
        F.col("ConceptSets").isNull(), F.raise_error(F.concat(F.lit("definition "), of, F.lit(" has no concept sets")))
    )
    checked = F.coalesce(sound.cast(definitions.schema["ConceptSets"].dataType), F.col("ConceptSets"))
    sets = definitions.select(F.col(definition_id).alias("_definition"), F.explode(checked).alias("s"))
    local = F.when(F.col("id").between(0, (1 << _LOCAL_BITS) - 1), F.col("id")).otherwise(
        F.raise_error(F.concat(F.lit("codeset id out of range: "), F.coalesce(F.col("id").cast("string"), F.lit("none")))).cast("bigint")
    )
    return sets.select("_definition", "s.id", F.explode("s.expression.items").alias("i")).select(
        study_codeset_id(F.col("_definition"), local).alias("codeset_id"),
        F.col("i.concept.CONCEPT_ID").alias("concept_id"),
        F.coalesce("i.includeDescendants", F.lit(False)).alias("include_descendants"),
        F.coalesce("i.isExcluded", F.lit(False)).alias("is_excluded"),
    )


def _bounds(condition) -> tuple[dt.date | None, dt.date | None]:
    """Closed date bounds of an occurrence-date condition."""
    if condition is None:
        return None, None
    value, day = dt.date.fromisoformat(condition.Value), dt.timedelta(days=1)
    match condition.Op:
        case "gte":
            return value, None
        case "gt":
            return value + day, None
        case "lte":
            return None, value
        case "lt":
            return None, value - day
        case "eq":
            return value, value
        case "bt":
            return value, dt.date.fromisoformat(condition.Extent)
    raise ValueError(f"unknown date operator {condition.Op!r}")


def _criteria(row) -> tuple[Criterion, ...]:
    found = []
    for entry in row.PrimaryCriteria.CriteriaList:
        named = [(name, entry[name]) for name in _DOMAIN_OF if entry[name] is not None]
        if len(named) != 1:
            raise ValueError(f"definition {row.name!r} has an entry criterion of an unknown domain")
        (name, criterion), = named
        _require(criterion.CodesetId is not None, row, "a criterion without a codeset")
        _require(0 <= criterion.CodesetId < 1 << _LOCAL_BITS, row, f"codeset id {criterion.CodesetId}")
        codeset = study_codeset_id(row.definition_id, criterion.CodesetId)
        found.append(Criterion(_DOMAIN_OF[name], codeset, *_bounds(criterion.OccurrenceStartDate)))
    return tuple(found)


def _require(condition: bool, row, what: str) -> None:
    if not condition:
        raise ValueError(f"definition {row.name!r}: {what} is not supported")


def _part(row, path: str):
    for name in path.split("."):
        row = row[name]
        if row is None:
            return None
    return row


def cohort_definitions(definitions: DataFrame, cohort_type: str | None = None) -> list[CohortDefinition]:
    """Study configuration from parsed documents with columns ``definition_id`` and ``name``.

    Without ``cohort_type``, each document's type is in a column of that name. Only the settings come to the driver, one row per definition; the concept sets
    stay distributed.
    """
    built = []
    for row in definitions.drop("ConceptSets").collect():
        _require(not row.unsupported, row, ", ".join(row.unsupported))
        for part in (
            "PrimaryCriteria", "PrimaryCriteria.CriteriaList", "PrimaryCriteria.ObservationWindow",
            "PrimaryCriteria.PrimaryCriteriaLimit", "QualifiedLimit", "ExpressionLimit", "EndStrategy",
            "CollapseSettings",
        ):
            _require(_part(row, part) is not None, row, f"a document without {part}")
        window, offset = row.PrimaryCriteria.ObservationWindow, row.EndStrategy.DateOffset
        _require(row.PrimaryCriteria.PrimaryCriteriaLimit.Type == ALL, row, "a primary limit")
        _require(row.ExpressionLimit.Type == ALL, row, "an expression limit")
        _require(row.QualifiedLimit.Type in (ALL, FIRST), row, "this qualified limit")
        _require(not row.InclusionRules, row, "an inclusion rule in a document")
        _require(offset is not None and offset.DateField == START_DATE, row, "this exit")
        _require(row.CollapseSettings.CollapseType == ERA, row, "this collapse")
        censoring = row.CensoringCriteria or []
        _require(all(c.Death is not None for c in censoring), row, "this censoring")
        built.append(
            CohortDefinition(
                cohort_id=row.definition_id,
                name=row.name,
                cohort_type=cohort_type or row.cohort_type,
                primary=_criteria(row),
                prior_days=window.PriorDays,
                post_days=window.PostDays,
                first_only=row.QualifiedLimit.Type == FIRST,
                exit_days=offset.Offset,
                censor_at_death=bool(censoring),
                era_pad=row.CollapseSettings.EraPad,
            )
        )
    return built
