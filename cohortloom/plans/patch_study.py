"""The shipped study: an opioid patch in six strengths beside psychiatric disorders and pain.

Disorders are concept sets over the vocabulary. Indications are plain concept lists.
A patch cohort holds exposures by local product code after any indication, of
persons without cancer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortloom.model import AT_LEAST, DISEASE, DRUG, EXACTLY, CohortDefinition, Criterion, Rule
from cohortloom.operators.concepts import concept_items, resolve_concept_sets, source_codes
from cohortloom.operators.dose import Strength
from cohortloom.operators.events import CONDITION, DRUG_SOURCE
from cohortloom.plans.cohorts import Codes
from cohortloom.sources.tables import Tables

# Ancestors of each disorder.
DEPRESSION = (
    4175329, 440383, 442306,
)
BIPOLAR_DISORDER = (
    436665,
)
SCHIZOPHRENIA = (
    435783, 4286201, 4335169, 434010, 432590, 35207135, 37117049,
)
ANXIETY_DISORDER = (
    442077, 37109206, 4199892, 434613, 4338031, 381537, 436074, 4304010,
)
NEURODEVELOPMENTAL_DISORDER = (
    40480225, 442335, 4024717, 45771096,
)
ALCOHOL_USE_DISORDER = (
    433735, 432609, 433753, 435243, 4218106, 439005, 436953, 378726, 435532, 433735, 433753, 374623,
    435243, 377830, 375519, 376383, 374317, 36714559, 378421,
)
SUBSTANCE_USE_DISORDER = (
    37116661, 44790195, 44786481, 4151569, 4149607, 440069, 440787, 37116660, 434697, 4219382,
    4004672, 443274, 44787894, 4269905, 4279309, 2796056, 4217840, 4302387, 4319165,
)
SOMATOFORM_DISORDER = (
    435784,
)

# Indications, as plain lists of concepts.
OA_INDICATIONS = (
    75897, 73553, 4155797, 4066493, 4116450, 4116451, 4079749, 4115380, 4115519, 46273178, 4116769,
    44783205, 4079750, 4114585, 4115521, 4242103, 4114586, 4115522, 80180, 762446, 40484571, 76191,
    136779, 443582, 444206, 72986, 40482662, 80494, 193460,
)
NEUROPATHY_INDICATIONS = (
    378421, 74723, 137856, 4080146, 374923, 378741, 380094, 4068622, 4067313, 137548, 4226266,
    136198, 4068613, 440890, 4160055, 437262, 42536233, 4256912, 4054876, 4062252, 4059119, 375801,
    4048028, 80497, 44782620, 72986, 195906, 43531046, 443730, 377821, 376065, 374360, 4140164,
    138841, 77630, 443795, 4043346, 76191, 40483292, 4028571, 378135, 439807, 4087597, 376963,
    4204199, 4134552, 436336, 4101333, 380394, 437784, 374221, 4044402, 138612, 382014, 36717576,
    196307, 4059120, 4062251, 4054877, 4248551, 4057038, 4160362, 36717471, 4056894, 4046351, 75344,
    78832, 4251304, 140090, 43531045, 141004, 374027, 4151985, 4001450, 4134121, 198520, 4044404,
    74635, 4066603, 4068617, 4152592, 4295340, 195259, 376395, 4134455, 43531028, 43531027, 436910,
    4102334, 381732, 4102481, 4102360, 4105009, 4216397, 373852, 377271, 4301699, 4102492, 375738,
    435227, 4133638, 40481180, 4024561, 378420, 45773181, 4101881, 138148, 4296728, 4174262, 376686,
    376112, 381551, 375260, 372888, 372409, 77079, 436785, 136788, 321661, 4227449, 433916, 134442,
    192885, 137858, 79119, 4068616, 4161309, 373470, 440703, 379801,
)
PANCREAS_INDICATIONS = (
    4340964, 195596,
)

# Ancestors of cancer.
CANCER = (
    4112752, 4082311, 317510, 432571, 4162276, 443588, 4246127, 197230, 443392, 4112853, 4180790,
    443388, 4181351, 4180793, 4181483, 4163261, 443390, 4178976, 437233, 138994, 196360, 198985,
    200962, 4311499, 432851, 4111921,
)

# Local product codes of each strength.
CODES_12 = (
    "622700340", "641605240", "641905750", "645304800", "645604290", "646900090", "648901870",
    "649806240", "659901030", "668101080", "671805850",
)
CODES_25 = (
    "622700350", "641605250", "641905760", "645304790", "645604170", "646900100", "648901880",
    "649806250", "657802100", "659901020", "668101010", "671805440",
)
CODES_37_5 = (
    "671805930",
)
CODES_50 = (
    "622700360", "641605260", "641905770", "645304830", "645604330", "646900110", "648901890",
    "649806230", "657802110", "659901010", "668101030", "671805820",
)
CODES_75 = (
    "641605270", "641905780", "646901000", "648901900", "659901000", "668101070", "671805830",
)
CODES_100 = (
    "641605280", "641905790", "645305180", "645604340", "646901010", "648901910", "659900990",
    "668101060", "671805840",
)

# Cohort ids and names.
DISORDERS = (
    (1289, "depression", DEPRESSION),
    (1292, "bipolar disorder", BIPOLAR_DISORDER),
    (1293, "schizophrenia", SCHIZOPHRENIA),
    (1294, "anxiety disorder", ANXIETY_DISORDER),
    (1295, "neurodevelopmental disorder", NEURODEVELOPMENTAL_DISORDER),
    (1296, "alcohol use disorder", ALCOHOL_USE_DISORDER),
    (1297, "substance use disorder", SUBSTANCE_USE_DISORDER),
    (1319, "somatoform disorder", SOMATOFORM_DISORDER),
)
INDICATIONS = (
    (1301, "total indications", OA_INDICATIONS + NEUROPATHY_INDICATIONS + PANCREAS_INDICATIONS),
    (1304, "oa indications", OA_INDICATIONS),
    (1306, "neuropathy indications", NEUROPATHY_INDICATIONS),
    (1308, "pancreas indications", PANCREAS_INDICATIONS),
)
ANY_PATCH = (1239, "fentanyl")
PATCHES = (
    (1284, "fentanyl_1", "12", 12.0, CODES_12),
    (1285, "fentanyl_2", "25", 25.0, CODES_25),
    (1286, "fentanyl_3", "375", 37.5, CODES_37_5),
    (1287, "fentanyl_4", "50", 50.0, CODES_50),
    (1288, "fentanyl_5", "75", 75.0, CODES_75),
    (1346, "fentanyl_6", "100", 100.0, CODES_100),
)
TOTAL_INDICATIONS = 1301
# Codesets have the id of the cohort they define; cancer defines none.
CANCER_CODESET = 1

RULES = (
    Rule(CONDITION, TOTAL_INDICATIONS, AT_LEAST, 1, days_after=0),
    Rule(CONDITION, CANCER_CODESET, EXACTLY, 0),
)


def _patches(as_published: bool):
    """The strengths; as published, the last one repeats the name and codes of the one before."""
    if not as_published:
        return PATCHES
    cohort_id, _, label, amount, _ = PATCHES[-1]
    _, name, _, _, codes = PATCHES[-2]
    return (*PATCHES[:-1], (cohort_id, name, label, amount, codes))


def definitions(as_published: bool = False) -> tuple[CohortDefinition, ...]:
    diseases = [
        CohortDefinition(cohort_id, name, DISEASE, (Criterion(CONDITION, cohort_id),))
        for cohort_id, name, _ in DISORDERS + INDICATIONS
    ]
    drugs = [
        CohortDefinition(cohort_id, name, DRUG, (Criterion(DRUG_SOURCE, cohort_id),), RULES)
        for cohort_id, name in (ANY_PATCH, *[patch[:2] for patch in _patches(as_published)])
    ]
    return (*diseases, *drugs)


def pairs() -> tuple[tuple[int, int], ...]:
    """Every disease with every patch cohort."""
    everything = definitions()
    return tuple(
        (disease.cohort_id, drug.cohort_id)
        for disease in everything if disease.cohort_type == DISEASE
        for drug in everything if drug.cohort_type == DRUG
    )


def strengths(as_published: bool = False) -> tuple[Strength, ...]:
    """Cohorts the dose is counted from; as published, the last strength counts the one before."""
    listed = [Strength(label, cohort_id, amount) for cohort_id, _, label, amount, _ in PATCHES]
    if as_published:
        listed[-1] = Strength(listed[-1].label, listed[-2].cohort_id, listed[-1].amount)
    return tuple(listed)


def items(spark: SparkSession) -> DataFrame:
    """Concept set items of the whole study."""
    excluded = {"depression": BIPOLAR_DISORDER}
    frames = [
        concept_items(spark, cohort_id, include, excluded.get(name, ()))
        for cohort_id, name, include in DISORDERS
    ]
    frames += [
        concept_items(spark, cohort_id, include, descendants=False) for cohort_id, _, include in INDICATIONS
    ]
    frames.append(concept_items(spark, CANCER_CODESET, CANCER))
    written = frames[0]
    for frame in frames[1:]:
        written = written.unionByName(frame)
    return written


def codes(spark: SparkSession, tables: Tables, as_published: bool = False) -> Codes:
    patches = _patches(as_published)
    products = source_codes(spark, ANY_PATCH[0], [code for patch in PATCHES for code in patch[-1]])
    for cohort_id, _, _, _, own in patches:
        products = products.unionByName(source_codes(spark, cohort_id, own))
    return Codes(resolve_concept_sets(tables["concept"], tables["concept_ancestor"], items(spark)), products)
