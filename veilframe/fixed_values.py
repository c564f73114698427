"""These must equal the published ones for results to match."""

# Columns the rule-based job removes.
DIRECT_IDENTIFIERS = [
    "SSN", "DRIVERS", "PASSPORT", "PREFIX", "FIRST", "LAST", "MAIDEN",
    "ADDRESS", "ZIP", "LAT", "LON", "ADDRESS_payer", "PHONE_payer",
    "DEATHDATE", "PROVIDER", "PHONE", "NAME_payer",
]

QUASI_IDENTIFIERS = ["BIRTHDATE", "CITY", "STATE", "COUNTY", "ORGANIZATION", "PATIENT"]

SENSITIVE_ATTRIBUTES = [
    "REASONCODE", "REASONDESCRIPTION", "PAYER", "CONDITION_codes",
    "CONDITION_descriptions", "MEDICATION_codes", "MEDICATION_descriptions",
]

DATE_COLUMNS = ["START", "STOP", "BIRTHDATE", "DEATHDATE"]
ID_COLUMNS = ["Id_encounter", "Id_patient", "Id_payer"]

# Words in a column name that make it a direct or a quasi-identifier.
DIRECT_WORDS = [
    "ID", "NAME", "SSN", "EMAIL", "PHONE", "ADDRESS", "PASSPORT", "LICENSE", "DRIVERS",
]
QUASI_WORDS = [
    "AGE", "GENDER", "RACE", "ETHNICITY", "BIRTHDATE", "DEATHDATE", "MARITAL", "LANGUAGE",
    "BIRTHPLACE", "CITY", "STATE", "ZIP", "LAT", "LON", "COUNTY",
]

# Words that pick the hash of a direct identifier, in the order they are applied.
ROUTING_WORDS = {
    "id": ["ID"],
    "name": ["NAME", "FIRST", "LAST"],
    "address": ["ADDRESS"],
    "ssn": ["SSN"],
}

# Roles used by the hybrid job when no role file is given.
DEFAULT_ROLES = {
    "direct_identifiers": [
        "Id_encounter", "PATIENT", "Id_patient", "SSN", "DRIVERS", "PASSPORT", "PREFIX",
        "FIRST", "LAST", "SUFFIX", "MAIDEN", "ADDRESS", "Id", "NAME", "ADDRESS_provider",
        "Id_org", "NAME_org", "ADDRESS_org", "PHONE", "Id_payer", "NAME_payer",
        "ADDRESS_payer", "PHONE_payer",
    ],
    "quasi_identifiers": [
        "BIRTHDATE", "DEATHDATE", "MARITAL", "RACE", "ETHNICITY", "GENDER", "BIRTHPLACE",
        "CITY", "STATE", "COUNTY", "ZIP", "LAT", "LON", "GENDER_provider", "CITY_provider",
        "STATE_provider", "ZIP_provider", "LAT_provider", "LON_provider", "CITY_org",
        "STATE_org", "ZIP_org", "LAT_org", "AGE_RANGE", "LON_org", "CITY_payer",
        "STATE_HEADQUARTERED", "ZIP_payer",
    ],
    "clinical_data": [
        "START", "STOP", "ORGANIZATION", "PROVIDER", "PAYER", "ENCOUNTERCLASS", "CODE",
        "DESCRIPTION", "BASE_ENCOUNTER_COST", "TOTAL_CLAIM_COST", "PAYER_COVERAGE",
        "REASONCODE", "REASONDESCRIPTION", "HEALTHCARE_EXPENSES", "HEALTHCARE_COVERAGE",
        "ORGANIZATION_provider", "SPECIALITY", "UTILIZATION", "REVENUE", "UTILIZATION_org",
        "AMOUNT_COVERED", "AMOUNT_UNCOVERED", "REVENUE_payer", "COVERED_ENCOUNTERS",
        "UNCOVERED_ENCOUNTERS", "COVERED_MEDICATIONS", "UNCOVERED_MEDICATIONS",
        "COVERED_PROCEDURES", "UNCOVERED_PROCEDURES", "COVERED_IMMUNIZATIONS",
        "UNCOVERED_IMMUNIZATIONS", "UNIQUE_CUSTOMERS", "QOLS_AVG", "MEMBER_MONTHS",
        "condition_codes", "condition_descriptions", "condition_dates", "medication_codes",
        "medication_descriptions", "total_medication_cost", "total_medication_claim_cost",
        "observation_count", "top_observation_types",
    ],
}

# Condition and target columns of the clinical/financial sample.
SAMPLE_CONDITIONS = [
    "CITY", "STATE", "COUNTY", "ORGANIZATION", "PATIENT",
    "MARITAL", "RACE", "ETHNICITY", "GENDER", "BIRTHPLACE",
]
SAMPLE_TARGETS = [
    "ENCOUNTERCLASS", "CODE", "DESCRIPTION", "BASE_ENCOUNTER_COST",
    "TOTAL_CLAIM_COST", "PAYER_COVERAGE", "REASONCODE", "REASONDESCRIPTION",
    "PAYER", "HEALTHCARE_EXPENSES", "HEALTHCARE_COVERAGE", "REVENUE",
    "UTILIZATION_org", "AMOUNT_COVERED", "AMOUNT_UNCOVERED", "REVENUE_payer",
]
SAMPLE_ROWS = 100

# Source date column -> year column.
YEAR_COLUMNS = {
    "START": "start_year",
    "STOP": "stop_year",
    "BIRTHDATE": "birth_year",
    "condition_dates": "condition_year",
}
YEAR_PATTERN = "([0-9]{4})"

# Pseudonym namespaces: key columns in numbering order, label prefix, digits.
NAMESPACES = {
    "encounters": (["Id_encounter"], "EN", 5),
    "patients": (["PATIENT", "Id_patient"], "Patient_", 4),
    "organizations": (["ORGANIZATION"], "Org_", 3),
    "payers": (["PAYER"], "Payer_", 4),
    "id_payers": (["Id_payer"], "Payer_", 4),
    "reason_codes": (["REASONCODE"], "RC_", 4),
}
ALTERNATE_PATIENT_PREFIX = "IDP_"

PERSON_PREFIX = "Person_"
ADDRESS_PREFIX = "Address_"

UNKNOWN = "Unknown"

AGE_REFERENCE_DATE = "2023-01-01"
DAYS_PER_YEAR = 365.25
# First age that no longer belongs to the band, and the band's name.
AGE_BANDS = [
    (12, "<12"), (18, "12-17"), (25, "18-24"), (35, "25-34"), (45, "35-44"),
    (55, "45-54"), (65, "55-64"), (75, "65-74"),
]
OLDEST_AGE_BAND = "75+"

# Texts that a CSV reader takes as missing.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

METHODS_APPLIED = [
    "Column Deletion",
    "Encounter ID Pseudonymization",
    "Date Generalization",
    "Organization Grouping",
    "Patient Pseudonymization",
    "Payer Mapping",
    "Id_payer Mapping",
    "Reason Code Mapping",
]
