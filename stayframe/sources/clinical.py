"""Typed scans of the six clinical source tables (S2): one schema per
table, source columns renamed onto the library's names (``hadm_id`` ->
``admission_id``). Column lookup is case-insensitive, so upper- or
lower-case sources both work."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stayframe.sources.io import scan_typed

TS, INT, STR, DBL, DATE = "timestamp_ntz", "int", "string", "double", "date"

# The source's descriptive prescription columns.
PRESCRIPTION_DETAILS = ["drug_type", "drug_name_poe", "formulary_drug_cd", "gsn", "ndc", "prod_strength",
                        "dose_val_rx", "dose_unit_rx", "form_val_disp", "form_unit_disp"]
# Columns that a source may lack; they are left out then.
OPTIONAL = {"chartevents": {"error"}, "prescriptions": set(PRESCRIPTION_DETAILS)}

SCHEMAS: dict[str, dict[str, tuple[str, str]]] = {
    "admissions": {
        "subject_id": ("SUBJECT_ID", INT), "admission_id": ("HADM_ID", INT), "admittime": ("ADMITTIME", TS),
        "dischtime": ("DISCHTIME", TS), "expire_flag": ("HOSPITAL_EXPIRE_FLAG", INT),
        "ethnicity_raw": ("ETHNICITY", STR), "insurance_raw": ("INSURANCE", STR),
        "admission_type_raw": ("ADMISSION_TYPE", STR), "admission_location_raw": ("ADMISSION_LOCATION", STR),
    },
    "patients": {"subject_id": ("SUBJECT_ID", INT), "dob": ("DOB", TS), "dod": ("DOD", TS),
                 "gender_raw": ("GENDER", STR)},
    "chartevents": {"subject_id": ("SUBJECT_ID", INT), "admission_id": ("HADM_ID", INT), "itemid": ("ITEMID", INT),
                    "charttime": ("CHARTTIME", TS), "valuenum": ("VALUENUM", DBL), "value": ("VALUE", STR),
                    "valueuom": ("VALUEUOM", STR), "error": ("ERROR", INT)},
    "labevents": {"subject_id": ("SUBJECT_ID", INT), "admission_id": ("HADM_ID", INT), "itemid": ("ITEMID", INT),
                  "charttime": ("CHARTTIME", TS), "valuenum": ("VALUENUM", DBL), "value": ("VALUE", STR),
                  "valueuom": ("VALUEUOM", STR)},
    "prescriptions": {"subject_id": ("SUBJECT_ID", INT), "admission_id": ("HADM_ID", INT),
                      "startdate": ("STARTDATE", TS), "enddate": ("ENDDATE", TS), "drug": ("DRUG", STR),
                      "drug_name_generic": ("DRUG_NAME_GENERIC", STR), "route": ("ROUTE", STR),
                      **{c: (c.upper(), STR) for c in PRESCRIPTION_DETAILS}},
    "noteevents": {"subject_id": ("SUBJECT_ID", INT), "admission_id": ("HADM_ID", INT),
                   "charttime": ("CHARTTIME", TS), "chartdate": ("CHARTDATE", DATE), "category": ("CATEGORY", STR),
                   "description": ("DESCRIPTION", STR), "text": ("TEXT", STR), "iserror": ("ISERROR", INT)},
}


def typed(name: str, df: DataFrame) -> DataFrame:
    """Typed, renamed projection of one source table."""
    have = {c.upper(): c for c in df.columns}
    schema = {k: (have.get(src.upper(), src), typ) for k, (src, typ) in SCHEMAS[name].items()
              if src.upper() in have or k not in OPTIONAL.get(name, ())}
    return scan_typed(df, schema)


def with_row_id(df: DataFrame) -> DataFrame:
    """Stable tie-break column for first/last picks (file order is not a
    thing on a cluster): a hash of the whole row."""
    from pyspark.sql import functions as F
    return df.withColumn("row_id", F.xxhash64(*[F.col(c) for c in df.columns]))
