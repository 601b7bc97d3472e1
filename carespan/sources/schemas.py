"""Canonical tables: names and column types every operator relies on."""

from __future__ import annotations

from pyspark.sql import types as T

# table -> column -> type
COLUMNS = {
    "facility": {"facility_id": "int", "facility_name": "string", "cnes": "string"},
    "team": {"team_id": "bigint", "team_name": "string", "ine": "string"},
    "occupation": {"occupation_id": "int", "cbo": "string"},
    "procedure_code": {"procedure_id": "int", "code": "string"},
    "exit_type": {"exit_type_id": "int", "marker": "string"},
    "ethnicity": {"ethnicity_id": "int", "ethnicity_name": "string"},
    "country": {"country_id": "int", "country_name": "string"},
    "person": {
        "person_id": "bigint", "name": "string", "cns": "string", "cpf": "string", "sex_id": "int",
        "deceased": "int", "deleted": "int",
    },
    "registration": {
        "registration_id": "bigint", "person_id": "bigint", "cns": "string", "cpf": "string",
        "birth_date": "date", "race_id": "int", "nationality_id": "int", "ethnicity_id": "int",
        "country_id": "int", "exit_type_id": "int", "inactive": "int", "homeless": "int",
        "dis_physical": "int", "dis_cognitive": "int", "dis_autism": "int", "dis_hearing": "int",
        "dis_visual": "int", "dis_other": "int", "micro_area": "string",
    },
    "person_link": {
        "link_id": "bigint", "registration_id": "bigint", "root_id": "bigint", "facility_id": "int",
        "team_id": "bigint", "valid_from": "date", "facility_valid_to": "date",
        "root_valid_to": "date", "alive": "int", "moved": "int",
    },
    "encounter": {
        "encounter_id": "bigint", "person_id": "bigint", "event_date": "date",
        "occupation_id": "int", "visit_type_id": "int", "facility_id": "int", "team_id": "bigint",
        "weight": "double", "height": "double", "systolic": "int", "diastolic": "int",
        "icd_codes": "string", "icpc_codes": "string", "lmp_date": "date",
    },
    "home_visit": {
        "person_id": "bigint", "event_date": "date", "occupation_id": "int",
        "newborn_followup": "int", "child_followup": "int", "weight": "double", "height": "double",
        "blood_pressure": "string",
    },
    "vaccination": {
        "person_id": "bigint", "event_date": "date", "vaccine_codes": "string",
    },
    "pregnancy": {
        "person_id": "bigint", "pregnancy_no": "int", "start_date": "date",
        "puerperium_start": "date", "puerperium_end": "date",
    },
    "procedure_event": {
        "person_id": "bigint", "event_date": "date",
        "procedure_id": "int",
    },
    "dental_procedure": {
        "person_id": "bigint", "event_date": "date", "facility_id": "int",
        "team_id": "bigint", "occupation_id": "int", "procedure_id": "int",
    },
    "dental_encounter": {
        "person_id": "bigint", "event_date": "date",
        "facility_id": "int", "team_id": "bigint", "occupation_id": "int",
        "treatment_completed": "int",
    },
    "group_activity": {
        "activity_id": "bigint", "event_date": "date", "practice_id": "int", "participants": "int",
        "facility_id": "int", "team_id": "bigint", "occupation_id": "int",
    },
    "benefit_roll": {
        "document": "string", "document_type": "string", "roll_name": "string",
        "cycle": "date",
    },
}

# Large event tables, stored by month of event.
FACTS = (
    "encounter", "home_visit", "vaccination", "procedure_event", "dental_procedure",
    "dental_encounter", "group_activity",
)


def schema_of(table: str) -> T.StructType:
    """Declared schema of a canonical table."""
    return T.StructType.fromDDL(", ".join(f"{c} {t}" for c, t in COLUMNS[table].items()))
