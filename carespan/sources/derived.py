"""Canonical tables derived from the star-schema test files (see FIXTURES.md).

The expressions use only syntax that Spark SQL and DuckDB share, so ``view_sql`` serves both.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carespan.codes import CodeSets
from carespan.setting import Period, Setting
from carespan.sources.operational import SOURCE_COLUMNS
from carespan.sources.schemas import COLUMNS, FACTS
from carespan.sources.tables import Tables

AS_OF = date(2001, 8, 1)
NOW = "DATE '2001-08-01'"
SETTING = Setting(
    period=Period(date(2000, 8, 1), date(2001, 7, 31)),
    as_of=AS_OF,
    scope=tuple(range(20)),
    codes=CodeSets(
        med_nurse_ids=(0, 1),
        dentist_ids=(5,),
        dental_technician_ids=(6,),
        dental_assistant_ids=(7,),
        multi_professional_ids=(1, 2),
        condition_since=date(1990, 1, 1),
    ),
)

_TEAMS = "(SELECT count(*) FROM supplier)"

LITERALS = {
    "exit_type": ["-", "OBITO"],
    "occupation": [
        "225125", "223505", "322205", "515105", "322255", "223208", "322405", "322415", "223605",
        "251605",
    ],
    "procedure_code": [
        "0414020138", "0414020146", "0101020058", "0101020066", "0101020074", "0101020082",
        "0101020104", "0101020120", "0307030040", "0307010031", "0307010074", "0307010082",
        "0307010104", "0307010112", "0307010120", "0101020090", "0307010015", "0307020010",
        "0301010153", "0301100039", "0101040024", "0202010503", "0301040095", "0201020033",
        "0204030030", "0214010040",
    ],
}


def _registration(id_expression):
    return {
        "registration_id": id_expression,
        "person_id": "c_custkey",
        "cns": "CASE WHEN c_custkey % 7 = 0 THEN CAST(NULL AS STRING) ELSE lpad(CAST(700000000000005 + c_custkey * 11 AS STRING), 15, '0') END",
        "cpf": "CASE WHEN c_custkey % 9 = 0 THEN CAST(NULL AS STRING) WHEN c_custkey % 9 = 1 THEN '00000000000' ELSE lpad(CAST(c_custkey AS STRING), 11, '1') END",
        "birth_date": f"CASE WHEN c_custkey % 70 = 69 THEN CAST(NULL AS DATE) WHEN c_custkey % 30 = 11 THEN DATE '1970-01-01' WHEN c_custkey % 97 = 13 THEN DATE '1980-02-03' WHEN c_custkey % 10 = 0 THEN {NOW} - CAST((c_custkey * 37) % 730 AS INT) ELSE {NOW} - CAST((c_custkey * 7919) % 30000 AS INT) END",
        "race_id": "c_custkey % 6",
        "nationality_id": "CASE WHEN c_custkey % 11 = 0 THEN 3 ELSE 1 END",
        "ethnicity_id": "c_custkey % 5",
        "country_id": "c_custkey % 25",
        "exit_type_id": "CASE WHEN c_custkey % 10 = 3 THEN 1 ELSE 0 END",
        "inactive": "CASE WHEN c_custkey % 13 = 0 THEN 1 ELSE 0 END",
        "homeless": "CASE WHEN c_custkey % 37 = 0 THEN 1 ELSE 0 END",
        "dis_physical": "CASE WHEN c_custkey % 16 = 1 THEN 1 ELSE 0 END",
        "dis_cognitive": "CASE WHEN c_custkey % 18 = 1 THEN 1 ELSE 0 END",
        "dis_autism": "CASE WHEN c_custkey % 36 = 1 THEN 1 ELSE 0 END",
        "dis_hearing": "CASE WHEN c_custkey % 32 = 1 THEN 1 ELSE 0 END",
        "dis_visual": "CASE WHEN c_custkey % 48 = 1 THEN 1 ELSE 0 END",
        "dis_other": "CASE WHEN c_custkey % 64 = 1 THEN 1 ELSE 0 END",
        "micro_area": "lpad(CAST(c_custkey % 40 AS STRING), 2, '0')",
    }


def _link(id_expression, step):
    return {
        "link_id": id_expression,
        "registration_id": id_expression,
        "root_id": "c_custkey",
        "facility_id": f"(c_custkey + {step}) % {_TEAMS} % 25",
        "team_id": f"(c_custkey + {step}) % {_TEAMS}",
        "valid_from": f"{NOW} - CAST((c_custkey + {step}) % 900 + 1 AS INT)",
        "facility_valid_to": f"CASE WHEN c_custkey % 17 = 0 THEN {NOW} - 1 ELSE DATE '3000-12-31' END",
        "root_valid_to": f"CASE WHEN c_custkey % 19 = 0 THEN {NOW} - 1 ELSE DATE '3000-12-31' END",
        "alive": "CASE WHEN c_custkey % 50 = 49 THEN 0 ELSE 1 END",
        "moved": "CASE WHEN c_custkey % 23 = 0 THEN 1 ELSE 0 END",
    }


_PREGNANT = "(c_custkey % 400 + 60)"

# table -> parts of its UNION ALL: (source, condition, column -> expression)
PARTS = {
    "facility": [("nation", None, {
        "facility_id": "n_nationkey",
        "facility_name": "n_name",
        "cnes": "lpad(CAST(n_nationkey AS STRING), 7, '0')",
    })],
    "team": [("supplier", None, {
        "team_id": "s_suppkey",
        "team_name": "CASE WHEN s_suppkey % 20 = 7 THEN 'SEM EQUIPE' ELSE s_name END",
        "ine": "CASE WHEN s_suppkey % 25 = 3 THEN '-' ELSE lpad(CAST(s_suppkey AS STRING), 10, '0') END",
    })],
    "ethnicity": [("region", None, {"ethnicity_id": "r_regionkey", "ethnicity_name": "r_name"})],
    "country": [("nation", None, {"country_id": "n_nationkey", "country_name": "n_name"})],
    "person": [("customer", None, {
        "person_id": "c_custkey",
        "name": "CASE WHEN c_custkey % 40 = 5 THEN 'RN ' || c_name WHEN c_custkey % 30 = 11 THEN 'PESSOA REPETIDA' WHEN c_custkey % 97 = 13 THEN 'GRUPO ' || CAST(c_custkey % 7 % 5 AS STRING) ELSE c_name END",
        "cns": _registration("c_custkey")["cns"],
        "cpf": _registration("c_custkey")["cpf"],
        "sex_id": "CASE WHEN c_custkey % 41 = 7 THEN CAST(NULL AS INT) WHEN c_custkey % 43 = 8 THEN 3 ELSE c_custkey % 2 + 1 END",
        "deceased": "CASE WHEN c_custkey % 50 = 49 THEN 1 ELSE 0 END",
        "deleted": "CASE WHEN c_custkey % 60 = 59 THEN 1 WHEN c_custkey % 2 = 0 THEN 0 ELSE CAST(NULL AS INT) END",
    })],
    "registration": [
        ("customer", None, _registration("c_custkey")),
        ("customer", "c_custkey % 15 = 4", _registration("c_custkey + 100000000")),
    ],
    "person_link": [
        ("customer", None, _link("c_custkey", 0)),
        ("customer", "c_custkey % 30 = 4", _link("c_custkey + 100000000", 1)),
    ],
    "encounter": [
        ("orders", None, {
            "encounter_id": "o_orderkey",
            "person_id": "o_custkey",
            "event_date": "o_orderdate",
            "occupation_id": "o_orderkey % 4",
            "visit_type_id": "o_orderkey % 9 + 1",
            "facility_id": f"o_orderkey % {_TEAMS} % 25",
            "team_id": f"o_orderkey % {_TEAMS}",
            "weight": "CASE WHEN o_orderkey % 3 = 0 THEN CAST(70.5 AS DOUBLE) END",
            "height": "CASE WHEN o_orderkey % 3 = 0 THEN CAST(1.7 AS DOUBLE) END",
            "systolic": "CASE WHEN o_orderkey % 5 < 2 THEN 120 END",
            "diastolic": "CASE WHEN o_orderkey % 5 < 1 THEN 80 END",
            "icd_codes": "CASE o_orderkey % 60 WHEN 0 THEN '|E11|' WHEN 1 THEN '|I10|' WHEN 2 THEN '|Z30|' WHEN 3 THEN '|J00|E14|' ELSE '|J00|' END",
            "icpc_codes": "CASE o_orderkey % 70 WHEN 5 THEN '|T90|' WHEN 6 THEN '|K86|' WHEN 7 THEN '|W11|' ELSE '|R74|' END",
            "lmp_date": "CASE o_orderkey % 15 WHEN 0 THEN CAST(o_orderdate AS DATE) - 60 WHEN 1 THEN DATE '3000-12-31' END",
        }),
        ("events", None, {
            "encounter_id": "1000000000 + event_id",
            "person_id": "user_id",
            "event_date": f"{NOW} - CAST((event_id * 13) % 720 + 1 AS INT)",
            "occupation_id": "event_id % 4",
            "visit_type_id": "event_id % 9 + 1",
            "facility_id": f"user_id % {_TEAMS} % 25",
            "team_id": f"user_id % {_TEAMS}",
            "weight": "CASE WHEN event_id % 3 = 0 THEN CAST(70.5 AS DOUBLE) END",
            "height": "CASE WHEN event_id % 3 = 0 THEN CAST(1.7 AS DOUBLE) END",
            "systolic": "CASE WHEN event_id % 5 < 2 THEN 120 END",
            "diastolic": "CASE WHEN event_id % 5 < 1 THEN 80 END",
            "icd_codes": "'|J00|'",
            "icpc_codes": "'|R74|'",
            "lmp_date": "CAST(NULL AS DATE)",
        }),
    ],
    "home_visit": [("customer", "c_custkey % 18 = 9", {
        "person_id": "c_custkey",
        "event_date": f"{NOW} - CAST({_PREGNANT} - 290 AS INT)",
        "occupation_id": "3",
        "newborn_followup": "1",
        "child_followup": "0",
        "weight": "CAST(NULL AS DOUBLE)",
        "height": "CAST(NULL AS DOUBLE)",
        "blood_pressure": "CAST(NULL AS STRING)",
    }), ("events", "event_type IN ('view', 'click')", {
        "person_id": "user_id",
        "event_date": f"{NOW} - CAST((event_id * 17) % 720 + 1 AS INT)",
        "occupation_id": "CASE WHEN event_id % 3 = 0 THEN 4 ELSE 3 END",
        "newborn_followup": "CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END",
        "child_followup": "CASE WHEN event_id % 4 = 1 THEN 1 ELSE 0 END",
        "weight": "CASE WHEN event_id % 6 = 0 THEN CAST(9.5 AS DOUBLE) END",
        "height": "CASE WHEN event_id % 6 = 0 THEN CAST(0.7 AS DOUBLE) END",
        "blood_pressure": "CASE WHEN event_id % 5 = 0 THEN '120/80' END",
    })],
    "vaccination": [("customer", "c_custkey % 18 = 3", {
        "person_id": "c_custkey",
        "event_date": f"{NOW} - CAST({_PREGNANT} - 150 AS INT)",
        "vaccine_codes": "'|57|'",
    }), ("events", "event_type IN ('signup', 'purchase', 'error')", {
        "person_id": "user_id",
        "event_date": f"{NOW} - CAST((event_id * 19) % 720 + 1 AS INT)",
        "vaccine_codes": "CASE event_id % 8 WHEN 0 THEN '|22|42|' WHEN 1 THEN '|24|' WHEN 2 THEN '|26|' WHEN 3 THEN '|33|' WHEN 4 THEN '|57|' WHEN 5 THEN '|67|' WHEN 6 THEN '|29|' ELSE '|58|' END",
    })],
    "pregnancy": [
        ("customer", "c_custkey % 6 = 3", {
            "person_id": "c_custkey",
            "pregnancy_no": "1",
            "start_date": f"{NOW} - CAST({_PREGNANT} AS INT)",
            "puerperium_start": f"CASE WHEN {_PREGNANT} > 280 THEN {NOW} - CAST({_PREGNANT} - 280 AS INT) END",
            "puerperium_end": f"CASE WHEN {_PREGNANT} > 322 THEN {NOW} - CAST({_PREGNANT} - 322 AS INT) END",
        }),
        ("customer", "c_custkey % 12 = 3", {
            "person_id": "c_custkey",
            "pregnancy_no": "0",
            "start_date": f"{NOW} - 1200",
            "puerperium_start": f"{NOW} - 920",
            "puerperium_end": f"{NOW} - 878",
        }),
    ],
    "procedure_event": [("lineitem JOIN orders ON l_orderkey = o_orderkey", "l_partkey % 26 >= 19", {
        "person_id": "o_custkey",
        "event_date": "l_shipdate",
        "procedure_id": "l_partkey % 26",
    })],
    "dental_procedure": [("lineitem JOIN orders ON l_orderkey = o_orderkey", "l_partkey % 26 <= 18", {
        "person_id": "o_custkey",
        "event_date": "l_shipdate",
        "facility_id": "l_suppkey % 25",
        "team_id": "l_suppkey",
        "occupation_id": "5 + l_linenumber % 3",
        "procedure_id": "l_partkey % 26",
    })],
    "dental_encounter": [("orders", None, {
        "person_id": "o_custkey",
        "event_date": "o_orderdate",
        "facility_id": f"o_orderkey % {_TEAMS} % 25",
        "team_id": f"o_orderkey % {_TEAMS}",
        "occupation_id": "5 + o_orderkey % 2",
        "treatment_completed": "CASE WHEN o_custkey % 4 = 0 THEN 1 ELSE 0 END",
    })],
    "group_activity": [("orders", None, {
        "activity_id": "o_orderkey",
        "event_date": "o_orderdate",
        "practice_id": "o_custkey % 10",
        "participants": "o_orderkey % 40 + 1",
        "facility_id": f"o_orderkey % {_TEAMS} % 25",
        "team_id": f"o_orderkey % {_TEAMS}",
        "occupation_id": "5 + o_orderkey % 3",
    })],
    "benefit_roll": [("customer", None, {
        "document": "lpad(CAST(c_custkey AS STRING), 11, '1')",
        "document_type": "CASE WHEN c_custkey % 5 = 4 THEN 'NIS' ELSE 'CPF' END",
        "roll_name": "upper(c_name)",
        "cycle": "CASE WHEN c_custkey % 3 = 0 THEN DATE '2001-06-01' ELSE DATE '2001-07-01' END",
    })],
}


def view_sql(table: str) -> str:
    """SELECT text of a derived table over the test files."""
    types = COLUMNS[table]
    if table in LITERALS:
        rows = ", ".join(f"({i}, '{text}')" for i, text in enumerate(LITERALS[table]))
        (key, key_type), (text, text_type) = types.items()
        return (
            f"SELECT CAST(k AS {key_type}) AS {key}, CAST(v AS {text_type}) AS {text}"
            f" FROM (VALUES {rows}) AS literal(k, v)"
        )
    selects = []
    for source, condition, columns in PARTS[table]:
        names = ", ".join(f"CAST({columns[c]} AS {t}) AS {c}" for c, t in types.items())
        selects.append(f"SELECT {names} FROM {source}" + (f" WHERE {condition}" if condition else ""))
    return " UNION ALL ".join(selects)


_SOURCES = ("region", "nation", "supplier", "customer", "orders", "lineitem", "events")


def open_derived(spark: SparkSession, directory: str) -> Tables:
    """Canonical tables over the Parquet test files of a directory."""

    def opener(table):
        text = view_sql(table)
        used = [s for s in _SOURCES if re.search(rf"\b(FROM|JOIN) {s}\b", text)]
        for source in used:
            text = re.sub(rf"\b(FROM|JOIN) {source}\b", rf"\1 {{{source}}}", text)
        return lambda: spark.sql(
            text, **{s: spark.read.parquet(f"{directory}/{s}.parquet") for s in used}
        )

    return Tables({table: opener(table) for table in COLUMNS})


def earlier(tables: Tables) -> Tables:
    """A state of the source before the one of the test files, to load changes from.

    It lacks the events of July 2001, holds other values in rows of the 15th of a month, and has the
    events of January 2000 a second time, dated in May 1980 under keys of their own.
    """
    changed = {}
    for name in FACTS:
        rows = tables[name].where("date_format(event_date, 'yyyy-MM') <> '2001-07'")
        other = "participants" if name == "group_activity" else "person_id"
        fifteenth = F.dayofmonth("event_date") == 15
        rows = rows.withColumn(other, F.when(fifteenth, F.col(other) + 1).otherwise(F.col(other)).cast(COLUMNS[name][other]))
        gone = tables[name].where("date_format(event_date, 'yyyy-MM') = '2000-01'").withColumn(
            "event_date", F.make_date(F.lit(1980), F.lit(5), F.dayofmonth("event_date"))
        )
        for key in ("encounter_id", "activity_id"):
            if key in COLUMNS[name]:
                gone = gone.withColumn(key, F.col(key) + 10**12)
        changed[name] = rows.unionByName(gone)
    return tables.replacing(**changed)


def operational_reader(tables: Tables) -> Callable[[str], DataFrame]:
    """Reader of operational source tables made back from canonical ones, YYYYMMDD integers for dates."""
    raw = {}
    for name, (source, columns) in SOURCE_COLUMNS.items():
        cells = []
        for canonical, column in columns.items():
            value = F.col(canonical)
            if column.endswith("#"):
                value = F.date_format(value, "yyyyMMdd").cast("int")
            elif column.endswith("!"):
                value = value.cast("string")
            cells.append(value.alias(column.rstrip("#!")))
        raw[source] = tables[name].select(*cells)
    activity = tables["group_activity"]
    key = F.concat(F.lit("u"), F.col("activity_id").cast("string"))
    raw["tb_atividade_coletiva"] = activity.select(
        F.col("activity_id").alias("co_seq_atividade_coletiva"), key.alias("co_unico_atividade_coletiva")
    )
    raw["rl_ativ_col_pratica_saude"] = activity.select(
        F.col("activity_id").alias("co_atividade_coletiva"), F.col("practice_id").alias("co_pratica_saude")
    )
    raw["tb_fat_atividade_coletiva"] = activity.select(
        key.alias("nu_uuid_ficha"), F.col("participants").alias("nu_participantes"),
        F.date_format("event_date", "yyyyMMdd").cast("int").alias("co_dim_tempo"),
        F.col("facility_id").alias("co_dim_unidade_saude"), F.col("team_id").alias("co_dim_equipe"),
        F.col("occupation_id").alias("co_dim_cbo"),
    )
    return raw.__getitem__
