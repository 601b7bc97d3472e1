"""Canonical tables from the operational star schema, over JDBC or from exported files.

``open_operational`` takes a function that reads one source table by name, so the same mapping serves a
live database (``jdbc_reader``) and Parquet exports. Dates kept as YYYYMMDD integers become real dates;
the bounds on them are put to the integer column, where a database can use them.

The usual course is to read once and write the lake (``write_lake``), and to query the lake.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carespan.functions.scalars import number_date
from carespan.sources.tables import Tables

# Canonical table -> (source table, canonical column -> source column). A source column
# marked with # holds a YYYYMMDD integer, one marked with ! a number kept as text or boolean.
SOURCE_COLUMNS = {
    "facility": ("tb_dim_unidade_saude", {
        "facility_id": "co_seq_dim_unidade_saude", "facility_name": "no_unidade_saude", "cnes": "nu_cnes",
    }),
    "team": ("tb_dim_equipe", {"team_id": "co_seq_dim_equipe", "team_name": "no_equipe", "ine": "nu_ine"}),
    "occupation": ("tb_dim_cbo", {"occupation_id": "co_seq_dim_cbo", "cbo": "nu_cbo"}),
    "procedure_code": ("tb_dim_procedimento", {
        "procedure_id": "co_seq_dim_procedimento", "code": "co_proced",
    }),
    "exit_type": ("tb_dim_tipo_saida_cadastro", {
        "exit_type_id": "co_seq_dim_tipo_saida_cadastro", "marker": "nu_identificador",
    }),
    "ethnicity": ("tb_dim_etnia", {"ethnicity_id": "co_seq_dim_etnia", "ethnicity_name": "no_etnia"}),
    "country": ("tb_pais", {"country_id": "co_pais", "country_name": "no_pais_portugues"}),
    "person": ("tb_fat_cidadao_pec", {
        "person_id": "co_seq_fat_cidadao_pec", "name": "no_cidadao", "cns": "nu_cns",
        "cpf": "nu_cpf_cidadao", "sex_id": "co_dim_sexo", "deceased": "st_faleceu", "deleted": "st_deletar",
    }),
    "registration": ("tb_fat_cad_individual", {
        "registration_id": "co_seq_fat_cad_individual", "person_id": "co_fat_cidadao_pec", "cns": "nu_cns",
        "cpf": "nu_cpf_cidadao", "birth_date": "dt_nascimento", "race_id": "co_dim_raca_cor",
        "nationality_id": "co_dim_nacionalidade", "ethnicity_id": "co_dim_etnia",
        "country_id": "co_dim_pais_nascimento", "exit_type_id": "co_dim_tipo_saida_cadastro",
        "inactive": "st_ficha_inativa", "homeless": "st_morador_rua", "dis_physical": "st_defi_fisica",
        "dis_cognitive": "st_defi_intelectual_cognitiva", "dis_autism": "st_defi_tea",
        "dis_hearing": "st_defi_auditiva", "dis_visual": "st_defi_visual", "dis_other": "st_defi_outra",
        "micro_area": "nu_micro_area",
    }),
    "person_link": ("tb_fat_cidadao", {
        "link_id": "co_seq_fat_cidadao", "registration_id": "co_fat_cad_individual",
        "root_id": "co_fat_cidadao_raiz", "facility_id": "co_dim_unidade_saude",
        "team_id": "co_dim_equipe", "valid_from": "co_dim_tempo#",
        "facility_valid_to": "co_dim_tempo_valdd_unidd_saud#", "root_valid_to": "co_dim_tempo_validade#",
        "alive": "st_vivo", "moved": "st_mudou",
    }),
    "encounter": ("tb_fat_atendimento_individual", {
        "encounter_id": "co_seq_fat_atd_ind", "person_id": "co_fat_cidadao_pec", "event_date": "co_dim_tempo#",
        "occupation_id": "co_dim_cbo_1", "visit_type_id": "co_dim_tipo_atendimento",
        "facility_id": "co_dim_unidade_saude_1", "team_id": "co_dim_equipe_1", "weight": "nu_peso",
        "height": "nu_altura", "systolic": "nu_pressao_sistolica", "diastolic": "nu_pressao_diastolica",
        "icd_codes": "ds_filtro_cids", "icpc_codes": "ds_filtro_ciaps", "lmp_date": "co_dim_tempo_dum#",
    }),
    "home_visit": ("tb_fat_visita_domiciliar", {
        "person_id": "co_fat_cidadao_pec", "event_date": "co_dim_tempo#", "occupation_id": "co_dim_cbo",
        "newborn_followup": "st_acomp_recem_nascido", "child_followup": "st_acomp_crianca",
        "weight": "nu_peso", "height": "nu_altura", "blood_pressure": "nu_medicao_pressao_arterial",
    }),
    "vaccination": ("tb_fat_vacinacao", {
        "person_id": "co_fat_cidadao_pec", "event_date": "co_dim_tempo#",
        "vaccine_codes": "ds_filtro_imunobiologico",
    }),
    "pregnancy": ("tb_fat_rel_op_gestante", {
        "person_id": "co_fat_cidadao_pec", "pregnancy_no": "co_gestacao", "start_date": "dt_inicio_gestacao",
        "puerperium_start": "dt_inicio_puerperio", "puerperium_end": "dt_fim_puerperio",
    }),
    "procedure_event": ("tb_fat_atd_ind_procedimentos", {
        "person_id": "co_fat_cidadao_pec", "event_date": "co_dim_tempo#",
        "procedure_id": "co_dim_procedimento_avaliado",
    }),
    "dental_procedure": ("tb_fat_atend_odonto_proced", {
        "person_id": "co_fat_cidadao_pec", "event_date": "co_dim_tempo#",
        "facility_id": "co_dim_unidade_saude_1", "team_id": "co_dim_equipe_1",
        "occupation_id": "co_dim_cbo_1", "procedure_id": "co_dim_procedimento",
    }),
    "dental_encounter": ("tb_fat_atendimento_odonto", {
        "person_id": "co_fat_cidadao_pec", "event_date": "co_dim_tempo#",
        "facility_id": "co_dim_unidade_saude_1", "team_id": "co_dim_equipe_1",
        "occupation_id": "co_dim_cbo_1", "treatment_completed": "st_conduta_tratamento_concluid!",
    }),
    "benefit_roll": ("tb_cidadao_bolsa_familia", {
        "document": "nu_documento", "document_type": "tp_documento", "roll_name": "no_cidadao",
        "cycle": "ds_vigencia",
    }),
}

# A group activity is spread over a header, a bridge to practices and a fact joined by a text key.
ACTIVITY_FACT = "tb_fat_atividade_coletiva"
ACTIVITY_HEADER = "tb_atividade_coletiva"
ACTIVITY_PRACTICE = "rl_ativ_col_pratica_saude"

EVENT_TABLES = frozenset(
    [source for source, columns in SOURCE_COLUMNS.values() if "event_date" in columns] + [ACTIVITY_FACT]
)

Reader = Callable[[str], DataFrame]


def jdbc_reader(spark: SparkSession, url: str, properties: dict, splits: dict[str, tuple] | None = None) -> Reader:
    """Reader of source tables over JDBC.

    ``splits`` gives (column, lowest, highest, number of partitions) for tables to be read in parallel;
    event tables split well on their YYYYMMDD column. An event table without a split is refused, as it
    would come through one connection into one task.
    """

    def read(table: str) -> DataFrame:
        if splits and table in splits:
            column, lowest, highest, parts = splits[table]
            return spark.read.jdbc(
                url, table, column=column, lowerBound=lowest, upperBound=highest, numPartitions=parts,
                properties=properties,
            )
        if table in EVENT_TABLES:
            raise ValueError(f"no split is given for the event table {table}")
        return spark.read.jdbc(url, table, properties=properties)

    return read


def _bounded(rows: DataFrame, since: date | None, until: date | None) -> DataFrame:
    for bound, symbol in ((since, ">="), (until, "<=")):
        if bound is not None:
            rows = rows.where(f"co_dim_tempo {symbol} {bound:%Y%m%d}")
    return rows


def _mapped(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    chosen = []
    for name, source in columns.items():
        if source.endswith("#"):
            value = number_date(F.col(source[:-1]))
        elif source.endswith("!"):
            value = F.col(source[:-1]).cast("int")
        else:
            value = F.col(source)
        chosen.append(value.alias(name))
    return rows.select(*chosen)


def _group_activity(read: Reader, since, until) -> DataFrame:
    fact = _bounded(read(ACTIVITY_FACT), since, until)
    header, bridge = read(ACTIVITY_HEADER), read(ACTIVITY_PRACTICE)
    rows = fact.join(header, F.col("nu_uuid_ficha") == F.col("co_unico_atividade_coletiva")).join(
        bridge, F.col("co_seq_atividade_coletiva") == F.col("co_atividade_coletiva")
    )
    return rows.select(
        F.col("co_seq_atividade_coletiva").alias("activity_id"),
        number_date(F.col("co_dim_tempo")).alias("event_date"),
        F.col("co_pratica_saude").alias("practice_id"), F.col("nu_participantes").alias("participants"),
        F.col("co_dim_unidade_saude").alias("facility_id"), F.col("co_dim_equipe").alias("team_id"),
        F.col("co_dim_cbo").alias("occupation_id"),
    )


def open_operational(read: Reader, since: date | None = None, until: date | None = None) -> Tables:
    """Canonical tables over the operational schema; the bounds limit the event tables."""

    def opener(source, columns):
        dated = columns.get("event_date")
        return lambda: _mapped(_bounded(read(source), since, until) if dated else read(source), columns)

    openers = {name: opener(*mapping) for name, mapping in SOURCE_COLUMNS.items()}
    openers["group_activity"] = lambda: _group_activity(read, since, until)
    return Tables(openers)
