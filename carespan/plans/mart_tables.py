"""Declared columns of the marts, and their tables in the catalog.

Surrogate keys that a database would number by itself are left out. ``EXTRA`` are columns our marts
carry beside the declared ones.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import _parse_datatype_string

from carespan.sources.published import INDEX, Published

# Mart table -> its columns.
MART_COLUMNS = {
    "dim_paciente": (
        "cns string, cpf string, nome string, data_nascimento date, sexo string, nome_mae string,"
        " nacionalidade int, pais_nascimento int, micro_area string, etnia int, st_vivo int, dt_carga date"
    ),
    "dim_equipe": (
        "nu_ine string, no_equipe string, tp_equipe string, cnes string, no_unidade string, dt_carga date"
    ),
    "dim_unidade": "cnes string, no_unidade string, tp_unidade string, dt_carga date",
    "dim_sigtap": "co_sigtap string, no_procedimento string, categoria string, dt_carga date",
    "fato_atendimento": (
        "cns_paciente string, cns_profissional string, nu_ine string, cnes_unidade string,"
        " tp_atendimento string, ds_tipo_demanda string, co_sigtap string, competencia int,"
        " dt_atendimento date, dt_carga date"
    ),
    "fato_indicadores": (
        "nu_ine string, competencia int, cd_indicador string, numerador decimal(12,4),"
        " denominador decimal(12,4), vl_indicador decimal(10,4), classificacao string, dt_carga date"
    ),
    "fato_boas_praticas": (
        "cns string, nu_ine string, competencia int, cd_indicador string, pontuacao decimal(5,2),"
        " boas_praticas map<string,boolean>, dt_carga date"
    ),
    "fato_estrangeiros": (
        "cns string, cpf string, nome string, data_nascimento date, pais_origem string,"
        " pais_nascimento string, unidade_saude string, cnes string, ine string, equipe string,"
        " microarea string, flag_atendimento_recente int, flag_vinculo_equipe int, flag_cpf_presente int,"
        " flag_cns_valido int, dt_carga date"
    ),
    "inconsistencias": "cns string, cpf string, tp_inconsistencia string, descricao string, dt_deteccao date",
    "busca_ativa": (
        "cns string, cpf string, nome string, condicao string, nu_ine string, micro_area string,"
        " telefone string, acs_responsavel string, prioridade int, dt_geracao date"
    ),
    "fato_vacinacao": (
        "cns string, co_sigtap string, ds_vacina string, dose string, dt_aplicacao date, fonte string,"
        " dt_carga date"
    ),
    "fato_visita_domiciliar": (
        "cns string, cns_acs string, nu_ine string, dt_visita date, tp_visita string, dt_carga date"
    ),
}
EXTRA = {
    "dim_paciente": "paciente_id bigint", "fato_atendimento": "paciente_id bigint",
    "fato_indicadores": "cnes string", "fato_boas_praticas": "paciente_id bigint",
    "busca_ativa": "paciente_id bigint",
}
PARTITIONS = {
    "fato_atendimento": "competencia", "fato_indicadores": "competencia, cd_indicador",
    "fato_boas_praticas": "competencia, cd_indicador", "fato_estrangeiros": "dt_carga",
    "busca_ativa": "condicao",
}


def declared(name: str) -> str:
    """Columns of a mart, with those that ours carries beside the declared ones."""
    return f"{MART_COLUMNS[name]}, {EXTRA[name]}" if name in EXTRA else MART_COLUMNS[name]


def switch_catalog(spark: SparkSession, database: str, published: Published) -> None:
    """Have the marts of a database be those of the newest run.

    A mart is a view: the files of all runs, a table partitioned by run, joined with the index of the
    current run, which prunes the runs and months that are not current. The index is one view for all
    marts, so replacing it switches all of them at once; until then readers see the marts of before.
    """
    runs = published.runs()
    index = f"CREATE OR REPLACE VIEW {database}.{INDEX} AS SELECT * FROM parquet.`{published.index_path(runs[-1])}`"
    if not spark.catalog.tableExists(f"{database}.{INDEX}"):
        spark.sql(index)
    held = {e.tabela: e.mensal for e in published.index()}
    for name, monthly in held.items():
        parts = ", ".join(["run", *([PARTITIONS[name]] if name in PARTITIONS else [])])
        files, columns = f"{database}.{name}_arquivos", _parse_datatype_string(declared(name)).fieldNames()
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {files} ({declared(name)}, run string) USING parquet"
            f" PARTITIONED BY ({parts}) LOCATION '{published.root}/{name}'"
        )
        spark.catalog.recoverPartitions(files)
        if not spark.catalog.tableExists(f"{database}.{name}"):
            same = " AND CAST(f.competencia AS string) <=> i.mes" if monthly else ""
            spark.sql(
                f"CREATE VIEW {database}.{name} AS SELECT {', '.join(f'f.{c}' for c in columns)} FROM {files} AS f"
                f" JOIN {database}.{INDEX} AS i ON f.run = i.run{same} WHERE i.tabela = '{name}'"
            )
    spark.sql(index)  # the switch


def create_tables(spark: SparkSession, database: str, root: str) -> None:
    """Declare the marts under ``root`` in a database of the catalog, where they are not yet."""
    for name in MART_COLUMNS:
        columns = declared(name)
        parts = f" PARTITIONED BY ({PARTITIONS[name]})" if name in PARTITIONS else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{parts} LOCATION '{root}/{name}'"
        )


def load_partitions(spark: SparkSession, database: str, names=tuple(PARTITIONS)) -> None:
    """Tell the catalog of the partitions that the batch jobs wrote, of all marts or of some."""
    for name in names:
        spark.catalog.recoverPartitions(f"{database}.{name}")
