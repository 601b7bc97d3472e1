"""The queries of the text operators and their DuckDB texts."""

from __future__ import annotations

import corpus_pipeline
from carespan.llm import (
    decontamination, html_text, license_rules, manifest, mixing, ngram_join, packing, periodic_runs, pii,
    quality_rules, secret_scan, sharding, token_counts,
)
from carespan.llm.checks import TEXTS
from carespan.session import tune

_MODULES = (
    secret_scan, quality_rules, ngram_join, token_counts, pii, html_text, sharding, mixing, license_rules,
    decontamination, manifest, packing, periodic_runs,
)


def _tuned(query):
    return lambda spark, sf_dir: query(tune(spark), sf_dir)


QUERIES = {name: _tuned(query) for module in _MODULES for name, query in module.QUERIES.items()}
QUERIES["pipeline"] = corpus_pipeline.run
SQL = {name: text for module in _MODULES for name, text in module.SQL.items()} | TEXTS
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
