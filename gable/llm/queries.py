"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

import corpus_pipeline
from gable.llm import (decontamination, language_id, minhash, mixing, ngram_join, periodic_runs, quality_rules, secret_scan, sharding,
                       spelling, token_files, toxicity, warc)
from gable.llm.common import Query

QUERIES: dict[str, Query] = {
    "op1_decontamination": decontamination.query,
    "op2_sharding": sharding.query,
    "op3_mixing": mixing.query,
    "op4_toxicity": toxicity.query,
    "op5_ngram_join": ngram_join.query,
    "op6_secret_scan": secret_scan.query,
    "op7_token_files": token_files.query,
    "op8_warc_bundles": warc.query,
    "op9_language_id": language_id.query,
    "op10_quality_rules": quality_rules.query,
    "op11_periodic_runs": periodic_runs.query,
    "op12_minhash": minhash.query,
    "op13_spelling": spelling.query,
    "pipeline": corpus_pipeline.run,
}
ORACLE: dict[str, str] = {
    "op1_decontamination": decontamination.SQL.strip(),
    "op3_mixing": mixing.SQL.strip(),
    "op8_warc_bundles": warc.SQL.strip(),
}
