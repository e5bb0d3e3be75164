"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from feedloom.llm.ann import ann_query
from feedloom.llm.cover_lloyd import codes_query, codes_sql
from feedloom.llm.decontaminate import decontamination_query
from feedloom.llm.jaccard_join import jaccard_query
from feedloom.llm.language import language_query
from feedloom.llm.licenses import license_query
from feedloom.llm.merkle import merkle_query, merkle_sql
from feedloom.llm.pii import pii_query
from feedloom.llm.ppm import ppm_query
from feedloom.llm.secrets import secrets_query
from feedloom.llm.simhash_anchors import simhash_query
from feedloom.llm.sp_sampling import sampling_query
from feedloom.llm.token_files import token_files_query

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": language_query,
    "op2_ann": ann_query,
    "op3_secrets": secrets_query,
    "op4_pii": pii_query,
    "op5_jaccard_join": jaccard_query,
    "op6_decontaminate": decontamination_query,
    "op7_ppm": ppm_query,
    "op8_sp_sampling": sampling_query,
    "op9_licenses": license_query,
    "op10_token_files": token_files_query,
    "op11_simhash": simhash_query,
    "op12_merkle": merkle_query,
    "op13_vector_codes": codes_query,
    "pipeline": corpus_pipeline.run,
}
ORACLES: dict[str, str] = {"op12_merkle": merkle_sql(), "op13_vector_codes": codes_sql()}
