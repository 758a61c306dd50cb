"""The queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .byte_bpe import op9_byte_bpe
from .decontamination import OP3_SQL, op3_benchmark_decontamination
from .language_id import op4_language_id
from .lexical_search import OP11_SQL, op11_lexical_search
from .mixing import OP12_SQL, op12_mixing
from .near_copies import OP2_SQL, op2_ngram_jaccard_join
from .quality_model import op1_quality_classifier
from .quality_rules import op10_quality_rules
from .repeats import op6_suffix_array_dedup
from .separator_scan import op8_token_counts
from .token_codes import op5_token_ids
from .toxicity import op7_toxicity
from .vector_codes import OP13_SQL, op13_vector_codes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_language_id": op4_language_id,
    "op5_token_ids": op5_token_ids,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_token_counts": op8_token_counts,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_quality_rules": op10_quality_rules,
    "op11_lexical_search": op11_lexical_search,
    "op12_mixing": op12_mixing,
    "op13_vector_codes": op13_vector_codes,
}

ORACLE_SQL: dict[str, str] = {
    "op2_ngram_jaccard_join": OP2_SQL,
    "op3_benchmark_decontamination": OP3_SQL,
    "op11_lexical_search": OP11_SQL,
    "op12_mixing": OP12_SQL,
    "op13_vector_codes": OP13_SQL,
}
