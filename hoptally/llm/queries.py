"""The registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from hoptally.llm.classifier import op9_quality_classifier
from hoptally.llm.codes import OP12_SQL, op12_vector_codes
from hoptally.llm.embedding import OP8_SQL, op8_embedding_near_dedup
from hoptally.llm.html import op3_html_extraction
from hoptally.llm.lm import op2_lm_scoring
from hoptally.llm.minhash import op4_minhash_near_dedup
from hoptally.llm.mixing import op10_mixing
from hoptally.llm.negatives import OP11_SQL, op11_hard_negatives
from hoptally.llm.packing import op5_packing
from hoptally.llm.pii import op13_pii
from hoptally.llm.quality import OP7_SQL, op7_quality_rules
from hoptally.llm.substring import op1_substring_dedup
from hoptally.llm.warc import OP6_SQL, op6_warc_revisits


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_lm_scoring": op2_lm_scoring,
        "op3_html_extraction": op3_html_extraction,
        "op4_minhash_near_dedup": op4_minhash_near_dedup,
        "op5_packing": op5_packing,
        "op6_warc_revisits": op6_warc_revisits,
        "op7_quality_rules": op7_quality_rules,
        "op8_embedding_near_dedup": op8_embedding_near_dedup,
        "op9_quality_classifier": op9_quality_classifier,
        "op10_mixing": op10_mixing,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_vector_codes": op12_vector_codes,
        "op13_pii": op13_pii,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_warc_revisits": OP6_SQL, "op7_quality_rules": OP7_SQL, "op8_embedding_near_dedup": OP8_SQL, "op11_hard_negatives": OP11_SQL, "op12_vector_codes": OP12_SQL}
