"""Queries and SQL of this subpackage, for the driver's entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewheel.llm.bpe import op3_bpe_codec
from tidewheel.llm.decontaminate import op5_decontamination
from tidewheel.llm.exact_dedup import OP4_SQL, op4_exact_dedup
from tidewheel.llm.html_text import op7_html_text
from tidewheel.llm.jaccard_join import op1_ngram_jaccard_join
from tidewheel.llm.pii import op2_pii_surrogates
from tidewheel.llm.quality import op9_quality
from tidewheel.llm.token_counts import op8_token_counts
from tidewheel.llm.toxicity import op6_toxicity
from tidewheel.llm.warc import op10_warc_archives


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
        "op2_pii_surrogates": op2_pii_surrogates,
        "op3_bpe_codec": op3_bpe_codec,
        "op4_exact_dedup": op4_exact_dedup,
        "op5_decontamination": op5_decontamination,
        "op6_toxicity": op6_toxicity,
        "op7_html_text": op7_html_text,
        "op8_token_counts": op8_token_counts,
        "op9_quality": op9_quality,
        "op10_warc_archives": op10_warc_archives,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_exact_dedup": OP4_SQL}
