"""The training-data queries and the SQL that checks them, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fingerprints import op6_fingerprints
from .html_text import OP4_SQL, op4_html_extraction
from .jaccard import OP3_SQL, op3_ngram_jaccard
from .language import op9_language_id
from .line_dedup import OP1_SQL, op1_line_dedup
from .mixing import op7_source_mixing
from .neighbours import OP8_SQL, op8_nearest_neighbours
from .packing import op5_packing
from .sharding import op10_sharding
from .url_filters import OP2_SQL, op2_url_filters


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_url_filters": op2_url_filters,
        "op3_ngram_jaccard": op3_ngram_jaccard,
        "op4_html_extraction": op4_html_extraction,
        "op5_packing": op5_packing,
        "op6_fingerprints": op6_fingerprints,
        "op7_source_mixing": op7_source_mixing,
        "op8_nearest_neighbours": op8_nearest_neighbours,
        "op9_language_id": op9_language_id,
        "op10_sharding": op10_sharding,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": OP1_SQL,
        "op2_url_filters": OP2_SQL,
        "op3_ngram_jaccard": OP3_SQL,
        "op4_html_extraction": OP4_SQL,
        "op8_nearest_neighbours": OP8_SQL,
    }
