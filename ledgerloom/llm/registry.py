"""Queries of this subpackage and the SQL that DuckDB can check them with."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from .decontaminate import OP6_SQL, op6_decontamination
from .divergence import OP12_SQL, op12_source_divergence
from .langid import op3_language_id
from .licenses import op1_license_scan
from .media import op10_media_copies
from .packing import op5_packing
from .set_join import op11_jaccard_join
from .sharding import op2_sharding
from .simhash import op7_simhash
from .token_counts import op9_token_counts
from .toxicity import op8_toxicity
from .url_filter import OP4_SQL, op4_url_filter
from .variants import op13_spelling_variants


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of ``corpus_pipeline``, which stands at the repository's top."""
    root = str(Path(__file__).resolve().parents[2])
    if root not in sys.path:  # the working folder may be another
        sys.path.append(root)
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_license_scan": op1_license_scan,
        "op2_sharding": op2_sharding,
        "op3_language_id": op3_language_id,
        "op4_url_filter": op4_url_filter,
        "op5_packing": op5_packing,
        "op6_decontamination": op6_decontamination,
        "op7_simhash": op7_simhash,
        "op8_toxicity": op8_toxicity,
        "op9_token_counts": op9_token_counts,
        "op10_media_copies": op10_media_copies,
        "op11_jaccard_join": op11_jaccard_join,
        "op12_source_divergence": op12_source_divergence,
        "op13_spelling_variants": op13_spelling_variants,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_url_filter": OP4_SQL, "op6_decontamination": OP6_SQL, "op12_source_divergence": OP12_SQL}
