"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import sql
from millrace.llm.bpe import op12_bpe_backtrack
from millrace.llm.centroids import op13_centroids_ns
from millrace.llm.decontamination import op6_decontaminate_index
from millrace.llm.filter_audit import op11_filter_audit
from millrace.llm.jaccard_join import op7_jaccard_components
from millrace.llm.licenses import op2_license_dice, op2_license_passages
from millrace.llm.mixing import op4_mix_waterfill
from millrace.llm.pii import op9_pii_spans
from millrace.llm.quality import op5_quality_ratio
from millrace.llm.secrets import op8_secret_markov
from millrace.llm.sharding import op1_shard_minimax
from millrace.llm.suffix_merge import op10_suffix_dedup
from millrace.llm.toxicity import op3_toxicity_channel

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_shard_minimax": op1_shard_minimax,
    "op2_license_dice": op2_license_dice,
    "op3_toxicity_channel": op3_toxicity_channel,
    "op4_mix_waterfill": op4_mix_waterfill,
    "op5_quality_ratio": op5_quality_ratio,
    "op6_decontaminate_index": op6_decontaminate_index,
    "op7_jaccard_components": op7_jaccard_components,
    "op8_secret_markov": op8_secret_markov,
    "op9_pii_spans": op9_pii_spans,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_bpe_backtrack": op12_bpe_backtrack,
    "op13_centroids_ns": op13_centroids_ns,
}

#: Queries beside those of the contract.
MORE: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op2_license_passages": op2_license_passages}

#: The others depend on seeded hashes, fitted models or look-around patterns; tests hold them against plain code.
SQL: dict[str, str] = {
    "op2_license_dice": sql.OP2,
    "op6_decontaminate_index": sql.OP6,
    "op7_jaccard_components": sql.OP7,
    "op10_suffix_dedup": sql.OP10,
    "op11_filter_audit": sql.OP11,
    "op13_centroids_ns": sql.OP13,
}
