"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillsieve.llm.byte_bpe import op3_byte_bpe, op3_sql
from quillsieve.llm.chroma import op2_chroma
from quillsieve.llm.jaccard_join import OP10_SQL, op10_jaccard_join
from quillsieve.llm.language import op5_language_id
from quillsieve.llm.mixing import OP4_SQL, op4_poisson_mix
from quillsieve.llm.pii import op6_pii
from quillsieve.llm.secrets import OP7_SQL, op7_secret_scan
from quillsieve.llm.shards import op8_shard
from quillsieve.llm.toxicity import op1_toxicity
from quillsieve.llm.va_file import OP9_SQL, op9_exact_topk


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_chroma": op2_chroma,
        "op3_byte_bpe": op3_byte_bpe,
        "op4_poisson_mix": op4_poisson_mix,
        "op5_language_id": op5_language_id,
        "op6_pii": op6_pii,
        "op7_secret_scan": op7_secret_scan,
        "op8_shard": op8_shard,
        "op9_exact_topk": op9_exact_topk,
        "op10_jaccard_join": op10_jaccard_join,
    }


def oracle_sql() -> dict[str, str]:
    import public_tokenizers

    return {"op3_byte_bpe": op3_sql(public_tokenizers.path("byte_bpe_50k.tiktoken")), "op4_poisson_mix": OP4_SQL, "op7_secret_scan": OP7_SQL, "op9_exact_topk": OP9_SQL, "op10_jaccard_join": OP10_SQL}
