"""Registered queries of the corpus operators and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fishladder.llm.chat import OP4_SQL, op4_chat_format
from fishladder.llm.decontaminate import OP5_SQL, op5_decontaminate
from fishladder.llm.fim import OP11_SQL, op11_fill_in_middle
from fishladder.llm.langid import op8_language_id
from fishladder.llm.mixing import OP7_SQL, op7_mixing
from fishladder.llm.pii import op2_pii
from fishladder.llm.quality import OP10_SQL, op10_quality
from fishladder.llm.sharding import op3_sharding
from fishladder.llm.simhash import op9_simhash
from fishladder.llm.token_counts import op6_token_counts
from fishladder.llm.token_records import op1_token_records
from fishladder.llm.topk import OP13_SQL, op13_topk_search
from fishladder.llm.vector_codes import OP12_SQL, op12_vector_codes


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five-stage corpus pipeline at the repository top."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


REGISTRY = {f.__name__: f for f in (
    op1_token_records, op2_pii, op3_sharding, op4_chat_format, op5_decontaminate, op6_token_counts, op7_mixing,
    op8_language_id, op9_simhash, op10_quality, op11_fill_in_middle, op12_vector_codes, op13_topk_search, pipeline)}

SQL = {"op4_chat_format": OP4_SQL, "op5_decontaminate": OP5_SQL, "op7_mixing": OP7_SQL, "op10_quality": OP10_SQL,
       "op11_fill_in_middle": OP11_SQL, "op12_vector_codes": OP12_SQL, "op13_topk_search": OP13_SQL}
