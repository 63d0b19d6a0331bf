"""The queries of this subpackage, and SQL for those that SQL can express."""

import corpus_pipeline
from spokeline.llm.alignment import op11_token_alignment
from spokeline.llm.chat import ORACLE_SQL as CHAT_SQL
from spokeline.llm.chat import op1_chat_format
from spokeline.llm.contamination import ORACLE_SQL as CONTAMINATION_SQL
from spokeline.llm.contamination import op5_decontamination
from spokeline.llm.fingerprints import op9_fingerprints
from spokeline.llm.mixing import op7_mix
from spokeline.llm.neardups import op10_near_dedup
from spokeline.llm.private import op8_private
from spokeline.llm.quality import op6_quality
from spokeline.llm.secrets import op12_secret_scan
from spokeline.llm.spelling import op13_spelling_variants
from spokeline.llm.substrings import op3_substring_dedup
from spokeline.llm.tokencounts import op4_token_counts
from spokeline.llm.urls import op2_url_filter

QUERIES = {
    query.__name__: query
    for query in (
        op1_chat_format,
        op2_url_filter,
        op3_substring_dedup,
        op4_token_counts,
        op5_decontamination,
        op6_quality,
        op7_mix,
        op8_private,
        op9_fingerprints,
        op10_near_dedup,
        op11_token_alignment,
        op12_secret_scan,
        op13_spelling_variants,
    )
} | {"pipeline": corpus_pipeline.run}

ORACLES: dict[str, str] = {
    "op1_chat_format": CHAT_SQL,
    "op5_decontamination": CONTAMINATION_SQL,
}
