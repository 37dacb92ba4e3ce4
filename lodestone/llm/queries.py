"""Queries of this subpackage, and SQL for those that SQL can express."""

from lodestone.llm import decontaminate, katz, languages, media, mixing, neardup, passages, sanitise, secrets, sharding

QUERIES = {
    "op1_source_mix": mixing.op1_source_mix,
    "op2_media": media.op2_media,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_katz": katz.op4_katz,
    "op5_shards": sharding.op5_shards,
    "op6_near_duplicates": neardup.op6_near_duplicates,
    "op7_personal_data": sanitise.op7_personal_data,
    "op8_repeated_passages": passages.op8_repeated_passages,
    "op9_secrets": secrets.op9_secrets,
    "op10_language": languages.op10_language,
}

ORACLES = {"op1_source_mix": mixing.OP1_SQL}
