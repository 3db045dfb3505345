"""Registry of the training-data queries: name -> callable(spark, sf_dir), and their oracle SQL."""

from stratus.llm import (
    chat, decontaminate, filter_audit, line_dedup, line_frequency, mixing, pii, quality, secrets, simhash, spelling, top_inner,
    toxicity)

QUERIES = {
    "op1_line_frequency": line_frequency.op1_line_frequency,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_simhash": simhash.op3_simhash,
    "op4_secrets": secrets.op4_secrets,
    "op5_pii": pii.op5_pii,
    "op6_suffix_arrays": decontaminate.op6_suffix_arrays,
    "op7_quality": quality.op7_quality,
    "op8_mixing": mixing.op8_mixing,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_chat": chat.op10_chat,
    "op11_top_inner": top_inner.op11_top_inner,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_spelling": spelling.op13_spelling,
}

ORACLE = {
    "op1_line_frequency": line_frequency.OP1_SQL,
    "op4_secrets": secrets.OP4_SQL,
    "op6_suffix_arrays": decontaminate.OP6_SQL,
    "op10_chat": chat.OP10_SQL,
    "op11_top_inner": top_inner.OP11_SQL,
    "op12_filter_audit": filter_audit.OP12_SQL,
    "op13_spelling": spelling.OP13_SQL,
}
