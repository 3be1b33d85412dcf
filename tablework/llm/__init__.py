"""Operators of a training-data pipeline and their registered queries."""

from tablework.llm import ann, chat, importance, langid, lexical, licences, mixing, neardup, packing, secrets, spans, suffixes, weak

QUERIES = {
    "op1_secret_scans": secrets.op1_secret_scans,
    "op2_mix_sources": mixing.op2_mix_sources,
    "op8_near_duplicates": neardup.op8_near_duplicates,
    "op10_language_codes": langid.op10_language_codes,
    "op7_repeated_spans": spans.op7_repeated_spans,
    "op3_licence_rules": licences.op3_licence_rules,
    "op4_quality_votes": weak.op4_quality_votes,
    "op9_chat_formats": chat.op9_chat_formats,
    "op5_learned_partitions": ann.op5_learned_partitions,
    "op6_lexical_packing": packing.op6_lexical_packing,
    "op11_ranked_search": lexical.op11_ranked_search,
    "op12_repeated_bytes": suffixes.op12_repeated_bytes,
    "op13_importance_resampling": importance.op13_importance_resampling,
}
SQL = {"op2_mix_sources": mixing.OP2_SQL, "op8_near_duplicates": neardup.OP8_SQL, "op7_repeated_spans": spans.OP7_SQL,
       "op3_licence_rules": licences.OP3_SQL, "op9_chat_formats": chat.OP9_SQL,
       "op11_ranked_search": lexical.OP11_SQL, "op13_importance_resampling": importance.OP13_SQL}
