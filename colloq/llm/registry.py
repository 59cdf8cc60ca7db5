"""Queries of this subpackage by name, and their SQL where SQL can state them."""

from . import chat, decontaminate, exact_dedup, packing, quality, secrets, sharding, simhash, substring_dedup, surrogates

QUERIES = {
    "op1_substring_dedup": substring_dedup.query,
    "op2_packing": packing.query,
    "op3_exact_dedup": exact_dedup.query,
    "op4_secrets": secrets.query,
    "op5_simhash": simhash.query,
    "op6_surrogates": surrogates.query,
    "op7_decontaminate": decontaminate.query,
    "op8_sharding": sharding.query,
    "op9_chat": chat.query,
    "op10_quality": quality.query,
}
ORACLE = {
    "op1_substring_dedup": substring_dedup.SQL,
    "op3_exact_dedup": exact_dedup.SQL,
    "op4_secrets": secrets.SQL,
    "op7_decontaminate": decontaminate.SQL,
    "op9_chat": chat.SQL,
}
