"""The operators' queries, by name, and DuckDB SQL where it can express them."""

from . import ann, exact_dedup, hard_negatives, hmm, language_id, near_dedup, packing, secret_scan, suffix_dedup, token_alignment, token_files, toxicity, word_bpe


def queries():
    return {
        "op1_suffix_dedup": suffix_dedup.query,
        "op2_packing": packing.query,
        "op3_token_files": token_files.query,
        "op4_near_dedup": near_dedup.query,
        "op5_ann": ann.query,
        "op6_hmm": hmm.query,
        "op7_exact_dedup": exact_dedup.query,
        "op8_word_bpe": word_bpe.query,
        "op9_toxicity": toxicity.query,
        "op10_language_id": language_id.query,
        "op11_secret_scan": secret_scan.query,
        "op12_token_alignment": token_alignment.query,
        "op13_hard_negatives": hard_negatives.query,
    }


def oracle_sql():
    return {"op7_exact_dedup": exact_dedup.ORACLE, "op13_hard_negatives": hard_negatives.ORACLE}
