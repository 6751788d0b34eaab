"""Registered queries of this package, with SQL counterparts where SQL can state them."""

from __future__ import annotations

from shelfline.llm import bpe, fixity, hyper_lang, inner_products, leaks, minhash, repeats, secrets, site_lines, toxicity, turn_repair, weak_rules, whitening

QUERIES = {
    "op1_trigram_secrets": secrets.op1_trigram_secrets,
    "op2_merkle_fixity": fixity.op2_merkle_fixity,
    "op3_site_lines": site_lines.op3_site_lines,
    "op4_qgram_leaks": leaks.op4_qgram_leaks,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_hyper_lang": hyper_lang.op6_hyper_lang,
    "op7_bbit_minhash": minhash.op7_bbit_minhash,
    "op8_weak_rules": weak_rules.op8_weak_rules,
    "op9_bpe": bpe.op9_bpe,
    "op10_suffix_repeats": repeats.op10_suffix_repeats,
    "op11_turn_repair": turn_repair.op11_turn_repair,
    "op12_qd_whitening": whitening.op12_qd_whitening,
    "op13_norm_sorted": inner_products.op13_norm_sorted,
}

ORACLE_SQL = {
    "op2_merkle_fixity": fixity.OP2_SQL,
    "op3_site_lines": site_lines.OP3_SQL,
    "op11_turn_repair": turn_repair.OP11_SQL,
    "op13_norm_sorted": inner_products.OP13_SQL,
}
