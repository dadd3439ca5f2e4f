"""Queries of this subpackage and the SQL that checks them."""

from eventloom.llm import (
    byte_bpe,
    embedding_dedup,
    exact_dedup,
    html_text,
    lattice_lm,
    license_scan,
    line_dedup,
    mixing,
    packing,
    periodic_runs,
    prefix_trie,
    quality,
    simhash,
)

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_cube_mixing": mixing.op2_cube_mixing,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_nnls_packing": packing.op4_nnls_packing,
    "op5_embedding_dedup": embedding_dedup.op5_embedding_dedup,
    "op6_license_scan": license_scan.op6_license_scan,
    "op7_lattice_lm": lattice_lm.op7_lattice_lm,
    "op8_simhash": simhash.op8_simhash,
    "op9_html_wrappers": html_text.op9_html_wrappers,
    "op10_quality": quality.op10_quality,
    "op11_byte_bpe": byte_bpe.op11_byte_bpe,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}
CHECKS = {
    "op1_exact_dedup": exact_dedup.OP1_SQL,
    "op6_license_scan": license_scan.OP6_SQL,
    "op12_prefix_trie": prefix_trie.OP12_SQL,
    "op13_periodic_runs": periodic_runs.OP13_SQL,
}
