"""The queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from . import hardnegatives, jaccard, lines, mixing, packing, pieces, prefixtrie, spotsigs, substrings, tokencounts, topk, toxicity, warc

QUERIES = {
    "op1_jaccard": jaccard.op1_jaccard,
    "op2_substrings": substrings.op2_substrings,
    "op3_warc": warc.op3_warc,
    "op4_lines": lines.op4_lines,
    "op5_topk": topk.op5_topk,
    "op6_token_counts": tokencounts.op6_token_counts,
    "op7_mixing": mixing.op7_mixing,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_spotsigs": spotsigs.op9_spotsigs,
    "op10_packing": packing.op10_packing,
    "op11_hard_negatives": hardnegatives.op11_hard_negatives,
    "op12_prefix_trie": prefixtrie.op12_prefix_trie,
    "op13_pieces": pieces.op13_pieces,
}

ORACLE = {
    "op1_jaccard": jaccard.OP1_SQL,
    "op3_warc": warc.OP3_SQL,
    "op4_lines": lines.OP4_SQL,
    "op5_topk": topk.OP5_SQL,
    "op11_hard_negatives": hardnegatives.OP11_SQL,
    "op12_prefix_trie": prefixtrie.OP12_SQL,
}
