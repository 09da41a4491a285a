"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from tidemark.llm import licenses
from tidemark.llm.decontaminate import op7_fm_index
from tidemark.llm.licenses import op6_license_sentences
from tidemark.llm.packing import op9_best_two_fit
from tidemark.llm.partenum import op2_partenum
from tidemark.llm.prefix_trie import op11_burst_trie
from tidemark.llm.katz import op8_katz
from tidemark.llm.suffixes import op4_suffix_dedup
from tidemark.llm.quality import op5_line_frequency
from tidemark.llm.shards import op3_virtual_slots
from tidemark.llm.token_blocks import op1_token_blocks
from tidemark.llm.token_counts import op12_rank_merging
from tidemark.llm.url_filter import op10_url_filter
from tidemark.llm.whitening import op13_exact_polynomial

QUERIES = {
    "op4_suffix_dedup": op4_suffix_dedup,
    "op8_katz": op8_katz,
    "op2_partenum": op2_partenum,
    "op1_token_blocks": op1_token_blocks,
    "op3_virtual_slots": op3_virtual_slots,
    "op5_line_frequency": op5_line_frequency,
    "op6_license_sentences": op6_license_sentences,
    "op7_fm_index": op7_fm_index,
    "op9_best_two_fit": op9_best_two_fit,
    "op10_url_filter": op10_url_filter,
    "op11_burst_trie": op11_burst_trie,
    "op12_rank_merging": op12_rank_merging,
    "op13_exact_polynomial": op13_exact_polynomial,
}

ORACLES: dict[str, str] = {
    "op6_license_sentences": licenses.SQL,
}
