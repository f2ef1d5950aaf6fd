"""Named queries of this package and their DuckDB twins."""

from __future__ import annotations

from linegauge.llm.bpe import op2_bpe
from linegauge.llm.chat import OP6_SQL, op6_chat
from linegauge.llm.jaccard import op4_jaccard_join
from linegauge.llm.licenses import OP3_SQL, op3_license_scan
from linegauge.llm.nearest import op8_nearest
from linegauge.llm.packing import op5_packing
from linegauge.llm.repetition import op7_quality_rules
from linegauge.llm.simhash import op11_simhash
from linegauge.llm.suffix_dedup import op9_suffix_dedup
from linegauge.llm.token_files import op1_token_files
from linegauge.llm.toxicity import op10_toxicity
from linegauge.llm.trie_codes import OP13_SQL, op13_trie_codes
from linegauge.llm.whitening import op12_whitening

QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_bpe": op2_bpe,
    "op3_license_scan": op3_license_scan,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_packing": op5_packing,
    "op6_chat": op6_chat,
    "op7_quality_rules": op7_quality_rules,
    "op8_nearest": op8_nearest,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_simhash": op11_simhash,
    "op12_whitening": op12_whitening,
    "op13_trie_codes": op13_trie_codes,
}
ORACLES: dict[str, str] = {
    "op3_license_scan": OP3_SQL,
    "op6_chat": OP6_SQL,
    "op13_trie_codes": OP13_SQL,
}
