"""The registered queries of the training-data operators and their DuckDB SQL where SQL can express them."""
from __future__ import annotations

from .conversation_trie import OP12_SQL, op12_conversation_trie
from .decontaminate import OP3_SQL, op3_decontamination
from .language_id import op1_language_id
from .lexical_search import OP11_SQL, op11_lexical_search
from .licenses import op6_license_scan
from .mixing import op9_mixing
from .ngram_join import OP7_SQL, op7_ngram_join
from .secrets import OP8_SQL, op8_secret_scan
from .simhash import op13_simhash
from .spotsigs import op5_fingerprints
from .substring_dedup import OP4_SQL, op4_substring_dedup
from .suffix_dedup import OP2_SQL, op2_suffix_dedup
from .toxicity import op10_toxicity

LLM_QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_fingerprints": op5_fingerprints,
    "op6_license_scan": op6_license_scan,
    "op7_ngram_join": op7_ngram_join,
    "op8_secret_scan": op8_secret_scan,
    "op9_mixing": op9_mixing,
    "op10_toxicity": op10_toxicity,
    "op11_lexical_search": op11_lexical_search,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_simhash": op13_simhash,
}

LLM_ORACLE = {
    "op2_suffix_dedup": OP2_SQL,
    "op3_decontamination": OP3_SQL,
    "op4_substring_dedup": OP4_SQL,
    "op7_ngram_join": OP7_SQL,
    "op8_secret_scan": OP8_SQL,
    "op11_lexical_search": OP11_SQL,
    "op12_conversation_trie": OP12_SQL,
}
