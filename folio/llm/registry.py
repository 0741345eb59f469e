"""The training-data queries and their DuckDB SQL."""

from __future__ import annotations

from folio.llm.boosting import op11_quality_classifier
from folio.llm.bpe import op9_byte_bpe
from folio.llm.chat import OP3_SQL, op3_chat_formatting
from folio.llm.collocations import OP13_SQL, op13_collocations
from folio.llm.decontam import OP8_SQL, op8_decontamination
from folio.llm.hmm import op4_hmm_scoring
from folio.llm.langid import op1_language_id
from folio.llm.ngram_join import OP10_SQL, op10_ngram_join
from folio.llm.planes import op5_token_planes
from folio.llm.quality import op7_quality_rules
from folio.llm.shards import op2_sharding
from folio.llm.tagpath import op6_tag_paths
from folio.llm.whitening import op12_whitening

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_sharding": op2_sharding,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_hmm_scoring": op4_hmm_scoring,
    "op5_token_planes": op5_token_planes,
    "op6_tag_paths": op6_tag_paths,
    "op7_quality_rules": op7_quality_rules,
    "op8_decontamination": op8_decontamination,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_ngram_join": op10_ngram_join,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_whitening": op12_whitening,
    "op13_collocations": op13_collocations,
}

SQL = {
    "op3_chat_formatting": OP3_SQL,
    "op8_decontamination": OP8_SQL,
    "op10_ngram_join": OP10_SQL,
    "op13_collocations": OP13_SQL,
}
