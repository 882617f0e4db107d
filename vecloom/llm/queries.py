"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from vecloom.llm.byte_bpe import op7_byte_bpe
from vecloom.llm.chat import OP9_SQL, op9_chat_format
from vecloom.llm.decontaminate import OP6_SQL, op6_decontaminate
from vecloom.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from vecloom.llm.license_scan import op3_license_scan
from vecloom.llm.line_dedup import OP4_SQL, op4_line_dedup
from vecloom.llm.ngram_join import op5_ngram_join
from vecloom.llm.quality import op2_quality_rules
from vecloom.llm.source_audit import OP12_SQL, op12_source_audit
from vecloom.llm.source_mix import op11_source_mix
from vecloom.llm.substring_dedup import OP10_SQL, op10_substring_dedup
from vecloom.llm.suffix_dedup import op1_suffix_dedup
from vecloom.llm.tokens_file import op8_token_file

QUERIES = {q.__name__: q for q in (op1_suffix_dedup, op2_quality_rules, op3_license_scan, op4_line_dedup, op5_ngram_join, op6_decontaminate, op7_byte_bpe, op8_token_file, op9_chat_format,
                                   op10_substring_dedup, op11_source_mix, op12_source_audit, op13_hard_negatives)}
ORACLE = {"op4_line_dedup": OP4_SQL, "op6_decontaminate": OP6_SQL, "op9_chat_format": OP9_SQL,
          "op10_substring_dedup": OP10_SQL, "op12_source_audit": OP12_SQL, "op13_hard_negatives": OP13_SQL}
