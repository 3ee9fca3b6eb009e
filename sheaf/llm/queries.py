"""The corpus queries and their SQL."""

from __future__ import annotations

from sheaf.llm.fingerprints import op3_fingerprints
from sheaf.llm.language_id import op10_language_id
from sheaf.llm.near_duplicates import op9_near_duplicates
from sheaf.llm.oracles import ORACLES as MORE_ORACLES
from sheaf.llm.packing import op2_best_fit_packing
from sheaf.llm.pieces import op7_sentencepiece
from sheaf.llm.quality_classifier import op11_quality_classifier
from sheaf.llm.quality_rules import ORACLES as QUALITY_ORACLES
from sheaf.llm.quality_rules import op1_quality_rules
from sheaf.llm.runs import ORACLES as RUN_ORACLES
from sheaf.llm.runs import op12_periodic_runs
from sheaf.llm.secrets import op6_secret_scans
from sheaf.llm.suffix_dedup import op8_suffix_dedup
from sheaf.llm.token_counts import op5_token_counts
from sheaf.llm.vector_codes import ORACLES as CODE_ORACLES
from sheaf.llm.vector_codes import op13_vector_codes
from sheaf.llm.warc import op4_warc

QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_best_fit_packing, op3_fingerprints, op4_warc, op5_token_counts, op6_secret_scans, op7_sentencepiece, op8_suffix_dedup, op9_near_duplicates, op10_language_id, op11_quality_classifier, op12_periodic_runs, op13_vector_codes)}
ORACLES = QUALITY_ORACLES | MORE_ORACLES | RUN_ORACLES | CODE_ORACLES
