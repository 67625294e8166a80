"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from tidewatch.llm.bpe import op10_bpe
from tidewatch.llm.fingerprint import op1_fingerprint
from tidewatch.llm.html_text import op13_html
from tidewatch.llm.jaccard_join import op9_jaccard_join
from tidewatch.llm.langid import op4_langid
from tidewatch.llm.packing import op5_packing
from tidewatch.llm.pii import op2_pii
from tidewatch.llm.sharding import op3_sharding
from tidewatch.llm.spelling import op11_spelling
from tidewatch.llm import topk
from tidewatch.llm.suffix_dedup import op6_suffix_dedup
from tidewatch.llm.topk import op8_topk
from tidewatch.llm.toxicity import op7_toxicity
from tidewatch.llm.whitening import op12_whitening

QUERIES = {f.__name__: f for f in (op1_fingerprint, op2_pii, op3_sharding, op4_langid, op5_packing, op6_suffix_dedup,
                                 op7_toxicity, op8_topk, op9_jaccard_join, op10_bpe, op11_spelling, op12_whitening,
                                 op13_html)}
ORACLES: dict[str, str] = {"op8_topk": topk.SQL}
