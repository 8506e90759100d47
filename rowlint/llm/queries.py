"""The operators' queries and their SQL, for ``__spark_entry__``."""

from __future__ import annotations

from .chat import OP13_SQL, op13_chat
from .collocations import OP12_SQL, op12_collocations
from .context_mixing import op6_lm_score
from .decontam import op7_decontamination
from .fim import OP11_SQL, op11_fim
from .line_dedup import OP9_SQL, op9_line_dedup
from .mixing import OP10_SQL, op10_mixing
from .mtree import OP2_SQL, op2_topk
from .near_dedup import op1_near_dedup
from .pii import op4_pii
from .secrets_scan import op3_secrets
from .toxicity import op5_toxicity
from .warc import OP8_SQL, op8_warc

QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_topk": op2_topk,
    "op3_secrets": op3_secrets,
    "op4_pii": op4_pii,
    "op5_toxicity": op5_toxicity,
    "op6_lm_score": op6_lm_score,
    "op7_decontamination": op7_decontamination,
    "op8_warc": op8_warc,
    "op9_line_dedup": op9_line_dedup,
    "op10_mixing": op10_mixing,
    "op11_fim": op11_fim,
    "op12_collocations": op12_collocations,
    "op13_chat": op13_chat,
}

SQL = {
    "op2_topk": OP2_SQL,
    "op8_warc": OP8_SQL,
    "op9_line_dedup": OP9_SQL,
    "op10_mixing": OP10_SQL,
    "op11_fim": OP11_SQL,
    "op12_collocations": OP12_SQL,
    "op13_chat": OP13_SQL,
}
