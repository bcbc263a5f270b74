"""The queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from .bpe import op8
from .decontaminate import OP1_SQL, op1
from .fim import OP11_SQL, op11
from .fingerprint import op10
from .langid import op5
from .linededup import op6
from .neardup import op4
from .packing import op12
from .quality import op9
from .spelling import op13
from .substrings import op3
from .tokencount import op7
from .tokenfile import op2

QUERIES = {"op1_decontaminate": op1, "op2_token_file": op2, "op3_substrings": op3, "op4_near_duplicates": op4, "op5_language": op5, "op6_fuzzy_lines": op6, "op7_token_counts": op7, "op8_bpe": op8, "op9_quality": op9, "op10_syncmers": op10, "op11_fill_in_middle": op11, "op12_packing": op12, "op13_spelling": op13}
SQL = {"op1_decontaminate": OP1_SQL, "op11_fill_in_middle": OP11_SQL}
