"""Queries of the document operators, and the DuckDB SQL of those that SQL can express.

op4, op11 and op13 have SQL. Tokenizers, classifiers, page trees, crc32, isolation forests and the suffix array are out of
its reach, and op10's windows too slow. Tests hold op3, op4, the statistics of op5, op7, op8, op9, op10
and op12 against brute force or the library, on small tables; op1 and op6 are held to accuracy on rows they didn't learn
from, op2 to pages of known text, and the pipeline has no brute-force version of the whole.
"""

from __future__ import annotations

from .clustering import OP13_SQL, op13_centroids
from .decontaminate import op10_decontamination
from .html_extract import op2_html_text
from .jaccard_join import OP4_SQL, op4_jaccard_join
from .language_id import op6_language_id
from .mixing import OP11_SQL, op11_mixing
from .packing import op7_packing
from .quality import op5_quality_rules
from .repeats import op8_repeat_removal
from .spelling import op12_spelling_variants
from .token_count import op9_token_counts
from .token_files import op3_token_files
from .toxicity import op1_toxicity

_ALL = (
    op1_toxicity, op2_html_text, op3_token_files, op4_jaccard_join, op5_quality_rules, op6_language_id, op7_packing, op8_repeat_removal,
    op9_token_counts, op10_decontamination, op11_mixing, op12_spelling_variants, op13_centroids,
)

QUERIES = {f.__name__: f for f in _ALL}

SQL: dict[str, str] = {"op4_jaccard_join": OP4_SQL, "op11_mixing": OP11_SQL, "op13_centroids": OP13_SQL}
