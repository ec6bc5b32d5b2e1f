"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from .chat import SQL as CHAT_SQL
from .chat import op10_chat
from .decontaminate import op2_decontaminate
from .importance import SQL as IMPORTANCE_SQL
from .importance import op11_importance
from .mixing import SQL as MIXING_SQL
from .mixing import op6_mixing
from .neardup import op4_simhash
from .pii import op8_pii
from .quality import op1_quality
from .tiff import op3_tiff
from .tokens import op9_tokens
from .toxicity import op7_toxicity
from .trie import SQL as TRIE_SQL
from .trie import op12_trie
from .warc import SQL as WARC_SQL
from .warc import op5_warc
from .wrapper import SQL as WRAPPER_SQL
from .wrapper import op13_html

QUERIES = {f.__name__: f for f in (op1_quality, op2_decontaminate, op3_tiff, op4_simhash, op5_warc, op6_mixing, op7_toxicity, op8_pii, op9_tokens, op10_chat, op11_importance, op12_trie, op13_html)}

ORACLES = {"op5_warc": WARC_SQL, "op6_mixing": MIXING_SQL, "op10_chat": CHAT_SQL, "op11_importance": IMPORTANCE_SQL, "op12_trie": TRIE_SQL, "op13_html": WRAPPER_SQL}
