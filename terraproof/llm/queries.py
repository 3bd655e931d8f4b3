"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from terraproof.llm.q01_simhash import op1_simhash
from terraproof.llm.q02_quality import SQL as OP2_SQL
from terraproof.llm.q02_quality import op2_quality
from terraproof.llm.q03_suffix_tree import op3_suffix_tree
from terraproof.llm.q04_bpe import op4_bpe
from terraproof.llm.q05_html import op5_html
from terraproof.llm.q06_urls import op6_urls
from terraproof.llm.q07_media import op7_media
from terraproof.llm.q08_chat import SQL as OP8_SQL
from terraproof.llm.q08_chat import op8_chat
from terraproof.llm.q09_language import op9_language
from terraproof.llm.q10_packing import op10_packing
from terraproof.llm.q11_classifier import op11_classifier
from terraproof.llm.q12_whitening import op12_whitening
from terraproof.llm.q13_spelling import op13_spelling

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_quality": op2_quality,
    "op3_suffix_tree": op3_suffix_tree,
    "op4_bpe": op4_bpe,
    "op5_html": op5_html,
    "op6_urls": op6_urls,
    "op7_media": op7_media,
    "op8_chat": op8_chat,
    "op9_language": op9_language,
    "op10_packing": op10_packing,
    "op11_classifier": op11_classifier,
    "op12_whitening": op12_whitening,
    "op13_spelling": op13_spelling,
}
ORACLES: dict[str, str] = {
    "op2_quality": OP2_SQL,
    "op8_chat": OP8_SQL,
}
