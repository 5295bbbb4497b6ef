"""Queries of this subpackage: name -> (function, DuckDB SQL or None)."""

from __future__ import annotations

from quire.llm.alignment import op12_alignment
from quire.llm.ann import op1_nearest
from quire.llm.html_main import op10_main_text
from quire.llm.jaccard import OP8_SQL, op8_jaccard
from quire.llm.langid import op4_langid
from quire.llm.lexical import OP13_SQL, op13_lexical
from quire.llm.mixing import OP6_SQL, op6_mix
from quire.llm.packing import op9_pack
from quire.llm.pii import op2_pii
from quire.llm.quality import OP5_SQL, op5_quality
from quire.llm.simhash import op11_simhash
from quire.llm.token_files import op7_token_orc
from quire.llm.urls import OP3_SQL, op3_urls


def load() -> dict:
    return {
        "op1_nearest": (op1_nearest, None),
        "op2_pii": (op2_pii, None),
        "op3_urls": (op3_urls, OP3_SQL),
        "op4_langid": (op4_langid, None),
        "op5_quality": (op5_quality, OP5_SQL),
        "op6_mix": (op6_mix, OP6_SQL),
        "op7_token_orc": (op7_token_orc, None),
        "op8_jaccard": (op8_jaccard, OP8_SQL),
        "op9_pack": (op9_pack, None),
        "op10_main_text": (op10_main_text, None),
        "op11_simhash": (op11_simhash, None),
        "op12_alignment": (op12_alignment, None),
        "op13_lexical": (op13_lexical, OP13_SQL),
    }
