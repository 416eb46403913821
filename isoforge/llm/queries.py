"""Queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from isoforge.llm.byte_bpe import op8_byte_bpe
from isoforge.llm.code_compression import SQL as CODES_SQL
from isoforge.llm.code_compression import op11_code_compression
from isoforge.llm.license_scan import op10_license_scan
from isoforge.llm.ngram_join import op1_ngram_join
from isoforge.llm.one_bit_neighbours import op5_one_bit_neighbours
from isoforge.llm.packing import op7_packing
from isoforge.llm.phrase_mining import SQL as PHRASE_SQL
from isoforge.llm.phrase_mining import op13_phrase_mining
from isoforge.llm.progressive_jpeg import op9_progressive_jpeg
from isoforge.llm.quality import op6_quality_rules
from isoforge.llm.secret_scan import op3_secret_scan
from isoforge.llm.toxicity import op2_toxicity
from isoforge.llm.url_filter import op12_url_filter
from isoforge.llm.warc import SQL as WARC_SQL
from isoforge.llm.warc import op4_warc

QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_toxicity": op2_toxicity,
    "op3_secret_scan": op3_secret_scan,
    "op4_warc": op4_warc,
    "op5_one_bit_neighbours": op5_one_bit_neighbours,
    "op6_quality_rules": op6_quality_rules,
    "op7_packing": op7_packing,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_progressive_jpeg": op9_progressive_jpeg,
    "op10_license_scan": op10_license_scan,
    "op11_code_compression": op11_code_compression,
    "op12_url_filter": op12_url_filter,
    "op13_phrase_mining": op13_phrase_mining,
}

ORACLE_SQL: dict[str, str] = {"op4_warc": WARC_SQL, "op11_code_compression": CODES_SQL, "op13_phrase_mining": PHRASE_SQL}
