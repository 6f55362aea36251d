"""Queries of the corpus operators and their SQL, by name."""

from __future__ import annotations

from tidemart.llm.language import op8_language
from tidemart.llm.mixing import OP5_SQL, op5_mix
from tidemart.llm.ngrams import op9_ngrams
from tidemart.llm.packing import op3_pack
from tidemart.llm.quality import OP2_SQL, op2_quality
from tidemart.llm.repeats import op13_repeats
from tidemart.llm.search import OP7_SQL, op7_search
from tidemart.llm.secrets import op10_secrets
from tidemart.llm.sharding import op6_shard
from tidemart.llm.simhash import op1_simhash
from tidemart.llm.spelling import op12_spelling
from tidemart.llm.warc import OP4_SQL, op4_warc
from tidemart.llm.whitening import op11_whiten

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_quality": op2_quality,
    "op3_pack": op3_pack,
    "op4_warc": op4_warc,
    "op5_mix": op5_mix,
    "op6_shard": op6_shard,
    "op7_search": op7_search,
    "op8_language": op8_language,
    "op9_ngrams": op9_ngrams,
    "op10_secrets": op10_secrets,
    "op11_whiten": op11_whiten,
    "op12_spelling": op12_spelling,
    "op13_repeats": op13_repeats,
}

ORACLES = {"op2_quality": OP2_SQL, "op4_warc": OP4_SQL, "op5_mix": OP5_SQL, "op7_search": OP7_SQL}
