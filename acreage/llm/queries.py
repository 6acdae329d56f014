"""Queries of this subpackage, and SQL for those that SQL can express."""

from acreage.llm.chat import OP3_SQL, op3_chat_format
from acreage.llm.decontaminate import op4_decontaminate
from acreage.llm.divergence import OP13_SQL, op13_source_divergence
from acreage.llm.jaccard import OP7_SQL, op7_jaccard_join
from acreage.llm.mixing import OP1_SQL, op1_mix_sources
from acreage.llm.perplexity import op5_perplexity
from acreage.llm.phrases import OP12_SQL, op12_phrase_mining
from acreage.llm.quality_rules import op10_quality_rules
from acreage.llm.secrets import OP2_SQL, op2_secret_scan
from acreage.llm.sharding import op8_kd_shards
from acreage.llm.simhash import op11_simhash
from acreage.llm.substring import OP6_SQL, op6_substring_dedup
from acreage.llm.warc import OP9_SQL, op9_warc

QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_secret_scan": op2_secret_scan,
    "op3_chat_format": op3_chat_format,
    "op4_decontaminate": op4_decontaminate,
    "op5_perplexity": op5_perplexity,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_kd_shards": op8_kd_shards,
    "op9_warc": op9_warc,
    "op10_quality_rules": op10_quality_rules,
    "op11_simhash": op11_simhash,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE_SQL = {
    "op1_mix_sources": OP1_SQL,
    "op2_secret_scan": OP2_SQL,
    "op3_chat_format": OP3_SQL,
    "op6_substring_dedup": OP6_SQL,
    "op7_jaccard_join": OP7_SQL,
    "op9_warc": OP9_SQL,
    "op12_phrase_mining": OP12_SQL,
    "op13_source_divergence": OP13_SQL,
}
