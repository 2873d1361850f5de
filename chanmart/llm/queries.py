"""Queries of this subpackage, ``(spark, sf_dir) -> DataFrame``, and their DuckDB SQL where SQL can express them."""

from chanmart.llm.conversation_repair import OP12_SQL, op12_conversation_repair
from chanmart.llm.conversation_trie import OP13_SQL, op13_conversation_trie
from chanmart.llm.decontaminate import OP8_SQL, op8_benchmark_decontamination
from chanmart.llm.line_dedup import OP4_SQL, op4_line_dedup
from chanmart.llm.near_dup import op6_minhash_near_dedup
from chanmart.llm.packing import op1_best_fit_packing
from chanmart.llm.pii import OP10_SQL, op10_pii
from chanmart.llm.revisits import OP7_SQL, op7_warc_revisits
from chanmart.llm.secrets import OP2_SQL, op2_secret_scan
from chanmart.llm.suffix_dedup import op9_suffix_array_dedup
from chanmart.llm.topk import OP3_SQL, op3_exact_topk
from chanmart.llm.toxicity import op5_toxicity
from chanmart.llm.url_filter import OP11_SQL, op11_url_filter

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_secret_scan": op2_secret_scan,
    "op3_exact_topk": op3_exact_topk,
    "op4_line_dedup": op4_line_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_warc_revisits": op7_warc_revisits,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_pii": op10_pii,
    "op11_url_filter": op11_url_filter,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLE_SQL = {
    "op2_secret_scan": OP2_SQL,
    "op3_exact_topk": OP3_SQL,
    "op4_line_dedup": OP4_SQL,
    "op7_warc_revisits": OP7_SQL,
    "op8_benchmark_decontamination": OP8_SQL,
    "op10_pii": OP10_SQL,
    "op11_url_filter": OP11_SQL,
    "op12_conversation_repair": OP12_SQL,
    "op13_conversation_trie": OP13_SQL,
}
