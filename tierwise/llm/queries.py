"""Registered queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .archive import OP7_SQL, op7_warc_archive
from .exact_topk import OP8_SQL, op8_exact_topk
from .langid import op5_language_id
from .manifest import OP12_SQL, op12_merkle_manifest
from .mixing import OP3_SQL, op3_source_mix
from .neardup import op4_near_duplicates
from .nn_descent import op6_nn_descent
from .packing import op9_pack_sequences
from .prefix_trie import OP13_SQL, op13_prefix_trie
from .quality import op1_quality_classifier
from .secrets import op2_secret_scan
from .substrings import op10_repeated_passages
from .token_counts import op11_token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_quality_classifier, op2_secret_scan, op3_source_mix, op4_near_duplicates, op5_language_id, op6_nn_descent,
    op7_warc_archive, op8_exact_topk, op9_pack_sequences, op10_repeated_passages,
    op11_token_counts, op12_merkle_manifest, op13_prefix_trie)}

SQL: dict[str, str] = {"op3_source_mix": OP3_SQL, "op7_warc_archive": OP7_SQL, "op8_exact_topk": OP8_SQL,
                       "op12_merkle_manifest": OP12_SQL, "op13_prefix_trie": OP13_SQL}
