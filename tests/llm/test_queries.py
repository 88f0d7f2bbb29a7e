"""Every corpus query is registered with SQL, or is one that the other tests compare with a brute-force version."""

from __spark_entry__ import oracle_sql, queries
from webloom.llm.queries import ORACLE_SQL, QUERIES

BRUTE_FORCE = {
    "op2_fingerprints", "op3_mixing", "op4_ngram_join", "op5_line_dedup", "op6_token_files", "op7_packing", "op9_sharding",
    "op10_toxicity", "op11_merge_replay", "op13_manifest", "pipeline",
}


def test_every_query_is_checked():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(queries()) - set(oracle_sql()) == BRUTE_FORCE
    assert set(ORACLE_SQL) <= set(QUERIES)
