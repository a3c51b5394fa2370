"""The registered queries: their columns, and their SQL where there is some."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from millrace.llm.queries import QUERIES, SQL
from tests.llm.conftest import SF

COLUMNS = {
    "op1_shard_minimax": "doc_id size text_crc32 law shard slot grown_shard",
    "op2_license_dice": "doc_id n_units licenses best_dice licensed",
    "op3_toxicity_channel": "doc_id held_out score predicted",
    "op4_mix_waterfill": "doc_id size source_size target taken",
    "op5_quality_ratio": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words score base_failed kept",
    "op6_decontaminate_index": "doc_id n_words n_hit n_items items_sha256 contaminated n_near near_items",
    "op7_jaccard_components": "doc_id n_shingles component_id",
    "op8_secret_markov": "doc_id n_assign n_access n_hex n_markov base_sha256 spans",
    "op9_pii_spans": "doc_id n_email n_ip n_card n_phone base_sha256 spans scores",
    "op10_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op11_filter_audit": "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
    "op12_bpe_backtrack": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op13_centroids_ns": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
}
LONG = ("size slot source_size taken n_words word_chars n_symbols n_dup_lines n_repeat_words n_hit n_items n_shingles n_assign n_access "
        "n_hex n_email n_ip n_card n_phone n_bytes n_removed n_spans text_crc32 n_units best_dice n_tokens n_near removed redundant unique_fails good_lost toxic_lost shapley distance "
        "cluster_inertia inertia").split()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(spark, name):
    out = entry_points.queries()[name](spark, SF)
    assert out.columns == COLUMNS[name].split()
    kinds = dict(out.dtypes)
    assert all(kinds[c] == "bigint" for c in kinds if c in LONG)
    rows = {"op11_filter_audit": 600 * 4, "op13_centroids_ns": spark.read.parquet(f"{SF}/embeddings.parquet").count()}
    assert out.count() == rows.get(name, spark.read.parquet(f"{SF}/documents.parquet").count())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, same, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{os.path.join(SF, table)}.parquet'")
    columns = COLUMNS[name].split()
    cursor = con.execute(SQL[name])
    places = [[d[0] for d in cursor.description].index(c) for c in columns]
    assert len(places) == len(cursor.description)
    same([tuple(r) for r in QUERIES[name](spark, SF).select(*columns).collect()], [tuple(r[i] for i in places) for r in cursor.fetchall()])
