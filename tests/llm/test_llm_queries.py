"""The queries against their SQL counterparts, and the columns that each must return."""

from pathlib import Path

import duckdb
import pytest

from tidemark.llm import ORACLES, QUERIES

COLUMNS = {
    3: ["doc_id", "n_shingles", "component_id", "kept"], 4: ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    5: ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"], 6: ["doc_id", "size", "source_size", "target", "taken"],
    7: ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    8: ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"], 9: ["doc_id", "held_out", "score", "predicted"],
    11: ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
    12: ["page_id", "host", "path", "rule", "verdict"],
    13: ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]}


def number(name):
    return int(name[2:].split("_")[0])


def test_one_query_for_each_operator():
    assert sorted(map(number, QUERIES)) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES, key=number))
def test_columns_and_sql(name, spark, sf):
    df = QUERIES[name](spark, sf)
    assert set(COLUMNS.get(number(name), [])) <= set(df.columns)
    if name not in ORACLES:
        assert number(name) == 1 or df.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
        return
    con = duckdb.connect()
    for path in Path(sf).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    got = sorted(map(tuple, df.select(*columns).collect()), key=repr)
    assert got == sorted(cursor.fetchall(), key=repr)
    con.close()
