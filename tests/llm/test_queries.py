"""The registered queries on the smallest test data, and the pipeline stage by stage."""

import os

import brute
import pytest
from compare import connect, differences

import __spark_entry__ as entry
import corpus_pipeline
from ledgerloom.llm.common import table, written
from ledgerloom.llm.oracles import ORACLES
from ledgerloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def test_all_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in entry.oracle_sql()


# The columns that each query's contract names, with their types.
COLUMNS = {
    1: "query_id bigint, rank int, vec_id bigint, score double",
    2: "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    3: "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    4: "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    5: "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    6: "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    7: "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    8: "doc_id bigint, held_out boolean, score double, predicted int",
    9: "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    10: "doc_id bigint, held_out boolean, lang_pred string, score double",
    11: "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    12: "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    13: "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string",
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_registered_query_has_its_contracts_columns_and_rows(spark, name):
    number = int(name[2:].split("_")[0])
    found = written(QUERIES[name](spark, FOLDER), "whole")
    assert set(COLUMNS[number].split(", ")) <= {f"{column} {kind}" for column, kind in found.dtypes}
    count = lambda table_name: table(spark, FOLDER, table_name).count()
    if number == 1:
        assert found.count() == 5 * table(spark, FOLDER, "embeddings").where("vec_id % 50 = 0").count()
    elif number == 2:
        assert found.count() == 1 + table(spark, FOLDER, "conversations").select("conv_id").distinct().count()
    elif number == 7:
        assert found.select("doc_id").distinct().count() == count("documents") and found.where("offset + length > 2048").isEmpty()
    else:
        assert found.count() == count("embeddings" if number == 12 else "documents")


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_oracle(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) == []


def test_pipeline_stages_decide_as_plain_python(spark):
    docs = table(spark, FOLDER, "documents")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns
        rows = docs.collect()
        after = {r.doc_id: r.text for r in rows}
        assert set(after) <= set(before)
        if name == "exact":
            assert set(after) == {i for i, e in brute.exact_classes(before.items()).items() if e[2]}
        if name == "near":
            assert set(after) == {i for i, e in brute.near_classes(before.items(), 80, 100).items() if e[2]}
        if name == "mix":
            copies = {i: sum(r.doc_id == i for r in rows) for i in after}
            assert max(copies.values()) <= 3
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {r.doc_id for r in packed} == set(before)
    assert sum(r.piece == 0 for r in packed) == len(rows)
