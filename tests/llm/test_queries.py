"""The registered queries: DuckDB twins, contracts' columns, whole tables."""

import pytest
from oracle_compare import compare, duck_conn

import __spark_entry__ as E
from sheetfold.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op2": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op3": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op4": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op6": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op8": "query_id bigint, rank int, vec_id bigint, score double",
    "op11": "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string",
    "op12": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op13": "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, "
            "good_lost bigint, toxic_lost bigint, shapley bigint",
}


def test_all_operators_and_the_pipeline_are_registered():
    names = E.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) < set(names) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, name):
    n, problems = compare(spark, duck_conn(SF), name, QUERIES[name], ORACLE[name], SF)
    assert not problems, problems


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    df = QUERIES[name](spark, SF)
    types = dict(df.dtypes)
    for column in COLUMNS.get(name.split("_")[0], "").split(", "):
        if column:
            c, kind = column.split(" ")
            assert types[c] == kind
    n = df.count()
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    if name[:4] in ("op1_", "op2_", "op3_", "op6_", "op7_"):
        assert n == docs
