"""Physical plans: what reaches the scan, and what must not appear."""

import pytest
from pyspark.sql import functions as F

from compare import DATA
from sedimenta.plans.catalogue import QUERIES

SF = str(DATA / "sf0.001")


def plan(df) -> str:
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"stream_ingest", "stream_folder", "jsonl_roundtrip"}))
def test_no_cross_join_and_no_single_task(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text, "row-at-a-time Python"
    assert "SinglePartition, ENSURE" not in text or "TakeOrderedAndProject" in text


@pytest.mark.parametrize(
    "name, columns",
    [
        ("char_count", {"doc_id", "text"}),
        ("resume_anti_join", {"doc_id", "source"}),
        ("l2_norm", {"vec_id", "embedding"}),
        ("row_to_text", {"c_custkey", "c_name", "c_mktsegment"})
    ]
)
def test_only_needed_columns_are_read(spark, name, columns):
    line = next(x for x in plan(QUERIES[name](spark, SF)).splitlines() if "FileScan" in x)
    schema = line.split("ReadSchema: struct<")[1].rstrip(">")
    assert {part.split(":")[0] for part in schema.replace("array<", "").split(",") if ":" in part} == columns


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["dense_topk"](spark, SF))
    assert "PushedFilters: [IsNotNull(vec_id), IsNotNull(embedding)]" in text


def test_text_functions_stay_in_the_jvm(spark):
    from sedimenta.functions import text as tx

    rows = spark.read.parquet(f"{SF}/documents.parquet")
    text = plan(rows.select(tx.collapse_whitespace(tx.remove_repeated_lines(tx.remove_control_chars(F.col("text"))))))
    assert "Python" not in text and "Exchange" not in text


def test_batches_are_limited_by_bytes(spark):
    import pyarrow as pa

    import __spark_entry__ as entry

    key = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

    def largest():
        texts = spark.range(4000, numPartitions=1).select(F.repeat(F.lit("x"), 10_000).alias("t"))
        return texts.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]

    entry.queries()["clean_text"](spark, SF)
    try:
        assert largest() < 5 << 20
        entry.queries()["op13_url_filter"](spark, SF)
        assert key not in spark.conf.getAll
        spark.conf.set(key, "1m")
        entry.queries()["clean_text"](spark, SF)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key)


def test_a_census_harvests_each_text_once(spark):
    import __spark_entry__ as entry

    for name in ("census_paths", "census_meta"):
        text = plan(entry.queries()[name](spark, SF))
        assert text.count("ArrowEvalPython [harvest_json") == 1, name


def test_a_handoff_harvests_each_text_once(spark, monkeypatch):
    import __spark_entry__ as entry
    from sedimenta.operators import corpus
    from sedimenta.plans import file_queries

    plans, own = [], corpus.materialize

    def written(df):
        plans.append(plan(df))
        return own(df)

    for module in (corpus, file_queries):
        monkeypatch.setattr(module, "materialize", written, raising=False)
    rows = entry.queries()["chunk_handoff"](spark, SF)
    assert rows.count() > 0
    harvests = [x.count("ArrowEvalPython [harvest_json") for x in plans]
    assert sum(harvests) == 1, harvests
    ranged = [n for x, n in zip(plans, harvests, strict=True) if "rangepartitioning" in x]
    assert ranged == [0], "drawing the ranges computes what is dealt into them once more"
