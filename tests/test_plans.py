"""Shape of the physical plans: pushdown, no products, no Python where none is needed."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from corpuscle.plans import all_queries, stream_queries  # noqa: E402
from corpuscle.plans.registry import Tables  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
PYTHON = {"page_blocks", "paragraph_blocks", "page_listing", "page_tables", "page_lines",
          "author_lines"}
# Their result is read back from files a job wrote, so the plan is a scan.
STAGED = {"renamed_pairs", "diff_report"}

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data here")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(all_queries()) - STAGED))
def test_no_products(spark, name):
    text = plan(all_queries()[name].run(spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in PYTHON:
        assert "Python" not in text and "MapInPandas" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(all_queries()["keyset_page"].run(spark, FOLDER))
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,1500)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderpriority:string>" in text


def test_flagship_scans_texts_once(spark):
    text = plan(all_queries()["popular_documents"].run(spark, FOLDER))
    assert text.count("FileScan") == 1 and text.count("Generate ") == 1


def test_rule_tables_are_broadcast_without_hints(spark):
    text = plan(all_queries()["status_cascade"].run(spark, FOLDER))
    assert text.count("BroadcastHashJoin") == 4 and "SortMergeJoin" not in text


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name,scans,exchanges", [
    ("block_context", 1, 1), ("bare_article_filter", 2, 12), ("cosine_pairs", 2, 4),
    ("article_pairing", 1, 0), ("best_reference", 1, 0), ("dictionary_mentions", 1, 0)])
def test_few_scans(spark, no_broadcast, name, scans, exchanges):
    text = plan(all_queries()[name].run(spark, FOLDER))
    assert text.count("FileScan") <= scans and text.count("Exchange ") <= exchanges


def test_annotation_files_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """A file per row of a small table: its one task would write them all."""
    from corpuscle.plans import all_queries, table_queries

    monkeypatch.setattr(table_queries, "_folder", lambda t: f"{tmp_path}/notes")
    spark.createDataFrame([(i, f"s{i}", i) for i in range(40)], "s_suppkey BIGINT, s_name STRING, s_nationkey BIGINT") \
        .coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    assert all_queries()["annotation_files"].run(spark, str(tmp_path)).count() == 40
    tasks = {p.name.split("-")[1] for p in (tmp_path / "notes").glob("part-*.txt")}
    assert len(tasks) > 8


def test_deletes_pass_by_hashed_keys(spark, no_broadcast):
    """No sort of the facts and children: it would hold millions of narrow rows per task."""
    text = plan(all_queries()["cascade_delete"].run(spark, FOLDER))
    assert text.count("ShuffledHashJoin") == 4 and "SortMergeJoin" not in text


@pytest.mark.parametrize("name", ["question_catalogue", "items_per_question"])
def test_links_without_items_are_dropped_before_they_are_counted(spark, name):
    text = plan(all_queries()[name].run(spark, FOLDER))
    below = text[text.index("LeftSemi"):]
    assert "HashAggregate" not in below[:below.index("FileScan")] and "l_partkey" in below[:below.index("FileScan")]


@pytest.mark.parametrize("name,exchanges", [("picked_tables", 1), ("picked_table_check", 1)])
def test_tables_are_picked_inside_their_row(spark, no_broadcast, name, exchanges):
    text = plan(all_queries()[name].run(spark, FOLDER))
    assert text.count("FileScan") == 1 and text.count("Exchange ") == exchanges and "Join" not in text


def test_names_of_editions_are_folded_and_shuffled_once(spark, no_broadcast):
    text = plan(all_queries()["version_diff"].run(spark, FOLDER))
    assert "translate" not in text and text.count("Exchange ") == 2
    assert sum("Exchange " in x and "name#" in x for x in text.splitlines()) <= 1


def test_stream_load_is_delivered_columns_of_its_table(spark):
    """The stream makes the records; their texts and lists are not written before it."""
    star = Path(stream_queries._load(Tables(spark, FOLDER)).removeprefix("file:"))
    staged = spark.read.parquet(str(star.parent / "in"))
    assert staged.columns == ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]
    assert staged.count() == spark.read.parquet(f"{FOLDER}/orders.parquet").count()
