"""Shape of the physical plans: pruned scans, pushed filters, no pairwise joins."""

import contextlib
import io

import pytest
from conftest import SMALL

from pixelweave import plans

QUERIES = plans.queries()


def plan_of(df, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def windows_in_one_task(plan):
    """Windows whose input is gathered into a single partition."""
    lines = plan.splitlines()
    return [
        line
        for i, line in enumerate(lines)
        if " Window [" in line and any("SinglePartition" in below for below in lines[i + 1 : i + 3])
    ]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_join_no_python_per_row_no_global_window(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL), "simple")
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    # Only the class list, as long as the caller's, is numbered in one task.
    assert bool(windows_in_one_task(plan)) == (name == "present_classes")


@pytest.mark.parametrize("name", ["label_semi_join", "label_encode", "class_share"])
def test_scan_reads_only_what_is_needed(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    schemas = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert schemas and all("value" not in s and "props" not in s for s in schemas)


@pytest.mark.parametrize("name", ["label_encode", "class_share", "class_weights", "present_classes"])
def test_class_filter_reaches_the_scan(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "PushedFilters: [In(event_type" in plan


def test_listing_does_not_read_file_contents(spark, tmp_path):
    from pixelweave.sources import files

    (tmp_path / "train").mkdir()
    (tmp_path / "train" / "coco_1.png").write_bytes(b"x")
    plan = plan_of(files.list_images(spark, str(tmp_path), "train"))
    assert "content" not in [line for line in plan.splitlines() if line.startswith("ReadSchema")][0]


def test_chunk_predicate_reaches_a_written_table(spark, tmp_path):
    from pixelweave.plans.bindings import chunks
    from pixelweave.sources.chunks import read_chunks

    chunks(spark, SMALL).write.parquet(str(tmp_path / "t"))
    plan = plan_of(read_chunks(spark.read.parquet(str(tmp_path / "t")), 3, 5))
    assert "GreaterThanOrEqual(chunk_id,3)" in plan and "LessThan(chunk_id,5)" in plan
