import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from shelfmark.llm import decontaminate, simhash
from shelfmark.llm.common import table

DATA = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    """What each stage took and gave."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = table(spark, DATA, "documents"), {}
    for name, stage in cp.STAGES:
        stage(spark, docs, DATA).write.parquet(str(folder / name))
        out[name] = docs, (docs := spark.read.parquet(str(folder / name)))
    return out


def test_stages_in_order(outputs, spark):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "packing"]
    names = table(spark, DATA, "documents").dtypes
    for name in list(outputs)[:-1]:
        assert outputs[name][1].dtypes == names


def test_toxic_documents_go_and_others_stay_as_they_are(outputs):
    before, after = outputs["toxicity"]
    assert 0 < before.count() - after.count() < 0.3 * before.count()
    assert after.exceptAll(before).count() == 0


def test_lines_go_but_no_document(outputs):
    before, after = outputs["line_dedup"]
    assert before.count() == after.count()
    assert after.filter(F.length("text") != F.col("n_chars")).count() == 0
    pairs = before.join(after.select("doc_id", F.col("text").alias("kept")), "doc_id").collect()
    assert sum(len(r["kept"]) < len(r["text"]) for r in pairs) > 0
    for r in pairs:
        rest = iter(r["text"].split("\n"))
        assert r["kept"] == "" or all(x in rest for x in r["kept"].split("\n"))


def test_one_of_each_group_stays(outputs):
    before, after = outputs["simhash_near_dedup"]
    marked = simhash.near_duplicates(before)
    assert sorted(r[0] for r in after.select("doc_id").collect()) == sorted(
        r[0] for r in marked.select("component_id").distinct().collect()
    )


def test_no_benchmark_window_stays(outputs, spark):
    before, after = outputs["benchmark_decontamination"]
    found = decontaminate.with_hits(before, table(spark, DATA, "benchmark"))
    assert after.count() == found.filter("n_hit = 0").count()


def test_packing_takes_all(outputs):
    before, after = outputs["packing"]
    assert after.select("doc_id").distinct().count() == before.count()


def test_repeated_and_unnamed_rows(spark, make):
    long = "x y z w v u t s r q"
    docs = make((1, "a b c"), (1, "a b c"), (2, "a b c"), (None, "a b c"), (1, long), (1, long), (None, "only here it is"), (None, None), (7, ""))
    kept = cp.keep_one_of_near_duplicates(spark, docs, DATA)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"] or 0), r["text"]) for r in kept.collect())
    assert got == [(0, "only here it is"), (1, "a b c"), (1, long), (7, "")]


def test_near_duplicates_of_an_empty_table(spark, make):
    assert cp.keep_one_of_near_duplicates(spark, make(), DATA).count() == 0


def test_run(spark, outputs):
    assert cp.run(spark, DATA).count() == outputs["packing"][1].count()


def test_the_rest_imports_without_this_package():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[:2] == ["shelfmark", "llm"] or name == "corpus_pipeline":
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert len(e.queries()) > 50 and not [n for n in e.queries() if n.startswith("op") or n == "pipeline"]
assert set(e.queries()) == set(e.oracle_sql())
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(cp.__file__))
