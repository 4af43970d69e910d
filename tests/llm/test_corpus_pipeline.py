"""The pipeline's stages against the operators' brute-force versions, and the import guard."""

import shutil
import subprocess
import sys
from pathlib import Path

import corpus_pipeline

from .test_dedup import exact_brute, near_brute
from .test_shards_packs_leaks import check_packed, leaks, packing

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


def test_stages_on_a_whole_table(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact", "near", "benchmark", "pack"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    docs = docs.unionByName(spark.createDataFrame([(10**6, None, None, "s", 0), (10**6 + 1, " 12 ", None, "s", 4), (10**6 + 2, "Ωμέγα και άλφα", None, "s", 14)], docs.schema))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        kept[name] = sorted((r.doc_id, r.text) for r in docs.collect())
    # clean rows stay, rows without letters and in an unknown script go
    assert kept["language"] == sorted(r for r in rows if r[0] < 10**6)
    assert [i for i, _ in kept["exact"]] == sorted(i for i, _, _, k, _ in exact_brute(kept["language"]) if k)
    assert [i for i, _ in kept["near"]] == sorted(i for i, _, _, k in near_brute(kept["exact"], 5) if k)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    gone = {d for d, _ in leaks(kept["near"], items)}
    assert kept["benchmark"] == [r for r in kept["near"] if r[0] not in gone]
    got = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    check_packed(kept["benchmark"], got, packing.tokenizer_json(), 4096)


def test_rows_with_null_or_repeated_ids_are_judged_each(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    item = min(items)[1]
    rows = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").limit(40).collect() if 300 < len(r.text or "") < 3000]
    gone = {d for d, _ in leaks(rows, items)}
    fine = sorted({t for i, t in rows if i not in gone})[:5]
    far = "Ωμέγα και άλφα " * 20
    top = 10**6
    odd = [(None, fine[0]), (None, far), (None, item), (None, None), (top, fine[1]), (top, far), (top + 1, fine[2]), (top + 1, item), (top + 2, item + " end"),
           (None, fine[3]), (top + 3, fine[3]), (top + 4, fine[3]), (top + 3, fine[4])]
    odd = spark.createDataFrame([(i, t, None, "s", 0) for i, t in odd], docs.select(*columns).schema)

    def left(stage, rows):
        got = stage(spark, rows, SF)
        return sorted(((r.doc_id, r.text) for r in got.where(f"doc_id is null or doc_id >= {top}").collect()), key=str)

    all_odd = sorted(((r.doc_id, r.text) for r in odd.collect()), key=str)
    assert left(corpus_pipeline.language, docs.select(*columns).unionByName(odd)) == [r for r in all_odd if r[1] not in (None, far)]
    assert left(corpus_pipeline.benchmark, odd) == [r for r in all_odd if item not in (r[1] or "")]
    assert left(corpus_pipeline.exact, odd) == [r for r in all_odd if r not in [(None, item), (None, far), (None, fine[3]), (top + 3, fine[3])]]


def test_entry_works_without_the_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "spark-warehouse", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert not [n for n in q if n.startswith('op') or n == 'pipeline']; assert set(e.oracle_sql()) <= set(q); print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
