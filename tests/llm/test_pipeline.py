"""The pipeline and the registered queries."""

import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from check_queries import compare, connect  # noqa: E402
from test_join import brute_force  # noqa: E402
from test_models import brute_score  # noqa: E402
from test_texts import WORD, expected_targets  # noqa: E402

import __spark_entry__  # noqa: E402
from maskloom.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_against_sql(spark, name):
    error, n = compare(queries.QUERIES[name](spark, SF), connect(SF), queries.SQL[name])
    assert error is None and n, error


def test_registered():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13 and "pipeline" in names


def test_entry_without_the_subpackage(tmp_path):
    import shutil
    import subprocess

    root = Path(__spark_entry__.__file__).parent
    shutil.copytree(root / "maskloom", tmp_path / "maskloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, env={"PATH": "/usr/bin"}, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    assert not [n for n in said.stdout.split() if n == "0"]


def test_stages_as_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    columns, outs = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        assert i == 4 or docs.columns == columns
        outs.append(docs.collect())
    given = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    _, best = brute_score(given, labels, corpus_pipeline.SEED)
    assert {r.doc_id for r in outs[0]} == {given[j][0] for j in best}
    assert Counter(r.doc_id for r in outs[1]) == Counter(r.doc_id for r in outs[0])  # all of these texts have letters of a language
    parts = brute_force([(r.doc_id, r.text) for r in outs[1]])
    assert sorted(r.doc_id for r in outs[2]) == sorted(i for i, label in parts.items() if i == label)
    sizes = Counter()
    for r in outs[2]:
        sizes[r.source] += len(WORD.findall(r.text))
    taken = Counter()
    for r in outs[3]:
        taken[r.source] += len(WORD.findall(r.text))
    longest = {s: max(len(WORD.findall(r.text)) for r in outs[2] if r.source == s) for s in sizes}
    assert all(abs(taken[s] - t) <= longest[s] / 2 + 1 for s, t in expected_targets(sizes).items())
    whole_texts = {(r.doc_id, r.text, r.n_chars) for r in outs[2]}
    assert all((r.doc_id, r.text, r.n_chars) in whole_texts for r in outs[3])
    assert Counter(r.doc_id for r in outs[4]) == Counter(r.doc_id for r in outs[3])
    assert all(r.n_tokens * 4 == len(r.ids) for r in outs[4])
    whole = corpus_pipeline.run(spark, SF)
    assert Counter((r.doc_id, r.ids_sha256) for r in whole.collect()) == Counter((r.doc_id, r.ids_sha256) for r in outs[4])


def test_pipeline_without_documents(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_on_odd_rows(spark, tmp_path, odd_rows):
    rows = [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in odd_rows]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (None, None, None), (1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
