import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import corpus_pipeline as P
from vigil.llm import registry
from vigil.llm.toxicity import fit, score
from vigil.session import materialize

from .test_decontaminate import words
from .test_neardup import brute
from .test_packing import check
from .test_templates import Settings, brute_templates, masked

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in P.STAGES:
        new = materialize(stage(spark, docs, sf), name)
        out[name] = (docs, new)
        docs = new
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_all_but_the_last_keep_the_columns(stages):
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.columns == before.columns and after.dtypes == before.dtypes


def test_toxic_documents_go(spark, sf, stages):
    before, after = stages["toxicity"]
    toxic = score(spark, fit(before, spark.read.parquet(f"{sf}/labels.parquet")))
    want = {r.doc_id for r in before.select("doc_id", toxic(before.text).alias("s")).collect() if r.s < 0.5}
    assert set(texts(after)) == want


def test_recurring_lines_go(stages):
    before, after = (texts(x) for x in stages["line_dedup"])
    gone = brute_templates(list(before.items()), Settings())
    assert set(before) == set(after)
    for d, text in before.items():
        left = after[d].split("\n")
        assert all(x in text.split("\n") for x in left)
        for line in set(text.split("\n")) - set(left):
            assert " ".join(masked(line)) in gone or any("<*>" in g for g in gone)


def test_one_of_each_group_stays(stages):
    before, after = (texts(x) for x in stages["near_duplicates"])
    assert set(after) == {d for d, (_, _, kept) in brute(list(before.items()), P.SHINGLE).items() if kept}


def test_no_benchmark_window_is_left(spark, sf, stages):
    windows = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[i:i + 10]) for i in range(len(w) - 9)}
    before, after = (texts(x) for x in stages["decontamination"])
    dirty = {d for d, t in before.items() if any(tuple(w[i:i + 10]) in windows for w in [words(t)] for i in range(len(w) - 9))}
    assert set(after) == set(before) - dirty


def test_packing_holds_every_id(stages):
    import numpy as np
    from tokenizers import Tokenizer

    from vigil.llm.vocab import vocabulary

    tok, (before, after) = Tokenizer.from_file(vocabulary("word_bpe_49k.json")), stages["packing"]
    docs = texts(before)
    assert {r.doc_id for r in after.collect()} == set(docs)
    check(after.collect(), lambda d: np.array(tok.encode(docs[d] or "", add_special_tokens=False).ids + [1], "<u4"))


def test_odd_and_empty_tables(spark, sf, odd_docs, no_docs):
    for name, stage in P.STAGES:
        for docs in (odd_docs, no_docs):
            out = stage(spark, docs, sf)
            if name != "packing":
                assert out.columns == docs.columns, name
            n = out.count()
            assert n == 0 if docs is no_docs else n > 0, name
    # 1 twice, 2, 3 and the null id's longer text are one group; the wordless rows all stay
    left = P.near_duplicate(spark, odd_docs, sf)
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(["1", "4", "5", "6", "7", "8", "9", "10", "None"])


def test_every_operator_is_registered():
    names = {n.split("_")[0] for n in registry.queries()}
    assert names == {f"op{n}" for n in range(1, 14)} and set(registry.oracle_sql()) <= set(registry.queries())
    assert 4 <= len(P.STAGES) <= 5


def test_the_rest_works_without_the_subpackage(tmp_path):
    shutil.copytree(ROOT / "vigil", tmp_path / "vigil", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'port_scan' in q and not any(n.startswith('op') for n in q); print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=100)
    assert done.returncode == 0, done.stderr


def test_rows_of_one_document_and_a_column_named_like_the_line_counts(spark, sf):
    import corpus_pipeline as P

    text = "the first of many words that stand here and nowhere else in this small table of documents"
    rows = [(1, text, s, "kept") for s in ("zz", "aa", "mm")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, __lines string")
    out = P.near_duplicate(spark, P.line_dedup(spark, docs, sf), sf)
    assert out.columns == docs.columns
    for n in (1, 3, 7):
        assert [tuple(r) for r in P.near_duplicate(spark, P.line_dedup(spark, docs.repartition(n), sf), sf).collect()] == [rows[1]]
