import pytest

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole, n = {r.doc_id for r in docs.collect()}, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
        n.append(docs.count())
        assert {r.doc_id for r in docs.collect()} <= whole
    assert n[0] >= n[1] >= n[2] > 100
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count()


def test_stages_drop_what_is_planted_and_keep_the_rest(spark):
    """Copies and near copies among the given documents go but for one of each, most toxic documents go, clean ones stay, sources are mixed and all rows are encoded."""
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.toxic is not None}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    top = docs.agg({"doc_id": "max"}).first()[0]
    base = [f"planted{i % 97} word{i} about harbours" for i in range(120)]
    copy, family = " ".join(base), [" ".join([*base[:i], "changed", *base[i + 1 :]]) for i in (3, 40, 77, 100)]
    exact = " ".join(f"other{i}" for i in range(90))
    rows = [(top + 1, exact), (top + 2, exact.replace(" ", "\n", 3)), (top + 3, exact), *((top + 10 + i, t) for i, t in enumerate([copy, *family])), (top + 30, "x " * 60_000)]
    planted = spark.createDataFrame([(i, t, "en", "src_planted", len(t)) for i, t in rows], docs.schema)
    toxic, copies, near, mixed, encoded = (f for _, f in corpus_pipeline.STAGES)
    keep = lambda df: spark.createDataFrame(df.collect(), docs.schema)
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}

    start = docs.unionByName(planted)
    first = keep(toxic(spark, start, SF))
    gone = ids(start) - ids(first)
    bad, clean = ({d for d, t in labels.items() if t == v and d in ids(docs)} for v in (1, 0))
    assert len(gone & bad) >= 0.8 * len(bad) > 0 and len(gone & clean) <= max(1, 0.01 * len(clean)) and not gone & {i for i, _ in rows}

    second = keep(copies(spark, first, SF))
    assert ids(second) & {top + 1, top + 2, top + 3} == {top + 1}
    texts = {r.doc_id: " ".join((r.text or "").split()) for r in first.collect()}
    assert second.count() == len(set(texts.values()))

    third = keep(near(spark, second, SF))
    assert ids(third) & {top + 10 + i for i in range(5)} == {top + 10} and {top + 1, top + 30} <= ids(third)
    assert second.count() - third.count() >= 4

    fourth = keep(mixed(spark, third, SF))
    assert ids(fourth) <= ids(third) and fourth.count() > 0
    times = fourth.groupBy("doc_id").count().agg({"count": "max"}).first()[0]
    assert times <= 2
    assert encoded(spark, fourth, SF).count() == fourth.count()


def test_run_gives_the_same_again(spark):
    a, b = (sorted((r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect()) for _ in range(2))
    assert a == b and a


def test_entry_without_the_package(tmp_path):
    """The other queries stay when the subpackage and the pipeline are gone."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(corpus_pipeline.__file__).parent
    shutil.copytree(root / "tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and not any(n.startswith('op') or n == 'pipeline' for n in q); e.oracle_sql()"
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path), "PATH": ""}).returncode == 0


if __name__ == "__main__":
    pytest.main([__file__])
