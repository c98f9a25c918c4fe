import sys
from pathlib import Path

import __spark_entry__ as E
import corpus_pipeline as P
from mise.llm import exact_dedup, simhash, toxicity
from mise.llm.common import read_table

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = set(E.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert "pipeline" in names and set(E.oracle_sql()) <= names


def test_stages(spark):
    docs = read_table(spark, SF, "documents")
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact_dedup", "simhash", "mixing", "sentencepiece"]
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        if name != "sentencepiece":
            assert out.columns == docs.columns
        kept = out.select("doc_id").distinct().count()
        if name == "toxicity":
            model = toxicity.fit(docs, read_table(spark, SF, "labels"))
            want = toxicity.scored(docs, model).filter(f"score < {toxicity.THRESHOLD}").count()
        elif name == "exact_dedup":
            want = exact_dedup.copy_groups(docs).filter("kept").count()
        elif name == "simhash":
            want = simhash.near_duplicates(docs).select("component_id").distinct().count()
        else:
            want = kept
        assert kept == want > 0


def test_run(spark):
    out = P.run(spark, SF)
    rows = out.collect()
    assert rows and all(len(r["ids"]) == r["n_tokens"] for r in rows)


def test_entry_without_the_corpus_operators():
    """With both removed, the entry module still imports and has the other queries."""
    import importlib
    held = {n: m for n, m in sys.modules.items() if n == "corpus_pipeline" or n == "mise.llm" or n.startswith("mise.llm.")}
    try:
        for n in held:
            sys.modules[n] = None
        sys.modules["corpus_pipeline"] = None
        spec = importlib.util.spec_from_file_location("entry_alone", Path(E.__file__))
        alone = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(alone)
        assert alone.queries() and not any(n.startswith("op") and "_" in n and n[2].isdigit() for n in alone.queries())
    finally:
        sys.modules.update(held)
