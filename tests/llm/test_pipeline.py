"""The pipeline's stages on the smallest tables, against the operators' own decisions and brute force."""

import corpus_pipeline
from groundstop.llm import toxicity
from test_queries import brute_components


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, {}
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, now, sf_dir).write.parquet(path)
        before, now = now, spark.read.parquet(path)
        kept[name] = now
        if name != "packing":
            assert now.columns == columns
            assert now.exceptAll(before).count() == 0
    clean = {r.doc_id for r in toxicity.score(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))).where("predicted = 0").collect()}
    assert {r.doc_id for r in kept["toxicity"].collect()} == clean
    plain = lambda t: "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
    texts = [plain(r.text) for r in kept["exact_dedup"].collect()]
    assert len(set(texts)) == len(texts) and set(texts) == {plain(r.text) for r in kept["toxicity"].collect()}
    rows = [(r.doc_id, r.text) for r in kept["exact_dedup"].collect()]
    assert sorted(repr(r.doc_id) for r in kept["jaccard_join"].collect()) == sorted({c for _, n, c in brute_components(rows)[0]})
    assert {r.doc_id for r in kept["packing"].select("doc_id").distinct().collect()} == {r.doc_id for r in kept["decontamination"].collect()}
    assert corpus_pipeline.run(spark, sf_dir).count() == now.count()
