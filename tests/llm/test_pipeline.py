"""The pipeline: each stage's decisions take effect, and columns stay."""

import corpus_pipeline
from weftline.llm import op2_mixing, op7_toxicity, op8_chosen_path
from weftline.llm.common import table, written

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = written(stage(spark, docs, SF), "test")
        assert docs.columns == columns, name
        kept.append((name, {r["doc_id"] for r in before.select("doc_id").collect()}, {r["doc_id"] for r in docs.select("doc_id").collect()}, before))
    by = {k[0]: k for k in kept}
    assert all(after <= before for _, before, after, _ in kept)
    _, before, after, rows = by["toxicity"]
    model = op7_toxicity.fit(rows, table(spark, SF, "labels"))
    assert after == {r["doc_id"] for r in op7_toxicity.score(rows, model).where("predicted = 0").collect()}
    _, before, after, rows = by["near_duplicates"]
    assert after == {r["class_id"] for r in op8_chosen_path.join(rows).collect()}
    _, before, after, rows = by["suffixes"]
    assert before == after
    _, before, after, rows = by["mixing"]
    assert after == {r["doc_id"] for r in op2_mixing.sample(rows).where("kept").collect()}
    assert {r["doc_id"] for r in corpus_pipeline.packing(spark, docs, SF).collect()} == after


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0 and corpus_pipeline.ORACLE_SQL is None


def test_no_documents(spark):
    none = table(spark, SF, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        none = written(stage(spark, none, SF), "test-empty")
        assert none.count() == 0


def test_awkward_documents(spark, docs, texts, tmp_path):
    """Null, empty, long and repeated rows, ids of several texts, rows without id and columns with clashing names pass through all stages."""
    more = spark.createDataFrame([(None, "no id one two three four"), (None, None), (0, "another text of the first id, unlike the other one in all its words"), (402, ""), (600, texts[0][1].upper())], "doc_id long, text string")
    docs.unionByName(more, allowMissingColumns=True).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(k, k % 2, int(k % 7 == 0)) for k, _ in enumerate(texts)] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    at = table(spark, str(tmp_path), "documents")
    rows = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = written(stage(spark, at, str(tmp_path)), "test")
        assert at.columns == docs.columns, name
        rows[name] = [(r["doc_id"], r["text"]) for r in at.collect()]
    near = rows["near_duplicates"]
    kept = set(rows["toxicity"])  # with labels at random the models reject what they like
    assert {(i, t) for i, t in near if i is None} == {(i, t) for i, t in kept if i is None} and len(near) == len(set(near)) and len(kept) > 20
    for k in range(12):  # of exact and near copies one stays, the one with the smallest id
        copies = [i for i, t in kept if t in (texts[k][1], texts[k][1].upper()) or i == 200 + k]
        assert sum(i in copies and t != "another text of the first id, unlike the other one in all its words" for i, t in near) == bool(copies), k
    assert {i for i, _ in rows["suffixes"]} == {i for i, _ in near} and set(i for i, _ in rows["mixing"]) <= {i for i, _ in near}
    packed = corpus_pipeline.packing(spark, at, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == {i for i, _ in rows["mixing"]}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(packed)
