"""The pipeline, stage by stage, against plain versions."""

import brute
import corpus_pipeline as p
import test_tokens

from quillon.llm import entry


def test_stages(spark, sf_dir):
    docs = entry.table(spark, sf_dir, "documents")
    items = [(r.item_id, r.text) for r in entry.table(spark, sf_dir, "benchmark").collect()]
    names = docs.columns
    by_name = dict(p.STAGES)
    assert [n for n, _ in p.STAGES] == list(by_name) and len(p.STAGES) == 5

    def step(name):
        nonlocal docs
        before = docs.collect()
        docs = by_name[name](spark, docs, sf_dir)
        after = docs.collect()
        docs = spark.createDataFrame(after, docs.schema)
        return before, after

    before, after = step("quality rules")
    assert docs.columns == names
    labels = {r.doc_id: r.quality for r in entry.table(spark, sf_dir, "labels").collect()}
    kept = {r.doc_id for r in after}
    assert not [r.doc_id for r in before if labels.get(r.doc_id) == 1 and r.doc_id not in kept and not brute.quality_counts(r.text)["base_failed"]]
    assert not [r.doc_id for r in after if brute.quality_counts(r.text)["base_failed"]]

    before, after = step("line dedup")
    assert docs.columns == names
    want = brute.dedup_lines([(r.doc_id, r.text) for r in before])
    assert sorted((r.doc_id, r.text, r.n_chars) for r in after) == sorted((r.doc_id, t, len(t)) for r, (t, _, _) in zip(before, want, strict=True))

    before, after = step("n-gram Jaccard join")
    assert docs.columns == names
    before.sort(key=lambda r: r.doc_id)
    _, low = brute.components([r.text for r in before], 5, 80)
    assert sorted(r.doc_id for r in after) == [r.doc_id for i, r in enumerate(before) if low[i] == i]

    before, after = step("benchmark decontamination")
    assert docs.columns == names
    assert {r.doc_id for r in after} == {r.doc_id for r in before if not brute.hits(r.text, items)[1]}

    before, after = step("best-fit packing")
    test_tokens.check_packing(after, [(r.doc_id, r.text) for r in before])
    assert all(test_tokens.crc(r.ids) == r.ids_crc32 for r in after)
    assert sorted(map(tuple, p.run(spark, sf_dir).select("doc_id", "piece", "ids_crc32").collect())) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in after)
