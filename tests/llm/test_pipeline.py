"""The pipeline stage by stage against plain versions."""

import corpus_pipeline
from buyerscope.llm import decontamination, mixing, toxicity
from buyerscope.llm.common import table
from buyerscope.sources.staging import staged
from tests.llm import brute
from tests.llm.test_corpus_operators import check_shards, leaks_by_brute_force

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = table(spark, SF, "documents")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(staged(stage(spark, kept[-1], SF)))
    for df in kept[1:-1]:
        assert sorted(df.columns) == sorted(docs.columns)
    ids = [sorted(r.doc_id for r in df.collect()) for df in kept]

    scores = toxicity.scores(docs, toxicity.fit(docs, table(spark, SF, "labels"))).collect()
    assert ids[1] == sorted(r.doc_id for r in scores if not r.predicted)

    rows = [(r.doc_id, r.text) for r in kept[1].collect()]
    assert ids[2] == sorted({c for _, _, c in brute.simhash(rows)})

    items = decontamination.read_items(table(spark, SF, "benchmark"), 0, 1)
    bad = {d for d, _ in leaks_by_brute_force([(r.doc_id, r.text) for r in kept[2].collect()], items)}
    assert ids[3] == [i for i in ids[2] if i not in bad]

    plan = mixing.plan(kept[3])
    for source, (_, target, *_rest) in plan.items():
        own = [len(brute.words(r.text)) for r in kept[4].collect() if r.source == source]
        whole = [len(brute.words(r.text)) for r in kept[3].collect() if r.source == source]
        assert abs(sum(own) - target) <= max(whole)
    assert all(ids[4].count(i) <= 2 for i in set(ids[4]))

    last = kept[5].collect()
    assert ids[5] == ids[4]
    check_shards([(r.shard, r.slot) for r in last], [len((r.text or "").encode()) + 8 for r in last], 24)


def test_run_gives_the_last_stage(spark):
    df = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "text", "shard", "slot"} <= set(df.columns) and df.count() > 0
