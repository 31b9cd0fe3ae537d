from collections import Counter

import corpus_pipeline as P
from sluice.llm.common import documents, stage


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    docs = documents(spark, sf)
    seen = [docs]
    for name, step in P.STAGES:
        seen.append(stage(step(spark, seen[-1], sf), "test"))
    assert all(d.columns == docs.columns for d in seen[:-1])
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in seen]
    assert ids[1] < ids[0] and ids[2] <= ids[1] and ids[3] == ids[2] and ids[4] <= ids[3] and ids[5] == ids[4]
    copies = Counter(r.doc_id for r in seen[4].select("doc_id").collect())
    assert max(copies.values()) <= 3
    assert Counter(r.doc_id for r in seen[5].filter("piece = 0").collect()) == copies
