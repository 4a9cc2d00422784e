import os

import corpus_pipeline
from ratelake.llm.queries import oracle_sql, queries
from ratelake.llm.shared import table

SF = "/root/testdata/sf0.001"


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14))
    assert set(oracle_sql()) <= set(queries())


def test_stages_one_by_one(spark, root):
    docs, columns, seen = table(spark, SF, "documents"), table(spark, SF, "documents").columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert sorted(out.columns) == sorted(columns), name
        out.write.parquet(os.path.join(root, str(k)))
        docs = spark.read.parquet(os.path.join(root, str(k)))
        seen.append(docs.count())
    rows = docs.orderBy("start").collect()
    assert seen[0] >= seen[1] >= seen[2] <= seen[3] == seen[4] and seen[2] > 0
    assert [r.start for r in rows] == [sum(r.n_tokens for r in rows[:i]) for i in range(len(rows))]
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)
    whole = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, rows))
