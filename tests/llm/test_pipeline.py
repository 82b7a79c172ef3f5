"""The corpus pipeline: each stage takes effect on what its predecessor kept."""

import corpus_pipeline as cp
from helpers import empty, odd
from skuflow.llm import decontamination, jaccard, secrets
from skuflow.llm.common import table, written

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    columns, seen = docs.columns, [docs.count()]
    for name, stage in cp.STAGES:
        before, docs = docs, written(stage(spark, docs, SF), "stage")
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert ids <= {r["doc_id"] for r in before.select("doc_id").collect()} and docs.count() == len(ids)
        seen.append(len(ids))
        if name != "mixing sources":
            assert docs.columns == columns
        if name == "n-gram Jaccard join":
            assert jaccard.classes(docs).where("n_links > 0").count() == 0
        if name == "benchmark decontamination":
            assert decontamination.contaminated(docs, table(spark, SF, "benchmark")).count() == 0
        if name == "secret scans":
            live = secrets.secret_scan(before).where("n_live > 0").count()
            assert docs.count() == before.count() and docs.exceptAll(before).count() == live
    assert seen[0] >= seen[1] > seen[2] > seen[3] and seen[4] == seen[3] and seen[5] > 0.3 * seen[4]
    assert docs.where("taken <= 0 or taken > 3 * size").count() == 0


def test_odd_and_empty_tables(spark):
    for docs in (odd(spark), empty(spark)):
        for _, stage in cp.STAGES:
            docs = written(stage(spark, docs, SF), "stage")
    assert docs.count() == 0
