"""A row that stands twice has the blocks of one."""

from pyspark.sql import functions as F

from skuflow.llm import licenses
from skuflow.llm.queries import queries

SF = "/root/testdata/sf0.001"


def test_blocks_of_repeated_rows(spark):
    once = {r["doc_id"]: r for r in queries()["op1_license_scan"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where(
        F.col("doc_id").isin([i for i, r in once.items() if r["n_blocks"]]))
    rows = licenses.license_scan(docs.unionByName(docs).unionByName(docs)).collect()
    assert rows and len(rows) == 3 * docs.count()
    assert all(r == once[r["doc_id"]] for r in rows)
