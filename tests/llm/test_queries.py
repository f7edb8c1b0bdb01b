"""Registered queries on tables with columns that clash."""

from tenure.llm import queries


def test_labels_with_an_id_column(spark, tmp_path):
    rows = [(i, i % 2, i % 2, 7, "x") for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int, id int, text string").write.parquet(f"{tmp_path}/labels.parquet")
    assert queries._labels(spark, str(tmp_path)).columns == ["id", "quality", "toxic"]
