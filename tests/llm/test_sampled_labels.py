import pytest

from segmint.llm.common import sampled_labels


def test_every_label_value_is_kept(spark):
    labels = spark.range(12_000).selectExpr("id AS doc_id", "concat('l', least(id % 100, id)) AS lang")
    got = sampled_labels(labels, "doc_id", "lang", 60).groupBy("lang").count().collect()
    assert len(got) == 100 and sum(r["count"] for r in got) <= 1.2 * 60 * 64
    with pytest.raises(ValueError):
        sampled_labels(labels, "doc_id", "lang", 20).count()
