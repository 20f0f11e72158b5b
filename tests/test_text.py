import uuid

from noisyframe.session import checkpoint_dir
from noisyframe.sources.text import read_labelled_text


def test_multiline_records(spark):
    path = f"{checkpoint_dir(spark)}/text-{uuid.uuid4().hex}.txt"
    spark.createDataFrame([("__label__a one\ntwo\n__label__b three",)], "value string").coalesce(1) \
        .write.text(path)
    rows = sorted((r.label, r.text) for r in read_labelled_text(spark, path).collect())
    assert rows == [("a", "one __newline__ two"), ("b", "three")]
