"""The pipeline's stages on tables whose extra columns have the names that the stages use themselves."""

from pyspark.sql import functions as F

from lanthorn.llm import jaccard, mixing, pii
from lanthorn.llm.common import free_names
from tests.llm.llm_cases import odd

NAMES = ("doc", "hash", "spans_", "Mix_id", "mix_copies", "mix_words", "mix_n", "gone_id", "copy_of_doc_id", "found", "component_id")


def clashing(spark):
    df = odd(spark)
    for i, name in enumerate(NAMES):
        df = df.withColumn(name, F.lit(f"own {i}"))
    return df


def test_stages_keep_clashing_columns(spark):
    docs = clashing(spark)
    for stage in (pii.redact, mixing.repeated, jaccard.one_per_component):
        out = stage(docs)
        assert out.columns == docs.columns
        for i, name in enumerate(NAMES):
            assert [r[0] for r in out.select(name).distinct().collect()] == [f"own {i}"], (stage.__name__, name)


def test_free_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, B int")
    assert free_names(df, "a", "b", "c", "a") == ["a_", "b_", "c", "a__"]
