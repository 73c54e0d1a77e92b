"""Query of the quality classifier."""

from lanthorn.llm.quality_cnn import classify
from lanthorn.session import read_table, spread


def op8_quality_classifier(spark, sf_dir):
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return classify(spread(read_table(spark, sf_dir, "documents").select("doc_id", "text")), labels)


QUERIES = {"op8_quality_classifier": op8_quality_classifier}
