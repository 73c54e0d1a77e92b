"""Query of the quality rules."""

from lanthorn.llm.quality_rules import apply_rules, fit_ratio
from lanthorn.session import read_table, spread


def op9_quality_rules(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = read_table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return apply_rules(spread(docs), fit_ratio(docs, trusted))


QUERIES = {"op9_quality_rules": op9_quality_rules}
