"""Query of the language identification."""

from lanthorn.llm.langid import identify
from lanthorn.session import read_table, spread


def op7_language_id(spark, sf_dir):
    return identify(spread(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")))


QUERIES = {"op7_language_id": op7_language_id}
