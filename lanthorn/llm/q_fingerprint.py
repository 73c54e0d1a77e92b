"""Query of the document fingerprints."""

from lanthorn.llm.fingerprint import fingerprints
from lanthorn.session import read_table


def op6_document_fingerprints(spark, sf_dir):
    return fingerprints(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op6_document_fingerprints": op6_document_fingerprints}
