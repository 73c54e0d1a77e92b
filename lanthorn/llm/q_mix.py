"""Query of the mix to target weights."""

from lanthorn.llm.mixing import mixed
from lanthorn.session import read_table


def op5_mix_to_targets(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixed(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


QUERIES = {"op5_mix_to_targets": op5_mix_to_targets}
