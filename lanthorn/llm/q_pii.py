"""Query of the personal-data finder."""

from pyspark.sql import functions as F

from lanthorn.llm.pii import KINDS, find_personal_data, joined
from lanthorn.session import read_table, spread


def op3_personal_data(spark, sf_dir):
    found = find_personal_data(spread(read_table(spark, sf_dir, "documents").select("doc_id", "text")))

    def number(column, kind):
        return F.size(F.filter(column, lambda x: x["k"] == KINDS.index(kind))).cast("bigint")

    return found.select("doc_id", *[number("base", k).alias(f"n_{k}") for k in KINDS[:4]],
                        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
                        number("spans", "ctx").alias("n_ctx"))


QUERIES = {"op3_personal_data": op3_personal_data}
