"""Query of the secret finder."""

from pyspark.sql import functions as F

from lanthorn.llm.secret_scan import KINDS, find_secrets, joined
from lanthorn.session import read_table, spread


def op13_secret_scan(spark, sf_dir):
    found = find_secrets(spread(read_table(spark, sf_dir, "documents").select("doc_id", "text")))

    def number(column, kind):
        return F.size(F.filter(column, lambda x: x["k"] == KINDS.index(kind))).cast("bigint")

    return found.select("doc_id", *[number("base", k).alias(f"n_{k}") for k in KINDS[:3]],
                        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
                        number("spans", "markov").alias("n_markov"))


QUERIES = {"op13_secret_scan": op13_secret_scan}
