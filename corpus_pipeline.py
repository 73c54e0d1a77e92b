"""Corpus pipeline: quality rules, near duplicates, personal data, mix, SentencePiece ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next one's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from lanthorn.llm.common import written
from lanthorn.llm.jaccard import one_per_component
from lanthorn.llm.mixing import repeated
from lanthorn.llm.pii import redact
from lanthorn.llm.q_pieces import digest
from lanthorn.llm.quality_rules import drop_rejected, fit_ratio
from lanthorn.session import read_table, spread

#: near duplicates: Jaccard similarity of the sets of five-word shingles, in percent, from which two texts are linked
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def quality_rules(spark, docs, sf_dir):
    """Documents that the base rules or the log-likelihood ratio reject go."""
    trusted = read_table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return drop_rejected(spread(docs), fit_ratio(docs, trusted))


def near_duplicates(spark, docs, sf_dir):
    """One document of each component of the n-gram Jaccard join stays, that of the smallest id."""
    return one_per_component(docs, width=SHINGLE_WORDS, percent=SIMILAR_PERCENT)


def personal_data(spark, docs, sf_dir):
    """Every span of personal data becomes its kind in angle brackets; n_chars follows."""
    return redact(docs, length_col="n_chars")


def mix(spark, docs, sf_dir):
    """Documents are dropped or repeated so that the sources meet their token targets."""
    return repeated(docs)


def sentence_pieces(spark, docs, sf_dir):
    """Pieces of each remaining text: their number, the hash of their ids, and the round trip."""
    return digest(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", personal_data),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", sentence_pieces),
]

#: the stages iterate and segment text, which SQL can't express; tests hold them against brute force
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
