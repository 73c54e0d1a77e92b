"""Query of the SentencePiece encoding and decoding."""

import public_tokenizers
from pyspark.sql import functions as F

from lanthorn.llm.pieces import PieceModel, encode
from lanthorn.session import read_table, spread

MODEL = "piece_bpe_32k.model"


def digest(docs):
    """Per document: number of pieces and of byte pieces, hash of the ids, and whether decoding gives the text back."""
    model = PieceModel(public_tokenizers.path(MODEL))
    rows = encode(docs, model, back=True)
    return rows.select("doc_id", F.length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_chars"), "n_pieces", "n_byte_pieces",
                       F.sha2("ids", 256).alias("ids_sha256"),
                       (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("round_trip"))


def op10_sentencepiece(spark, sf_dir):
    return digest(spread(read_table(spark, sf_dir, "documents").select("doc_id", "text")))


QUERIES = {"op10_sentencepiece": op10_sentencepiece}
