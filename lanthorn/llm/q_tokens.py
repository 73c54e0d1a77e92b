"""Query of the token counts."""

import public_tokenizers

from lanthorn.llm.tokens import count_tokens
from lanthorn.session import read_table, spread

TOKENIZER = "word_bpe_49k.json"


def op2_token_counts(spark, sf_dir):
    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return count_tokens(docs, public_tokenizers.path(TOKENIZER))


QUERIES = {"op2_token_counts": op2_token_counts}
