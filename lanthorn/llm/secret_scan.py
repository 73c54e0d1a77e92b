"""Secrets: base patterns and character Markov models, in DataFrame functions only.

*Base.*  Three kinds by regular expression and check (an assignment to a secret's name, an access key, a long
hexadecimal string), leftmost and non-overlapping per kind.

*Models.*  Two Markov chains over characters, one of random strings and one of ordinary identifiers, are trained from
labelled samples: the values of the base matches are random, the words that several texts without a base match
share are ordinary (a random string hardly recurs).  Both samples are bounded, by hash order: ``SECRETS`` distinct
values, and the distinct words of ``ORDINARY_TEXTS`` distinct whole texts that occur in ``COMMON`` of them at least.
Each chain counts the transitions between characters (start and digits, A-Z, a-z and the signs ``+ / _ = -``) and
backs off to the characters' own shares, which are equal where there is no sample.
A token's score is its log-likelihood ratio, the sum over its transitions of log P(random) - log P(ordinary).
Tokens of 16 characters or more, one of them a letter, score as secrets from ``TOTAL`` in all and
``MEAN`` per transition; outside all base matches they become spans of kind ``markov``.

Defined cases: null text counts as empty and has no spans; repeated rows each get their spans; an empty table gives
an empty result; extra columns are not read; null ids are returned; offsets are code points, end exclusive.  Texts are never cut.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanthorn.llm.common import id_and_text, written
from lanthorn.llm.folds import placed

KINDS = ("assign", "access", "hex", "markov")
#: pattern (possessive forms, the same matches), a cheap test that a match needs, and what is left of a match to check
ASSIGN = r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?"
VALUE = r"[A-Za-z0-9+/_.=-]++"
PATTERNS = {
    "assign": (ASSIGN + VALUE, r"(?i)(?:passw|secret|token|api_?key)"),
    "access": (r"AKIA[A-Z0-9]++", r"AKIA[A-Z0-9]{16}"),
    "hex": (r"(?<![0-9a-f])[0-9a-f]{24,}+", r"[0-9a-f]{24}"),
}
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: tokens that the models score: 16 characters or more, one of them a letter, no letter, digit or sign of theirs beside them
TOKEN = r"(?<![\p{L}\p{N}+/_=-])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{16,}+(?![\p{L}\p{N}])"
WORD = r"[A-Za-z0-9_]++"
ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_=-"
SECRETS = 20_000
ORDINARY_TEXTS = 2_000
COMMON = 2
BACKOFF = 20.0
TOTAL = 12.0
MEAN = 0.5
SPANS = "array<struct<s:int,k:int,e:int>>"


def _value(kind: str, m: Column) -> Column:
    """The part of a match whose length counts: of an assignment the value, else all."""
    return F.regexp_replace(m, "^" + ASSIGN, "") if kind == "assign" else m


def spans(text: Column, pattern: str, needs: Column, valid, kind: int) -> Column:
    """Array of (s, k, e) of the matches that are valid: the pieces between matches and the matches interleave."""
    pieces, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.arrays_zip(pieces.alias("p"), matches.alias("m"))
    none = F.array().cast(SPANS)

    def element(x):
        start = F.length(x["p"])
        end = start + F.coalesce(F.length(x["m"]), F.lit(0))
        ok = F.when(x["m"].isNotNull(), valid(x["m"])).otherwise(False)
        one = F.array(F.struct(start.alias("s"), F.lit(kind).alias("k"), end.alias("e")))
        return F.struct(end.alias("len"), F.when(ok, one).otherwise(none).alias("found"))

    def shifted(x, by):
        return F.struct((x["s"] + by).alias("s"), x["k"].alias("k"), (x["e"] + by).alias("e"))

    return F.when(needs, placed(F.transform(zipped, element), none, shifted)).otherwise(none)


def base_spans(text: Column) -> Column:
    found = [spans(text, p, text.rlike(needs), lambda m, k=k: F.length(_value(k, m)) >= LEAST[k], KINDS.index(k))
             for k, (p, needs) in PATTERNS.items()]
    return F.array_sort(F.concat(*found))


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, base, secrets) per document, written once: base spans and the values of base matches; no text."""
    rows = id_and_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    text = F.col("text")
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("h"), base_spans(text).alias("base"))
    value = F.transform("base", lambda b: F.substr(text, b["s"] + 1, b["e"] - b["s"]))
    return written(rows.select("doc_id", "h", "base", F.transform(value, lambda v: _value("assign", v)).alias("secrets")), "secret-scan")


def _transitions(strings: DataFrame) -> dict[tuple[str, str], int]:
    """Counts of the neighbouring characters of ``strings`` (value); at most one number per pair of the alphabet."""
    kept = strings.select(F.concat(F.lit(" "), F.regexp_replace("value", r"[^A-Za-z0-9+/_=-]", "")).alias("v")).where("length(v) > 1")
    pairs = kept.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("v") - 1), lambda i: F.substr("v", i, F.lit(2)))).alias("pair"))
    return {(r["pair"][0], r["pair"][1]): r["n"] for r in pairs.groupBy("pair").agg(F.count("*").alias("n")).collect()}


def _chain(counts: dict) -> dict[tuple[str, str], float]:
    """log P(next | before) of every pair: counts raised by ``BACKOFF`` times the next character's own share, itself raised by one."""
    own = {b: 1 + sum(counts.get((a, b), 0) for a in " " + ALPHABET) for b in ALPHABET}
    everything = sum(own.values())
    out = {}
    for a in " " + ALPHABET:
        total = sum(counts.get((a, b), 0) for b in ALPHABET) + BACKOFF
        for b in ALPHABET:
            out[a, b] = math.log((counts.get((a, b), 0) + BACKOFF * own[b] / everything) / total)
    return out


def trained(docs: DataFrame, scan: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            secrets: int = SECRETS, ordinary_texts: int = ORDINARY_TEXTS) -> dict[tuple[str, str], float]:
    """Log-likelihood ratio of every transition, random against ordinary."""
    random = scan.select(F.explode("secrets").alias("value")).distinct()
    random = random.orderBy(F.xxhash64("value"), "value").limit(secrets)
    chosen = scan.where(F.size("base") == 0).select("h").distinct().orderBy("h").limit(ordinary_texts)
    texts = id_and_text(docs, id_col, text_col).select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    texts = texts.join(F.broadcast(chosen), "h", "left_semi").groupBy("h").agg(F.min("text").alias("text"))
    words = texts.select(F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))).alias("value"))
    words = words.groupBy("value").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON)
    random, ordinary = _chain(_transitions(random)), _chain(_transitions(words))
    return {pair: random[pair] - ordinary[pair] for pair in random}


def ratio(token: Column, model: dict[tuple[str, str], float]) -> Column:
    """A token's log-likelihood ratio under the model, a table addressed by two neighbouring characters."""
    table = ",".join(repr(round(model[a, b], 9)) for a in " " + ALPHABET for b in ALPHABET)
    table = F.split(F.lit(table), ",").cast("array<double>")
    place = lambda c: F.locate(c, F.lit(ALPHABET)) if isinstance(c, str) else F.instr(F.lit(ALPHABET), c)

    def step(a, c):
        now = place(c)
        return F.struct(now.alias("before"), (a["sum"] + F.element_at(table, (a["before"] * len(ALPHABET) + now).cast("int"))).alias("sum"))

    return F.aggregate(F.split(token, ""), F.struct(F.lit(0).alias("before"), F.lit(0.0).alias("sum")), step, lambda a: a["sum"])


def is_random(token: Column, model: dict, total: float = TOTAL, mean: float = MEAN) -> Column:
    return ratio(token, model) >= F.greatest(F.lit(total), F.lit(mean) * F.length(token))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", total: float = TOTAL, mean: float = MEAN) -> DataFrame:
    """(doc_id, base, spans): both arrays hold (s, k, e) in order of place, then kind."""
    scan = scanned(docs, id_col, text_col)
    model = trained(docs, scan, id_col, text_col)
    rows = id_and_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    text, valid = F.col("text"), lambda m: is_random(m, model, total, mean)
    tokens = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    rows = rows.select("doc_id", "text", base_spans(text).alias("base"), F.exists(tokens, valid).alias("some"))
    found = spans(text, TOKEN, F.col("some"), valid, KINDS.index("markov"))
    rows = rows.select("doc_id", "base", found.alias("found"))
    outside = F.filter("found", lambda x: ~F.exists("base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", outside)).alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(kinds, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))))
