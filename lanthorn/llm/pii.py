"""Personal data: base patterns and bootstrapped contextual extraction, in DataFrame functions only.

*Base.*  Four kinds by regular expression and check (e-mail, IP address, card number with Luhn digit,
phone number), leftmost and non-overlapping per kind.  A text split by a pattern and the
pattern's matches interleave, so running lengths give every match its place.

*Bootstrapping.*  Identifier-like tokens (seven digits or more, four dotted numbers, or an at-sign) and runs of
digit groups set apart by blanks (seven digits or more together) are instances; one that meets a base match is a seed.
An instance's patterns hold the word before it, or the word after it, on two levels: with its shape (each digit
and letter folded), and with its class alone (mail, dotted address, number of any grouping, else the shape with runs
folded), so seeds of all lengths and groupings speak for one word.  Each level is scored by itself, round its
pattern-instance graph:
a pattern scores the mean of its distinct instances (one doubtful instance added), an instance that
is no seed the mean of its patterns.  Patterns that end above ``CONFIDENCE`` with ``SUPPORT`` distinct seeds or
more are trusted, and instances with a trusted pattern outside all base matches become spans of kind ``ctx``
(of a span inside another only the outer one stays).

Defined cases: null text counts as empty and has no spans; repeated rows each get their spans; an empty
table gives an empty result; without seeds nothing is added; extra columns are not read; null ids are
returned; offsets are code points, end exclusive.  Texts are never cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanthorn.llm.common import free_names, id_and_text, written
from lanthorn.llm.folds import once, placed

KINDS = ("email", "ip", "card", "phone", "ctx")
#: possessive forms of the base patterns (same matches, no deep recursion), with a cheap test that a match needs; a match
#: starts where a run of its characters begins or the last match ended, so a long run is tried once, not from every character
PATTERNS = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"@[A-Za-z0-9-]"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){11}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
}
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
TOKEN = r"(?<!\S)\S*[0-9@]\S*"
#: digit groups set apart by blanks; each ends at a blank, the end or closing marks (possessive, so no deep recursion)
_DIGITS = r"[0-9]++(?:[().+-]++[0-9]++)*+"
_GROUP = rf"(?:\(\+?+{_DIGITS}\)|{_DIGITS})(?![^\s.,;:!?)\]}}>\"'])"
RUN = rf"(?<![^\s(\[{{<\"'])\+?+{_GROUP}(?:\x20++{_GROUP})++"
OPENING, CLOSING = r"^[(\[{<\"']+", r"(?<![.,;:!?)\]}>\"'])[.,;:!?)\]}>\"']++$"
CONTEXT_CHARS = 60
MIN_DIGITS = 7
DOTTED = r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"
#: classes of instances; any other is its shape with runs of letters and of digits folded to one
CLASSES = {"mail": r"^[^@/]+@[^@/]+$", "dotted": DOTTED, "number": r"^[0-9\x20()+./-]+$"}
ROUNDS = 3
CONFIDENCE = 0.8
SUPPORT = 4
BROADCAST_SPANS = 1 << 18
SPANS = "array<struct<s:int,k:int,e:int>>"
CANDIDATES = "array<struct<s:int,e:int,value:string,left:string,right:string>>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, r"[^0-9]", "")


def _luhn(d: Column) -> Column:
    """Whether a string of digits passes: every second digit from the right doubled, digit sums added."""
    def add(total, i):
        v = F.substr(d, F.length(d) - i + 1, F.lit(1)).cast("int")
        twice = v * 2
        return total + F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(v)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(f"^(?:{_PART}\\.){{3}}{_PART}$")
    if kind == "card":
        return F.when(F.length(_digits(m)).between(12, 19), _luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def _spans(kind: str, text: Column) -> Column:
    """Array of (s, k, e) of a kind's valid matches."""
    pattern, needs = PATTERNS[kind]
    k = KINDS.index(kind)
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    none = F.array().cast(SPANS)

    def element(x):
        start = F.length(x["p"])
        end = start + F.coalesce(F.length(x["m"]), F.lit(0))
        ok = F.when(x["m"].isNotNull(), _valid(kind, x["m"])).otherwise(False)
        one = F.array(F.struct(start.alias("s"), F.lit(k).alias("k"), end.alias("e")))
        return F.struct(end.alias("len"), F.when(ok, one).otherwise(none).alias("found"))

    def shifted(x, by):
        return F.struct((x["s"] + by).alias("s"), x["k"].alias("k"), (x["e"] + by).alias("e"))

    return F.when(text.rlike(needs), placed(F.transform(zipped, element), none, shifted)).otherwise(none)


def _candidates(text: Column, pattern: str, needs: str) -> Column:
    """Array of identifier-like matches, tokens without the marks around them, with the words beside (digits folded, lower case)."""
    opening = (lambda m: F.regexp_replace(m, OPENING, "")) if pattern == TOKEN else (lambda m: m)
    closing = (lambda m: F.regexp_replace(m, CLOSING, "")) if pattern == TOKEN else (lambda m: m)
    pieces, tokens = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def zipped(pieces, tokens):
        """Each match with the piece before it, the match before that, and the piece after it."""
        return F.arrays_zip(pieces.alias("p"), tokens.alias("m"), F.concat(F.array(F.lit("")), tokens).alias("b"),
                            F.slice(pieces, F.lit(2), F.size(pieces)).alias("q"))

    none = F.array().cast(CANDIDATES)
    fold = lambda w: F.regexp_replace(F.lower(w), r"[0-9]", "9")

    def element(x):
        m = F.coalesce(x["m"], F.lit(""))
        begin = F.length(x["p"])
        core = closing(opening(m))
        start = begin + F.length(m) - F.length(opening(m))
        before = F.regexp_extract(F.right(x["p"], F.lit(CONTEXT_CHARS)), r"(\S+)\s*$", 1)
        left = F.when(before == "", F.regexp_extract(F.coalesce(x["b"], F.lit("")), r"(\S*)$", 1)).otherwise(before)
        right = F.regexp_extract(F.left(x["q"], F.lit(CONTEXT_CHARS)), r"^\s*(\S+)", 1)
        one = F.array(F.struct(start.cast("int").alias("s"), (start + F.length(core)).cast("int").alias("e"), F.lower(core).alias("value"),
                               fold(left).alias("left"), fold(right).alias("right")))
        wanted = (F.length(_digits(core)) >= MIN_DIGITS) | (F.contains(core, F.lit("@")) & (F.length(core) > 2)) | core.rlike(DOTTED)
        return F.struct((begin + F.length(m)).alias("len"), F.when(wanted, one).otherwise(none).alias("found"))

    def shifted(x, by):
        return F.struct((x["s"] + by).alias("s"), (x["e"] + by).alias("e"), *[x[c].alias(c) for c in ("value", "left", "right")])

    elements = once(F.struct(pieces.alias("p"), tokens.alias("m")), lambda z: F.transform(zipped(z["p"], z["m"]), element))
    return F.when(text.rlike(needs), placed(elements, none, shifted)).otherwise(none)


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, base, found) per document, written once: base spans, candidate tokens and runs; no text."""
    rows = id_and_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    text = F.col("text")
    base = F.concat(*[_spans(k, text) for k in PATTERNS])
    rows = rows.select("doc_id", F.xxhash64("text").alias("h"), F.array_sort(base).alias("base"),
                       F.concat(_candidates(text, TOKEN, "[0-9@]"), _candidates(text, RUN, r"[0-9]\)?\x20+\(?[0-9]")).alias("found"))
    return written(rows, "pii-scan")


def trusted_patterns(tokens: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: int = SUPPORT) -> DataFrame:
    """(pattern) trusted after ``rounds`` of scoring; ``tokens`` holds (value, seed, pattern)."""
    edges = written(tokens.groupBy("value", "pattern").agg(F.max("seed").alias("seed")), "pii-edges")
    score = edges.groupBy("value").agg(F.max("seed").cast("double").alias("score"))
    seeds = edges.groupBy("value").agg(F.max("seed").alias("is_seed"))
    patterns = None
    for _ in range(rounds):
        patterns = written(edges.join(score, "value").groupBy("pattern").agg(
            (F.sum("score") / (F.count("*") + 1)).alias("p")), "pii-patterns")
        score = written(edges.join(patterns, "pattern").groupBy("value").agg(F.avg("p").alias("mean")).join(seeds, "value").select(
            "value", F.when(F.col("is_seed") == 1, F.lit(1.0)).otherwise(F.col("mean")).alias("score")), "pii-instances")
    enough = edges.where("seed = 1").groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= support)
    return patterns.where(F.col("p") >= confidence).join(enough, "pattern", "left_semi").select("pattern")


def contextual(scan: DataFrame) -> DataFrame:
    """(doc_id, h, ctx): added spans of the documents that have some."""
    rows = scan.where(F.size("found") > 0).select("doc_id", "h", "base", F.explode("found").alias("t"))
    inside = F.exists("base", lambda b: (b["s"] < F.col("t.e")) & (F.col("t.s") < b["e"]))
    shape = F.regexp_replace(F.regexp_replace(F.col("t.value"), r"\p{L}", "a"), r"[0-9]", "9")
    kind = F.regexp_replace(F.regexp_replace(shape, r"a+", "a"), r"9+", "9")
    for name, form in reversed(CLASSES.items()):
        kind = F.when(F.col("t.value").rlike(form), F.lit(name)).otherwise(kind)

    def pattern(level, side, word, form):
        named = F.concat_ws("\u0001", F.lit(level), F.lit(side), word, form)
        # without the shape, the start or end of the text is no context
        return F.struct(F.lit(level).alias("level"), (F.when(F.col(word) != "", named) if level == "class" else named).alias("name"))

    beside = [pattern(level, side, word, form) for level, form in (("shape", shape), ("class", kind))
              for side, word in (("L", "t.left"), ("R", "t.right"))]
    rows = rows.select("doc_id", "h", "t.s", "t.e", "t.value", inside.cast("int").alias("seed"), F.explode(F.array(*beside)).alias("p"))
    # each level has instances of its own, so neither changes the other's scores
    rows = rows.where("p.name is not null").select(
        "doc_id", "h", "s", "e", F.concat_ws("\u0001", "p.level", "value").alias("value"), "seed", F.col("p.name").alias("pattern"))
    rows = written(rows, "pii-tokens")
    trusted = trusted_patterns(rows.select("value", "seed", "pattern"))
    hits = rows.where("seed = 0").join(trusted, "pattern").select("doc_id", "h", "s", "e").distinct()
    far_first = F.array_sort(F.collect_set(F.struct("s", (-F.col("e")).alias("back"))))

    def step(a, x):
        one = F.array(F.struct(x["s"].alias("s"), F.lit(KINDS.index("ctx")).alias("k"), (-x["back"]).alias("e")))
        return F.struct(F.greatest(a["at"], -x["back"]).alias("at"), F.when(-x["back"] > a["at"], F.concat(a["out"], one)).otherwise(a["out"]).alias("out"))

    outer = F.aggregate("ctx", F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("out")), step, lambda a: a["out"])
    return hits.groupBy("doc_id", "h").agg(far_first.alias("ctx")).withColumn("ctx", outer)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, base, spans): h is the hash of the text; both arrays hold (s, k, e) in order of place, then kind."""
    scan = scanned(docs, id_col, text_col)
    added = written(contextual(scan), "pii-added").toDF("doc", "hash", "ctx")
    rows = scan.join(added, scan.doc_id.eqNullSafe(added.doc) & (scan.h == added.hash), "left")
    both = F.array_sort(F.concat("base", F.coalesce("ctx", F.array().cast(SPANS))))
    return rows.select("doc_id", "h", "base", both.alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    one = lambda x: F.concat_ws(":", F.element_at(kinds, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))
    return F.concat_ws(",", F.transform(spans, one))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with every span of ``text_col`` replaced by its kind in angle brackets (other columns kept).

    Only documents with spans meet the span table; the others pass untouched.  Overlapping spans become one
    replacement, named by the first.  ``length_col``, if given, is set to the new length.
    """
    doc, hash_, spans = free_names(docs, "doc", "hash", "spans")
    found = find_personal_data(docs, id_col, text_col).where(F.size("spans") > 0)
    found = written(found.select(F.col("doc_id").alias(doc), F.col("h").alias(hash_), F.col("spans").alias(spans)).distinct(),
                    "pii-spans")
    # spans are broadcast only below a checked number; beyond it the texts are shuffled
    number = found.select(F.coalesce(F.sum(F.size(spans) + 2), F.lit(0))).first()[0]
    found = F.broadcast(found) if number <= BROADCAST_SPANS else found.hint("merge")
    text = F.col(text_col)
    kinds = F.array(*map(F.lit, KINDS))

    def step(a, x):
        later = x["s"] >= a["at"]
        piece = F.concat(F.substr(text, a["at"] + 1, x["s"] - a["at"]), F.lit("<"), F.element_at(kinds, x["k"] + 1), F.lit(">"))
        return F.struct(F.greatest(a["at"], x["e"]).alias("at"), F.when(later, F.concat(a["out"], F.array(piece))).otherwise(a["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    new = F.aggregate(spans, start, step, lambda a: F.concat(F.concat_ws("", a["out"]), F.substr(text, a["at"] + 1, F.length(text))))
    key = F.col(id_col).cast("bigint").eqNullSafe(F.col(doc)) & (F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))) == F.col(hash_))
    rows = docs.join(found, key, "left")
    rows = rows.withColumn(text_col, F.when(F.col(spans).isNotNull(), new).otherwise(text))
    if length_col:
        rows = rows.withColumn(length_col, F.when(F.col(spans).isNotNull(), F.length(text).cast("bigint")).otherwise(F.col(length_col)))
    return rows.select(*docs.columns)
