"""Column expressions for cleaning text fields.  All JVM-side built-ins."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results.
# Star-rating words and their scores (exact, case-sensitive).
RATING_WORDS = {"One": 1, "Two": 2, "Three": 3, "Four": 4, "Five": 5}
# Fixed rate used for the second currency column.
GBP_TO_INR = 105.50
# First number in a price text: digits with an optional fraction.
PRICE_PATTERN = r"(\d+(?:\.\d+)?)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_price(col: Column | str) -> Column:
    """First ``\\d+(\\.\\d+)?`` in the text as a double; null when none.

    A currency sign or any prefix is skipped, ``-5.00`` gives 5.0 and
    ``1,234.50`` gives 1.0, as in the reference.  ``try_cast`` keeps ANSI
    mode from raising on an empty match.
    """
    digits = F.regexp_extract(_c(col), PRICE_PATTERN, 1)
    return F.nullif(digits, F.lit("")).try_cast("double")


def parse_rating(col: Column | str, words: Mapping[str, int] = RATING_WORDS) -> Column:
    """Exact word -> score lookup, anything else null."""
    c = _c(col)
    expr = None
    for word, score in words.items():
        expr = (F.when(c == word, F.lit(score)) if expr is None
                else expr.when(c == word, F.lit(score)))
    return expr.otherwise(F.lit(None).cast("int"))


def parse_availability(col: Column | str) -> Column:
    """'out of stock' -> false (tested first), 'in stock' -> true, else null."""
    low = F.lower(_c(col))
    return (F.when(low.contains("out of stock"), F.lit(False))
            .when(low.contains("in stock"), F.lit(True))
            .otherwise(F.lit(None).cast("boolean")))


def is_blank(col: Column | str) -> Column:
    """True when null, empty or only whitespace (never null itself)."""
    return ~F.coalesce(_c(col), F.lit("")).rlike(r"\S")


def strip_ws(col: Column | str) -> Column:
    """Strip all leading/trailing whitespace (``trim`` strips spaces only)."""
    return F.regexp_replace(_c(col), r"^\s+|\s+$", "")


def squeeze_ws(col: Column | str) -> Column:
    """Runs of whitespace -> one space, then stripped."""
    return strip_ws(F.regexp_replace(_c(col), r"\s+", " "))


def normalise(col: Column | str) -> Column:
    """``strip().lower()``."""
    return F.lower(strip_ws(col))


def contains_any(col: Column | str, keywords: Iterable[str]) -> Column:
    """Lower-cased text contains any keyword as a substring (never null)."""
    low = F.lower(F.coalesce(_c(col), F.lit("")))
    kws = F.array(*[F.lit(k.lower()) for k in keywords])
    return F.exists(kws, lambda k: low.contains(k))


#: characters of a text that a snippet shows
SNIPPET_CHARS = 200


def snippet(col: Column | str, n: int = SNIPPET_CHARS) -> Column:
    """First ``n`` characters, newlines -> spaces, then stripped."""
    return strip_ws(F.replace(F.substring(_c(col), 1, n), F.lit("\n"), F.lit(" ")))


def format_doc_id(num: Column | str) -> Column:
    return F.format_string("doc_%02d", _c(num))


def format_chunk_id(num: Column | str, chunk: int = 1) -> Column:
    return F.format_string(f"doc_%02d_chunk_{chunk:02d}", _c(num))


def resolve_url(base: Column | str, href: Column | str) -> Column:
    """``urljoin`` of an absolute base URL and a link, as a SQL expression.

    A link with a scheme stays, ``//host`` takes the base scheme, an empty one
    is the base itself, ``?q`` and ``#f`` replace the base's own; any other
    path is joined to the base's folder (or the root) and folded in one pass
    over its segments: ``.`` goes, ``..`` drops the segment before it and stops
    at the root.  Query and fragment are never folded.
    """
    b, h = _c(base), _c(href)
    origin = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    base_path = F.regexp_extract(b, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    base_nofrag = F.regexp_replace(b, r"#.*$", "")
    base_noquery = F.regexp_replace(base_nofrag, r"\?.*$", "")
    path = F.regexp_extract(h, r"^([^?#]*)", 1)
    rest = F.substr(h, F.length(path) + 1, F.length(h))
    rest = F.regexp_replace(F.regexp_replace(rest, r"^\?(?=#|$)", ""), r"#$", "")  # an empty query or fragment goes
    folder = F.regexp_replace(base_path, r"[^/]*$", "")
    segments = F.split(F.when(path.startswith("/"), path).otherwise(F.concat(folder, path)), "/", -1)
    last = F.element_at(segments, -1)
    inner = F.slice(segments, 1, F.size(segments) - 1)

    def step(done, seg):
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(seg == "..", up).when(seg.isin(".", ""), done).otherwise(F.concat(done, F.array(seg)))

    folded = F.aggregate(F.concat(inner, F.array(F.when(last == "..", "..").otherwise("."))),
                         F.array().cast("array<string>"), step)
    end = F.when(last.isin(".", ".."), "").otherwise(last)
    joined = F.concat(origin, F.lit("/"), F.array_join(F.concat(folded, F.array(end)), "/"), rest)
    return (F.when(h.isNull(), F.lit(None).cast("string"))
            .when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h)
            .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
            .when(h == "", b)
            .when(h.startswith("?"), F.concat(base_noquery, rest))
            .when(h.startswith("#"), F.concat(base_nofrag, rest))
            .otherwise(joined))
