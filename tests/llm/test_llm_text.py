"""Repeated strings, Jaccard components, quality rules and token counts against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm_cases import empty, odd, odd_rows, prose, rows
from tokenizers import Tokenizer

from lanthorn.llm import jaccard, quality_rules, sarray, textbuf, tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def without_repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), len(bytes(gone).replace(b"\0", b" ").split()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length, chunk", [(200, 2 << 20), (40, 3000)])
def test_repeated_strings(spark, length, chunk):
    got = rows(sarray.repeated_spans(odd(spark), length, chunk_bytes=chunk, names_per_bucket=500),
               "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    want = [(r[0], *w) for r, w in zip(odd_rows(), without_repeats([r[1] for r in odd_rows()], length))]
    assert got == sorted(want, key=lambda t: tuple((v is None, v) for v in t))


def test_repeated_strings_of_nothing(spark):
    assert sarray.repeated_spans(empty(spark)).count() == 0


def test_covers_hold_every_difference():
    for v, cover in sarray.COVERS.items():
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))


def shingle_set(text, width=4):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def brute_components_of_width(docs, width, percent):
    return [(i, c) for i, _, c in brute_components(docs, percent, width)]


def brute_components(docs, percent=85, width=4):
    sets = [(i, shingle_set(t, width)) for i, t in docs]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and i is not None and j is not None and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [(i, len(s), find(i) if i is not None else None) for i, s in sets]


def test_jaccard_components_of_odd_rows(spark):
    got = rows(jaccard.jaccard_components(odd(spark)), "doc_id", "n_shingles", "component_id")
    want = brute_components([(r[0], r[1]) for r in odd_rows()])
    assert got == sorted(want, key=lambda t: tuple((v is None, v) for v in t))
    assert jaccard.jaccard_components(empty(spark)).count() == 0


def test_jaccard_chain_is_one_component(spark):
    """Neighbours in the chain link, its ends do not; a hub alone would miss some of it."""
    words = prose(9, 400).split()
    docs = []
    for k in range(12):
        docs.append((100 - k, " ".join([f"new{j}" for j in range(k * 10)] + words[k * 10:])))
    docs += [(1, prose(10, 90)), (2, prose(11, 90))]
    want = brute_components(docs)
    got = rows(jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id bigint, text string")), "doc_id", "n_shingles", "component_id")
    assert got == sorted(want)
    sets = [shingle_set(t) for _, t in docs]
    assert len({w[2] for w in want}) == 3 and 100 * len(sets[0] & sets[11]) < 85 * len(sets[0] | sets[11])


def test_jaccard_of_documents_made_of_common_passages(spark):
    """Texts of three of eight common passages and a few own words, near copies among them: every link is found."""
    passages = [prose(100 + k, 60).replace("\n", " ") for k in range(8)]
    docs = []
    for i in range(140):
        parts = [passages[(i * 7 + j * (1 + i % 3)) % 8] for j in range(3)]
        docs.append((1000 - i, " ".join([*parts, prose(500 + i // 2 if i % 5 else 900 + i, 6 + i % 25).replace("\n", " ")])))
    got = rows(jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id bigint, text string"), 5, 80), "doc_id", "component_id")
    want = brute_components_of_width(docs, 5, 80)
    assert got == sorted(want) and 2 < len({c for _, c in want}) < 140


def test_jaccard_with_crowded_ngrams_that_the_sketch_does_not_see(spark, monkeypatch):
    """With a blind sketch the exact counts alone move common n-grams up: same links, fewer meetings in the prefixes."""
    passages = [prose(300 + k, 60).replace("\n", " ") for k in range(6)]
    docs = [(i, " ".join([passages[i % 6], prose(700 + i // 3, 50 + i % 7).replace("\n", " ")])) for i in range(120)]
    docs += docs[:3]  # repeated rows
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = sorted(set(brute_components_of_width(docs[:120], 5, 80)))
    monkeypatch.setattr(jaccard, "ngram_heat", lambda *a: np.zeros(jaccard.SKETCH, dtype=np.uint8))
    seen = []
    shared_grams = jaccard.shared_grams
    monkeypatch.setattr(jaccard, "shared_grams", lambda index: seen.append(index.groupBy("gram").count().agg({"count": "max"}).first()[0]) or shared_grams(index))
    for crowd in (1000, 8):
        monkeypatch.setattr(jaccard, "CROWD", crowd)
        got = rows(jaccard.jaccard_components(table, 5, 80), "doc_id", "component_id")
        assert sorted(set(got)) == want and len(got) == 123
    assert seen[0] == 20 and seen[1] < 8


def test_crowded_cells_are_those_of_shared_ngrams(spark):
    grams = [0, 1, (1 << 15) - 1, 1 << 15, (1 << jaccard.CROWD_BITS) - 1, (1 << 40) + 77, (1 << jaccard.HASH_BITS) + 5]
    lists = [(i, 9, grams) for i in range(jaccard.CROWD)] + [(99, 9, [3, 4])]
    marks = jaccard.crowded_cells(spark.createDataFrame(lists, "rep bigint, n bigint, prefix array<bigint>"))
    assert jaccard.crowded(np.array(grams), marks).tolist() == [True] * 6 + [False]
    assert np.unpackbits(marks).sum() == 6


def test_fragments_are_stretches_of_the_order():
    key = np.sort(np.random.default_rng(1).integers(0, (1 << 63) - 1, 5000))
    cut = jaccard.fragment(np.concatenate([key >> 5, key]))
    assert (np.diff(jaccard.fragment(key)) >= 0).all() and cut.min() == 0 and len(np.unique(cut[:5000])) == 8


def test_one_document_per_component(spark):
    left = [r[0] for r in rows(jaccard.one_per_component(odd(spark)), "doc_id")]
    assert left == [1, 2, 3, 4, 5, 8, 9, 10, 12, 13, None]


def doubled(a: str, b: str, times: int) -> list[str]:
    """Thue-Morse words over two strings: the word and its complement after ``times`` doublings."""
    x, y = a, b
    for _ in range(times):
        x, y = x + y, y + x
    return [x, y]


@pytest.mark.parametrize("a, b, times", [("a", "b", 10), ("a", "b", 13), ("ab", "ba", 11), ("x", "yz", 12), ("é", "ü", 11)])
def test_structured_strings_do_not_collide(spark, a, b, times):
    """Any polynomial modulo a power of two takes these pairs for equal."""
    one, other = doubled(a, b, times)
    raw = np.frombuffer((one + other).encode(), dtype=np.uint8)
    n, ends = len(one.encode()), len(raw)
    x = textbuf.Texts(raw, np.array([0, n]), np.array([n, ends]), 0)
    h = textbuf.span_hash(x.prefix_hash(), np.array([0, n]), np.array([n, ends]))
    assert h[0] != h[1]
    again = textbuf.span_hash(textbuf.Texts(raw[n:], np.array([0]), np.array([ends - n]), 0).prefix_hash(), np.array([0]), np.array([ends - n]))
    assert again[0] == h[1]
    docs = spark.createDataFrame([(1, one), (2, other), (3, one + "\n" + other), (4, one + "\n" + one)], "doc_id bigint, text string")
    assert [r[2] for r in rows(jaccard.jaccard_components(docs), "doc_id", "n_shingles", "component_id")] == [1, 2, 3, 4]
    ratio = np.zeros(1 << 10)
    assert rows(quality_rules.apply_rules(docs, ratio), "doc_id", "n_dup_lines") == [(1, 0), (2, 0), (3, 0), (4, 1)]


def brute_rules(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


def test_quality_rules(spark):
    docs = odd(spark)
    ratio = quality_rules.fit_ratio(docs, spark.createDataFrame([(5,), (8,), (None,), (77,)], "doc_id bigint"), buckets=1 << 12)
    got = quality_rules.apply_rules(docs, ratio, threshold=-10)
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = [(r[0], *brute_rules(r[1])) for r in odd_rows()]
    assert rows(got, *names) == sorted(want, key=lambda t: tuple((v is None, v) for v in t))
    assert all(r.kept == (not r.base_failed and r.llr >= -10) for r in got.collect())
    kept = rows(quality_rules.drop_rejected(docs, ratio, -10), "doc_id")
    assert kept == [(r.doc_id,) for r in got.where("kept").orderBy(got.doc_id.asc_nulls_last()).collect()]
    assert quality_rules.drop_rejected(docs, ratio).columns == docs.columns


def test_ratio_is_the_smoothed_log_ratio(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "c")], "doc_id bigint, text string")
    ratio = quality_rules.fit_ratio(docs, docs.where("doc_id = 1"), buckets=1 << 16, smoothing=1.0)
    # raw: a 2, b 1, ab 1, ba 1, c 1 (6 n-grams, 5 of them trusted)
    want = sorted([np.log(3 / (2 * 5 / 6 + 1)), *[np.log(2 / (5 / 6 + 1))] * 3, np.log(1 / (5 / 6 + 1))])
    assert np.allclose(sorted(ratio[ratio != 0]), want)
    assert not quality_rules.fit_ratio(empty(spark), docs).any()
    assert quality_rules.apply_rules(empty(spark), ratio).count() == 0


def test_token_counts_equal_the_library(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    extra = ["ΑΣ ΣΑΣ. a<|endoftext|>b <|startoftext|>", "it's I'LL we'Ve 123 ٣٤ ½ 中文。🙂👍🏽 \x7f", "İstanbul ﬁ Ǆ é​ x", "a" * 3000 + "é" * 300]
    texts = [(r[0], r[1]) for r in odd_rows()] + [(100 + i, t) for i, t in enumerate(extra)]
    got = rows(tokens.count_tokens(spark.createDataFrame(texts, "doc_id bigint, text string"), path, limit=100),
               "doc_id", "n_bytes", "n_tokens", "over_limit")
    library = Tokenizer.from_file(path)
    n = [len(e.ids) for e in library.encode_batch([t or "" for _, t in texts], add_special_tokens=False)]
    want = [(i, len((t or "").encode()), k, k > 100) for (i, t), k in zip(texts, n)]
    assert got == sorted(want, key=lambda t: tuple((v is None, v) for v in t))
    assert tokens.count_tokens(empty(spark), path).count() == 0


def test_whole_tokens_are_those_the_library_leaves_whole():
    bpe = tokens.WordBpe(public_tokenizers.path("word_bpe_49k.json"))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    some = sorted(w.decode() for w in bpe.whole if w.isalpha() and w.isascii() and w.islower())[::50]
    assert len(some) > 300 and all(len(library.encode(w, add_special_tokens=False).ids) == 1 for w in some)
