"""Personal data, mixing, fingerprints, language, quality network and pieces."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_cases import empty, odd, odd_rows, prose, rows

from lanthorn.llm import fingerprint, langid, mixing, pieces, pii, quality_cnn
from lanthorn.llm.q_pieces import digest

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(v if i % 2 == 0 else 2 * v - 9 * (v > 4) for i, v in enumerate(map(int, reversed(d)))) % 10 == 0


def base_spans(text):
    out = []
    for n, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                  "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), n, m.end()))
    return sorted(out)


PERSONAL = [
    (1, "write a.b+c@x-y.example.com, or 10.0.255.1 and 10.0.256.1 é🙂 4111 1111 1111 1111 now"), (2, "call +1 (375) 555-4393 or +12"),
    (3, "a@b.c_d@e.f 1.2.3.4.5 4111-1111-1111-1112"), (4, None), (5, ""), (6, "no data @ all + 1"), (7, "7" * 20000 + " x@y.zz"),
    (7, "7" * 20000 + " x@y.zz"), (None, "+44 20 7946 0958")]


def test_base_spans(spark):
    got = pii.find_personal_data(spark.createDataFrame(PERSONAL, "doc_id bigint, text string"))
    found = sorted(((r.doc_id is None, r.doc_id or 0), [(s.s, s.k, s.e) for s in r.base]) for r in got.collect())
    assert found == sorted(((i is None, i or 0), base_spans(t)) for i, t in PERSONAL)
    assert pii.find_personal_data(empty(spark)).count() == 0
    assert pii.find_personal_data(odd(spark)).count() == len(odd_rows())


def test_contexts_reach_unseen_identifiers(spark):
    """Cards after 'card' are seeds; one that fails its check digit is found by its context, other numbers are not."""
    good = ["4111111111111111", "5500005555555559", "4012888888881881", "4222222222222220", "4000056655665556", "5105105105105100"]
    docs = [(i, f"pay by card {c} now") for i, c in enumerate(good)] + [(50, "pay by card 4111111111111112 now"), (51, "order 20240131 of 12345678")]
    got = {r.doc_id: [(s.s, s.k, s.e) for s in r.spans] for r in pii.find_personal_data(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got[50] == [(12, 4, 28)] and got[51] == [] and got[0] == [(12, 2, 28)]


def test_contexts_reach_shapes_that_no_seed_has(spark):
    """Seeds of all lengths speak for their word; grouped, short and unlike identifiers beside it are found, others not."""
    hosts = ["10.0.0.1", "192.168.10.200", "8.8.8.8", "172.16.1.12", "1.2.3.40", "100.20.3.4", "9.9.9.10", "250.1.22.3"]
    seeds = [f"write to {'x' * (i + 1)}@{'y' * (i + 2)}.org today" for i in range(8)]
    seeds += [f"dial +1{'5' * (i % 3)}5551234{560 + i} soon" for i in range(8)] + [f"login from {h} failed" for h in hosts]
    seeds += [f"pay by card {c} now" for c in ("4111 1111 1111 1111", "5500 0055 5555 5559", "4012888888881881", "4000-0566-5566-5556", "378282246310005", "5105 1051 0510 5100")]
    unseen = {"write to root@localhost today": "root@localhost", "dial 5551239999 soon": "5551239999", "dial 020 7946 0958 soon": "020 7946 0958",
              "login from 10.0.0.256 failed": "10.0.0.256", "pay by card 4111 1111 1111 1112, now": "4111 1111 1111 1112"}
    other = ["order 20240131 of 12345678", "rows 1 2 3 4 5 6 7 8 done", "version 1.2.3.444 of it", "sum 2024 1031 55 and", "card no dial"]
    docs = list(enumerate([*seeds, *unseen, *other]))
    got = {r.doc_id: [(s.s, s.e) for s in r.spans if s.k == 4] for r in pii.find_personal_data(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got == {i: [(t.index(unseen[t]), t.index(unseen[t]) + len(unseen[t]))] if t in unseen else [] for i, t in docs}


def test_runs_of_digit_groups_are_candidates(spark):
    texts = ["call 020 7946 0958.", "(4111 1111 1111 1112) 5", "12 +44 20 7946 0958 x", "7 8 " * 9000 + "9x", "1111. 2222 3333 4444, 5555", "a1 22 3333 444x", "+1 (375) 555-4393, (555) 123 4567"]
    want = [["020 7946 0958"], ["4111 1111 1111 1112"], ["+44 20 7946 0958"], ["7 8 " * 8999 + "7 8"], ["2222 3333 4444"], [], ["+1 (375) 555-4393", "(555) 123 4567"]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", pii._candidates(pii.F.col("t"), pii.RUN, "[0-9]")["value"].alias("v")).orderBy("i").collect()
    assert [r.v for r in got] == want


def test_redaction_keeps_everything_else(spark):
    docs = spark.createDataFrame([(i, t, "s", 0 if t is None else len(t)) for i, t in PERSONAL], "doc_id bigint, text string, source string, n_chars bigint")
    out = pii.redact(docs, length_col="n_chars")
    assert out.columns == docs.columns
    new = {r.doc_id: r for r in out.collect()}
    assert new[1].text == "write <email>, or <ip> and 10.0.256.1 é🙂 <card> now" and new[1].n_chars == len(new[1].text)
    assert new[4].text is None and new[5].text == "" and new[6].text == PERSONAL[5][1] and out.count() == len(PERSONAL)


def water_level(sizes, weights=(1, 2, 3), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, target = float(sum(sizes.values())), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if w[s] * level > cap * sizes[s]}
        if not full:
            target.update({s: w[s] * level for s in open_})
            break
        for s in full:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_mix_meets_its_targets(spark):
    docs = [(i, prose(i, 5 + i * 7 % 90), ["a", "b", "c", None, "tiny"][0 if i % 2 else i % 5 if i % 50 else 4], "x") for i in range(400)]
    docs += [(900, None, "b", "x"), (901, "", "void", "x"), (3, "again", "a", "x"), (3, "again", "a", "x"), (None, "no id", "a", "x")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string, copies string").repartition(5)
    got = mixing.mixed(df).collect()
    assert len(got) == len(docs)
    by = {}
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    for i, t, s, _ in docs:
        by[s] = by.get(s, 0) + size(t)
    want = water_level(by)
    assert {(r.source_size, round(r.target, 6)) for r in got} == {(by[s], round(want[s], 6)) for s in by}
    taken = {}
    for r in got:
        taken[(r.source_size, round(r.target, 6))] = taken.get((r.source_size, round(r.target, 6)), 0) + r.taken
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
    for (_, target), t in taken.items():
        assert abs(t - target) <= 25 + 0.01 * target
    assert sorted(got, key=str) == sorted(mixing.mixed(df).collect(), key=str)
    out = mixing.repeated(df)
    assert out.columns == df.columns and out.count() == sum(r.copies for r in got if r.size)
    assert mixing.mixed(empty(spark)).count() == 0


def test_fingerprints(spark):
    docs = [(r[0], r[1] or "") for r in odd_rows()]
    order = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    got = sorted(fingerprint.fingerprints(odd(spark)).collect(), key=lambda r: (r.doc_id is None, -(r.doc_id or 0)))
    seen = {}
    for k, (r, (i, t)) in enumerate(zip(got, order)):
        half = len(t) // 2
        edited = t[: len(t) - half] + order[(k + 1) % len(order)][1][:half]
        assert (r.doc_id, r.n_chars, r.edited_sha256) == (i, len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        seen.setdefault(t, set()).add(r.fingerprint)
    assert all(len(f) == 1 for f in seen.values()) and fingerprint.fingerprints(empty(spark)).count() == 0


def test_shared_substrings_share_interior_phrases():
    middle = prose(5, 500).encode()
    a, b = fingerprint.signatures([middle, b"some other beginning " + middle + b" and end"])
    other = fingerprint.signatures([prose(6, 500).encode()])[0]
    assert fingerprint.likeness(a, b) > 0.8 and fingerprint.likeness(a, other) < 0.1 and fingerprint.likeness(a, a) == 1


def greedy_phrases(text, known):
    n = i = 0
    while i < len(text):
        j = i + 1
        while j < len(text) and text[i:j + 1] in known:
            j += 1
        n, i = n + 1, j
    return n


def test_phrase_counts_are_longest_matches():
    model = langid.Model({"a": [prose(1, 60)], "b": [prose(2, 40).replace("th", "ou")]})
    texts = [prose(7, 30), "zzz 123", "é", ""]
    counts, _ = model.phrase_counts(texts)
    for k, lang in enumerate((prose(1, 60), prose(2, 40).replace("th", "ou"))):
        known = bytes(model.encode(" " + lang + " "))
        assert [greedy_phrases(bytes(model.encode(t)), known) for t in texts] == counts[:, k].tolist()


def signs(seed, first, n, words):
    """Words of two to four letters from the ``n`` code points from ``first`` on."""
    r = np.random.default_rng(seed)
    return " ".join("".join(chr(first + c) for c in r.integers(0, n, r.integers(2, 5))) for _ in range(words))


def test_every_letter_has_its_symbol():
    texts = {"a": [prose(1, 60)], "c": [signs(1, 0x4E00, 150, 200)], "d": [signs(2, 0x4E64, 150, 200)], "r": [signs(3, 0x430, 32, 90)]}
    model = langid.Model(texts)
    some = [signs(4, 0x4E00, 150, 300), signs(5, 0x4E64, 150, 900), signs(6, 0x430, 32, 40) + " " + prose(7, 30), "한 zz 丁", ""]
    counts, _ = model.phrase_counts(some)
    for k, lang in enumerate(sorted(texts)):
        known = "".join(map(chr, model.encode(" " + texts[lang][0] + " ") + 1000))
        want = []
        for t in some:
            coded = "".join(map(chr, model.encode(t) + 1000))
            want.append(sum(greedy_phrases(coded[i:i + langid.WINDOW], known) for i in range(0, len(coded), langid.WINDOW)))
        assert want == counts[:, k].tolist()


def test_languages_of_many_scripts_and_all_lengths(spark):
    """Four big alphabets beside a Latin one; one language has only shorter texts than the band, one only longer ones, one a single one in it."""
    make = {"en": lambda i: prose(i, 80), "ja": lambda i: signs(i, 0x4E00, 120, 80), "zh": lambda i: signs(i, 0x5E00, 120, 80),
            "ko": lambda i: signs(i, 0xAC00, 120, 12), "ru": lambda i: signs(i, 0x430, 32, 900), "el": lambda i: signs(i, 0x3B1, 24, 80 if i == 5 else 12)}
    docs = [(i, make[lang](i), lang) for i in range(240) for lang in [list(make)[i % 6]]]
    assert not any(200 <= len(t) <= 2000 for _, t, lang in docs if lang in ("ko", "ru"))
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.identify(df).collect()}
    assert got == {i: lang for i, _, lang in docs}
    texts = langid.training_texts(df, 16, 200, 2000)
    whole = {t for _, t, _ in docs}
    assert all(t in whole for parts in texts.values() for t in parts) and sum(map(len, texts["ru"])) <= 16 * 1100 and len(texts["ko"]) > 16
    assert [len(texts[k]) for k in ("en", "ja", "zh")] == [16] * 3


def test_language_id_on_held_out_documents(spark):
    swap = {"en": "th er on an", "fr": "eau oi é que", "de": "sch ung ei ß"}
    docs = []
    for i in range(300):
        lang = list(swap)[i % 3]
        r = np.random.default_rng(i)
        docs.append((i, " ".join("".join(r.choice(swap[lang].split(), 3)) for _ in range(80)), lang))
    docs += [(1000, None, "en"), (1001, "12 34 !", "en"), (1002, "", None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").withColumn("score", langid.F.lit("x"))
    got = {r.doc_id: r for r in langid.identify(df, 8, 100, 3000).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    assert all(got[i].lang_pred == lang for i, _, lang in docs[:300] if got[i].held_out)
    assert {got[i].lang_pred for i in (1000, 1001, 1002)} == {"und"} and all(0 <= r.score <= 1 for r in got.values())
    assert langid.identify(odd(spark)).count() == len(odd_rows()) and langid.identify(empty(spark)).count() == 0


def test_quality_network_gradients():
    """The hand-written gradients equal finite differences."""
    texts = [prose(1, 120).encode(), b"", b"###!!! $$$ " * 40, prose(2, 3).encode()]
    labels, weights = np.array([1, 0, 0, 1], np.float32), np.ones(4, np.float32)
    net = quality_cnn.Net(3)
    for n in net.p:
        net.p[n] = net.p[n].astype(np.float64)

    def loss():
        z = net.forward(texts) @ net.p["out"] + net.p["out_bias"][0]
        return float((np.log1p(np.exp(z)) - labels * z).mean())

    grads = net.gradients(texts, labels, weights)
    r = np.random.default_rng(1)
    for name, g in grads.items():
        for _ in range(4):
            at = tuple(r.integers(0, s) for s in g.shape)
            if name == "emb":
                at = (ord("t"), at[1])
            old = net.p[name][at]
            net.p[name][at] = old + 1e-5
            up = loss()
            net.p[name][at] = old - 1e-5
            down = loss()
            net.p[name][at] = old
            assert abs((up - down) / 2e-5 - g[at]) < 2e-3


def test_quality_network_on_held_out_documents(spark):
    docs = [(i, prose(i, 60) if i % 2 else " ".join(w + "***" for w in prose(i, 60).upper().split())) for i in range(240)] + [(900, None), (901, "")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(240)] + [(None, 1), (5000, 1), (7, 7)], "doc_id bigint, quality int")
    got = quality_cnn.classify(spark.createDataFrame(docs, "doc_id bigint, text string"), labels).collect()
    assert len(got) == len(docs) and all(r.predicted == int(r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 240]
    assert len(held) > 30 and np.mean([r.predicted == r.doc_id % 2 for r in held]) > 0.95
    nothing = quality_cnn.classify(odd(spark), labels.limit(0)).collect()
    assert {r.score for r in nothing} == {0.5} and quality_cnn.classify(empty(spark), labels.limit(0)).count() == 0


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(public_tokenizers.path("piece_bpe_32k.model"))


def test_pieces_equal_the_library(spark, model):
    extra = ["   ", "a  b   c     d" + " " * 40 + "x", "\n\n\t x\n", "▁▁a ▁b", "aaaa" * 200, "if (x) {\n        return 1;\n    }",
             "<s> <0x41> <unk>", "=====----****", "x" * 50 + " " * 100, "\x00 中文 Ǆ é̀ ​"]
    texts = [(r[0], r[1]) for r in odd_rows()] + [(100 + i, t) for i, t in enumerate(extra)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.text or "", np.frombuffer(r.ids, "<i4").tolist()) for r in pieces.encode(df, model).collect()))
    assert got == sorted((i is None, i or 0, t or "", library.encode(t or "")) for i, t in texts)
    back = digest(df).collect()
    assert {r.doc_id for r in back if not r.round_trip} == {103}  # the word mark itself decodes to a blank
    assert digest(empty(spark)).count() == 0
