"""Long runs without blanks take linear time in the personal-data finder, and matches stay those of the plain patterns."""

import re
import time

import pytest

from lanthorn.llm import pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"}
TRICKY = [
    "a@b.cc_d@e.ff g@h.ii%j@k.ll", "x.y@z a@b.c.@d.e f+g@h.i-j.k@l.mm", "a@b@c.dd@e.ff", "1.2.3.4.5.6.7.8 01.002.3.4x5.6.7.8",
    "a..b@c..d 9.9.9.9@1.2.3.4", "mail:a@b.cc,c@d.ee;1.1.1.1", "@@a@b.cc@", "1234.5.6.7890.1.2.3", "....a@b.cc.....", "a@b.cc" * 5,
]
RUNS = ["a" * 1_000_000, "1" * 1_000_000, "a." * 500_000, "1." * 500_000, "." * 1_000_000 + "x1", "aB3+/" * 200_000 + "==", "a@" * 500_000]


def expected(kind, text):
    out = []
    for m in re.finditer(PLAIN[kind], text, re.ASCII):
        if kind == "email" or all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), m.end()))
    return out


def test_matches_are_those_of_the_plain_patterns(spark):
    df = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id int, text string")
    for r in pii.find_personal_data(df).collect():
        for kind in PLAIN:
            got = [(x["s"], x["e"]) for x in r["base"] if pii.KINDS[x["k"]] == kind]
            assert got == expected(kind, TRICKY[r["doc_id"]]), (kind, TRICKY[r["doc_id"]])


@pytest.mark.parametrize("run", range(len(RUNS)))
def test_a_run_of_a_million_characters(spark, run):
    text = RUNS[run] + " me@example.org 10.1.2.3"
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    began = time.monotonic()
    row = pii.find_personal_data(df).first()
    assert time.monotonic() - began < 60
    kinds = {pii.KINDS[x["k"]]: (x["s"], x["e"]) for x in row["base"]}
    at = len(text)
    assert kinds["email"] == (at - 23, at - 9) and kinds["ip"] == (at - 8, at)
