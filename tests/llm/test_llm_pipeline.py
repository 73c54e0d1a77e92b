"""The pipeline against a plain run of its stages, and the entry without the subpackage."""

import os
import shutil
import subprocess
import sys

import public_tokenizers
import sentencepiece
from llm_cases import prose
from test_llm_models import base_spans
from test_llm_text import brute_components, brute_rules, shingle_set

import corpus_pipeline
from lanthorn.llm import mixing, quality_rules
from lanthorn.llm.q_pieces import MODEL

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def corpus():
    docs = [(i, prose(i % 70, 60 + i % 70), "en", f"s{i % 4}", 0) for i in range(90)]
    docs += [(200 + i, "junk ### " * 40, "en", "s1", 0) for i in range(4)]
    docs += [(300, prose(300, 70) + " mail x.y@example.com now", "en", "s2", 0), (301, None, None, None, None), (302, "few words", "en", "s0", 0)]
    return docs


def test_pipeline_equals_its_stages_by_hand(spark, tmp_path):
    docs = corpus()
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    ratio = quality_rules.fit_ratio(table, table.where("doc_id < 40").select("doc_id"))
    verdict = {r.doc_id: r.llr >= quality_rules.THRESHOLD for r in quality_rules.apply_rules(table, ratio).collect()}
    kept = [d for d in docs if not brute_rules(d[1])[5] and verdict[d[0]]]
    assert {d[0] for d in kept} >= set(range(90)) and not {d[0] for d in kept} & {200, 301, 302}
    root = {i: r for i, _, r in brute_components([(d[0], d[1]) for d in kept])}
    kept = [d for d in kept if root[d[0]] == d[0]]
    assert len(kept) < 90
    texts = {}
    for i, t, *_ in kept:
        for s, k, e in reversed(base_spans(t)):
            t = t[:s] + ["<email>", "<ip>", "<card>", "<phone>"][k] + t[e:]
        texts[i] = t
    assert texts[300].endswith("mail <email> now")
    frame = spark.createDataFrame([(i, texts[i], s) for i, _, _, s, _ in kept], "doc_id bigint, text string, source string")
    copies = {r.doc_id: r.copies for r in mixing.mixed(frame).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))
    want = sorted((i, len(texts[i]), len(library.encode(texts[i]))) for i in texts for _ in range(copies[i]))
    assert sorted((r.doc_id, r.n_chars, r.n_pieces) for r in got) == want and all(r.round_trip for r in got)


def similarity(a, b, width):
    x, y = shingle_set(a, width), shingle_set(b, width)
    return 100 * len(x & y) / len(x | y)


def test_near_duplicates_are_five_words_at_80_percent(spark, tmp_path):
    """Copies with scattered edits, an appended block or a cut that four words at 85 % would keep."""
    docs, want = [], []
    for k, edits in enumerate((11, 12, 13, 14, 16)):
        words = prose(500 + k, 600).split()
        changed = [f"edit{i}" if i % (600 // edits) == 20 and i // (600 // edits) < edits else w for i, w in enumerate(words)]
        docs += [(10 * k, " ".join(words)), (10 * k + 1, " ".join(changed))]
    for k, share in enumerate((78, 81, 83, 86)):
        words = prose(600 + k, 400).split()
        docs += [(100 + 10 * k, " ".join(words)), (101 + 10 * k, " ".join(words[: 4 * share]))]
        docs += [(200 + 10 * k, " ".join(words[::-1])), (201 + 10 * k, " ".join(words[::-1] + prose(700 + k, 400 * (100 - share) // share).split()))]
    between = 0
    for (i, a), (j, b) in zip(docs[::2], docs[1::2]):
        want += [i] if similarity(a, b, 5) >= 80 else [i, j]
        between += similarity(a, b, 5) >= 80 and similarity(a, b, 4) < 85
    assert between >= 5 and len(want) > len(docs) // 2
    table = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"](spark, table, str(tmp_path))
    assert sorted(r.doc_id for r in got.collect()) == sorted(want)


def test_stages_return_the_columns_of_documents(spark, tmp_path):
    table = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, table, str(tmp_path)).schema.names == table.columns


def test_entry_without_the_subpackage(tmp_path):
    shutil.copytree(os.path.join(ROOT, "lanthorn"), tmp_path / "lanthorn", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'parse_price' in q and 'pipeline' not in q and not any(n.startswith('op1_') for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
