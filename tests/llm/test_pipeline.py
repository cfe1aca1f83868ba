"""The pipeline against brute force, stage by stage, on what the stage before has kept."""

import re

import pytest

import corpus_pipeline as cp
from claimweave.llm import decontaminate as dc
from claimweave.llm import mixing
from tests.llm.test_mixing import check
from tests.llm.test_ngram_join import brute
from tests.llm.test_scans import brute_hits, low

SF = "/root/testdata/sf0.001"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in cp.STAGES:
        stage(spark, out[-1], SF).write.parquet(f"{folder}/{name}")
        out.append(spark.read.parquet(f"{folder}/{name}"))
    return out


def texts(frame):
    return {r["doc_id"]: r["text"] for r in frame.collect()}


def test_columns_stay(stages):
    for frame in stages[1:-1]:
        assert frame.schema == stages[0].schema


def test_language(stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert set(after) <= set(before) and all(before[k] == t for k, t in after.items())
    assert len(after) >= 0.97 * len(before)
    assert all(any(c.isalpha() for c in t) for t in after.values())


def test_near_copies(stages):
    before, after = texts(stages[1]), texts(stages[2])
    want = {c for _, n, c in brute(list(before.items()), 5, 80) if n} | {k for k, t in before.items() if not (t or "").split()}
    assert set(after) == want and all(before[k] == t for k, t in after.items())


def test_benchmark(spark, stages):
    items = [(r["item_id"], re.findall(WORD, low(r["text"]))) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = texts(stages[2]), texts(stages[3])
    dirty = 0
    for k, t in before.items():
        words = re.findall(WORD, low(t))
        hit, _ = brute_hits(words, items)
        dirty += bool(hit)
        if len(hit) > 0.8 * len(words):
            assert k not in after
        else:
            assert re.findall(WORD, low(after[k])) == [w for i, w in enumerate(words) if i not in hit]
            assert hit or after[k] == t
    assert dirty


def test_personal_data(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert set(before) == set(after)
    found = re.compile(r"\+\d \(\d{3}\) \d{3}-\d{4}|[\w.]+@[\w.]+\w|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])")
    for k, t in before.items():
        assert len(after[k]) == len(t) or found.search(t)
        assert not [v for v in found.findall(t) if v in after[k]]


def test_mix(stages):
    """The mix takes effect: documents that give nothing go, and the text holds the words that are taken."""
    docs = stages[4].collect()
    rows = mixing.Mix(stages[4]).taken().collect()
    check(rows, docs)
    taken = {r["doc_id"]: r["taken"] for r in rows}
    out = {r["doc_id"]: r for r in stages[5].collect()}
    assert set(out) == {k for k, n in taken.items() if n} and 0 < len(out) < len(docs)
    whole = 0
    for d in docs:
        if d["doc_id"] in out:
            r, words = out[d["doc_id"]], d["text"].split()
            spans = [(s["from"], s["to"]) for s in r["spans"]]
            assert r["taken"] == taken[d["doc_id"]] and spans == sorted(spans) and all(a < b for a, b in spans)
            assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))
            kept = [w for a, b in spans for w in words[a:b]]
            assert r["text"].split() == kept and len(kept) <= r["taken"] <= 2 * len(kept)
            assert r["n_chars"] == len(r["text"])
            if len(kept) == len(words):
                assert r["text"] == d["text"]
                whole += 1
    assert whole and dc.item_words(None) == []


def test_run_and_odd_rows(spark):
    assert cp.run(spark, SF).count() > 100
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "the and of " * 20, "en", None, 220), (3, "der die das " * 20, "de", "b", 240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.limit(0)):
        for _, stage in cp.STAGES[:-1]:
            frame = stage(spark, frame, SF)
            assert frame.columns == docs.columns
        assert cp.STAGES[-1][1](spark, frame, SF).count() == sum(r["taken"] > 0 for r in mixing.Mix(frame).taken().collect())
