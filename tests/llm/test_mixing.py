import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from claimweave.llm import mixing

SF = "/root/testdata/sf0.001"


def levels(sizes, weights=mixing.WEIGHTS):
    """Targets by resharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, total = {}, 1.5 * sum(sizes.values())
    while True:
        left, open_ = total - sum(full.values()), [s for s in names if s not in full]
        x = left / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if x * weight[s] > 2 * sizes[s]]
        if not over:
            return {s: full.get(s, x * weight[s]) for s in names}
        full |= {s: 2 * sizes[s] for s in over}


def check(rows, docs, block=mixing.BLOCK):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((d["doc_id"], size(d["text"])) for d in docs)
    sizes = Counter()
    for d in docs:
        sizes[d["source"]] += size(d["text"])
    want, taken = levels(sizes), Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.5 + 1e-6


def test_taken_words_meet_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.Mix(docs).taken()
    check(rows.collect(), docs.collect())
    again = mixing.Mix(docs.repartition(5)).taken()
    assert rows.exceptAll(again).count() == again.exceptAll(rows).count() == 0


def test_odd_documents(spark):
    rows = [(1, "a b c", "s", "x"), (1, "a b c", "s", "x"), (None, None, "s", "x"), (None, None, "s", "x"), (2, "", None, "x"), (3, "w " * 3000, None, "x"), (4, "one", "é", "x"), (5, "  ", "empty", "x"), (6, "k " * 40, "z", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, sid string")
    check(mixing.Mix(docs, block=16, shard_blocks=8).taken().collect(), docs.collect())
    assert mixing.Mix(docs.limit(0)).taken().count() == 0


def test_permutations(spark):
    for n in (1, 2, 7, 1000):
        frame = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3)).alias("p"))
        got = [r["p"] for r in frame.collect()]
        assert sorted(got) == list(range(n)) and (n < 1000 or got != sorted(got))


def test_blocks_hold_the_words_counted(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    blocks = mixing.mixed_blocks(docs, block=32, shard_blocks=16)
    mix = mixing.Mix(docs, block=32, shard_blocks=16)
    slots = mix.slots().collect()
    assert sorted(16 * s["shard"] + s["place"] for s in slots) == list(range(len(slots)))
    rows = blocks.collect()
    assert len(rows) == len(slots) and sum(len(r["words"]) for r in rows) == sum(s["length"] for s in slots)
    drawn = Counter(w for r in rows for w in r["words"])
    assert sum(drawn.values()) == sum(r["taken"] for r in mix.taken().collect())
    known = {w for d in docs.collect() for w in re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "")}
    assert set(drawn) <= known
