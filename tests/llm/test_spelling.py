import random
import zlib

import pytest
from pyspark.sql import functions as F

from claimweave.llm.spelling import Grams, count_words, group_variants, index_keys, near_words, probe_keys


def edits(word, letters):
    for i in range(len(word)):
        yield word[:i] + word[i + 1 :]
        for c in letters:
            if c != word[i]:
                yield word[:i] + c + word[i + 1 :]
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]


def brute_near(counts):
    letters = sorted({c for w in counts for c in w})
    return {w: {x for x in edits(w, letters) if x in counts and x != w} for w in counts}


def brute_groups(counts, factor=5):
    near, out = brute_near(counts), {}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= factor * n else None
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None)
    return out


def frame_of(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def gathered(frame):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in frame.collect()}


def made_up(kind, rng):
    if kind == "few letters":  # grams repeat, prefixes are wide
        return {"".join(rng.choice("ab") for _ in range(rng.randint(4, 9))) for _ in range(500)}
    if kind == "accents":
        return {"".join(rng.choice("aéñÿzß") for _ in range(rng.randint(6, 8))) for _ in range(800)} | {w for x in ("canción", "größer") for w in edits(x, "aéß")}
    if kind == "one beginning":  # a third of the words share a frequent beginning
        return {"überein" + "".join(rng.choice("abc") for _ in range(rng.randint(0, 4))) for _ in range(400)} | {"".join(rng.choice("defgh") for _ in range(6)) for _ in range(800)}
    return {x for w in ("continental", "abababababab", "zzzzzzzz") for x in edits(w, "abtz")} | {"continental"}


@pytest.mark.parametrize("kind", ["few letters", "accents", "one beginning", "all edits"])
def test_groups_equal_brute_force(spark, kind):
    rng = random.Random(kind)
    counts = {w: rng.choice([5, 6, 25, 30, 125, 700, 4000]) for w in sorted(made_up(kind, rng)) if len(w) >= 4}
    assert gathered(group_variants(frame_of(spark, counts))) == brute_groups(counts)


def test_pairs_come_once(spark):
    counts = {w: 5 for w in edits("pepper", "pe") if len(w) >= 4}
    pairs = [(r["a"], r["b"]) for r in near_words(frame_of(spark, counts)).collect()]
    both = {(a, b) for a, b in pairs} | {(b, a) for a, b in pairs}
    assert len(pairs) == len(set(pairs)) and len(both) == 2 * len(pairs)
    assert both == {(a, b) for a, x in brute_near(counts).items() for b in x}


def test_pivots_are_the_cheapest_disjoint_pair():
    prefix = [(0, 5 << 32), (1, 1 << 32), (2, 1 << 32), (5, 2 << 32)]
    assert Grams.pivots(prefix) == (1, 5)
    assert Grams.pivots([(3, 1 << 32), (4, 1 << 32), (5, 1 << 32)]) == (3, 5)


def test_each_edit_is_met_by_keys():
    import numpy as np

    grams = Grams(np.arange(8192) % 17)
    for word in ("abcdef", "aaaaaa", "mississippi"):
        for other in edits(word, "aimx"):
            if other == word:
                continue
            (last_a, pa), (last_b, pb) = grams.prefix(word), grams.prefix(other)
            met = (last_a <= last_b and set(probe_keys(word, *grams.pivots(pa))) & set(index_keys(other, pb))) or (last_b <= last_a and set(probe_keys(other, *grams.pivots(pb))) & set(index_keys(word, pa)))
            assert met, (word, other)


def counted(texts, least_length=6, least_count=5):
    out = {}
    for doc_id, text in texts:
        run = ""
        for c in (text or "") + " ":
            c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run
                out[word] = out.get(word, 0) + 1
            run = ""
    return {w: n for w, n in out.items() if len(w) >= least_length and n >= least_count}


def test_counts_of_odd_texts(spark):
    long = "Überein stimmung ÑANDÚ größere10größere×÷x " * 4000
    texts = [(1, None), (2, ""), (3, "123 !?"), (None, "winter " * 7), (4, long), (4, long), *((i, "Summer summer SUMMER sum-mer") for i in range(500))]
    frame = spark.createDataFrame(texts, "doc_id long, text string").withColumn("word", F.lit("x")).withColumn("n", F.lit(None).cast("int")).withColumn("ID", F.lit(1))
    got = {r["word"]: r["n"] for r in count_words(frame).collect()}
    assert got == counted(texts) and len([w for w in got if len(w) == 5]) == 0


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert group_variants(count_words(none)).collect() == []


def test_long_word(spark):
    word = "lang" * 5000
    counts = {word: 100, word[:9000] + word[9001:]: 5, word + "x": 6}
    assert gathered(group_variants(frame_of(spark, counts))) == brute_long(counts, word)


def brute_long(counts, word):
    a, b = [w for w in counts if w != word]
    return {word: (None, word, 100, 2, None), a: (word, word, counts[a], 1, 100), b: (word, word, counts[b], 1, 100)}


def test_short_words_are_refused(spark):
    with pytest.raises(ValueError):
        count_words(spark.createDataFrame([], "doc_id long, text string"), least_length=3)


def test_nothing_is_broadcast(spark, tmp_path):
    """A word has a dozen keys and more, and compressed files say little: no side may be taken for small and sent through the driver."""
    plan = lambda frame: frame._jdf.queryExecution().executedPlan().toString()
    words = frame_of(spark, {f"{a}inter{b}": 5 + len(a) for a in ("w", "h", "sp") for b in ("", "s", "ed", "n")})
    words.write.parquet(f"{tmp_path}/words")
    read = spark.read.parquet(f"{tmp_path}/words")
    near = near_words(read)
    assert "SortMergeJoin" in plan(near) and "Broadcast" not in plan(near) and near.count() > 0
    assert "Broadcast" not in plan(group_variants(read))
