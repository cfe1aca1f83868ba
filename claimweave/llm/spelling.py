"""Spelling variants: words one edit apart, grouped under their most frequent form.

Words are counted over all documents in compiled code. Pairs are found with pivotal grams:

* Bigrams have one order, rare first: by how many words hold a bigram of its class (one of
  ``CLASSES`` hash classes, so the counts have a fixed size), then by a hash.
* A word's prefix holds its three first bigrams in that order and all that equal the third. One edit
  changes at most one of two disjoint bigrams, and three different places always hold two disjoint ones.
* The pivots are two disjoint bigrams of the prefix with the smallest sum of counts, chosen by
  dynamic programming over the places.
* Of two words one edit apart, let r be the one whose prefix ends first. One of its pivots is
  untouched, and it lies in the prefix of the other word s. Either the left pivot stands at the same place
  in both words, with equal letters before it, or the right pivot stands at the same distance from
  the end, with equal letters after it. These position limits are exact for one edit.
* The edit is then in what remains beside the pivot: in its first or in its second half. The other
  half is equal too and goes into the key, so words that merely share a frequent beginning don't meet.

The join carries ``levenshtein(r, s) = 1`` as its condition, so only verified pairs leave it. It is a
plain inner join between two exchanges: adaptive execution splits a hot key on both sides. All joins here are asked
for as merge joins: sizes known of compressed files and before an explode are far too low, and a side that is taken
for small would be broadcast through the driver.

Null texts and texts without letters have no words. A null id counts as an empty one. Repeated rows
count as often as they stand. Empty tables give no rows. Words shorter than ``least_length`` or rarer than
``least_count`` take no part; ``least_length`` is 4 at least, as shorter words lack two disjoint bigrams.
Equal counts: the smallest word in code-point order is the form.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.llm.tables import Scratch, quoted

CLASSES = 8192
#: Every step to a form multiplies the count by FACTOR or more, so chains are short.
FACTOR = 5
#: One occurrence in so many, by its hash, loses a letter.
DAMAGE = 199
LETTERS = "[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(text: Column) -> Column:
    """All maximal runs of letters, A-Z as lower case."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(LETTERS), 0)


def damaged(doc_id: Column, run: Column, every: int = DAMAGE) -> Column:
    """``run``, or ``run`` without the letter that the hash of id and run points at."""
    h = F.crc32(F.encode(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run), "UTF-8"))
    at = F.pmod(h, F.length(run).cast("long")).cast("int")
    shorter = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(h % every == 0, shorter).otherwise(run)


def count_words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_length: int = 6, least_count: int = 5) -> DataFrame:
    """``word`` and ``n``: occurrences over all documents."""
    if least_length < 4:
        raise ValueError("words of fewer than 4 letters lack two disjoint bigrams")
    found = docs.select(quoted(doc_id).alias("id"), F.explode(runs(quoted(text))).alias("run"))
    words = found.select(damaged(F.col("id"), F.col("run")).alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def gram_counts(words: DataFrame) -> np.ndarray:
    """How many bigrams of all words fall into each class: ``CLASSES`` numbers, whatever the number of words."""
    grams = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substr("word", i, F.lit(2)))).alias("g"))
    counts = np.zeros(CLASSES, np.int64)
    for row in grams.groupBy((F.crc32(F.encode("g", "UTF-8")) % CLASSES).alias("c")).count().collect():
        counts[row["c"]] = row["count"]
    return counts


class Grams:
    """Order, prefix and pivots of a word's bigrams."""

    def __init__(self, counts: np.ndarray):
        self._counts = np.minimum(counts, (1 << 30) - 1).tolist()
        self._order: dict[str, int] = {}

    def order(self, gram: str) -> int:
        """Rare bigrams first; equal for equal bigrams."""
        if gram not in self._order:
            if len(self._order) > 1 << 16:
                self._order.clear()
            h = zlib.crc32(gram.encode())
            self._order[gram] = (self._counts[h % CLASSES] << 32) | h
        return self._order[gram]

    def prefix(self, word: str) -> tuple[int, list[tuple[int, int]]]:
        """Order of the third bigram, and (place, order) of all bigrams up to it."""
        orders = [self.order(word[i : i + 2]) for i in range(len(word) - 1)]
        last = sorted(orders)[2]
        return last, [(i, o) for i, o in enumerate(orders) if o <= last]

    @staticmethod
    def pivots(prefix: list[tuple[int, int]]) -> tuple[int, int]:
        """Places of two disjoint bigrams whose counts have the smallest sum; the leftmost of equal ones.

        ``single`` is the best bigram that ends before the present one, ``double`` the best pair so far.
        """
        double, single, waiting = None, None, []
        for place, order in prefix:
            while waiting and waiting[0][1] + 2 <= place:
                free = waiting.pop(0)
                single = free if single is None else min(single, free)
            if single is not None:
                pair = ((single[0] + (order >> 32)), single[1], place)
                double = pair if double is None else min(double, pair)
            waiting.append((order >> 32, place))
        return double[1], double[2]


def _key(*parts: object) -> int:
    h = xxhash.xxh3_64_intdigest("\x00".join(map(str, parts)).encode())
    return h - (1 << 64) if h >> 63 else h


def index_keys(word: str, prefix: list[tuple[int, int]]) -> Iterator[int]:
    """Four keys per bigram of the prefix: which side of it is equal, and which half of the rest."""
    n = len(word)
    for at, _ in prefix:
        middle = (at + 2 + n) // 2
        yield _key("La", at, n, word[:middle])
        yield _key("Lb", at, n, word[: at + 2], word[middle:])
        middle = at // 2
        yield _key("Ra", n - at, n, word[:middle], word[at:])
        yield _key("Rb", n - at, n, word[middle:])


def probe_keys(word: str, left: int, right: int) -> Iterator[int]:
    """The keys under which words one edit away from ``word`` are found, for each of their lengths."""
    size = len(word)
    for n in (size - 1, size, size + 1):
        if left + 2 <= n:
            middle = (left + 2 + n) // 2
            yield _key("La", left, n, word[:middle])
            yield _key("Lb", left, n, word[: left + 2], word[size - (n - middle) :])
        at = n - (size - right)  # the right pivot's place in a word of n letters
        if at >= 0:
            middle = at // 2
            yield _key("Ra", n - at, n, word[:middle], word[right:])
            yield _key("Rb", n - at, n, word[size - (n - middle) :] if n - middle <= size else word)


def _keyed(words: DataFrame, counts: np.ndarray, probing: bool) -> DataFrame:
    """One row per key: the word, its count and where its prefix ends."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(counts)
        for batch in batches:
            keys, sizes, lasts = [], [], []
            for word in batch.column(0).to_pylist():
                last, prefix = grams.prefix(word)
                own = set(probe_keys(word, *grams.pivots(prefix)) if probing else index_keys(word, prefix))
                keys.extend(own)
                sizes.append(len(own))
                lasts.append(last)
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(keys, pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lasts, pa.int64()), lists], names=["word", "n", "last", "keys"])

    keyed = words.select("word", "n").mapInArrow(task, "word string, n long, last long, keys array<long>")
    return keyed.select(F.explode("keys").alias("key"), "word", "n", "last")


def near_words(words: DataFrame) -> DataFrame:
    """``a``, ``n_a``, ``b``, ``n_b``: each pair of words exactly one edit apart, once.

    ``words`` holds distinct words of 4 code points and more in ``word``, and their counts in ``n``.
    """
    counts = gram_counts(words)
    r = _keyed(words, counts, True).select("key", F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("last").alias("last_a"))
    s = _keyed(words, counts, False).select("key", F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("last").alias("last_b"))
    first = (F.col("last_a") < F.col("last_b")) | ((F.col("last_a") == F.col("last_b")) & (F.col("a") < F.col("b")))
    met = r.join(s.hint("merge"), (r["key"] == s["key"]) & first & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "n_a", "b", "n_b").distinct()


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word`` and ``root``, the last of its chain of forms: chains halve in every round."""
    now = scratch.cut(forms.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = scratch.cut(now.join(further.hint("merge"), "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        now = joined.drop("moved")
        if not joined.where("moved").limit(1).count():
            return now


def group_variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """Per word: n, n_near, form and form_n (its most frequent near word, if ``factor`` times as frequent) and root."""
    scratch = Scratch(words.sparkSession, "spelling")
    words = scratch.cut(words.select("word", "n"))
    pairs = scratch.cut(near_words(words))
    both = pairs.select(F.col("a").alias("word"), "n_a", "b", "n_b").unionByName(pairs.select(F.col("b").alias("word"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b")))
    best = both.groupBy("word", F.col("n_a").alias("n")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("form"))).alias("best"))
    held = -F.col("best.less") >= factor * F.col("n")
    near = scratch.cut(best.select("word", "n_near", F.when(held, F.col("best.form")).alias("form"), F.when(held, -F.col("best.less")).alias("form_n")))
    roots = _roots(near.where("form is not null"), scratch)
    joined = words.join(near.hint("merge"), "word", "left").join(roots.hint("merge"), "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
