"""Benchmark decontamination by a generalised suffix automaton of normalised test items.

Words are runs of ASCII letters and digits and of everything beyond ASCII, A-Z lower-cased.
The automaton reads all items; a document's words are streamed through it and the length of
the longest match that ends at each word is tracked. Where it reaches ``window`` words, the
last ``window`` words stand in some item; an item of fewer words, but not none, counts where
it occurs as a whole.

A cheap exact test comes first: only runs of words in which each neighbouring pair is a
neighbouring pair of an item can match, so only such runs are walked. A pair that is taken
for another's by an equal 64-bit hash only makes the walk longer, not its result wrong,
as the walk compares the words themselves.

Items are handled in shards of a bounded number of words, each with an automaton of bounded
size that is built in a task. The driver passes one of them on to the tasks at a time, and between two
shards the documents are written, so a large benchmark costs more passes instead of more memory, in the
driver as in a task.

Null text has no words; an item without words never occurs. Items with equal ids count as
one in ``items``. Empty benchmark: no hits. Rows are handled one by one.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweave.llm import text as tx
from claimweave.llm.tables import Scratch, fresh, quoted

#: Words of items that one automaton holds, about (whole items).
SHARD_WORDS = 100_000

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: The same word class where Spark counts words; case does not matter for the count.
_COUNT = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def item_words(text: str | None) -> list[bytes]:
    raw = (text or "").encode()
    return _WORD.findall(raw.translate(bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))))


class Automaton:
    """Suffix automaton of all items of a shard over word numbers.

    ``step`` maps state * n_words + word to the next state; ``link`` and ``length`` are the
    suffix links and longest lengths. ``windows`` maps a state and length to item numbers.
    """

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        texts = [(item_id, w) for item_id, t in items if (w := item_words(t))]
        self.window = window
        self.words: dict[bytes, int] = {}
        for _, w in texts:
            for x in w:
                self.words.setdefault(x, len(self.words))
        self.ids = [item_id for item_id, _ in texts]
        self.size = max(1, len(self.words))
        coded = [[self.words[x] for x in w] for _, w in texts]
        self.lengths = sorted({min(window, len(w)) for w in coded}, reverse=True)
        self._build(coded)
        self.windows: dict[tuple[int, int], tuple[int, ...]] = {}
        gathered: dict[tuple[int, int], set[int]] = {}
        for number, w in enumerate(coded):
            need = min(window, len(w))
            for at, state, matched in self.walk(w):
                if matched >= need and (need == window or at == len(w) - 1):
                    gathered.setdefault((self.shrink(state, need), need), set()).add(number)
        self.windows = {k: tuple(sorted(v)) for k, v in gathered.items()}
        hashes = [np.array([self._hash(x) for x in w], np.uint64) for _, w in texts]
        self.vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.empty(0, np.uint64)
        pairs = [tx.combine([h[:-1], h[1:]]) for h in hashes if len(h) > 1]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.uint64)

    @staticmethod
    def _hash(word: bytes) -> np.uint64:
        return tx.words(np.frombuffer(word, np.uint8), np.array([0, len(word)]), tx.ALNUM).hash[0]

    def _build(self, coded: list[list[int]]) -> None:
        step: list[dict[int, int]] = [{}]
        link, length = [-1], [0]
        for w in coded:
            last = 0
            for c in w:
                if c in step[last]:  # an earlier item already has this continuation
                    q = step[last][c]
                    if length[q] == length[last] + 1:
                        last = q
                        continue
                    last = self._clone(step, link, length, last, c, q)
                    continue
                new = len(step)
                step.append({})
                link.append(0)
                length.append(length[last] + 1)
                p = last
                while p != -1 and c not in step[p]:
                    step[p][c] = new
                    p = link[p]
                if p != -1:
                    q = step[p][c]
                    link[new] = q if length[q] == length[p] + 1 else self._clone(step, link, length, p, c, q)
                last = new
        self.step = {s * self.size + c: t for s, own in enumerate(step) for c, t in own.items()}
        self.link, self.length = link, length

    @staticmethod
    def _clone(step, link, length, p: int, c: int, q: int) -> int:
        new = len(step)
        step.append(dict(step[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = new
        while p != -1 and step[p].get(c) == q:
            step[p][c] = new
            p = link[p]
        return new

    def walk(self, coded: list[int]) -> Iterator[tuple[int, int, int]]:
        """Place, state and length of the longest match that ends at each word (-1: no item has the word)."""
        step, link, length, size = self.step, self.link, self.length, self.size
        state = matched = 0
        for at, c in enumerate(coded):
            if c < 0:
                state = matched = 0
            else:
                while (to := step.get(state * size + c)) is None and state:
                    state = link[state]
                    matched = length[state]
                if to is None:
                    state = matched = 0
                else:
                    state, matched = to, matched + 1
            yield at, state, matched

    def shrink(self, state: int, need: int) -> int:
        """State of the last ``need`` words of a longer match."""
        while self.length[self.link[state]] >= need:
            state = self.link[state]
        return state

    def hits(self, coded: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged word ranges (end exclusive) inside occurrences, and the item numbers."""
        ranges: list[list[int]] = []
        items: set[int] = set()
        for at, state, matched in self.walk(coded):
            for need in self.lengths:
                if matched < need:
                    continue
                found = self.windows.get((self.shrink(state, need), need))
                if found:
                    items.update(found)
                    begin = at + 1 - need
                    while ranges and ranges[-1][0] >= begin:
                        ranges.pop()
                    if ranges and ranges[-1][1] >= begin:
                        ranges[-1][1] = at + 1
                    else:
                        ranges.append([begin, at + 1])
        return [(a, b) for a, b in ranges], items


def _member(sorted_values: np.ndarray, x: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in ``sorted_values``; ``seen`` is a table over the upper 20 bits."""
    maybe = np.flatnonzero(seen[(x >> np.uint64(44)).astype(np.int64)])
    out = np.zeros(len(x), bool)
    if len(maybe):
        at = np.searchsorted(sorted_values, x[maybe])
        at[at == len(sorted_values)] = 0
        out[maybe] = sorted_values[at] == x[maybe]
    return out


def _upper_bits(values: np.ndarray) -> np.ndarray:
    seen = np.zeros(1 << 20, bool)
    seen[(values >> np.uint64(44)).astype(np.int64)] = True
    return seen


def _scan(column: pa.Array, automaton: Automaton, tables: tuple[np.ndarray, np.ndarray]):
    """For each row: number of words, byte ranges and word ranges of hits, item numbers."""
    least = automaton.lengths[-1] if automaton.lengths else 1
    out = []
    for _, data, offsets in tx.groups(column):
        w = tx.words(data, offsets, tx.ALNUM)
        n = len(offsets) - 1
        bounds = np.searchsorted(w.doc, np.arange(n + 1))
        rows = [(int(b - a), [], [], ()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        if len(w.hash) and automaton.lengths:
            if least > 1:
                ok = _member(automaton.pairs, tx.combine([w.hash[:-1], w.hash[1:]]), tables[1]) & (w.doc[:-1] == w.doc[1:])
                first, last = _runs(ok)
                last = last + 1  # of pairs to words
            else:
                ok = _member(automaton.vocabulary, w.hash, tables[0])
                ok_next = np.append(w.doc[1:] != w.doc[:-1], True)
                first, last = _runs(ok, ok_next)
            long = last - first >= least
            lower = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
            for a, b in zip(first[long].tolist(), last[long].tolist(), strict=True):
                coded = [automaton.words.get(data[s:e].tobytes().translate(lower), -1) for s, e in zip(w.start[a:b], w.end[a:b], strict=True)]
                ranges, items = automaton.hits(coded)
                if ranges:
                    d = int(w.doc[a])
                    count, spans, bytes_, known = rows[d]
                    spans = [*spans, *((a - int(bounds[d]) + x, a - int(bounds[d]) + y) for x, y in ranges)]
                    bytes_ = [*bytes_, *((int(w.start[a + x] - offsets[d]), int(w.end[a + y - 1] - offsets[d])) for x, y in ranges)]
                    rows[d] = (count, spans, bytes_, {*known, *items})
        out += rows
    return out


def _runs(ok: np.ndarray, cut_after: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends (exclusive) of runs of true values; ``cut_after`` ends a run early."""
    before = np.append(False, ok[:-1] if cut_after is None else ok[:-1] & ~cut_after[:-1])
    first = np.flatnonzero(ok & ~before)
    after = np.append(ok[1:], False) if cut_after is None else np.append(ok[1:] & ~cut_after[:-1], False)
    return first, np.flatnonzero(ok & ~after) + 1


_RANGES = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def find_items(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` with a struct column ``leaks`` (renamed with ``_`` where taken).

    Fields: ``n_words``; ``words`` and ``bytes``, the disjoint ascending ranges of hit words and
    of their UTF-8 bytes; ``items``, ids of the items with occurring windows, sorted as strings.
    """
    spark = docs.sparkSession
    out = fresh(docs, "leaks")
    struct = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("words", _RANGES), T.StructField("bytes", _RANGES), T.StructField("items", T.ArrayType(T.StringType()))])
    schema = T.StructType([*docs.schema.fields, T.StructField(out, struct)])
    named = items.select(quoted(item_id).cast("string").alias("item_id"), quoted(item_text).alias("text"))
    total = named.agg(F.sum(F.regexp_count("text", F.lit(_COUNT)))).first()[0] or 0
    n_shards = max(1, -(-total // shard_words))
    name = docs.columns.index(text)

    def mapper(automaton, first: bool):
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = pickle.loads(automaton.value)
            tables = (_upper_bits(own.vocabulary), _upper_bits(own.pairs))
            for batch in batches:
                rows = _scan(batch.column(name), own, tables)
                columns = list(batch.columns)
                earlier = [None] * len(rows) if first else columns.pop().to_pylist()
                result = []
                for (count, spans, bytes_, found), old in zip(rows, earlier, strict=True):
                    ids = {own.ids[k] for k in found if own.ids[k] is not None}
                    if old:
                        spans = [*spans, *((x["start"], x["end"]) for x in old["words"])]
                        bytes_ = [*bytes_, *((x["start"], x["end"]) for x in old["bytes"])]
                        ids |= set(old["items"])
                    result.append({"n_words": count, "words": _merged(spans), "bytes": _merged(bytes_), "items": sorted(ids)})
                pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])
                kind = pa.struct([("n_words", pa.int64()), ("words", pa.list_(pair)), ("bytes", pa.list_(pair)), ("items", pa.list_(pa.string()))])
                yield pa.RecordBatch.from_arrays([*columns, pa.array(result, kind)], names=[*batch.schema.names[: len(columns)], out])

        return task

    def build(shard: pa.Table) -> pa.Table:
        rows = list(zip(shard["item_id"].to_pylist(), shard["text"].to_pylist(), strict=True))
        return pa.table({"shard": pa.array([shard["shard"][0].as_py()], pa.int64()), "automaton": pa.array([pickle.dumps(Automaton(rows, window))], pa.binary())})

    scratch = Scratch(spark, "decontaminate")
    shards = named.select(F.pmod(F.xxhash64("text"), F.lit(n_shards)).alias("shard"), "item_id", "text")
    built = scratch.cut(shards.groupBy("shard").applyInArrow(build, "shard long, automaton binary"))
    present = sorted(r["shard"] for r in built.select("shard").collect())
    frame = docs
    for k in present or [None]:
        own = built.where(F.col("shard") == k).first()["automaton"] if present else pickle.dumps(Automaton([], window))
        automaton = spark.sparkContext.broadcast(own)  # one shard
        frame = frame.mapInArrow(mapper(automaton, k is None or k == present[0]), schema)
        if len(present) > 1:
            frame = scratch.cut(frame)
            automaton.unpersist()
    return frame


def _merged(ranges: list[tuple[int, int]]) -> list[dict[str, int]]:
    out: list[dict[str, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], b)
        else:
            out.append({"start": a, "end": b})
    return out


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", window: int = 10, max_coverage: float = 0.8, **names) -> DataFrame:
    """``docs`` without the spans found in items, and without documents that mostly consist of them.

    A document is dropped when more than ``max_coverage`` of its words are hit; elsewhere each
    hit span is cut out of the text, bytes between words around it left as they are. A document
    without hits stays as it is, null text included.
    """
    found = find_items(docs, items, text, window=window, **names)
    leaks = found.columns[-1]
    hit = F.aggregate(F.col(leaks)["words"], F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    raw = F.encode(quoted(text), "UTF-8")
    ranges = F.col(leaks)["bytes"]
    state = F.aggregate(
        ranges,
        F.struct(F.lit(0).cast("int").alias("at"), F.lit(b"").alias("kept")),
        lambda s, x: F.struct(x["end"].cast("int").alias("at"), F.concat(s["kept"], F.substring(raw, s["at"] + 1, x["start"].cast("int") - s["at"])).alias("kept")),
        lambda s: F.decode(F.concat(s["kept"], F.substring(raw, s["at"] + 1, F.length(raw))), "UTF-8"),
    )
    cleaned = F.when(F.size(ranges) > 0, state).otherwise(quoted(text))
    kept = found.where((F.size(ranges) == 0) | (hit <= max_coverage * F.col(leaks)["n_words"]))
    return kept.select(*(cleaned.alias(c) if c == text else quoted(c) for c in docs.columns))


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
