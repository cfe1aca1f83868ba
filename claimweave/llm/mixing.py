"""Mixing sources to target weights, in fixed-length blocks of words.

Each source's documents, in the order of a hash, form one stream of words that is packed into
blocks of ``BLOCK`` words (the rest of the stream is one shorter block). A source's target is
filled in epochs: every epoch runs once through all its blocks in the order of a pseudorandom
permutation of their indices, the short block last; the last epoch stops at the target, cutting
its last block. So a source gives exactly its rounded target, and nothing is taken more often
than the epochs that have begun.

The slots of all sources are dealt to output shards of ``shard_blocks`` slots by another keyed
permutation. The source counts of a shard are thereby multinomial draws from the target shares,
conditioned on the totals (multivariate hypergeometric). Documents are joined by block index.

The permutations are swap-or-not networks, which work on any number of indices. All steps are
DataFrame expressions; offsets in a source are sums over about sqrt(rows) buckets and then
inside a bucket, so a source with a third of all rows is spread like the others.

Null or empty text has size 0, is never taken and gives source sizes 0. Null source is a source
of its own. Rows that repeat are separate documents. Empty table: no rows. Everything depends on
ids, sizes and the seed only, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.llm.tables import Scratch, quoted

BLOCK = 128
SHARD_BLOCKS = 4096
#: Weights by rank of the source in code point order, repeating.
WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2
_ROUNDS = 16
#: Slots made at once from one row.
_CHUNK = 1 << 14
_WORD = r"[^\x20\x09-\x0D]+"


def permuted(index: Column, size: Column, *key: Column) -> Column:
    """Image of ``index`` under a permutation of 0 .. size - 1 chosen by ``key``."""

    def swap(at: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(F.lit("pivot"), r, *key), size) - at, size)
        coin = F.xxhash64(F.lit("coin"), r, F.greatest(at, partner), *key).bitwiseAND(F.lit(1).cast("long"))
        return F.when(coin == 1, partner).otherwise(at)

    return F.aggregate(F.array(*(F.lit(r) for r in range(_ROUNDS))), index, swap)


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``sources`` (source, source_size) with sid, weight and target.

    With x the level at which min(most * size, x * weight) adds up to the whole: if the sources
    are filled up in the order of most * size / weight, x is the largest of the levels reached.
    """
    everything = Window.partitionBy()
    ranked = sources.withColumn("sid", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("sid") % len(weights) + 1).cast("int")))
    cap = (F.col("source_size") * most).cast("double")
    earlier = everything.orderBy(cap / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum(F.col("source_size").cast("double")).over(everything) * share - F.coalesce(F.sum(cap).over(earlier), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    )
    return ranked.withColumn("level", level).withColumn("target", F.least(cap, F.max("level").over(everything) * F.col("weight"))).drop("level")


class Mix:
    """The mix of ``docs``: sizes, sources with targets, slots, and what each document gives."""

    def __init__(self, docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS, seed: int = 0, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, keep: tuple[str, ...] = ()):
        self.block, self.shard_blocks, self.seed = block, shard_blocks, seed
        self.scratch = Scratch(docs.sparkSession, "mix")
        size = F.coalesce(F.regexp_count(quoted(text), F.lit(_WORD)), F.lit(0)).cast("long")
        kept = [quoted(c).alias(f"kept_{c}") for c in keep]
        # kept columns are written once under a row number and joined again at the end; what they hold only breaks ties
        marks = [F.monotonically_increasing_id().alias("row"), F.xxhash64(*(quoted(c) for c in keep)).alias("print")] if keep else []
        sized = self.scratch.cut(docs.select(quoted(doc_id).alias("doc_id"), quoted(source).alias("source"), size.alias("size"), *kept, *marks))
        self.kept = [c for c in sized.columns if c.startswith("kept_")]
        self.rows = sized.select("row", *self.kept) if keep else None
        sized = sized.drop(*self.kept)
        n_rows = sized.count()
        sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
        whole = F.round("target").cast("long")
        used = F.greatest(F.col("source_size"), F.lit(1))
        epochs, rest = F.floor(whole / used).cast("long"), whole % used
        per_epoch = F.ceil(F.col("source_size") / F.lit(block)).cast("long")
        sources = sources.withColumns({"whole": whole, "per_epoch": per_epoch, "n_slots": epochs * per_epoch + F.ceil(rest / F.lit(block)).cast("long")})
        before = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)
        self.sources = self.scratch.cut(sources.withColumn("first_slot", F.coalesce(F.sum("n_slots").over(before), F.lit(0).cast("long"))).coalesce(1))
        self.n_slots = self.sources.agg(F.sum("n_slots")).first()[0] or 0
        placed = self._placed(sized, n_rows)
        self.documents = self.scratch.cut(placed) if self.kept else placed

    def _placed(self, sized: DataFrame, n_rows: int) -> DataFrame:
        """Documents with sid, source size, target, and where their words begin in the source's stream."""
        n_buckets = int(n_rows**0.5) + 1
        rows = sized.join(self.sources.select(F.col("source").alias("_source"), "sid", "source_size", "target"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        rows = rows.withColumn("place", F.xxhash64(F.lit(self.seed), "doc_id", "size")).withColumn("bucket", F.pmod("place", F.lit(n_buckets)))
        sums = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
        before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select("sid", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0).cast("long")).alias("base"))
        inside = Window.partitionBy("sid", "bucket").orderBy("place", "doc_id", "size", *(["print", "row"] if self.kept else [])).rowsBetween(Window.unboundedPreceding, -1)
        begin = F.coalesce(F.sum("size").over(inside), F.lit(0).cast("long"))
        return rows.withColumn("inner", begin).join(sums, ["sid", "bucket"]).withColumn("start", F.col("base") + F.col("inner")).drop("place", "bucket", "base", "inner")

    def slots(self) -> DataFrame:
        """One row per slot: shard, place in it, sid, block, words taken from the block's beginning."""
        block = F.lit(self.block)
        chunks = self.sources.where("n_slots > 0").select("sid", "source_size", "whole", "per_epoch", "first_slot", "n_slots", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_slots") - 1, F.lit(_CHUNK).cast("long"))).alias("chunk"))
        chunks = chunks.repartition(max(1, min(self.n_slots // (4 * _CHUNK) + 1, 100_000)), "sid", "chunk")
        rows = chunks.withColumn("i", F.explode(F.sequence(F.col("chunk"), F.least(F.col("chunk") + _CHUNK, F.col("n_slots")) - 1)))
        epoch, step = F.floor(F.col("i") / F.col("per_epoch")).cast("long"), F.col("i") % F.col("per_epoch")
        rows = rows.withColumns({"epoch": epoch, "step": step, "full": F.floor(F.col("source_size") / block).cast("long")})
        index = F.when(F.col("step") < F.col("full"), permuted(F.col("step"), F.greatest(F.col("full"), F.lit(1)), F.lit(self.seed), F.col("sid"), F.col("epoch"))).otherwise(F.col("full"))
        left = F.col("whole") - F.col("epoch") * F.col("source_size") - F.col("step") * block
        length = F.least(block, F.col("source_size") - F.col("step") * block, left)
        dealt = permuted(F.col("first_slot") + F.col("i"), F.lit(max(1, self.n_slots)).cast("long"), F.lit(self.seed), F.lit("slots"))
        rows = rows.select("sid", index.alias("block"), length.alias("length"), dealt.alias("dealt"))
        return rows.select(F.floor(F.col("dealt") / self.shard_blocks).cast("long").alias("shard"), (F.col("dealt") % self.shard_blocks).alias("place"), "sid", "block", "length")

    def pieces(self) -> DataFrame:
        """Documents with words, once for each block they lie in: ``low`` to ``high`` in the block."""
        docs = self.documents.where("size > 0")
        end = F.col("start") + F.col("size")
        rows = docs.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / self.block).cast("long"), F.floor((end - 1) / self.block).cast("long"))))
        return rows.withColumns({"low": F.greatest(F.col("start") - F.col("block") * self.block, F.lit(0).cast("long")), "high": F.least(end - F.col("block") * self.block, F.lit(self.block).cast("long"))})

    def taken(self, spans: bool = False) -> DataFrame:
        """Documents with ``taken``, the words the mix takes from them, repeats counted.

        With ``spans`` also the word ranges (from, to exclusive) that it takes at least once, in order and disjoint.
        """
        draws = self.slots().groupBy("sid", "block", "length").agg(F.count("*").alias("times"))
        # the planner takes exploded rows for as few as their parents; either side grows with the data
        joined = self.pieces().hint("merge").join(draws, ["sid", "block"], "left")
        words = F.greatest(F.least(F.col("high"), F.col("length")) - F.col("low"), F.lit(0).cast("long")) * F.col("times")
        names = ["doc_id", "source", "size", "source_size", "target", *(["row"] if self.kept else [])]
        sums = [F.coalesce(F.sum(words), F.lit(0).cast("long")).alias("taken")]
        more = ["taken"]
        if spans:
            begin = F.col("block") * self.block + F.col("low") - F.col("start")
            part = F.struct(begin.alias("from"), (begin + F.least(F.col("high"), F.col("length")) - F.col("low")).alias("to"))
            sums.append(F.collect_list(F.when(words > 0, part)).alias("spans"))  # two a block at most: a text's own length bounds them
            more.append("spans")
        # a document with words has its own place in its source's stream
        some = joined.groupBy("sid", "start", *names).agg(*sums)
        if spans:
            some = some.withColumn("spans", _longest("spans"))
        some = some.select(*names, *more)
        nothing = [F.lit(0).cast("long").alias("taken")]
        if spans:
            nothing.append(F.array().cast(some.schema["spans"].dataType).alias("spans"))
        every = some.unionByName(self.documents.where("size = 0").select(*names, *nothing))
        return self.with_kept(every) if self.kept else every

    def with_kept(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the kept columns in place of the row number."""
        return rows.join(self.rows, "row").drop("row", "print")


def _longest(spans: str) -> Column:
    """Ranges in order; of those with one beginning the longest. A block's draws differ in length only."""
    ordered = F.array_sort(spans)
    return F.get(F.transform(F.array(ordered), lambda s: F.filter(s, lambda x, k: ~F.coalesce(F.get(s, k + 1)["from"] == x["from"], F.lit(False)))), F.lit(0))


def spanned_text(text: Column, spans: Column, size: Column) -> Column:
    """The words of ``text`` within ``spans``; the text itself where these are all its words."""
    covered = F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x["to"] - x["from"])
    words = F.regexp_extract_all(text, F.lit(_WORD), 0)
    parts = F.get(F.transform(F.array(words), lambda w: F.transform(spans, lambda x: F.array_join(F.slice(w, (x["from"] + 1).cast("int"), (x["to"] - x["from"]).cast("int")), " "))), F.lit(0))
    return F.when(covered == size, text).otherwise(F.array_join(parts, " "))


def mixed_blocks(docs: DataFrame, text: str = "text", **settings) -> DataFrame:
    """The mix itself: shard, place, source and the words of each slot, in the order of the stream."""
    mix = Mix(docs, text=text, keep=(text,), **settings)
    body = F.col(f"kept_{text}")
    words = F.slice(F.regexp_extract_all(body, F.lit(_WORD), 0), (F.col("block") * mix.block + F.col("low") - F.col("start") + 1).cast("int"), (F.col("high") - F.col("low")).cast("int"))
    parts = mix.with_kept(mix.pieces()).select("sid", "block", "source", "low", words.alias("words"))
    rows = mix.slots().hint("merge").join(parts, ["sid", "block"]).where("low < length")
    gathered = rows.groupBy("shard", "place", "sid", "source", "length").agg(F.array_sort(F.collect_list(F.struct("low", "words"))).alias("parts"))
    flat = F.flatten(F.transform("parts", lambda p: p["words"]))
    return gathered.select("shard", "place", "source", F.slice(flat, F.lit(1), F.col("length").cast("int")).alias("words"))
