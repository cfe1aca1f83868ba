"""Token counts of whole texts by a public tokenizer, in Arrow batches.

A text is cut at safe boundaries, namely a single space between two characters that are not
white space. Byte-level pre-tokenizers attach such a space to what follows it and never join
across it, so the lengths of the parts add up to the length of the text. The parts of a few
megabytes of text are pooled, those not met before are encoded in batches of about equal
bytes, and only lengths are kept and returned. The tables of known lengths are bounded.

Null text counts as empty (0 bytes, 0 tokens). Rows with equal ids are counted one by one.
Other columns stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweave.llm.tables import fresh, quoted

#: Bytes of text whose parts are pooled, and bytes of parts in one call of the library.
POOL_BYTES, CALL_BYTES = 4 << 20, 32 << 10
#: Known lengths kept by a task; parts over the length are never kept.
KNOWN, KNOWN_CHARS = 800_000, 64

_SAFE = re.compile(r"(?<=\S) (?=\S)")
_loaded: dict[int, object] = {}


def _tokenizer(text: str):
    from tokenizers import Tokenizer

    key = hash(text)
    if key not in _loaded:
        _loaded[key] = Tokenizer.from_str(text)
        _loaded[key].no_truncation()
        _loaded[key].no_padding()
    return _loaded[key]


def _calls(parts: list[str], limit: int) -> Iterator[list[str]]:
    """Runs of parts of about equal size."""
    at = 0
    while at < len(parts):
        size, stop = 0, at
        while stop < len(parts) and (stop == at or size < limit):
            size += len(parts[stop])
            stop += 1
        yield parts[at:stop]
        at = stop


def _encode(tokenizer, parts: list[str]) -> list[int]:
    return [len(e) for call in _calls(parts, CALL_BYTES) for e in tokenizer.encode_batch_fast(call, add_special_tokens=False)]


def _encode_joined(tokenizer, parts: list[str]) -> list[int]:
    """Lengths of parts that open with a space and end in another character.

    Such parts may stand behind one another in one text; where its tokens begin tells whose they are.
    """
    out: list[int] = []
    for call in _calls(parts, CALL_BYTES):
        ends = np.cumsum([len(p) for p in call])
        begins = np.array([o[0] for o in tokenizer.encode("".join(call), add_special_tokens=False).offsets], np.int64)
        out += np.bincount(np.searchsorted(ends, begins, side="right"), minlength=len(call)).tolist()
    return out


class _Lengths:
    """Lengths of parts that follow a cut (``lead`` is the space) or open a text."""

    def __init__(self, tokenizer, lead: str):
        self.tokenizer, self.lead, self.known = tokenizer, lead, {}

    def learn(self, parts: set[str]) -> dict[str, int]:
        """Lengths of the parts not known yet; the table of known ones starts anew when full."""
        new = [p for p in parts if p not in self.known]
        joined = [p for p in new if self.lead and not p[-1].isspace()]
        single = [p for p in new if not self.lead or p[-1].isspace()]
        got = dict(zip(joined, _encode_joined(self.tokenizer, [self.lead + p for p in joined]), strict=True))
        got.update(zip(single, _encode(self.tokenizer, [self.lead + p for p in single]), strict=True))
        if len(self.known) + len(got) > KNOWN:
            keep = {p: self.known[p] for p in parts if p in self.known}
            self.known = {}
            got |= keep
        self.known.update((p, n) for p, n in got.items() if len(p) <= KNOWN_CHARS)
        return got


def count_pool(texts: list[str], heads: _Lengths, tails: _Lengths) -> list[int]:
    cut = [_SAFE.split(t) for t in texts]
    new_heads = heads.learn({c[0] for c in cut})
    parts: set[str] = set()
    for c in cut:
        parts.update(c[1:])
    new_tails = tails.learn(parts)
    known = tails.known
    out = []
    for c in cut:
        n = new_heads[c[0]] if c[0] in new_heads else heads.known[c[0]]
        for p in c[1:]:
            k = known.get(p)
            n += new_tails[p] if k is None else k
        out.append(n)
    return out


def count_tokens(docs: DataFrame, tokenizer_path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes`` and ``n_tokens`` (renamed with ``_`` where taken) of ``text``.

    ``tokenizer_path`` names a ``tokenizers`` file whose pre-tokenizer is byte-level. Its
    content is sent to the tasks, so that executors need no copy.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    n_bytes, n_tokens = fresh(docs, "n_bytes"), fresh(docs, "n_tokens")
    name = docs.columns.index(text)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(content.value)
        heads, tails = _Lengths(tokenizer, ""), _Lengths(tokenizer, " ")
        for batch in batches:
            column, sizes = batch.column(name), batch.column(batch.num_columns - 1).to_pylist()
            counts: list[int] = []
            at = 0
            while at < len(sizes):
                total, stop = 0, at
                while stop < len(sizes) and (stop == at or total + sizes[stop] <= POOL_BYTES):
                    total += sizes[stop]
                    stop += 1
                counts += count_pool([t or "" for t in column.slice(at, stop - at).to_pylist()], heads, tails)
                at = stop
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64())], names=[*batch.schema.names, n_tokens])

    sized = docs.withColumn(n_bytes, F.coalesce(F.octet_length(quoted(text)), F.lit(0)).cast("long"))
    schema = T.StructType([*sized.schema.fields, T.StructField(n_tokens, T.LongType())])
    return sized.mapInArrow(task, schema)
