"""Secret scan: certain patterns, and weak parts that are reported only when they belong together.

Certain spans (``assign``, ``access``, ``hex``) are always reported. Weak parts are access
identifiers (``user``), secrets of mixed characters (``key``) and endpoints (``host``). Each
says little alone, so parts of a document are joined by interval: the scope of a part reaches
``SCOPE`` code points to both sides but not past a blank line, and a weak secret is reported
only if an identifier lies in its scope, an endpoint only if a secret and an identifier do.
Certain spans take part: ``access`` as an identifier, ``assign`` and ``hex`` as secrets. The
join runs over sorted positions, so its work follows the number of parts, not of their pairs.

Null text counts as empty. Every row gets its own result; other columns stay as they are.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from claimweave.llm.tables import fresh

#: Order of kinds at equal starts; the first three are the certain ones.
KINDS = ("assign", "access", "hex", "user", "key", "host")
#: Code points between parts that may belong together, at most.
SCOPE = 600

_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_USER = re.compile(r"(?:user(?:name)?|login|account|client_?id|access_?key_?id)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9@+/_.-]{3,})", re.IGNORECASE | re.ASCII)
_KEY = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/_-]{32,}(?![A-Za-z0-9+/_-])")
_HOST = re.compile(r"[a-z][a-z0-9+.-]{1,15}://[^\s\"'<>]+", re.ASCII)
_GAP = re.compile(r"\n[ \t\r]*\n")
#: What a text must hold for its scan to find anything certain; matched by a linear-time engine.
_ANY = r"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{24}"

Span = tuple[int, int, str]


def certain(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each certain kind, failing ones dropped."""
    found = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return found


def _mixed(value: str) -> bool:
    return any(c.isdigit() for c in value) and any(c.islower() for c in value) and any(c.isupper() for c in value)


class _Parts:
    """Positions of one role in a document; tells whether one lies in a scope."""

    def __init__(self, spans: list[Span]):
        self.starts = sorted(s for s, _, _ in spans)

    def within(self, low: int, high: int) -> bool:
        k = bisect.bisect_left(self.starts, low)
        return k < len(self.starts) and self.starts[k] < high


def linked(text: str, base: list[Span]) -> list[Span]:
    """Weak parts whose complements lie in their scope."""
    covered = sorted((s, e) for s, e, _ in base)
    begins = [s for s, _ in covered]

    def free(start: int, end: int) -> bool:
        k = bisect.bisect_left(begins, end) - 1
        return k < 0 or covered[k][1] <= start

    users = [(m.start(1), m.end(1), "user") for m in _USER.finditer(text)]
    keys = [(m.start(), m.end(), "key") for m in _KEY.finditer(text) if _mixed(m.group(0)) and free(m.start(), m.end())]
    hosts = [(m.start(), m.end(), "host") for m in _HOST.finditer(text)]
    gaps = [m.start() for m in _GAP.finditer(text)]

    def scope(start: int, end: int) -> tuple[int, int]:
        k = bisect.bisect_left(gaps, start)
        low = max(start - SCOPE, gaps[k - 1] if k else 0)
        return low, min(end + SCOPE, gaps[k] if k < len(gaps) else len(text))

    identifiers = _Parts([*users, *(x for x in base if x[2] == "access")])
    secrets = _Parts([*keys, *(x for x in base if x[2] in ("assign", "hex"))])
    kept = [x for x in keys if identifiers.within(*scope(x[0], x[1]))]
    kept += [x for x in users if secrets.within(*scope(x[0], x[1]))]
    kept += [x for x in hosts if identifiers.within(*(at := scope(x[0], x[1]))) and secrets.within(*at)]
    return kept


def scan(text: str) -> list[Span]:
    """All spans (start, end, kind) in code points, end exclusive, by start and kind."""
    base = certain(text)
    return sorted([*base, *linked(text, base)], key=lambda x: (x[0], KINDS.index(x[2])))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``secrets`` (renamed with ``_`` where taken).

    Fields: ``n_assign``, ``n_access``, ``n_hex`` (counts of the certain kinds), ``base_sha256``
    (digest of the certain spans), ``spans`` (all spans as ``kind:start:end`` joined by commas).
    A text without a certain span or a weak secret has no linked parts and is not searched for them.
    """
    out = fresh(docs, "secrets")
    name = docs.columns.index(text)
    fields = [("n_assign", "long"), ("n_access", "long"), ("n_hex", "long"), ("base_sha256", "string"), ("spans", "string")]
    types = {"long": pa.int64(), "string": pa.string()}
    nothing = (0, 0, 0, hashlib.sha256(b"").hexdigest(), "")
    weak = r"[A-Za-z0-9+/_-]{32}"

    def result(value: str) -> tuple:
        spans = scan(value)
        base = [x for x in spans if x[2] in KINDS[:3]]
        counts = [sum(x[2] == k for x in base) for k in KINDS[:3]]
        return (*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = pc.fill_null(batch.column(name), "")
            hit = pc.or_(pc.match_substring_regex(column, _ANY), pc.match_substring_regex(column, weak))
            rows = [nothing] * len(column)
            for k in pc.indices_nonzero(hit).to_pylist():
                rows[k] = result(column[k].as_py())
            arrays = [pa.array([r[i] for r in rows], types[t]) for i, (_, t) in enumerate(fields)]
            struct = pa.StructArray.from_arrays(arrays, names=[f for f, _ in fields])
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*batch.schema.names, out])

    struct = T.StructType()
    for field, kind in fields:
        struct.add(field, kind)
    return docs.mapInArrow(task, T.StructType([*docs.schema.fields, T.StructField(out, struct)]))
