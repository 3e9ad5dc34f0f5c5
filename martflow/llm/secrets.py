"""Secret scan over a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over the
trigrams that any match must contain (alternatives are OR-ed, sequences
AND-ed). The texts of one Arrow batch form an index segment: postings
(trigram -> texts) are built by numpy in one pass over the lower-cased bytes,
the query of each rule is evaluated by intersecting and uniting postings, and
only the texts that remain are verified with the regular expression. A rule
without mandatory trigrams (``hex``) scans every text. Segments are
independent, so the scan is one narrow pass: no shuffle, bounded memory, and a
lost executor repeats only its own segments.

Defined results: a null text counts as empty; an empty text has no spans; an
empty table gives an empty table; repeated rows each give their row; other
columns are ignored by :func:`scan` and kept by :func:`redact`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import LOWER, raw, slices


@dataclass(frozen=True)
class Rule:
    """``kind``; ``pattern``; a match counts if group ``group`` has at least
    ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    fold: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.A | (re.I if self.fold else 0))


# The three base kinds, in the order that breaks ties.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # the same spans as [0-9a-f]+ with the short ones dropped: a run is taken whole
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
# Further kinds that the scan adds.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9._~+/-]{16,}=*", fold=True),
    Rule("url_login", r"[a-z][a-z0-9+]{1,15}://[A-Za-z0-9._-]+:[^\s:@/]+@"),
)
RULES = BASE_RULES + MORE_RULES

# -- regular expression -> Boolean trigram query ------------------------------
# A query is True (any text), or a tuple ("t", trigram bytes) / ("and", ...) / ("or", ...).

_MOST = 64  # strings held while a sequence is still exact


def _both(op: str, parts: list) -> object:
    if op == "and":
        parts = [p for p in parts if p is not True]
        if not parts:
            return True
    elif any(p is True for p in parts):
        return True
    parts = list(dict.fromkeys(parts))
    return parts[0] if len(parts) == 1 else (op, *parts)


def _of_strings(strings: set[str]) -> object:
    """Some one of the strings occurs."""
    out = []
    for s in sorted(strings):
        b = s.lower().encode()
        out.append(_both("and", [("t", b[i:i + 3]) for i in range(len(b) - 2)]))
    return _both("or", out)


def _walk(items) -> tuple[set[str] | None, object]:
    """(all strings it can match, if few; a query that every match satisfies)."""
    now, whole, asked = {""}, True, []

    def flush():
        nonlocal now
        asked.append(_of_strings(now))
        now = {""}

    for op, arg in items:
        tail = False  # what follows doesn't join on directly
        if op is sre.LITERAL:
            exact, query = {chr(arg)}, True
        elif op is sre.SUBPATTERN:
            exact, query = _walk(arg[-1])
        elif op is sre.BRANCH:
            got = [_walk(x) for x in arg[1]]
            exact = set().union(*(x for x, _ in got)) if all(x is not None for x, _ in got) else None
            query = _both("or", [_of_strings(x) if x is not None else q for x, q in got])
        elif op is sre.IN and all(k is sre.LITERAL for k, _ in arg) and len(arg) <= 8:
            exact, query = {chr(c) for _, c in arg}, True
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, inner = arg
            exact, query = _walk(inner)
            if low == 0:
                exact, query = (exact | {""} if exact is not None and high == 1 else None), True
            elif high != 1:
                tail = True
        elif op is sre.AT:
            continue
        else:
            exact, query = None, True
        if exact is None or len(now) * len(exact) > _MOST:
            flush()
            whole = False
            asked.append(query if exact is None else _of_strings(exact))
        else:
            now = {a + b for a in now for b in exact}
            if tail:
                flush()
                whole = False
    if whole:
        return now, _of_strings(now)
    flush()
    return None, _both("and", asked)


def trigram_query(pattern: str) -> object:
    """The Boolean query over lower-cased trigrams that any match of
    ``pattern`` satisfies, or True if none is mandatory."""
    return _walk(sre_parser.parse(pattern))[1]


def _trigrams(query) -> set[bytes]:
    if query is True:
        return set()
    return {query[1]} if query[0] == "t" else set().union(*map(_trigrams, query[1:]))


class Index:
    """Trigram index of one segment of texts, for the trigrams that rules ask for."""

    def __init__(self, rules):
        self.rules = rules
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.ids = {t: i + 1 for i, t in enumerate(sorted(set().union(*map(_trigrams, self.queries))))}
        if len(self.ids) > 65_000:
            raise ValueError("too many trigrams for one index")
        self.slot = np.zeros(1 << 24, dtype=np.uint8 if len(self.ids) < 256 else np.uint16)
        for t, i in self.ids.items():
            self.slot[t[0] << 16 | t[1] << 8 | t[2]] = i

    def postings(self, data: np.ndarray, offsets: np.ndarray) -> dict[int, np.ndarray]:
        if len(data) < 3:
            return {}
        b = LOWER[data].astype(np.int32)
        slot = self.slot[(b[:-2] << 16) | (b[1:-1] << 8) | b[2:]]
        at = np.flatnonzero(slot)
        text = np.searchsorted(offsets, at, side="right") - 1
        inside = at + 3 <= offsets[text + 1]
        pair = np.unique(slot[at[inside]].astype(np.int64) << 32 | text[inside])
        which, texts = pair >> 32, pair & 0xFFFFFFFF
        bounds = np.searchsorted(which, np.arange(len(self.ids) + 2))
        return {i: texts[bounds[i]:bounds[i + 1]] for i in range(1, len(self.ids) + 1)}

    def candidates(self, query, posts: dict[int, np.ndarray], n: int) -> np.ndarray:
        if query is True:
            return np.arange(n)
        if query[0] == "t":
            return posts.get(self.ids[query[1]], np.zeros(0, np.int64))
        got = [self.candidates(q, posts, n) for q in query[1:]]
        out = got[0]
        for x in got[1:]:
            out = np.intersect1d(out, x, assume_unique=True) if query[0] == "and" else np.union1d(out, x)
        return out

    def spans(self, texts: list[str | None], data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, int]]]:
        """Per text the (start, rule number, end) of every verified match, in order."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        posts = self.postings(data, offsets)
        for k, (rule, query) in enumerate(zip(self.rules, self.queries)):
            find = rule.compiled().finditer
            for i in self.candidates(query, posts, len(texts)):
                if texts[i]:
                    found[i] += [(m.start(), k, m.end()) for m in find(texts[i])
                                 if m.end(rule.group) - m.start(rule.group) >= rule.least]
        for x in found:
            x.sort()
        return found


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_indexes: dict[tuple, Index] = {}


def _index(rules: tuple[Rule, ...]) -> Index:
    if rules not in _indexes:
        _indexes[rules] = Index(rules)
    return _indexes[rules]


def _each(column: pa.Array, rules) -> Iterator[tuple[list, list]]:
    index = _index(rules)
    data, offsets = raw(column)
    for i, j in slices(offsets):
        texts = column.slice(i, j - i).to_pylist()
        yield texts, index.spans(texts, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: ``doc_id`` and ``spans`` array<struct<kind, start,
    end>> (code points, end exclusive, by start, then in the rules' order)."""
    def task(batches):
        for b in batches:
            out = [[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in x] for _, f in _each(b.column(1), rules) for x in f]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(SPAN))], names=["doc_id", "spans"])

    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return src.mapInArrow(task, f"doc_id {src.schema[0].dataType.simpleString()}, "
                                "spans array<struct<kind: string, start: bigint, end: bigint>>")


def redact(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES,
           mask: str = "[{kind} removed]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mask`` (overlapping
    spans are merged; the first one's kind names the mask). Null stays null;
    all other columns and all rows are kept."""
    at = docs.columns.index(text)

    def one(t, spans):
        if not spans:
            return t
        out, end = [], 0
        for s, k, e in spans:
            if s >= end:
                out += [t[end:s], mask.format(kind=rules[k].kind)]
            end = max(end, e)
        return "".join(out) + t[end:]

    def task(batches):
        for b in batches:
            col = [one(t, x) for texts, found in _each(b.column(at).cast(pa.string()), rules) for t, x in zip(texts, found)]
            arrays = list(b.columns)
            arrays[at] = pa.array(col, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=b.schema.names)

    return docs.mapInArrow(task, docs.withColumn(text, F.col(text).cast("string")).schema)


def digest(scanned: DataFrame, base: tuple[str, ...] = tuple(r.kind for r in BASE_RULES)) -> DataFrame:
    """Per document the counts of the base kinds, the SHA-256 of their spans
    and all spans as text; native expressions over :func:`scan`'s rows."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def counted(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    first = F.filter("spans", lambda s: s["kind"].isin(*base))
    return scanned.select(
        "doc_id",
        *[counted(k) for k in base],
        F.sha2(joined(first).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))

