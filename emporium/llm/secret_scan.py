"""Secret scans with a trigram inverted index per block of documents.

For every rule a Boolean query over trigrams is derived from its regular
expression (:func:`trigram_query`, from Python's own parse tree).  For each
block of documents an inverted index maps every trigram that some rule needs
to the rows of the block that hold it; a rule's query intersects and unites
these postings, and only the candidate rows are verified with the expression.
Rules without mandatory trigrams scan all rows of the block.  Nothing is
shuffled; the index is bounded by the block.

Defined results: null text counts as empty and has no spans; long texts are
scanned whole; spans are code points, end exclusive, by start, then in the
order of the rules; repeated rows give equal rows; a null id stays null; an
empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 512


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; those whose ``group``
    is shorter than ``least`` are dropped."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The base kinds.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: Published formats of common credentials.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"(?:sk|rk)_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    # A scheme has up to 31 characters and begins a run of letters: long runs are passed in one go.
    Rule("url", r"(?<![a-z])[a-z][a-z0-9+.-]{0,30}://[^\s:/@]+:[^\s:/@]+@"),
)

# --- Boolean trigram queries -----------------------------------------------
# A query is True (no trigram is needed), a trigram, or ("and" | "or", parts).


def _join(kind: str, parts: list):
    flat = []
    for p in parts:
        if p is True:
            if kind == "or":
                return True
            continue
        flat.extend(p[1] if isinstance(p, tuple) and p[0] == kind else [p])
    flat = list(dict.fromkeys(flat))
    return True if not flat else flat[0] if len(flat) == 1 else (kind, tuple(flat))


def _of_strings(strings: set[str]):
    """Texts that hold one of ``strings``: all trigrams of one of them."""
    return _join("or", [_join("and", [s[i:i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _walk(tree, fold: bool) -> tuple[set[str] | None, object]:
    """``(strings, query)``: the set of strings the tree can match (None if
    unknown or large) and a query that every match satisfies.  Strings are
    lower-cased: the index is built over lower-cased text."""
    query, run, exact = [], {""}, True
    for op, arg in tree:
        name, strings, q = str(op), None, True
        if name == "LITERAL":
            strings = {chr(arg).lower()}
        elif name == "IN":
            chars: set[str] | None = set()
            for o, a in arg:
                if str(o) == "LITERAL":
                    chars.add(chr(a).lower())
                elif str(o) == "RANGE" and a[1] - a[0] < 8:
                    chars |= {chr(x).lower() for x in range(a[0], a[1] + 1)}
                else:
                    chars = None
                    break
            strings = chars if chars and len(chars) <= 8 else None
        elif name == "BRANCH":
            subs = [_walk(t, fold) for t in arg[1]]
            strings = set().union(*(s for s, _ in subs)) if all(s is not None for s, _ in subs) else None
            q = _join("or", [x for _, x in subs])
        elif name == "SUBPATTERN":
            strings, q = _walk(arg[-1], fold)
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, sub = arg
            s, sq = _walk(sub, fold)
            if s is not None and (low, high) == (0, 1):
                strings = s | {""}
            elif s is not None and low == high and low <= 8:
                strings = {""}
                for _ in range(low):
                    strings = {a + b for a in strings for b in s}
            elif low > 0:
                q = sq
        elif name == "AT":
            strings = {""}
        if strings is not None and len(run) * len(strings) <= 64:
            run = {a + b for a in run for b in strings}
            continue
        query += [_of_strings(run), q]
        run, exact = {""}, False
        if strings is not None and len(strings) <= 64:
            run = strings
    query.append(_of_strings(run))
    return (run if exact else None), _join("and", query)


def trigram_query(pattern: str):
    """Boolean query over lower-cased trigrams that every match satisfies."""
    return _walk(re._parser.parse(pattern, re.ASCII), False)[1]


def needed(query) -> set[str]:
    if query is True:
        return set()
    if isinstance(query, str):
        return {query}
    return set().union(*(needed(q) for q in query[1]))


def candidates(query, postings: dict[str, set[int]], everyone: set[int]) -> set[int]:
    if query is True:
        return everyone
    if isinstance(query, str):
        return postings[query]
    sets = [candidates(q, postings, everyone) for q in query[1]]
    return set.intersection(*sets) if query[0] == "and" else set().union(*sets)


def scan_block(texts: list[str], rules: tuple[Rule, ...], queries: list) -> list[list[tuple[int, int, int]]]:
    """Spans ``(start, rule number, end)`` per text, sorted."""
    low = [t.lower() for t in texts]
    postings = {g: {i for i, t in enumerate(low) if g in t} for g in set().union(*map(needed, queries))}
    everyone = set(range(len(texts)))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, (rule, query) in enumerate(zip(rules, queries)):
        find = re.compile(rule.pattern, re.ASCII).finditer
        for i in candidates(query, postings, everyone):
            out[i] += [(m.start(), k, m.end()) for m in find(texts[i]) if m.end(rule.group) - m.start(rule.group) >= rule.least]
    for spans in out:
        spans.sort()
    return out


_SPANS = "array<struct<kind: string, start: bigint, end: bigint>>"


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, id_col: str = "doc_id",
         text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """``(doc_id, spans)``, spans as an array of (kind, start, end)."""
    plain = [(r.kind, r.pattern, r.group, r.least) for r in rules]

    def run(batches):
        own = tuple(Rule(*r) for r in plain)
        queries = [trigram_query(r.pattern) for r in own]
        for batch in batches:
            for n in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(n, BLOCK_ROWS)
                found = scan_block([t or "" for t in part.column(1).to_pylist()], own, queries)
                spans = [[{"kind": own[k].kind, "start": s, "end": e} for s, k, e in f] for f in found]
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, f"doc_id long, spans {_SPANS}")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, text_col: str = "text",
           mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span of the text replaced by ``mark``
    (overlapping spans become one mark); other columns are untouched."""
    plain = [(r.kind, r.pattern, r.group, r.least) for r in rules]
    names, at = docs.columns, docs.columns.index(text_col)

    def cover(text: str, spans) -> str:
        parts, done, upto = [], 0, 0
        for s, _, e in spans:
            if s >= upto:
                parts += [text[done:s], mark]
            done = upto = max(upto, e)
        return "".join(parts) + text[done:]

    def run(batches):
        own = tuple(Rule(*r) for r in plain)
        queries = [trigram_query(r.pattern) for r in own]
        for batch in batches:
            for n in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(n, BLOCK_ROWS)
                texts = part.column(at).to_pylist()
                found = scan_block([t or "" for t in texts], own, queries)
                new = pa.array([cover(t, f) if f else t for t, f in zip(texts, found)], pa.string())
                yield pa.RecordBatch.from_arrays([new if i == at else part.column(i) for i in range(len(names))],
                                                 names=names)

    return docs.mapInArrow(run, docs.schema)
