"""Operator 10: secrets in texts, by patterns and assignment-aware lexing.

Two sources of spans, in code points with exclusive ends:

* the base patterns ``assign``, ``access`` and ``hex`` below;
* ``lexed``: the text is read as source or configuration code
  (``assignments``): (name, literal) and (name, other name) pairs.  Constants
  are propagated: a literal counts for every name that its name is assigned on
  to, ``cfg.K`` meaning ``K`` too.  The literal's score is the sensitivity of
  the best such name times how random the literal looks; from ``MIN_SCORE``
  its span is reported, unless a base span covers it.  Strings that are joined
  have one span from the first to the last; a string or block of several lines
  has one a line.

Edge cases: null and empty texts have no spans; a null doc_id is carried;
repeated rows give repeated results; extra columns are ignored by
``scan_secrets`` and kept by ``redact_secrets``; texts are read whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterlens.llm.assignments import assignments

#: The base patterns and the least lengths of what they match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "lexed")

MIN_SCORE = 0.5
#: How telling a part of a name is.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "accesskey": 1.0, "privatekey": 1.0, "secretkey": 1.0, "credential": 0.9,
    "credentials": 0.9, "auth": 0.7, "bearer": 0.9, "signature": 0.6, "salt": 0.6, "cert": 0.5,
}
_NAME = re.compile(r"[A-Za-z_]+(?:[._/-][A-Za-z_]+)*")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base patterns, by start, then kind as listed."""
    spans = []
    if ":" in text or "=" in text:
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def sensitivity(name: str) -> float:
    """How much a name promises a secret, from its parts and neighbouring parts joined."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    joined = parts + [a + b for a, b in zip(parts, parts[1:])]
    return max((SENSITIVE.get(p, 0.0) for p in joined), default=0.0)


def randomness(literal: str) -> float:
    """0 to 1: entropy of the characters against that of a random string, no white space."""
    if len(literal) < 8 or re.search(r"\s", literal):
        return 0.0
    n = len(literal)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    kinds = sum(bool(re.search(k, literal)) for k in ("[a-z]", "[A-Z]", "[0-9]", "[^a-zA-Z0-9]"))
    return min(1.0, entropy / min(math.log2(n), 4.5)) * (0.4 + 0.2 * min(kinds, 3))


def propagated(names: set[str], flows: dict[str, set[str]]) -> dict[str, float]:
    """For each name the best sensitivity among the names that it flows to, its own included."""
    into: dict[str, list[str]] = {}
    for name, targets in flows.items():
        for target in targets:
            into.setdefault(target, []).append(name)
    own = {name: 0.0 if name[:1] in "&~" else sensitivity(name) for name in names.union(flows, into)}
    worth: dict[str, float] = {}
    for best in sorted(own, key=own.get, reverse=True):  # so the first score that reaches a name is its best
        todo = [best]
        while todo:
            name = todo.pop()
            if name not in worth:
                worth[name] = own[best]
                todo += into.get(name, ())
    return worth


def flow_graph(names: set[str], flows: list[tuple[str, str]]) -> dict[str, set[str]]:
    """What flows to what.  A reference ``&q.K`` takes from ``q.K`` and from a plain ``K``, a reference ``&K`` from
    ``K`` and, through ``~K``, from any ``q.K``; it gives to the name that it is assigned to."""
    graph: dict[str, set[str]] = {}
    for name in names.union(target for _, target in flows):
        if "." in name:
            graph.setdefault(name, set()).add("~" + name.rsplit(".", 1)[-1])
    for ref, target in flows:
        use = "&" + ref
        graph.setdefault(use, set()).add(target)
        for giver in (ref, ref.rsplit(".", 1)[-1] if "." in ref else "~" + ref):
            graph.setdefault(giver, set()).add(use)
    return graph


def lexed_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of literals that reach a sensitive name."""
    if ":" not in text and "=" not in text and "(" not in text and "</" not in text:
        return []
    pairs, flows = assignments(text)
    defined, used = {pair.name for pair in pairs}, {ref for ref, _ in flows}
    worth = propagated(defined, flow_graph(defined, flows))
    out = set()
    for name, literal, start, end, argument in pairs:
        score = worth[name]
        if not score or literal in defined and literal in used:
            continue  # nothing sensitive, or a use of another constant
        if argument and _NAME.fullmatch(literal) and sensitivity(literal):
            continue  # what a call looks up by its name
        if score * randomness(literal) >= MIN_SCORE:
            out.add(("lexed", start, end))
    return sorted(out, key=lambda s: s[1:])


def all_spans(text: str | None) -> tuple[list, list]:
    """(base spans, all spans by start then kind) of one text."""
    if not text:
        return [], []
    base = base_spans(text)
    lexed = lexed_spans(text)
    if not lexed:
        return base, base
    cover, i, reached = [], 0, -1
    for span in sorted(lexed, key=lambda s: s[1]):
        while i < len(base) and base[i][1] <= span[1]:
            reached = max(reached, base[i][2])
            i += 1
        if reached < span[2]:
            cover.append(span)
    return base, sorted(base + cover, key=lambda s: (s[1], KINDS.index(s[0])))


def _joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_SCAN = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)`` with its counts and spans."""

    def scan(batches):
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                base, spans = all_spans(text)
                n = Counter(k for k, _, _ in base)
                rows.append((doc_id, n["assign"], n["access"], n["hex"],
                             hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
            columns = list(zip(*rows)) if rows else [()] * 6
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             names=[f.split()[0] for f in _SCAN.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(scan, _SCAN)


def redact(text: str | None, mark: str = "[REDACTED]") -> str | None:
    """The text with every span replaced by ``mark``; overlapping spans by one."""
    spans = all_spans(text)[1]
    if not spans:
        return text
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets redacted in ``text``, and ``n_chars`` counted anew where it is a column."""
    schema, at = docs.schema, docs.columns.index("text")

    def clean(batches):
        for batch in batches:
            texts = pa.array([redact(t) for t in batch.column(at).to_pylist()], batch.column(at).type)
            yield batch.set_column(at, batch.schema.field(at), texts)

    out = docs.mapInArrow(clean, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
