"""Operator 10: secret scans with assignment-aware lexing.

Fixed patterns give the base spans.  Beside them a small lexer reads assignments
in source and configuration syntax (name = "literal", name: literal, "name":
"literal", name := `literal`, concatenations), carries constants forward to the
names that they are given to, and scores every name-literal pair: how sensitive
the target name is, times how much the literal looks like a secret.  Under a fully
sensitive name any literal that is long enough and stands for nothing else counts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actuaria.llm.common import slices, texts_of

KINDS = ("assign", "access", "hex", "named")
_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of 24 and more are the matches of [0-9a-f]+ that are long enough

#: Parts of a name and how sensitive they make it; pairs of parts count where both are there.
NAME_PARTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0,
    "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "auth": 0.6, "signature": 0.6, "pass": 0.7,
}
NAME_PAIRS = {("api", "key"): 1.0, ("access", "key"): 1.0, ("private", "key"): 1.0, ("secret", "key"): 1.0, ("auth", "key"): 0.9, ("encryption", "key"): 0.9}  # noqa: E501
#: Literals that stand for a secret that is not there.
PLACEHOLDERS = re.compile(r"(?i)^(?:true|false|null|none|nil|undefined|example|changeme|placeholder|todo|your[\w-]*|x+|\*+|\.+|<.*>|\$\{.*\}|\{\{.*\}\})$")  # noqa: E501
THRESHOLD = 0.5
#: Parts and pairs of parts of fully sensitive names; literals of SPOKEN names may be several words.
SPOKEN = frozenset(("password", "passwd", "pwd", "passphrase"))
SURE_PARTS = SPOKEN | {"secret", "apikey", "credential", "credentials"}
SURE_PAIRS = tuple(p for p, w in NAME_PAIRS.items() if w == 1.0)
#: Parts of names of things about a secret.
ABOUT = frozenset(
    "label hint prompt message msg error placeholder title text field name input length len min max policy file path url uri type kind "
    "format regex pattern id reset help tooltip description desc header algorithm alg encoding count ttl expiry expires status role".split()
)
#: Values of fully sensitive names that are no secrets: types, states, prompts, references.
_NO_SECRET = re.compile(
    r"(?i)^(?:str|string|text|bytes|number|integer|boolean|object|optional|required|unknown|default|hidden|masked|redacted|removed|missing|empty"
    r"|(.)\1*|%\(?\w+\)?s?|\$\w+|\{\w*\}|<[^>]*>)$"
)
_PROMPT = re.compile(r"(?i)^(?:please|enter|type|your|the|a|an|invalid|wrong|forgot\w*|reset|change|choose|confirm|must|no|not)\b|[?:!…]$|\.\.\.$")

_TOKEN = re.compile(
    r"""(?P<string>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)
      |(?P<assign>:=|=>|==|!=|<=|>=|=|:)
      |(?P<plus>\+|\.\.)
      |(?P<word>[A-Za-z_$][A-Za-z0-9_$./+-]*|[0-9][A-Za-z0-9_./+-]*)
      |(?P<end>[\n;,{}()\[\]])""",
    re.VERBOSE,
)
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def name_parts(name: str) -> list[str]:
    return [p.lower() for chunk in re.split(r"[^A-Za-z0-9]+", name) for p in _CAMEL.split(chunk) if p]


def name_score(name: str) -> float:
    parts = name_parts(name)
    pairs = [w for (a, b), w in NAME_PAIRS.items() if a in parts and b in parts]
    return max([0.0, *(NAME_PARTS.get(p, 0.0) for p in parts), *pairs])


def literal_score(literal: str) -> float:
    """0 for placeholders and ordinary words, towards 1 for long mixed literals."""
    if len(literal) < 6 or PLACEHOLDERS.match(literal) or " " in literal.strip():
        return 0.0
    counts = [literal.count(c) for c in set(literal)]
    bits = -sum(n / len(literal) * math.log2(n / len(literal)) for n in counts)
    classes = sum(bool(re.search(p, literal)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, bits / 3.5) * (1.0 if classes >= 2 else 0.45)


def surely(name: str, literal: str) -> bool:
    """Whether a fully sensitive name makes the literal a secret, whatever its characters."""
    parts = name_parts(name)
    if not ABOUT.isdisjoint(parts):
        return False
    pairs = [p for p in SURE_PAIRS if p[0] in parts and p[1] in parts]
    if SURE_PARTS.isdisjoint(parts) and not pairs:
        return False
    bare = literal.strip()
    if len(bare) < 6 or PLACEHOLDERS.match(bare) or _NO_SECRET.match(bare):
        return False
    if not re.search(r"\s", bare):
        return name_score(bare) == 0 or bool(re.search("[0-9]", bare))
    if bare.startswith("-----BEGIN "):
        return True
    return not SPOKEN.isdisjoint(parts) and not _PROMPT.search(bare) and SURE_PARTS.isdisjoint(name_parts(bare))


def stands_alone(text: str, start: int, end: int) -> bool:
    """Whether a literal is quoted, or the whole value of a line in configuration syntax (name=value, name: value)."""
    if start and text[start - 1] in "\"'`" and text[end : end + 1] == text[start - 1]:
        return True
    return text[end : end + 1] in ("", "\n", "\r") and (text[start - 1 : start] == "=" or text[max(0, start - 2) : start].endswith((":", ": ")))


def assignments(text: str) -> Iterator[tuple[str, int, int, str]]:
    """(name, start, end, literal) of each literal that reaches a name.

    A quoted literal, several joined by ``+`` (each reported), a bare word of
    configuration syntax, or a name to which a literal was given before: that
    literal's own place is reported for the new name.  Comparisons give nothing.
    """
    constants: dict[str, list[tuple[int, int, str]]] = {}
    name: str | None = None
    target: str | None = None
    values: list[tuple[int, int, str]] = []
    joined = True
    for m in _TOKEN.finditer(text):
        kind, token = m.lastgroup, m.group()
        if kind == "string":
            inner = (m.start() + 1, m.end() - 1, token[1:-1])
            if target is not None and joined:
                values.append(inner)
                joined = False
            else:
                name = token[1:-1]
        elif kind == "word":
            if target is not None and joined:
                values.extend(constants.get(token) or [(m.start(), m.end(), token)])
                joined = False
            else:
                if target is not None and values:
                    constants[target] = values
                    yield from ((target, *v) for v in values)
                    target, values = None, []
                name = token
        elif kind == "assign":
            if token in ("==", "!=", "<=", ">="):
                name = None
            elif name is not None:
                if target is not None and values:
                    constants[target] = values
                    yield from ((target, *v) for v in values)
                target, values, joined, name = name, [], True, None
        elif kind == "plus":
            joined = target is not None
        else:
            if target is not None and values:
                constants[target] = values
                yield from ((target, *v) for v in values)
            target, values, name, joined = None, [], None, True
    if target is not None and values:
        yield from ((target, *v) for v in values)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), code points, of the fixed patterns."""
    found = []
    low = text.lower()
    if any(h in low for h in _ASSIGN_HINTS):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m.group(1)) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def named_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The literals that score as secrets by their names and lie in no base span."""
    if "=" not in text and ":" not in text:
        return []
    low = text.lower()
    if not any(p in low for p in NAME_PARTS) and "key" not in low:
        return []
    found = {
        (start, end, "named")
        for name, start, end, literal in assignments(text)
        if name_score(name) * literal_score(literal) >= THRESHOLD or (stands_alone(text, start, end) and surely(name, literal))
    }
    return sorted(s for s in found if not any(b[0] <= s[0] and s[1] <= b[1] for b in base))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_spans, spans), one row per row of ``docs``.

    Spans are texts kind:start:end (code points, end exclusive), joined by commas
    in order of start, then kind.  ``spans`` holds the base spans and those of
    kind ``named``.  Null and empty texts have none.  Every text is read whole.
    Repeated rows come each, null ids stay null, an empty table gives an empty
    one; other columns are not read.  No shuffle.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            texts = texts_of(batch.column("text"))
            base = [base_spans(t) for t in texts]
            more = [sorted(b + named_spans(t, b), key=lambda s: (s[0], KINDS.index(s[2]))) for t, b in zip(texts, base)]
            counts = [pa.array([sum(s[2] == kind for s in b) for b in base], pa.int64()) for kind in KINDS[:3]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, pa.array(map(joined, base), pa.string()), pa.array(map(joined, more), pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "spans"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        scan, "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, spans string"
    )
