r"""Licence scan: Aho-Corasick over identifier tags and notice phrases, shunting-yard expressions.

Three automata run: one over raw bytes (lower-cased) to find whether a text holds any anchor at
all, one over the words of such a text for notice phrases, one for licence tags.  The expression
behind a tag is parsed by the shunting-yard algorithm (``with`` binds tighter than ``and``, that
tighter than ``or``; brackets; a trailing ``+``) and evaluated twice: into the set of licence
families it names, and into whether a policy's allowed families satisfy it.

Defined results: null reads as empty; an empty text has no words, null first and last word, empty
labels and score 0; ids may repeat or be null; other columns are ignored.
"""

from __future__ import annotations

import functools
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import vectext
from .common import map_batches

# fixed values: base phrases and their labels
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# fixed values: further notice phrases
NOTICES = {
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "boost software license": "boost",
    "creative commons": "cc",
    "licensed under cc": "cc",
    "public domain": "public-domain",
    "all rights reserved": "proprietary",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
}
# fixed values: tags that introduce an expression
TAGS = ("spdx-license-identifier:", "license-identifier:", "license-expression:", "licence:", "license:")
# fixed values: prefixes of identifiers and their families
FAMILIES = (("lgpl", "lgpl"), ("agpl", "agpl"), ("gpl", "gpl"), ("apache", "apache"), ("mit", "mit"), ("bsd", "bsd"), ("0bsd", "bsd"), ("mpl", "mpl"), ("epl", "epl"), ("isc", "isc"), ("bsl", "boost"), ("cc0", "public-domain"), ("unlicense", "public-domain"), ("cc", "cc"), ("zlib", "zlib"), ("proprietary", "proprietary"))
#: Families that the default policy accepts.
ALLOWED = ("apache", "bsd", "boost", "isc", "mit", "public-domain", "zlib")

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_TOKEN = re.compile(r"\(|\)|[a-z0-9][a-z0-9.+:-]*")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions array<string>, allowed boolean"


def family(identifier: str) -> str | None:
    name = identifier.rstrip("+")
    if name.startswith("licenseref-"):
        return "custom"
    return next((f for p, f in FAMILIES if name == p or name.startswith((p + "-", p + "_")) or name.startswith(p) and name[len(p) :][:1].isdigit()), None)


def to_postfix(text: str) -> tuple[list[str], str] | None:
    """Postfix of the longest valid expression at the start of ``text``, and that expression."""
    out, stack, tokens, wants, at, best = [], [], [], True, 0, None
    for m in _TOKEN.finditer(text.split("\n", 1)[0]):
        if text[at : m.start()].strip() and tokens or not tokens and text[: m.start()].strip(" \t\"'*#/"):
            break
        t = m.group()
        if wants:
            if t == "(":
                stack.append(t)
            elif t in _PRECEDENCE or t == ")":
                break
            elif stack and stack[-1] == "with":
                out.append(t)
                wants = False
            elif family(t := t.rstrip(".:-")) is None:
                break
            else:
                out.append(t)
                wants = False
        elif t == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                break
            stack.pop()
        elif t in _PRECEDENCE:
            while stack and stack[-1] != "(" and _PRECEDENCE[stack[-1]] >= _PRECEDENCE[t]:
                out.append(stack.pop())
            stack.append(t)
            wants = True
        else:
            break
        tokens.append(t)
        at = m.end()
        if not wants and "(" not in stack:
            best = [*out, *reversed(stack)], " ".join(tokens)
    return best


def evaluate(postfix: list[str], allowed: frozenset[str]) -> tuple[set[str], bool]:
    """The families an expression names, and whether ``allowed`` satisfies it."""
    stack: list[tuple[set[str], bool]] = []
    for t in postfix:
        if t in ("and", "or"):
            (b, y), (a, x) = stack.pop(), stack.pop()
            stack.append((a | b, x and y if t == "and" else x or y))
        elif t == "with":
            stack.pop()  # an exception only widens its licence's permissions
        else:
            f = family(t)
            stack.append((set(), False) if f is None else ({f}, f in allowed))
    return stack[0]


@functools.cache
def _automata() -> tuple[ahocorasick.Automaton, ahocorasick.Automaton, ahocorasick.Automaton]:
    def built(words):
        a = ahocorasick.Automaton()
        for key, value in words:
            a.add_word(key, value)
        a.make_automaton()
        return a

    anchors = {max(p.split(), key=len) for p in (*BASE, *NOTICES)} | {t.rstrip(":") for t in TAGS}
    return (
        built((x, x) for x in sorted(anchors)),
        built((f" {p} ", (p, label, p in BASE)) for p, label in sorted({**NOTICES, **BASE}.items())),
        built((t, t) for t in TAGS),
    )


def _lower(text: str) -> str:
    return text.encode(errors="surrogatepass").lower().decode(errors="surrogatepass")


def scan(text: str, allowed: frozenset[str]) -> dict:
    """What one text that holds an anchor has (all but n_words)."""
    _, notices, tags = _automata()
    lowered = _lower(text)
    words = _WORD.findall(lowered)
    joined = f" {' '.join(words)} "
    spaces = None
    places, base, labels, evidence = [], set(), set(), 0.0
    for end, (phrase, label, is_base) in notices.iter(joined):
        labels.add(label)
        evidence = max(evidence, 0.9 if is_base else 0.7)
        if is_base:
            if spaces is None:
                spaces = np.flatnonzero(np.frombuffer(joined.encode("utf-32-le", errors="surrogatepass"), np.uint32) == 32)
            base.add(label)
            places.append(int(np.searchsorted(spaces, end - len(phrase) - 1)))
    expressions, fits = [], None
    for end, _ in tags.iter_long(lowered):
        stop = lowered.find("\n", end)
        parsed = to_postfix(lowered[end + 1 : stop if stop >= 0 else None].lstrip(" \t"))
        if parsed:
            named, ok = evaluate(parsed[0], allowed)
            labels |= named
            expressions.append(parsed[1])
            fits = ok if fits is None else fits and ok
            evidence = 1.0
    if fits is None and labels:
        fits = labels <= allowed
    return {"n_base": len(places), "first_word": min(places, default=None), "last_word": max(places, default=None), "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)), "score": evidence, "expressions": expressions, "allowed": fits}


_NOTHING = {"n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "", "score": 0.0, "expressions": [], "allowed": None}


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """One row per input row; no shuffle.  ``score`` is the strength of the evidence for a notice:
    1 for a valid tagged expression, 0.9 for a base phrase, 0.7 for another notice, 0 for none.
    ``allowed`` tells whether the policy accepts what was found (null: nothing found)."""
    kind = docs.schema[id_col].dataType.simpleString()
    policy = frozenset(allowed)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        anchors = _automata()[0]
        counts, rows = [], []
        for first, end, data, offsets in vectext.chunks(b.column(1)):
            counts.append(np.diff(vectext.word_spans(data, offsets, vectext.PUNCT)[2]))
            for t in b.column(1)[first:end].to_pylist():
                hit = t and next(anchors.iter(_lower(t)), None)
                rows.append(scan(t, policy) if hit else _NOTHING)
        kinds = {"n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "expressions": pa.list_(pa.string()), "allowed": pa.bool_()}
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(counts), pa.int64()), *(pa.array([r[n] for r in rows], k) for n, k in kinds.items())], [id_col, "n_words", *kinds])

    return map_batches(docs.select(id_col, text_col), batch, f"`{id_col}` {kind}, {COLUMNS}")
