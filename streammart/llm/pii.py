"""Personal data (operator 2): base patterns, completed by a skip-chain conditional random field.

Base spans come from four patterns with their checks. The field's nodes are the tokens that carry a digit or
an ``@``, and those that repeat the name before the ``@`` of an address found in the document ("jane.doe" after
"jane.doe@x.org"; a name of letters only may be any word and is left alone); all other tokens are fixed to "no entity",
which cuts the chain there and keeps inference exact in cost: linear in such tokens. Chain edges join neighbouring
nodes, skip edges join each node to the next one and to the first one of the same document with the same or a
similar text (same digits without separators, same word without case), so that a label reaches every repeat in two steps.
Loopy sum-product messages run over both kinds of edge; tokens of base spans are clamped to their label, and
other tokens whose marginal passes ``threshold`` become further spans. Base spans are never removed.

Weights are fitted by pseudo-likelihood on a sample of at most ``SAMPLE_DOCS`` documents with base spans, the
base labels as targets; the own features of half of the tokens are masked, so that the edges learn too.

Cases: null text counts as empty, a document without nodes has no further spans, repeated rows each get their
row, an empty table gives an empty result, a corpus without base spans gives a field that adds nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streammart.llm.common import bounded_sample, slices

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
SAMPLE_DOCS = 2000
SAMPLE_NODES = 200  # of one sampled document; the sample is a fit only, inference reads all nodes
THRESHOLD = 0.9
LEAST_NAME = 5  # letters of a word that is linked to its repeats
MOST_DIGITS = {"card": 19, "phone": 15}  # of one span of several tokens; the other kinds have one token

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Possessive forms and the look-behind match what the plain forms match, in linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGNAL = re.compile(r"[0-9@]\S*")
_WORD = re.compile(r"\S+")
_SEPARATORS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` can take part in one match: the run of local characters before it, the domain after it."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-3:] if len(p) > 3 else p) <= 255 for p in text.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) in code points, by kind and start."""
    spans = [(0, s, e) for s, e in _emails(text)]
    spans += [(1, m.start(), m.end()) for m in _IP.finditer(text) if _octets(m.group())]
    for m in _CARD.finditer(text):
        digits = _SEPARATORS.sub("", m.group()) if m.end() - m.start() >= 16 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_SEPARATORS.sub("", m.group())) <= 15:
                spans.append((3, m.start(), m.end()))
    return spans


def nodes(text: str) -> list[tuple[int, int]]:
    """Tokens between white space that hold a digit or an ``@``, without outer punctuation."""
    found, free, at = [], 0, _SIGNAL.search(text)
    while at:
        start, end = at.span()
        while start > free and not text[start - 1].isspace():
            start -= 1
        free = end
        start, end = _trimmed(text, start, end)
        if start < end:
            found.append((start, end))
        at = _SIGNAL.search(text, free)
    return found


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while end > start and not (text[end - 1].isalnum()):
        end -= 1
    while start < end and not (text[start].isalnum() or text[start] == "+"):
        start += 1
    return start, end


def handles(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Tokens, none of them in ``nodes``, that are the name of an address among ``spans``, without case."""
    names = {text[s:e].partition("@")[0].lower() for kind, s, e in spans if kind == 0}
    names = {n for n in names if len(n) >= LEAST_NAME and not n.isalpha() and n[0].isalnum() and n[-1].isalnum()}
    if not names:
        return []
    found = []
    for word in _WORD.finditer(text):
        if not _SIGNAL.search(word.group()):
            start, end = _trimmed(text, *word.span())
            if text[start:end].lower() in names:
                found.append((start, end))
    return found


def labels_of(tokens: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> np.ndarray:
    """The label of the span that overlaps a token; 0 for none."""
    out = np.zeros(len(tokens), np.int64)
    starts = np.array([t[0] for t in tokens])
    ends = np.array([t[1] for t in tokens])
    for kind, s, e in spans:
        out[np.searchsorted(ends, s, "right") : np.searchsorted(starts, e, "left")] = kind + 1
    return out


def features(text: str, tokens: list[tuple[int, int]]) -> np.ndarray:
    """Shape features, one row a token."""
    rows = np.zeros((len(tokens), 14))
    for row, (s, e) in zip(rows, tokens):
        token = text[s : min(e, s + 64)]
        digits = _SEPARATORS.sub("", token)
        n = len(digits) if e - s <= 64 else 20
        row[0] = 1
        row[1 + (n > 0) + (n > 3) + (n > 7) + (n > 15) + (n > 19)] = 1
        row[7] = "@" in token and "." in token[token.rfind("@") :]
        row[8] = token[0] == "+" or (s > 0 and text[s - 1] == "+")
        row[9] = token.count(".") == 3 and bool(_IP.fullmatch(token)) and _octets(token)
        row[10] = 16 <= n <= 19 and luhn(digits)
        row[11] = any(c.isalpha() for c in token)
        row[12] = "-" in token or (s > 0 and text[s - 1] == "(")
        row[13] = "@" in token
    return rows


def edges(text: str, tokens: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of node numbers: chain (touching neighbours) and skip (next and first token with the same key)."""
    chain = [i for i in range(len(tokens) - 1) if tokens[i + 1][0] - tokens[i][1] <= 3]
    skip, first, last = set(), {}, {}
    for i, (s, e) in enumerate(tokens):
        token = text[s:e].lower()
        digits = _SEPARATORS.sub("", token)
        keys = {"d" + digits} if len(digits) >= 6 else set()
        if e - s >= LEAST_NAME:
            keys.add("w" + token.partition("@")[0])
        for key in keys:
            if key in last:
                skip |= {(last[key], i), (first[key], i)}
            first.setdefault(key, i)
            last[key] = i
    return np.array([(i, i + 1) for i in chain], np.int64).reshape(-1, 2), np.array(sorted(skip), np.int64).reshape(-1, 2)


@dataclass
class Field:
    """Log-linear weights: own features x label, left label x label, linked label x label."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def marginals(self, text: str, tokens: list[tuple[int, int]], known: np.ndarray, rounds: int = 30) -> np.ndarray:
        """Label probabilities of each node after loopy messages; nodes with ``known`` > 0 are clamped."""
        own = features(text, tokens) @ self.unary
        clamp = known > 0
        own[clamp] = -1e9  # more than any number of messages
        own[clamp, known[clamp]] = 0.0
        chain, skip = edges(text, tokens)
        pairs = np.concatenate([chain, skip])
        if len(pairs):
            table = np.concatenate(
                [np.repeat(self.chain[None], len(chain), 0), np.repeat(self.skip[None], len(skip), 0)]
            )
            source = np.concatenate([pairs[:, 0], pairs[:, 1]])
            target = np.concatenate([pairs[:, 1], pairs[:, 0]])
            table = np.concatenate([table, table.transpose(0, 2, 1)])
            back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
            messages = np.zeros((len(source), len(LABELS)))
            for _ in range(rounds):
                belief = own.copy()
                np.add.at(belief, target, messages)
                away = belief[source] - messages[back]
                new = _log_sum(away[:, :, None] + table)
                new -= _log_sum(new)[:, None]
                new = 0.5 * (new + messages)
                done = np.abs(new - messages).max() < 1e-4
                messages = new
                if done:
                    break
            np.add.at(own, target, messages)
        return np.exp(own - _log_sum(own)[:, None])

    def more_spans(
        self, text: str, spans: list[tuple[int, int, int]], threshold: float = THRESHOLD
    ) -> list[tuple[int, int, int]]:
        """Spans besides the given ones, none of which overlaps one of those."""
        tokens = sorted(nodes(text) + handles(text, spans))
        known = labels_of(tokens, spans)
        if not len(tokens) or known.all():
            return []
        chance = self.marginals(text, tokens, known)
        label = chance.argmax(1)
        label[(chance.max(1) < threshold) | (known > 0)] = 0
        found: list[tuple[int, int, int]] = []
        for i, (s, e) in enumerate(tokens):
            if not label[i]:
                continue
            kind = int(label[i]) - 1
            joined = found and i and label[i - 1] == label[i] and s - tokens[i - 1][1] <= 3
            if joined and _digits(text, found[-1][1], e) <= MOST_DIGITS.get(KINDS[kind], 0):
                found[-1] = (kind, found[-1][1], e)
            else:
                found.append((kind, s, e))
        starts = np.array(sorted(s for _, s, _ in spans) or [0])
        ends = np.array(sorted(e for _, _, e in spans) or [0])
        return [x for x in found if np.searchsorted(starts, x[2], "left") == np.searchsorted(ends, x[1], "right")]


def _digits(text: str, start: int, end: int) -> int:
    return sum(c.isdigit() for c in text[start:end])


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(1)
    return top + np.log(np.exp(x - top[:, None] if x.ndim == 2 else x - top[:, None, :]).sum(1))


def fit(samples: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], steps: int = 300) -> Field:
    """Pseudo-likelihood: each label given its own features and the true labels of its neighbours."""
    k, width = len(LABELS), 14
    blocks, answers = [], []
    for own, label, chain, skip in samples:
        one = np.eye(k)[label]
        left, right, link = (np.zeros((len(label), k)) for _ in range(3))
        np.add.at(right, chain[:, 0], one[chain[:, 1]])
        np.add.at(left, chain[:, 1], one[chain[:, 0]])
        np.add.at(link, skip[:, 0], one[skip[:, 1]])
        np.add.at(link, skip[:, 1], one[skip[:, 0]])
        masked = own * 1.0
        masked[::2, 1:] = 0
        blocks += [np.hstack([own, left, right, link]), np.hstack([masked, left, right, link])]
        answers += [label, label]
    weights = np.zeros((width + 3 * k, k))
    if not blocks:
        weights[0, 0] = 10.0
        return Field(weights[:width], weights[width : width + k], weights[width + 2 * k :])
    x, y = np.vstack(blocks), np.eye(k)[np.concatenate(answers)]
    squares = np.full_like(weights, 1e-6)
    for _ in range(steps):
        score = x @ weights
        chance = np.exp(score - _log_sum(score)[:, None])
        slope = x.T @ (chance - y) / len(x) + 1e-4 * weights
        squares += slope**2
        weights -= 0.5 * slope / np.sqrt(squares)
    left, right = weights[width : width + k], weights[width + k : width + 2 * k]
    link = weights[width + 2 * k :]
    return Field(weights[:width], (left + right.T) / 2, (link + link.T) / 2)


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Field:
    """Fit the field on a bounded sample: the documents with the smallest hashes among those with base spans."""

    def shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text in batch.column("text").to_pylist():
                tokens = nodes(text)[:SAMPLE_NODES]
                label = labels_of(tokens, base_spans(text))
                if label.any():
                    chain, skip = edges(text, tokens)
                    own = features(text, tokens)
                    out.append([a.tobytes() for a in (own, label, chain, skip)])
            columns = [pa.array([row[i] for row in out], pa.binary()) for i in range(4)]
            yield pa.RecordBatch.from_arrays(columns, ["own", "label", "chain", "skip"])

    # Signal characters are rare, so most documents fall out before Python sees them.
    signs = F.col("text").contains("@") | F.col("text").contains("+") | F.col("text").rlike("[0-9][0-9.\\x20-]{6}")
    sample = bounded_sample(docs.select("doc_id", "text").filter(signs), sample_docs, "doc_id")
    rows = sample.mapInArrow(shapes, "own binary, label binary, chain binary, skip binary").collect()

    def array(data: bytes, kind: type, width: int) -> np.ndarray:
        return np.frombuffer(data, kind).reshape(-1, width)

    return fit(
        [
            (array(r.own, float, 14), array(r.label, np.int64, 1)[:, 0], array(r.chain, np.int64, 2), array(r.skip, np.int64, 2))
            for r in rows
        ]
    )


def find(docs: DataFrame, field: Field, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, ``base`` and ``added``: arrays of (kind, start, stop)."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            base, added = [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                found = base_spans(text)
                more = field.more_spans(text, found, threshold)
                for out, spans in ((base, found), (added, more)):
                    out.append([{"kind": KINDS[k], "start": s, "stop": e} for k, s, e in spans])
            columns = [batch.column("doc_id"), pa.array(base, pa.list_(span)), pa.array(added, pa.list_(span))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "base", "added"])

    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    spans = "array<struct<kind: string, start: bigint, stop: bigint>>"
    return docs.mapInArrow(run, f"doc_id {kind}, base {spans}, added {spans}")


def _is(kind: str):
    return lambda span: span["kind"] == kind


def _line(spans: Column) -> Column:
    def order(x):
        return F.struct(
            F.array_position(F.array(*map(F.lit, KINDS)), x["kind"]).alias("k"), x["start"].alias("s"), x["stop"].alias("e"), x["kind"].alias("kind")
        )

    parts = F.transform(
        F.array_sort(F.transform(spans, order)),
        lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string")),
    )
    return F.array_join(parts, ",")


def digests(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The contract's columns; n_added counts the field's own spans."""
    found = find(docs, train(docs))
    counts = [F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_line(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _line(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )
