"""Personal data: base patterns, and a skip-chain conditional random field that carries their labels to repeated mentions.

Tokens that hold a digit or an @ are the nodes (all others can only be `other`). Neighbouring tokens are tied by a chain, and tokens of
one document that repeat or resemble each other, however far apart, by skip edges with shared potentials: to the
observed mentions next to them on either side or, where none is observed, to the previous mention. Tokens inside base
matches are observed; loopy message passing gives the others their label, so that a number once written as a phone number is one
everywhere in the document. A span is added only where its tokens hang together with an observed one.

Weights are trained here in numpy by pseudo-likelihood on a bounded sample, with base matches as labels. Texts that name a thing
twice are rare, so every match of a training text is mentioned once more at its end in another writing (`with_mentions`), as are
some tokens that are nothing. Half of the tokens' own features are hidden in training, so that the ties get weight.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.llm.arrays import pieces, string_buffers

# Kinds and base patterns of the scan, in forms that never read a run of characters twice.
KINDS = ["email", "ip", "card", "phone"]
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_NOT_DIGIT = re.compile(r"[^0-9]+")

#: Probability an added token must have, rounds of message passing, and digits from which on numbers are compared.
SURE, ROUNDS, DIGITS = 0.9, 12, 6
#: Messages (logarithms) that change by no more stand still.
STILL = 1e-4


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base matches, in order."""
    found: list[tuple[int, int, int]] = []
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        begin = at
        while begin > done and _LOCAL.match(text[begin - 1]):
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            found.append((begin, 0, domain.end()))
            done = at = domain.end()
        else:
            at += 1
            done = at
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


@dataclass
class SkipChain:
    """Weights: of features (features x labels), chain (labels x labels), skip (labels x labels). Label 0 is `other`."""

    node: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


_SHAPES = 16


def _shape(token: str, digits: str) -> list[float]:
    """Features of one token."""
    letters = sum(c.isalpha() for c in token)
    n, dots = len(digits), token.count(".")
    return [
        1.0,
        "@" in token,
        "@" in token and "." in token.rpartition("@")[2].strip("."),
        dots == 3,
        n >= 14,
        10 <= n < 14,
        6 <= n < 10,
        3 <= n < 6,
        n < 3,
        token.startswith("+"),
        "(" in token or ")" in token,
        "-" in token.strip("-"),
        letters > 0,
        n > 0 and letters == 0,
        14 <= n <= 19 and _luhn(digits),
        dots > 0,
    ]


def _keys(core: str, digits: str) -> list[str]:
    """What makes two tokens resemble each other: equal text, the same last digits, the same name before the @ and after it."""
    found = []
    if len(digits) >= DIGITS:
        found.append("d" + digits[-7:] if len(digits) >= 7 else "s" + digits)
    if "@" in core:
        name, _, place = core.lower().rpartition("@")
        found.append(f"e{name}@{place.split('.')[0]}")
    elif len(digits) >= 4:
        found.append("w" + core.lower())
    return found


class Graph:
    """Nodes and edges of the documents of one piece. `label` is -1 where nothing is observed."""

    def __init__(self) -> None:
        self.features: list[list[float]] = []
        self.label: list[int] = []
        self.where: list[tuple[int, int, int]] = []
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []

    def add(self, doc: int, text: str, spans: list[tuple[int, int, int]]) -> None:
        last_index, last_node, mentions, s = -2, -1, {}, 0
        for index, m in enumerate(_TOKEN.finditer(text)):
            token = m[0]
            digits = _NOT_DIGIT.sub("", token)
            if not digits and "@" not in token:
                continue
            core = token.strip(".,;:!?\"'<>[]{}*#$%&|")
            begin = m.start() + token.find(core)
            while s < len(spans) and spans[s][2] <= begin:
                s += 1
            label = -1
            for a, kind, z in spans[s : s + 4]:
                if a < begin + len(core) and begin < z:
                    label = kind + 1
                    break
            node = len(self.label)
            self.features.append(_shape(core, digits))
            self.label.append(label)
            self.where.append((doc, begin, begin + len(core)))
            if last_index == index - 1:
                self.chain.append((last_node, node))
            for key in _keys(core, digits):
                mentions.setdefault(key, []).append(node)
            last_index, last_node = index, node
        for same in mentions.values():
            self._tie(same)

    def _tie(self, same: list[int]) -> None:
        """Tie mentions, which come in order, to the observed ones before and after them, however many others lie between; where
        none is observed, each to the previous one."""
        if not any(self.label[node] > 0 for node in same):
            self.skip.extend(zip(same[:-1], same[1:]))
            return
        known, waiting = -1, []
        for node in same:
            if known >= 0:
                self.skip.append((known, node))
            if self.label[node] > 0:
                self.skip.extend((other, node) for other in waiting)
                known, waiting = node, []
            else:
                waiting.append(node)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        return np.array(self.chain, np.int64).reshape(-1, 2), np.array(self.skip, np.int64).reshape(-1, 2)


def fit_skip_chain(graph: Graph, steps: int = 300, hidden: float = 0.5, seed: int = 2) -> SkipChain:
    """Maximise the pseudo-likelihood: each token's label given its features and the labels of all it is tied to."""
    width = len(KINDS) + 1
    model = SkipChain(np.zeros((_SHAPES, width)), np.zeros((width, width)), np.zeros((width, width)))
    if not graph.label:
        return model
    x = np.array(graph.features, float)
    y = np.maximum(np.array(graph.label), 0)
    x[np.random.default_rng(seed).random(len(x)) < hidden, 1:] = 0
    chain, skip = graph.edges()
    one = np.eye(width)[y]

    def around(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left, right = np.zeros((len(x), width)), np.zeros((len(x), width))
        if len(pairs):
            np.add.at(left, pairs[:, 1], one[pairs[:, 0]])
            np.add.at(right, pairs[:, 0], one[pairs[:, 1]])
        return left, right

    before, after = around(chain)
    near = sum(around(skip))
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in (model.node, model.chain, model.skip)]
    for i in range(1, steps + 1):
        score = x @ model.node + before @ model.chain + after @ model.chain.T + near @ model.skip
        p = np.exp(score - score.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        err = (p - one) / len(y)
        skip_grad = near.T @ err
        grads = (x.T @ err, before.T @ err + (after.T @ err).T, (skip_grad + skip_grad.T) / 2)
        for w, g, m in zip((model.node, model.chain, model.skip), grads, moments):
            g = g + 1e-4 * w
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.999 * m[1] + 0.001 * g * g
            w -= 0.1 * (m[0] / (1 - 0.9**i)) / (np.sqrt(m[1] / (1 - 0.999**i)) + 1e-9)
    return model


def marginals(graph: Graph, model: SkipChain) -> np.ndarray:
    """Label probabilities of all nodes by loopy message passing (sums of products, logarithms, damped), until no message changes."""
    width = model.chain.shape[0]
    own = np.array(graph.features, float) @ model.node
    seen = np.array(graph.label)
    known = np.flatnonzero(seen >= 0)
    own[known] = -50.0
    own[known, seen[known]] = 0.0
    chain, skip = graph.edges()
    source = np.concatenate([chain[:, 0], chain[:, 1], skip[:, 0], skip[:, 1]])
    target = np.concatenate([chain[:, 1], chain[:, 0], skip[:, 1], skip[:, 0]])
    c, s = len(chain), len(skip)
    back = np.concatenate([np.arange(c, 2 * c), np.arange(c), np.arange(2 * c + s, 2 * c + 2 * s), np.arange(2 * c, 2 * c + s)])
    tie = np.concatenate(
        [np.broadcast_to(w, (n, width, width)) for w, n in ((model.chain, c), (model.chain.T, c), (model.skip, s), (model.skip.T, s))]
    )
    message = np.zeros((len(source), width))
    # documents are apart from each other: each goes on until its messages stand still, at most twice (for the damping) its longest possible chain
    doc = np.unique(np.array([w[0] for w in graph.where], np.int64), return_inverse=True)[1]
    most = ROUNDS + 2 * np.bincount(doc)
    live = np.arange(len(source))
    rounds = 0
    while len(live):
        rounds += 1
        place = np.empty(len(source), np.int64)
        place[live] = np.arange(len(live))
        begin, end, opposite, ties, sent = source[live], target[live], place[back[live]], tie[live], message[live]
        belief = own.copy()
        np.add.at(belief, end, sent)
        out = (belief[begin] - sent[opposite])[:, :, None] + ties
        top = out.max(axis=1)
        new = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
        new -= new.max(axis=1, keepdims=True)
        message[live] = 0.3 * sent + 0.7 * new
        if rounds >= ROUNDS:
            change = np.zeros(len(most))
            np.maximum.at(change, doc[begin], np.abs(new - sent).max(axis=1))
            live = live[((change > STILL) & (rounds < most))[doc[begin]]]
    belief = own.copy()
    np.add.at(belief, target, message)
    p = np.exp(belief - belief.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def added_spans(graph: Graph, model: SkipChain) -> list[tuple[int, int, int, int]]:
    """(document, start, kind, end) of spans found through ties: runs of neighbouring unobserved tokens with one sure label, of
    which at least one is tied to a token that is observed with it or found in the same way."""
    p = marginals(graph, model)
    seen = np.array(graph.label)
    best = np.where(seen >= 0, seen, np.where(p[:, 1:].max(axis=1) >= SURE, p[:, 1:].argmax(axis=1) + 1, 0))
    chain, skip = graph.edges()
    anchored = seen > 0
    while len(skip):
        same = (best[skip[:, 0]] == best[skip[:, 1]]) & (best[skip[:, 0]] > 0)
        more = anchored.copy()
        more[skip[same & anchored[skip[:, 0]], 1]] = True
        more[skip[same & anchored[skip[:, 1]], 0]] = True
        if (more == anchored).all():
            break
        anchored = more
    follows = {int(b): int(a) for a, b in chain.tolist()}
    runs: list[list[int]] = []
    for i in np.flatnonzero((seen < 0) & (best > 0)).tolist():
        if runs and follows.get(i) == runs[-1][-1] and best[i] == best[runs[-1][-1]]:
            runs[-1].append(i)
        else:
            runs.append([i])
    found = []
    for run in runs:
        if anchored[run].any():
            doc, begin, _ = graph.where[run[0]]
            found.append((doc, begin, int(best[run[0]]) - 1, graph.where[run[-1]][2]))
    return found


def with_mentions(text: str, spans: list[tuple[int, int, int]]) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with each match mentioned again in another writing, and up to as many other numbers again as they are."""
    spans, others = list(spans), 0
    wanted = len(spans)
    for a, kind, z in spans[:wanted]:
        again = text[a:z]
        if kind == KINDS.index("email"):
            again = again.lower().rpartition(".")[0]
        elif kind == KINDS.index("phone"):
            again = again.lstrip("+").split(" ", 1)[-1]
        elif kind == KINDS.index("card"):
            again = "-".join(re.findall(r"[0-9]{1,4}", _NOT_DIGIT.sub("", again)[:-7])) + _NOT_DIGIT.sub("", again)[-7:]
        text += " and "
        spans.append((len(text), kind, len(text) + len(again)))
        text += again
    for m in re.finditer(r"[^\x20\x09-\x0D]*[0-9]{4}[^\x20\x09-\x0D]*", text):
        if others < wanted and not any(a < m.end() and m.start() < z for a, _, z in spans):
            text, others = f"{text} and {m[0]}", others + 1
    return text, sorted(spans)


def _candidates(piece: pa.RecordBatch) -> np.ndarray:
    """Rows with an @ or a digit."""
    data, offs = string_buffers(piece.column("text"))
    mark = (data == 0x40) | ((data >= 0x30) & (data <= 0x39))
    total = np.concatenate(([0], np.cumsum(mark)))
    return np.flatnonzero(total[offs[1:]] > total[offs[:-1]])


def train_pii_model(docs: DataFrame, text_col: str = "text", sample: int = 3000, longest: int = 50_000) -> SkipChain:
    """Fit on about `sample` texts of at most `longest` characters, drawn from all by a hash of the text."""
    total = max(1, docs.count())
    uniform = F.pmod(F.xxhash64(text_col), F.lit(1 << 30)) / float(1 << 30)
    rows = docs.where((F.length(text_col) <= longest) & (uniform < sample / total)).select(F.col(text_col).alias("text")).distinct().limit(2 * sample)
    graph = Graph()
    for i, text in enumerate(sorted(r["text"] for r in rows.collect())):
        graph.add(i, *with_mentions(text, base_spans(text)))
    return fit_skip_chain(graph)


def _find(model: SkipChain):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                found: list[list[tuple]] = [[] for _ in range(piece.num_rows)]
                texts, graph = piece.column("text"), Graph()
                for i in _candidates(piece).tolist():
                    text = texts[i].as_py()
                    spans = base_spans(text)
                    if spans:
                        found[i] = [(*s, False) for s in spans]
                        graph.add(i, text, spans)
                if graph.skip:
                    for doc, begin, label, end in added_spans(graph, model):
                        found[doc].append((begin, label, end, True))
                spans = [[{"kind": KINDS[k], "start": a, "end": z, "added": new} for a, k, z, new in sorted(f)] for f in found]
                yield pa.RecordBatch.from_arrays([piece.column("id"), pa.array(spans, kind)], names=["id", "spans"])

    return run


def find_personal_data(docs: DataFrame, model: SkipChain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: `id_col` and `spans`, an array of (kind, start, end, added) by start and kind; code points, end exclusive.

    Base matches are always there; `added` marks those of the field, which ties mentions to observed ones: a document without a base
    match has nothing to be tied to and gets no added span. Null and empty texts have none. Repeated rows and rows with a null
    id are scanned one by one; other columns are not read; an empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    found = source.mapInArrow(_find(model), f"id {kind}, spans array<struct<kind:string,start:long,end:long,added:boolean>>")
    return found.withColumnRenamed("id", id_col)
