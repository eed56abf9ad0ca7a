"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained here, in numpy, by backpropagation through time on a bounded sample of labelled texts
(`per_language` windows of each language, drawn by a hash from all of them). It labels every byte of every text: a text is cut into
stretches that are run side by side, each with some bytes of context before and after, and the probabilities of all its positions
are averaged. Tasks hold one bounded piece of a batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.llm.arrays import pieces, short_batches, string_buffers

STRETCH, CONTEXT, SIDE_BY_SIDE = 240, 16, 2048
UNKNOWN = "und"


@dataclass
class Network:
    """Per direction: input table (3H x 256), recurrent weights (3H x H), recurrent bias (3H); output (L x 2H) and its bias."""

    labels: list[str]
    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, labels: list[str], hidden: int, seed: int, kind=np.float32) -> Network:
        rng, w = np.random.default_rng(seed), {}
        for d in "fb":
            w[f"{d}x"] = rng.normal(0, 0.3, (3 * hidden, 256))
            w[f"{d}u"] = rng.normal(0, hidden**-0.5, (3 * hidden, hidden))
            w[f"{d}c"] = np.zeros((3 * hidden, 1))
        w["v"] = rng.normal(0, 0.3, (len(labels), 2 * hidden))
        w["o"] = np.zeros((len(labels), 1))
        return cls(labels, {k: x.astype(kind) for k, x in w.items()})


def _step(x: np.ndarray, h: np.ndarray, u: np.ndarray, c: np.ndarray):
    """One gated step for all columns: (update gate, reset gate, candidate, recurrent part of the candidate, new state)."""
    n = len(h)
    a = u @ h
    a += c
    gates = x[: 2 * n] + a[: 2 * n]
    gates *= 0.25
    gates += 0.5
    np.clip(gates, 0, 1, out=gates)
    z, r = gates[:n], gates[n:]
    q = a[2 * n :]
    cand = r * q
    cand += x[2 * n :]
    np.tanh(cand, out=cand)
    new = h - cand
    new *= z
    new += cand
    return z, r, cand, q, new


def _softmax(a: np.ndarray) -> np.ndarray:
    a -= a.max(axis=0)
    np.exp(a, out=a)
    a /= a.sum(axis=0)
    return a


def loss_and_gradients(net: Network, text: np.ndarray, wanted: np.ndarray, mask: np.ndarray):
    """Mean cross-entropy over the positions of (steps x columns) bytes, and its gradients, back through time."""
    w, (steps, cols) = net.weights, text.shape
    hidden, kind = w["fu"].shape[1], w["v"].dtype
    states = {d: np.zeros((steps + 1, hidden, cols), kind) for d in "fb"}
    kept: dict[str, list] = {d: [None] * steps for d in "fb"}
    order = {"f": list(range(steps)), "b": list(range(steps - 1, -1, -1))}
    for d in "fb":
        for i, t in enumerate(order[d]):
            *kept[d][i], states[d][i + 1] = _step(w[f"{d}x"][:, text[t]], states[d][i], w[f"{d}u"], w[f"{d}c"])
    both = np.concatenate([states["f"][1:], states["b"][:0:-1]], axis=1)
    p = np.einsum("lh,thc->tlc", w["v"], both) + w["o"]
    p = np.moveaxis(_softmax(np.moveaxis(p, 1, 0).copy()), 0, 1)
    total = mask.sum()
    picked = np.take_along_axis(p, np.broadcast_to(wanted, (steps, cols))[:, None, :], axis=1)[:, 0]
    loss = float(-(np.log(picked + 1e-12) * mask).sum() / total)
    err = p.copy()
    err[:, wanted, np.arange(cols)] -= 1
    err *= (mask / total)[:, None, :].astype(kind)
    g = {"v": np.einsum("tlc,thc->lh", err, both), "o": err.sum(axis=(0, 2))[:, None]}
    back = np.einsum("lh,tlc->thc", w["v"], err)
    for d, part in (("f", back[:, :hidden]), ("b", back[:, hidden:])):
        u, gu, gc = w[f"{d}u"], np.zeros_like(w[f"{d}u"]), np.zeros_like(w[f"{d}c"])
        inputs = np.zeros((steps, 3 * hidden, cols), kind)
        dh = np.zeros((hidden, cols), kind)
        for i in range(steps - 1, -1, -1):
            t, h = order[d][i], states[d][i]
            z, r, cand, q = kept[d][i]
            dh = dh + part[t]
            dc = dh * (1 - z) * (1 - cand * cand)
            dz = dh * (h - cand) * 0.25 * ((z > 0) & (z < 1))
            dr = dc * q * 0.25 * ((r > 0) & (r < 1))
            inputs[t] = np.concatenate([dz, dr, dc])
            da = np.concatenate([dz, dr, dc * r])
            gu += da @ h.T
            gc += da.sum(axis=1, keepdims=True)
            dh = dh * z + u.T @ da
        flat = np.moveaxis(inputs, 1, 0).reshape(3 * hidden, -1)
        gx = np.stack([np.bincount(text.ravel(), row, 256) for row in flat])
        g[f"{d}x"], g[f"{d}u"], g[f"{d}c"] = gx, gu, gc
    return loss, g


def fit_network(texts: list[bytes], labels: list[str], hidden: int = 8, steps: int = 350, batch: int = 96, window: int = 72, seed: int = 5) -> Network:
    """Train on windows of labelled byte strings (Adam, every language equally often)."""
    names = sorted(set(labels))
    net = Network.fresh(names, hidden, seed)
    if len(names) < 2:
        return net
    rng = np.random.default_rng(seed)
    groups = [[t for t, x in zip(texts, labels) if x == name and t] or [b" "] for name in names]
    m1 = {k: np.zeros_like(x) for k, x in net.weights.items()}
    m2 = {k: np.zeros_like(x) for k, x in net.weights.items()}
    for i in range(1, steps + 1):
        wanted = rng.integers(len(names), size=batch)
        text = np.zeros((window, batch), np.uint8)
        for c, y in enumerate(wanted.tolist()):
            t = groups[y][rng.integers(len(groups[y]))]
            a = int(rng.integers(max(1, len(t) - window + 1)))
            cut = np.frombuffer(t[a : a + window], np.uint8)
            text[: len(cut), c] = cut
        _, g = loss_and_gradients(net, text, wanted, (text > 0).astype(np.float32))
        rate = 0.02 * min(1.0, i / 20) * (1 - 0.9 * i / steps)
        for k, x in net.weights.items():
            m1[k] = 0.9 * m1[k] + 0.1 * g[k]
            m2[k] = 0.99 * m2[k] + 0.01 * g[k] ** 2
            x -= (rate * (m1[k] / (1 - 0.9**i)) / (np.sqrt(m2[k] / (1 - 0.99**i)) + 1e-7)).astype(x.dtype)
    return net


def position_sums(net: Network, text: np.ndarray, live: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of label probabilities over the live positions of each column; `text` and `live` have CONTEXT rows at both ends.

    `sizes` are the live positions of each column: the way back begins CONTEXT rows behind them, whatever stands in longer columns.
    """
    w, (rows, cols) = net.weights, text.shape
    hidden, steps = w["fu"].shape[1], rows - 2 * CONTEXT
    ahead = np.empty((steps, hidden, cols), np.float32)
    h = np.zeros((hidden, cols), np.float32)
    for t in range(rows - CONTEXT):
        h = _step(np.take(w["fx"], text[t], axis=1), h, w["fu"], w["fc"])[-1]
        if t >= CONTEXT:
            ahead[t - CONTEXT] = h
    out = np.zeros((len(net.labels), cols), np.float32)
    h = np.zeros((hidden, cols), np.float32)
    ends = sizes + 2 * CONTEXT
    shortest = ends.min()
    vf, vb = w["v"][:, :hidden], w["v"][:, hidden:]
    for t in range(rows - 1, CONTEXT - 1, -1):
        h = _step(np.take(w["bx"], text[t], axis=1), h, w["bu"], w["bc"])[-1]
        if t >= shortest:
            h *= ends > t
        if t < rows - CONTEXT:
            p = vf @ ahead[t - CONTEXT]
            p += vb @ h
            p += w["o"]
            out += _softmax(p) * live[t]
    return out


def document_probabilities(net: Network, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """(texts x labels) mean probability over all bytes of each text; even where a text is empty."""
    sizes = np.diff(offs)
    parts = -(-sizes // STRETCH)
    of_text = np.repeat(np.arange(len(sizes)), parts)
    nth = np.arange(len(of_text)) - np.repeat(np.cumsum(parts) - parts, parts)
    begins, low, high = offs[:-1][of_text] + nth * STRETCH, offs[:-1][of_text], offs[1:][of_text]
    sums = np.zeros((len(sizes), len(net.labels)))
    reach = np.arange(-CONTEXT, STRETCH + CONTEXT)[:, None]
    inner = (reach >= 0) & (reach < STRETCH)
    for a in range(0, len(of_text), SIDE_BY_SIDE):
        cut = slice(a, a + SIDE_BY_SIDE)
        own = np.minimum(high[cut] - begins[cut], STRETCH)
        longest = int(own.max())
        at = begins[cut] + reach[: longest + 2 * CONTEXT]
        valid = (at >= low[cut]) & (at < high[cut])
        text = np.where(valid, data[np.clip(at, 0, len(data) - 1)], 0).astype(np.uint8)
        live = (valid & inner[: longest + 2 * CONTEXT]).astype(np.float32)
        got = position_sums(net, text, live, own)
        np.add.at(sums, of_text[cut], got.T)
    return np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], 1 / max(1, len(net.labels)))


_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def has_letter(column: pa.Array, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Texts with a letter of any script; only those without an ASCII one are looked at character by character."""
    letters, wide = (np.concatenate(([0], np.cumsum(m))) for m in (_LETTER[data], data >= 0x80))
    found = letters[offs[1:]] > letters[offs[:-1]]
    for i in np.flatnonzero(~found & (wide[offs[1:]] > wide[offs[:-1]])).tolist():
        found[i] = any(map(str.isalpha, column[i].as_py()))
    return found


def _predict(net: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(net.labels, dtype=object)
        for batch in batches:
            for piece in pieces(batch, "text"):
                data, offs = string_buffers(piece.column("text"))
                p = document_probabilities(net, data, offs)
                best = p.argmax(axis=1)
                known = has_letter(piece.column("text"), data, offs)
                found = [names[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())]
                score = np.where(known, np.clip(p[np.arange(len(best)), best], 0, 1), 0.0)
                rest = [piece.column(c) for c in piece.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(found, pa.string()), pa.array(score, pa.float64())],
                    names=[*[c for c in piece.schema.names if c != "text"], "lang_pred", "score"],
                )

    return run


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learnt from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train_language_model(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 800,
    most_languages: int = 200,
    reject: bool = False,
) -> Network | None:
    """Fit the network on a bounded sample of the labelled rows that are not held out; None without any label.

    The sample has about `per_language` texts of each language, picked by a hash of id and text from all of them; of each text one
    window of 400 characters at a place given by the hash goes to the driver. More than `most_languages` labels are an error.
    With `reject` the network learns one label more, `REJECT`, from texts that are in none of the languages (`strange_texts`).
    """
    known = docs.where(~held_out(id_col)).where(F.col(lang_col).isNotNull() & (F.length(text_col) > 0))
    sizes = {r["lang"]: r["n"] for r in known.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n")).limit(most_languages + 1).collect()}
    if len(sizes) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    if not sizes:
        return None
    draw = F.xxhash64(F.col(id_col), F.col(text_col))
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col(lang_col) == lang, min(1.0, per_language / n)).otherwise(share)
    uniform = F.pmod(draw, F.lit(1 << 30)) / float(1 << 30)
    begin = F.pmod(F.shiftright(draw, 31), F.greatest(F.lit(1), F.length(text_col) - 399)) + 1
    window = F.substring(F.col(text_col), begin.cast("int"), F.lit(400))
    rows = known.where(uniform < share).select(window.alias("text"), F.col(lang_col).alias("lang"), draw.alias("draw")).collect()
    rows.sort(key=lambda r: (r["draw"], r["lang"]))
    texts, names = [r["text"].encode() for r in rows], [r["lang"] for r in rows]
    if reject:
        strange = strange_texts(texts, per_language)
        texts, names = texts + strange, names + [REJECT] * len(strange)
    return fit_network(texts, names)


#: Label of texts that are in none of the learnt languages; no language has a name without letters.
REJECT = "-"
# First and last letter of alphabets, by Unicode's code charts.
_ALPHABETS = ((0x391, 0x3C9), (0x410, 0x44F), (0x5D0, 0x5EA), (0x621, 0x64A), (0x905, 0x939), (0xE01, 0xE2E), (0x3041, 0x3096), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3))


def strange_texts(texts: list[bytes], n: int, seed: int = 11) -> list[bytes]:
    """`n` texts in no language: alphabets that occur in none of the sampled `texts`, and a few letters again and again.

    An alphabet that the sampled texts use in earnest (one letter in a thousand or more) is left out. Prose with its letters dealt
    anew is not among them: beside short or careless texts of a learnt language it would be told from them by chance.
    """
    rng = np.random.default_rng(seed)
    letters = np.array([ord(c) for t in texts for c in t.decode("utf-8", "replace") if c.isalpha()], np.int64)
    foreign = [(a, z) for a, z in _ALPHABETS if ((letters >= a) & (letters <= z)).sum() * 1000 < len(letters)]
    out: list[bytes] = []
    for i in range(n):
        if i % 2 and foreign:
            a, z = foreign[int(rng.integers(len(foreign)))]
            narrow = a + int(rng.integers(max(1, z - a - 60)))
            words = [rng.integers(narrow, min(z, narrow + 60) + 1, int(rng.integers(1, 9))) for _ in range(60)]
            out.append(" ".join("".join(map(chr, w.tolist())) for w in words).encode())
        else:
            few = rng.integers(97, 123, int(rng.integers(1, 3)))
            out.append((bytes(few.astype(np.uint8).tolist()) + b" " * int(rng.integers(2))) * 100)
    return out


def identify(docs: DataFrame, net: Network | None, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep` of every row with `lang_pred` and `score` (mean probability of that language over all bytes of the text).

    A null text and one without any letter get `und` and score 0, as does every text when there is no model. Repeated rows and
    rows with null ids come back one by one; an empty table gives an empty result.
    """
    if net is None:
        return docs.select(*keep, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    source = short_batches(docs).select(*keep, F.col(text_col).alias("text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "text")
    return source.mapInArrow(_predict(net), f"{fields}, lang_pred string, score double")


def keep_identified(docs: DataFrame, net: Network | None, least: float, text_col: str = "text", strange: float = 0.75) -> DataFrame:
    """Rows of `docs`, all their columns, whose text has a language.

    Texts without a letter go, those whose mean probability of the reject class (if the network has one) is `strange` or more, and
    those whose best language has less than `least` of what is left for languages. A short text of a learnt language may look
    strange at many of its few bytes, so `strange` is far above one half.
    Null and empty texts go; repeated rows and rows with null ids are judged one by one; an empty table gives an empty result.
    Without a model nothing can be told, which is an error and no empty result.
    """
    if net is None:
        raise ValueError("no language model: the corpus has no labelled text to learn from")
    reject = np.array([x == REJECT for x in net.labels])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text_col):
                data, offs = string_buffers(piece.column(text_col))
                p = document_probabilities(net, data, offs)
                odd, named = p[:, reject].sum(axis=1), p[:, ~reject]
                sound = (odd < strange) & (named.max(axis=1) >= least * named.sum(axis=1))
                yield piece.filter(pa.array(sound & has_letter(piece.column(text_col), data, offs)))

    return short_batches(docs).mapInArrow(run, docs.schema)
