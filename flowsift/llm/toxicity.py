"""Severity of toxic text by cumulative-link ordinal regression on sparse word features.

P(grade > j) = sigmoid(w . x - t_j) with t_0 < t_1 < ...: all thresholds share the weights. The model is trained here in numpy on
a bounded sample of labelled documents; scoring reads every whole text once, in tasks that hold one bounded piece at a time.

Features are words and the beginnings of words, so that a stem counts with any ending.

Labels say only whether a text is toxic. The grades above 0 come from the training texts themselves: toxic texts are ranked
by how much of the learnt lexicon they hold, and cut into equal parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.llm.arrays import Words, mix, odd_numbers, pieces, string_buffers
from flowsift.session import materialize

#: Bytes of letters and digits; all others part words.
_PART = np.full(256, 0x20, np.uint8)
_PART[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = [
    *range(0x30, 0x3A),
    *range(0x41, 0x5B),
    *range(0x61, 0x7B),
    *range(0x80, 0x100),
]


#: Numbers of bytes of a word's beginning that are features of their own.
BEGINNINGS = (4, 5)


@dataclass
class SeverityModel:
    """Sorted hashes of the feature words, their weights, and the ordered thresholds."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray


def word_counts(column: pa.Array, features: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, times, words of each text): how often each text has each feature word (every word, if None).

    Words are runs of letters and digits, lower-cased in A-Z; besides each word its first bytes are a feature (`BEGINNINGS`). A
    feature is a hash or, given a list, its number there.
    """
    data, offs = string_buffers(column)
    plain = _PART[data]
    words = Words(plain, offs, fold_case=True)
    owner, size = words.text_of_word(), words.stop - words.start
    text, value = [owner], [words.hash]
    for k in BEGINNINGS:
        at = np.flatnonzero(size > k)
        part = np.full(len(at), k, np.uint64)
        for j, factor in enumerate(odd_numbers(k, 11).tolist()):
            byte = plain[words.start[at] + j]
            part += (byte + 32 * ((byte >= 65) & (byte <= 90))).astype(np.uint64) * np.uint64(factor)
        text.append(owner[at])
        value.append(mix(part))
    text, value = np.concatenate(text), np.concatenate(value)
    if features is not None:
        if not len(features):
            text, value = text[:0], np.zeros(0, np.int64)
        else:
            number = np.minimum(np.searchsorted(features, value), len(features) - 1)
            same = features[number] == value
            text, value = text[same], number[same]
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    fresh = np.ones(len(text), dtype=bool)
    fresh[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(fresh)
    return text[first], value[first], np.diff(np.append(first, len(text))), words.counts


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, width: int, penalty: float = 2e-5, steps: int = 500):
    """(weights, thresholds) of the cumulative-link model by Adam on the full sample; gaps between thresholds stay positive."""
    n, top = len(grades), int(grades.max())
    w, first, gaps = np.zeros(width), np.array([1.0]), np.zeros(max(0, top - 1))
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, first, gaps)]
    for i in range(1, steps + 1):
        t = first[0] + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))
        score = np.bincount(rows, values * w[columns], n)
        edges = np.concatenate(([-np.inf], t, [np.inf]))
        up, down = _sigmoid(edges[grades + 1] - score), _sigmoid(edges[grades] - score)
        p = np.maximum(up - down, 1e-12)
        d_up, d_down = up * (1 - up) / p, down * (1 - down) / p
        g_score = (d_up - d_down) / n
        g_t = np.zeros(top + 2)
        np.add.at(g_t, grades + 1, -d_up / n)
        np.add.at(g_t, grades, d_down / n)
        g_t = g_t[1 : top + 1]
        g_w = np.bincount(columns, values * g_score[rows], width) + penalty * w
        tails = np.cumsum(g_t[::-1])[::-1]
        grads = [g_w, np.array([tails[0]]), tails[1:] * np.exp(gaps)]
        for x, g, m in zip((w, first, gaps), grads, moments):
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.999 * m[1] + 0.001 * g * g
            x -= 0.1 * (m[0] / (1 - 0.9**i)) / (np.sqrt(m[1] / (1 - 0.999**i)) + 1e-9)
    return w, first[0] + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _words_of_texts(features: np.ndarray | None):
    """Rows (number, value, times, toxic) of the features of each text; hashes as signed numbers if no list is given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                rows, values, times, _ = word_counts(piece.column("text"), features)
                owner = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("number").take(owner), pa.array(values.view(np.int64)), pa.array(times, pa.int64()), piece.column("toxic").take(owner)],
                    names=["number", "value", "times", "toxic"],
                )

    return run


_COUNTED = "number long, value long, times long, toxic int"


def choose_features(
    sample: DataFrame, n_toxic: int, n_clean: int, features: int = 400, least_texts: int = 5, least_gain: float = 15.0
) -> np.ndarray:
    """Sorted hashes of the feature words of `sample` (`number`, `text`, `toxic`); only these, `features` at most, leave the tasks.

    Feature words stand in `least_texts` texts or more and are those whose document counts, taken by Spark over the whole sample,
    differ most between the two sides, by the G statistic; `least_gain` of it is asked for, beyond what many tried words
    give by chance. Only marks of toxicity are wanted: words more than three times as common there.
    """
    words = sample.mapInArrow(_words_of_texts(None), _COUNTED).groupBy("value")
    counts = words.agg(F.count_if(F.col("toxic") == 1).alias("bad"), F.count_if(F.col("toxic") == 0).alias("good"))
    bad, good, n = F.col("bad").cast("double"), F.col("good").cast("double"), float(n_toxic + n_clean)
    part = lambda k, side: F.when(k > 0, k * F.log(k / ((bad + good) * side / n))).otherwise(0.0)
    marked = counts.where((bad + good >= least_texts) & (bad / n_toxic > 3 * good / n_clean))
    marked = marked.withColumn("gain", 2 * (part(bad, n_toxic) + part(good, n_clean))).where(F.col("gain") > least_gain)
    found = marked.orderBy(F.desc("gain"), "value").limit(features).select("value").collect()
    return np.sort(np.array([r["value"] for r in found], np.int64).view(np.uint64))


def fit_severity(rows: np.ndarray, columns: np.ndarray, times: np.ndarray, toxic: np.ndarray, names: np.ndarray, levels: int = 3) -> SeverityModel:
    """Grade the toxic texts by how much of the lexicon `names` they hold, and fit the model."""
    y, values = toxic.astype(bool), np.log1p(times)
    amount = np.bincount(rows, values, len(y))
    grades = np.zeros(len(y), np.int64)
    ranked = np.argsort(np.argsort(amount[y], kind="stable"), kind="stable")
    grades[y] = 1 + ranked * (levels - 1) // max(1, int(y.sum()))
    w, t = fit_ordinal(rows, columns, values, grades, max(1, len(names)))
    return SeverityModel(names, w, t)


def train_severity_model(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    toxic_col: str = "toxic",
    most_toxic: int = 1500,
    most_clean: int = 3000,
    longest: int = 50_000,
    levels: int = 3,
) -> SeverityModel | None:
    """Fit on a bounded sample of labelled documents: about `most_toxic` toxic and `most_clean` others, drawn from all by a hash of
    the id. Rows with a null label (or one that is neither 0 nor 1), id or text and texts of more than `longest` characters are
    not learnt from; None if one side is missing. The sample is written; words are counted in tasks, and what reaches the
    driver is one row per sampled text and feature in it."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(toxic_col).cast("int").isin(0, 1))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(toxic_col).cast("int")).alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    uniform = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, most_toxic / sizes[1]).otherwise(most_clean / sizes[0])
    drawn = known.where(uniform < share).limit(2 * (most_toxic + most_clean))
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = texts.where(F.length("text") <= longest)
    rows = texts.join(F.broadcast(drawn), "id")  # `drawn` is limited above
    sample = materialize(rows.select(F.monotonically_increasing_id().alias("number"), "text", "toxic"), "labelled")
    sides = np.array(sorted((r["number"], r["toxic"]) for r in sample.select("number", "toxic").collect()), np.int64).reshape(-1, 2)
    toxic = sides[:, 1] == 1
    if not toxic.any() or toxic.all():
        return None
    names = choose_features(sample, int(toxic.sum()), int((~toxic).sum()))
    if not len(names):
        return SeverityModel(names, np.zeros(1), np.array([np.inf]))
    found = sample.mapInArrow(_words_of_texts(names), _COUNTED).orderBy("number", "value").toArrow()
    number, column, times = (found.column(c).to_numpy() for c in ("number", "value", "times"))
    return fit_severity(np.searchsorted(sides[:, 0], number), column, times, toxic, names, levels)


def _score(model: SeverityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                rows, columns, times, sizes = word_counts(piece.column("text"), model.features)
                total = np.bincount(rows, np.log1p(times) * model.weights[columns], piece.num_rows)
                above = _sigmoid(total[:, None] - model.thresholds[None, :])
                above[sizes == 0] = 0.0
                above[:, np.isinf(model.thresholds)] = 0.0
                steps = np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("id"),
                        pa.array(above.sum(axis=1)),
                        pa.array((-np.diff(steps, axis=1)).argmax(axis=1), pa.int32()),
                        pa.array(above[:, 0]),
                        pa.array(above[:, 0] >= 0.5),
                    ],
                    names=["id", "severity", "grade", "p_toxic", "toxic"],
                )

    return run


def score_severity(docs: DataFrame, model: SeverityModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: `id_col`, expected `severity` (0 to the number of thresholds), likeliest `grade`, `p_toxic`, and `toxic` (p_toxic of
    one half or more). Texts without a word, null ones too, and all texts without a model, have severity 0. Repeated rows and
    rows with null ids are scored one by one; other columns are not read; an empty table gives an empty result."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    if model is None:
        model = SeverityModel(np.zeros(0, np.uint64), np.zeros(1), np.array([np.inf]))
    return source.mapInArrow(_score(model), f"id {kind}, severity double, grade int, p_toxic double, toxic boolean").withColumnRenamed("id", id_col)
