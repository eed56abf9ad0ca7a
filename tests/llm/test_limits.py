"""Cases at the limits that the operators state: nothing inside them is lost."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from flowsift.llm import decontaminate, pii, secrets
from flowsift.llm.arrays import string_buffers


def _least_edits(item, text, n):
    """Fewest edits between any n characters of `item` and any stretch of `text`."""
    best = n
    for a in range(len(item) - n + 1):
        row = [0] * (len(text) + 1)
        for c in item[a : a + n]:
            last, row[0] = row[0], row[0] + 1
            for j, d in enumerate(text, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
        best = min(best, min(row))
    return best


def _found(item, texts):
    index = decontaminate.BenchmarkIndex([(1, item)], decontaminate.Budget())
    return {r[0]: r for r in decontaminate.regions(index, *string_buffers(pa.array(texts)))}


def test_one_edit_at_any_place_of_a_stretch():
    rng = random.Random(7)
    some = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    item, texts = some(400), []
    for at in range(80):
        part = list(item[150:230])
        part[at] = "0"
        texts.append(some(60) + "".join(part) + some(60))
    assert {i: r[6] <= 1 for i, r in _found(item, texts).items()} == dict.fromkeys(range(80), True)


def test_stretches_with_edits_like_brute_force():
    rng = random.Random(11)
    some = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    item, texts = some(120), []
    copied = lambda: list(item[(a := rng.randint(0, 40)) : a + 80])
    for _ in range(30):
        part = copied()
        for _ in range(rng.randint(1, 7)):
            at = rng.randrange(len(part))
            part[at : at + 1] = rng.choice([["0"], [], [part[at], "0"]])
        texts.append(some(rng.choice([0, 5, 30])) + "".join(part) + some(rng.choice([0, 5, 30])))
    part = list(item[20:100])
    for at in (2, 9, 25, 40, 55):
        part[at] = "0"
    texts.append(some(30) + "".join(part) + some(30))
    got = _found(item, texts)
    expected = {i: e for i, t in enumerate(texts) if (e := _least_edits(item, t, 80)) <= 5}
    assert len(texts) > len(expected) > 15 and expected.keys() <= got.keys()
    for i, (_, _, begin, end, a, z, edits) in got.items():
        assert edits <= 5 * (z - a) // 80 and (z - a > 80 or edits == expected[i])
        assert edits == _least_edits(item[a:z], "".join(texts)[begin:end], z - a)


def _kinds(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: [(s["kind"], s["start"]) for s in r.spans] for r in secrets.find_secrets(df).collect()}


def test_the_scope_is_the_gap_between_parts(spark):
    long, name, point = "ab12" * 300, "ASIA12345678AB", "https://a.example.com"
    texts = [
        f"secret = {long} {name} {point}",
        f"{point} {name} secret = {long}",
        f"{long} {name}",
        f"{long}{' ' * 400}{name}",
        f"{long}{' ' * 401}{name}",
        f"{name}{' ' * 400}{long}",
        f"{name}{' ' * 401}{long}",
    ]
    got = {i: {k for k, _ in found} for i, found in _kinds(spark, texts).items()}
    assert got[0] == got[1] == {"assign", "hex", "weak_id", "endpoint"}
    assert got[2] == got[3] == got[5] == {"hex", "weak_id"} and got[4] == got[6] == {"hex"}
    df = spark.createDataFrame([(1, texts[0])], "doc_id long, text string")
    assert name not in secrets.redact_secrets(df).first().text


def test_near_parts_like_brute_force(spark):
    rng, rows = random.Random(3), []
    for row in range(40):
        at = 0
        for _ in range(rng.randint(2, 9)):
            start = at + rng.choice([0, 1, 399, 400, 401, rng.randint(0, 900)])
            at = start + rng.choice([1, 20, 400, rng.randint(1, 3000)])
            rows.append((row, rng.randint(0, 1), start, at))
    places = spark.createDataFrame(rows, "row long, kind int, start long, end long")
    got = secrets._near(places.where("kind = 0"), places.where("kind = 1"), 400).collect()
    gap = lambda a, b: max(a[2] - b[3], b[2] - a[3])
    expected = [a for a in rows if a[1] == 0 and any(b[1] == 1 and b[0] == a[0] and 0 <= gap(a, b) <= 400 for b in rows)]
    assert sorted(map(tuple, got)) == sorted(expected) and expected


def test_a_bare_key_of_any_length(spark):
    rng = random.Random(5)
    key = lambda n: "aB3" + "".join(rng.choice("abcXYZ019+/") for _ in range(n - 3))
    lengths = [19, 20, 128, 129, 400, 200_000]
    keys = [key(n) for n in lengths] + [key(400) + "=="]
    texts = [f"ASIA12345678ABCDEF01 {k} " for k in keys] + ["ASIA12345678ABCDEF01 " + key(400) + "_x"]
    got = _kinds(spark, texts)
    assert [("weak_key", 21) in got[i] for i in range(8)] == [False, True, True, True, True, True, True, False]
    sent = secrets.redact_secrets(spark.createDataFrame([(1, texts[4])], "doc_id long, text string")).first().text
    assert sent == "ASIA12345678ABCDEF01 [SECRET] "


def _field():
    """A field fitted on made texts with one phone number or address each, and other numbers."""
    rng, graph = random.Random(2), pii.Graph()
    digits = lambda n: "".join(rng.choice("123456789") for _ in range(n))
    for i in range(300):
        text = f"Call +1 ({digits(3)}) {digits(3)}-{digits(4)} or mail n{digits(2)}@mail.example.com in room {digits(4)}"
        graph.add(i, *pii.with_mentions(text, pii.base_spans(text)))
    return pii.fit_skip_chain(graph)


def test_fifty_mentions_far_from_the_observed_one():
    model, number = _field(), "+1 (521) 555-6210"
    for text in (
        f"Call {number} now" + "".join(f", or 555-6210 at {'x' * (k % 7 + 1)}" for k in range(50)),
        "".join(f"or 555-6210 at {'x' * (k % 7 + 1)}, " for k in range(50)) + f"that is {number} now",
    ):
        graph = pii.Graph()
        graph.add(0, text + "; room 555-0000 is another", pii.base_spans(text))
        found = [text[a:z] for _, a, _, z in pii.added_spans(graph, model)]
        assert found == ["555-6210"] * 50


def test_messages_reach_the_end_of_a_long_chain():
    graph, n = pii.Graph(), 60
    graph.features, graph.label = [[1.0] + [0.0] * (pii._SHAPES - 1)] * n, [1] + [-1] * (n - 1)
    graph.where, graph.chain = [(0, i, i + 1) for i in range(n)], [(i, i + 1) for i in range(n - 1)]
    width = len(pii.KINDS) + 1
    model = pii.SkipChain(np.zeros((pii._SHAPES, width)), 8.0 * np.eye(width), np.zeros((width, width)))
    step = np.exp(model.chain) / np.exp(model.chain).sum(axis=1, keepdims=True)
    exact = np.array([np.linalg.matrix_power(step, i)[1] for i in range(n)])
    assert np.abs(pii.marginals(graph, model) - exact).max() < 0.01


def _regions(items, texts, pairs=None):
    index = decontaminate.BenchmarkIndex(list(enumerate(items)), decontaminate.Budget())
    return index, decontaminate.regions(index, *string_buffers(pa.array(texts)))


def test_lengths_and_places_are_characters():
    """Accents, dashes, quotes, Chinese and characters of four bytes; case and punctuation beyond ASCII are folded."""
    rng = random.Random(5)
    letters = "äéßñøçабвгдежз中文字語書車東西南北𝄞𝔸"
    some = lambda n: "".join(rng.choice(letters) for _ in range(n))
    items = [some(121), some(300), "ÉCOLE – “Zürich” " * 9, some(79)]
    index, _ = _regions(items, [""])
    assert np.diff(index.offs).tolist()[:2] == [121, 300] and index.item_text(2)[:12].astype("<u4").tobytes().decode("utf-32-le") == "école zürich"
    texts, wanted = [], {}
    for i, item in enumerate(items):
        for edits in (0, 1, 3):
            part = list(item)
            for k in range(edits):
                part[7 + k * 23] = "x"
            before = some(13) + " — "
            texts.append(before + "".join(part).upper() if i == 2 else before + "".join(part) + "» " + some(20))
            wanted[len(texts) - 1, i] = edits
    _, found = _regions(items, texts)
    assert {(r[0], r[1]) for r in found} == set(wanted)
    whole = "".join(texts)
    for doc, i, begin, end, a, z, edits in found:
        if i in (0, 1):
            assert wanted[doc, i] or (a, z, edits) == (0, len(items[i]), 0)
            assert end - begin == z - a >= 80 and edits <= wanted[doc, i]
            assert sum(x != y for x, y in zip(whole[begin:end], items[i][a:z])) == edits
    # a copied stretch of 80 characters with five edits is inside the budget, whatever the alphabet
    part = list(items[1][100:180])
    for at in (2, 9, 25, 40, 55):
        part[at] = "q"
    assert [r[1] for r in _regions(items, [some(30) + "".join(part) + some(30)])[1]] == [1]


def test_periodic_texts_stay_within_memory():
    tracemalloc.start()
    _, found = _regions(["a" * 300, "ab" * 200], ["a" * 1_000_000])
    assert [(r[1], r[3] - r[2], r[6]) for r in found] == [(0, 300, 0)]
    assert tracemalloc.get_traced_memory()[1] < 500 << 20
    tracemalloc.stop()


def test_slices_of_diagonals_change_nothing(monkeypatch):
    rng = random.Random(9)
    some = lambda n: "".join(rng.choice("ab") for _ in range(n))
    items = ["ab" * 150, some(200), "abc" * 60, some(90), "a" * 40 + some(100) + "b" * 40]
    texts = [some(50) + (items[i][: rng.randint(80, 160)] + some(rng.randint(0, 90))) * rng.randint(1, 9) for i in range(5) for _ in range(4)]
    for i in range(0, len(texts), 3):
        t = list(texts[i])
        for at in range(rng.randint(3, 40), len(t), 37):
            t[at] = "0"
        texts[i] = "".join(t)
    one = _regions(items, texts)[1]
    monkeypatch.setattr(decontaminate, "PAIRS", 20_000)
    many = _regions(items, texts)[1]
    assert [(r[0], r[1], r[6], r[5] - r[4]) for r in many] == [(r[0], r[1], r[6], r[5] - r[4]) for r in one] and len(one) >= 20


def test_documents_are_read_once_for_many_blocks(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("etaoinshrdl") for _ in range(rng.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(30)) for i in range(300)]
    rows = [(i, text(60) + (" " + items[i][1] if i % 5 == 0 else "")) for i in range(300)] + [(300, None), (301, ""), (None, items[7][1])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    docs, bench = spark.read.parquet(str(tmp_path / "d")), spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(str, decontaminate.leaked_passages(docs, bench).collect()))
    kept = sorted(map(str, decontaminate.drop_leaks(docs, bench).collect()))
    assert len(one) == 61 and len(kept) == 303 - 61
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 5000)
    reads, inner = [], decontaminate.materialize
    monkeypatch.setattr(decontaminate, "materialize", lambda df, name: reads.append((name, str(tmp_path) in str(df.inputFiles()))) or inner(df, name))
    found = decontaminate.leaked_passages(docs, bench)
    assert sorted(map(str, found.collect())) == one
    assert [name for name, whole in reads if whole] == ["candidates"] and sum(name == "leaks" for name, _ in reads) > 8
    assert found.inputFiles() and not any(str(tmp_path) in f for f in found.inputFiles())
    assert sorted(map(str, decontaminate.drop_leaks(docs, bench).collect())) == kept
