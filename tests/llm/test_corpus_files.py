"""Merkle manifest, phrase collocations and token files against plain versions."""

import collections
import glob
import hashlib
import io
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F

from flowsift.llm import collocations as col
from flowsift.llm import merkle, token_files
from flowsift.llm.queries import ORACLES, QUERIES
from flowsift.session import scratch_path
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "text string, doc_id long, lang string, source string, n_chars long, rank int, digest string, f long"


def by_text(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, str(x)) for x in r))


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_phrase_collocations"])
def test_twins(spark, name):
    class Query:
        run, sql = staticmethod(QUERIES[name]), ORACLES[name]

    for folder in (FOLDER, "/root/testdata/sf0.01") if name.startswith("op12") else (FOLDER,):
        assert compare(spark, connect(folder), Query, folder) is None


# -- Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run = nodes[a // 3 * 3 : a // 3 * 3 + 3]
            paths[i].append(("".join(run[: a % 3]), "".join(run[a % 3 + 1 :])))
            at[i] = a // 3
        nodes = [sha(*nodes[j : j + 3]) for j in range(0, len(nodes), 3)]
    return nodes[0], paths


def plain_manifest(rows):
    told = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = collections.defaultdict(list)
    for r in rows:
        with_text = lambda t: sha(*map(told, (r["doc_id"], r["source"], t)))  # noqa: B023, E731
        odd = r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 2
        bad = r["text"] if odd or r["text"] is None else r["text"].replace("\n", "")
        groups[r["source"]].append((r["doc_id"], with_text(r["text"]), with_text(bad)))
    keys = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in keys:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = [plain_tree([x[1] for x in groups[s]]) for s in keys]
    root, tops = plain_tree([t[0] for t in trees])
    for s, (subroot, paths), top in zip(keys, trees, tops):
        for (i, leaf, claim), path in zip(groups[s], paths):
            folded = claim
            for left, right in path + top:
                folded = sha(left, folded, right)
            yield i, leaf, subroot, root, sha(*[x for p in path + top for x in p]), folded, folded == root


def manifest(docs):
    leaf = merkle.row_digest(F.col("doc_id"), F.col("source"), F.col("text"))
    bad = merkle.row_digest(F.col("doc_id"), F.col("source"), F.replace("text", F.lit("\n"), F.lit("")))
    claim = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, bad).otherwise(leaf)
    found = merkle.merkle_manifest(docs, "doc_id", "source", leaf, claim)
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def test_manifest_of_odd_rows(spark, monkeypatch):
    """Nulls, repeated keys and rows, lone leaves, names that clash, trees of several levels of blocks."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 2)
    monkeypatch.setattr(merkle, "TASK_ROWS", 7)
    rows = [(f"line {i}\nend" if i % 3 else f"line {i}", i, "hot") for i in range(100)]
    rows += [("a\nb", 7, "hot"), ("a\nb", 7, "hot"), ("c", None, "hot"), ("c", None, "hot"), (None, 3, "hot"), ("", 4, "hot")]
    rows += [("x\ny", 1, None), ("z", 2, None), ("alone\n", 50, "one"), ("é\n", 8, "Ä"), ("w", 9, "z"), (None, None, "z")]
    rows += [(f"s{i}\n", 200 + i, f"s{i}") for i in range(12)]
    docs = spark.createDataFrame([(t, i, "l", s, 1, 5, "d", 9) for t, i, s in rows], SCHEMA)
    wanted = by_text(plain_manifest([{"doc_id": i, "source": s, "text": t} for t, i, s in rows]))
    found = manifest(docs)
    assert "CartesianProduct" not in found._jdf.queryExecution().toString()
    assert by_text(found.collect()) == wanted
    assert any(not r[-1] for r in wanted) and any(r[-1] for r in wanted)


def test_manifest_one_row_and_none(spark):
    one = spark.createDataFrame([("a\nb", 1, "l", "s", 1, 5, "d", 9)], SCHEMA)
    row = manifest(one).first()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == sha("")
    assert manifest(one.limit(0)).collect() == []


def test_manifest_proofs_need_no_join(spark):
    """Siblings come out of nested blocks: the only joins of the finished plan are none."""
    plan = manifest(spark.read.parquet(f"{FOLDER}/documents.parquet"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate explode" in plan


# -- collocations


def plain_phrases(rows, least, longest=5):
    counts, totals = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(longest, len(words) - i) + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    return {k: v for k, v in counts.items() if v >= least}, {k: v for k, v in totals.items() if v}


def plain_scores(counts, totals):
    found = {}
    for (lang, w), a in counts.items():
        if len(w) < 2:
            continue
        cuts = [(counts[lang, w[:k]], counts[lang, w[k:]], k) for k in range(1, len(w))]
        score, _, l, r = min((1000 * a * totals[lang] // (l * r), k, l, r) for l, r, k in cuts)  # noqa: E741
        inside = any(
            g == lang and len(v) > len(w) and b >= a and any(v[i : i + len(w)] == w for i in range(len(v))) for (g, v), b in counts.items()
        )
        if not inside:
            found[lang, " ".join(w)] = (a, l, r, totals[lang], score)
    return found


@pytest.mark.parametrize("most", [4_000_000, 40])
def test_phrases_and_scores(spark, monkeypatch, most):
    """Words beyond ASCII, pieces, nulls, repeated rows, a pair of words that holds a third of all suffixes (routes dealt again)."""
    monkeypatch.setattr(col, "ROUTE_ROWS", most)
    monkeypatch.setattr(col, "CHUNK_BYTES", 1500)
    rng = random.Random(5)
    vocabulary = ["the", "The", "of", "ñu", "a b", "x\x1fy", "don't", "hot", "pair", "漢字", "zz", "-", "_"]
    rows = []
    for i in range(160):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        words += ["hot", "pair", rng.choice(vocabulary), rng.choice(vocabulary), rng.choice(vocabulary)] * 6
        text = "".join(w + rng.choice([" ", "  ", "\t", ". ", "\n", " ; "] if rng.random() < 0.2 else [" "]) for w in words)
        rows.append((text, i, rng.choice(["en", "en", None, "und"])))
    rows += [(None, 900, "en"), ("", 901, "en"), ("...", 902, "xx"), ("one", 903, "en"), ("same words here. " * 300, 904, "en")]
    rows += [rows[0]] * 5
    docs = spark.createDataFrame([(t, i, g, "s", 1, 5, "d", 9) for t, i, g in rows], SCHEMA).repartition(5)
    wanted, totals = plain_phrases([(g, t) for t, _, g in rows], least=12)
    phrases = col.frequent_phrases(docs, least=12)
    found = phrases.collect()
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in found} == wanted and len(found) == len(wanted)
    assert all(r.words == len(r.phrase.split(" ")) for r in found)
    counted = {r.lang: r.n for r in col.word_totals(docs).collect()}
    assert {k: v for k, v in counted.items() if v} == totals
    scored = col.collocations(phrases, col.word_totals(docs)).collect()
    assert {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in scored} == plain_scores(wanted, totals)


def test_phrases_of_nothing(spark):
    docs = spark.createDataFrame([(None, 1, "en", "s", 1, 5, "d", 9)], SCHEMA)
    assert col.frequent_phrases(docs).collect() == [] and col.frequent_phrases(docs.limit(0)).collect() == []


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    rows = [("en", "a", 1, big), ("en", "b", 1, big + 7), ("en", "a b", 2, big - 11)]
    phrases = spark.createDataFrame(rows, "lang string, phrase string, words int, f long")
    totals = spark.createDataFrame([("en", 7 * big + 1)], "lang string, n long")
    row = col.collocations(phrases, totals).first()
    assert row.score == 1000 * (big - 11) * (7 * big + 1) // (big * (big + 7))


def test_quicksort_abandons_and_counts():
    rng = np.random.default_rng(3)
    matrix = rng.integers(-1, 6, (4000, 4)).astype(np.int32)
    ended = np.cumsum(matrix < 0, axis=1) > 0
    matrix[ended] = -1
    weights = rng.integers(1, 9, 4000)
    wanted = collections.Counter()
    for row, weight in zip(matrix.tolist(), weights.tolist()):
        for k in range(1, 5):
            if row[k - 1] >= 0:
                wanted[tuple(row[:k])] += weight
    found = {}
    for depths, rows, sums in col.frequent_prefixes(matrix, weights, 60):
        for d, r, s in zip(depths, rows, sums):
            assert tuple(matrix[r, :d].tolist()) not in found
            found[tuple(matrix[r, :d].tolist())] = s
    assert found == {k: v for k, v in wanted.items() if v >= 60}


# -- token files

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def plain_ids(text):
    from tokenizers import Tokenizer

    plain_ids.model = getattr(plain_ids, "model", None) or Tokenizer.from_file(TOKENIZER)
    return [*plain_ids.model.encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def odd_texts():
    rng = random.Random(1)
    parts = ["a", "B", "é", " ", "  ", "\n", "\t", " ", "　", "'s", "don't", "1", "23", "!", "--", "<|endoftext|>", "中", "𝄞"]
    parts += ["\u0085", "\x1c", "ß", "ñ", ".", "\r\n", "ß ", "  ", "  "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    return [*texts, None, "", "x" * 300 + " yy " * 50, "word " * 30_000]


def written(spark, tmp_path, rows):
    docs = spark.createDataFrame([(t, i, "l", "s", 1, 5, "d", 9) for i, t in rows], SCHEMA)
    docs.write.parquet(f"{tmp_path}/docs")
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(spark.read.parquet(f"{tmp_path}/docs"), path, TOKENIZER)
    return path


def test_token_files_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BYTES", 20_000)
    rows = list(enumerate(odd_texts()))
    path = written(spark, tmp_path, rows)
    start, wanted = 0, []
    for i, text in rows:
        ids = plain_ids(text)
        wanted.append((i, start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert sorted((r[0], r[1], r[2], bytes(r[3])) for r in token_files.read_token_files(spark, path).collect()) == wanted
    # any reader of zstandard unpacks the files from end to end
    folder = path.removeprefix("file:")
    streams = [open(p, "rb").read() for p in sorted(glob.glob(f"{folder}/part-*"))]
    assert len(streams) > 3
    plain = [zstandard.ZstdDecompressor().stream_reader(io.BytesIO(s), read_across_frames=True).read() for s in streams if s]
    assert sum(map(len, plain)) == 2 * start


def test_only_wanted_frames_are_unpacked(spark, tmp_path):
    rows = [(i, f"text {i} " * 20) for i in range(60)] + [(None, "no id")]
    path = written(spark, tmp_path, rows)
    found = token_files.read_token_files(spark, path, [3, 59, 7000, None]).collect()
    assert {r.doc_id: r.n_tokens for r in found} == {3: len(plain_ids(rows[3][1])), 59: len(plain_ids(rows[59][1])), None: len(plain_ids("no id"))}
    assert token_files.read_token_files(spark, path, []).collect() == []
    content = next(c for c in (open(p, "rb").read() for p in glob.glob(f"{path.removeprefix('file:')}/part-*")) if c)
    at = token_files.TokenFile(content)
    broken = bytearray(content)
    broken[at.begin[5] + 9] ^= 255  # a frame that nobody asks for may be broken
    file = token_files.TokenFile(bytes(broken))
    assert file.read(4).tolist() == at.read(4).tolist()
    with pytest.raises((ValueError, zstandard.ZstdError)):
        file.read(5)
    with pytest.raises(ValueError):
        token_files.TokenFile(content[:-1])


def test_token_files_ties_and_nothing(spark, tmp_path):
    rows = [(5, "b"), (5, "a"), (5, "a"), (None, "n"), (None, None), (2, "")]
    path = written(spark, tmp_path, rows)
    found = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, None, 2, 5, 5, 5]
    assert sum(r.n_tokens for r in found) == sum(len(plain_ids(t)) for _, t in rows)
    assert sorted(crc(np.frombuffer(r.ids, "<u4")) for r in found) == sorted(crc(plain_ids(t)) for _, t in rows)
    (tmp_path / "none").mkdir()
    empty = written(spark, tmp_path / "none", [])
    assert token_files.read_token_files(spark, empty).collect() == []
