"""Phrase mining, whitening and first-fit packing against plain Python and numpy."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quotelens.llm import minhash_dedup, phrase_mining, tokenizing, tree_packing, whitening

SCHEMA = "doc_id long, text string, lang string, phrase string, score long, w1 string, part int, n_chars long"


def brute_phrases(rows, least, top):
    f, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    found = []
    for lang, counts in f.items():
        candidates = {}
        for p, a in counts.items():
            if len(p) > 1 and a >= least:
                cuts = [(1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                candidates[p] = (a, counts[p[:k]], counts[p[k:]], score)
        kept = [
            (p, *v) for p, v in candidates.items()
            if not any(len(q) > len(p) and p in (q[:2], q[1:]) and 100 * w[0] >= 50 * v[0] for q, w in candidates.items())
        ]
        kept.sort(key=lambda x: (-x[4], -x[1], " ".join(x[0]).encode()))
        for rank, (p, a, l, r, score) in enumerate(kept[:top], 1):  # noqa: E741
            found.append((lang, rank, " ".join(p), a, l, r, total[lang], score))
    return sorted(found)


def corpus(seed, docs):
    r = random.Random(seed)
    words = ["The", "the", "cat", "Éa", "éa", "x\x0by", "of", "new", "york", "city", "\x1cz", "İ"]
    return [
        ("".join(r.choice(words) + r.choice([" ", "  ", "\t", ". ", ",", "\n", " ", " "]) for _ in range(r.randrange(60))),
         r.choice(["en", "en", "en", "fr", None, "und"])) for _ in range(docs)
    ]


@pytest.mark.parametrize("chunk, words, least, top", [(8_000_000, 2_000_000, 10, 2000), (300, 2_000_000, 3, 7), (10**6, 17, 4, 30)])
def test_phrases(spark, monkeypatch, chunk, words, least, top):
    monkeypatch.setattr(phrase_mining, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(phrase_mining, "CHUNK_WORDS", words)
    monkeypatch.setattr(phrase_mining, "BUCKET_BYTES", 1000 if least == 3 else 12_000_000)
    monkeypatch.setattr(phrase_mining, "HELD_WINDOWS", words)
    rows = corpus(chunk, 150) + [("", "en"), (None, "en"), (None, None), ("new york " * 400, "fr"), ("  .. \n", "de")]
    rows += [("same same again.", "it")] * 12
    docs = spark.createDataFrame([(i, t, g, "p", 1, "w", 2, 3) for i, (t, g) in enumerate(rows)], SCHEMA)
    found = sorted(tuple(r) for r in phrase_mining.mine_phrases(docs, "text", "lang", least, top).collect())
    assert found == brute_phrases(rows, least, top) and {x[0] for x in found} >= {"en", "fr", "it", "und"}
    assert phrase_mining.mine_phrases(docs.limit(0), "text", "lang").count() == 0
    assert phrase_mining.mine_phrases(docs.where("doc_id < 2"), "text", "lang", 10**6).count() == 0


def test_scores_beyond_64_bits(spark):
    a, left, right = 3 * 10**12 + 7, 9 * 10**12 + 1, 4 * 10**12 + 3
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert row.select(phrase_mining.millionths("a", "l", "r")).first()[0] == 10**6 * a * a // (left * right)


def vectors(seed, n, scales):
    r = np.random.default_rng(seed)
    basis, _ = np.linalg.qr(r.normal(size=(len(scales), len(scales))))
    return (r.normal(size=(n, len(scales))) * scales) @ basis.T + 0.1


def test_whitening(spark):
    v = vectors(3, 400, np.array([1, 0.8, 0.7, 0.5, 0.2, 0.1, 0.09, 0.05, 0.02, 0.01])).astype(np.float32)
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    rows += [(5, rows[5][1]), (None, rows[6][1])]
    usable_rows = list(rows)
    rows += [(900, None), (901, []), (902, [None] + [1.0] * 9), (903, [float("nan")] * 10), (904, [float("-inf")] * 10)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as n", "2 as w", "'x' as vector")
    found = whitening.whiten(table, "vec_id", "embedding").collect()
    x = np.floor(1024 * np.array([r[1] for r in usable_rows], np.float32).astype(float)).astype(np.int64) + 100000
    n, s = len(x), x.sum(axis=0)
    c = x - s / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1], q[:, ::-1]
    white = c @ q / np.sqrt(e)
    by_row = defaultdict(list)
    for r in found:
        by_row[(r.vec_id, int(r.deviation))].append(r)
    assert len(found) == 8 * n and {r.n for r in found} == {n} and {r.component for r in found} == set(range(1, 9))
    assert {r.identity_error for r in found} == {found[0].identity_error} and found[0].identity_error < 1e-9
    signs = None
    for i, (key, _) in enumerate(usable_rows):
        deviation = sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[i], s))
        own = {r.component: r for r in by_row[(key, deviation)]}
        got = np.array([own[k].whitened for k in range(1, 9)])
        signs = np.sign(got * white[i, :8]) if signs is None else signs
        assert np.abs(got * signs - white[i, :8]).max() < 1e-9
        assert np.allclose([own[k].explained for k in range(1, 9)], e[:8] / e.sum(), rtol=1e-9)


def test_whitening_without_variance(spark):
    table = spark.createDataFrame([(i, [0.5, 0.25]) for i in range(5)], "vec_id long, embedding array<double>")
    assert whitening.whiten(table, "vec_id", "embedding").count() == 0
    assert whitening.whiten(table.limit(0), "vec_id", "embedding").count() == 0
    line = spark.createDataFrame([(i, [i / 8, i / 4]) for i in range(5)], "vec_id long, embedding array<double>")
    found = whitening.whiten(line, "vec_id", "embedding").collect()
    assert {r.component for r in found} == {1} and abs(found[0].explained - 1) < 1e-12 and len(found) == 5
    mixed = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        whitening.whiten(mixed, "vec_id", "embedding")


@pytest.mark.parametrize("eigenvalues", [
    [9, 5, 3, 1, 0.5], [1, 1, 1, 1], [5, 5 - 1e-9, 5 - 2e-9, 2, 2, 1e-7], [1e12, 1, 1 - 1e-6, 1e-3], [0, 0, 0], [4, 1e-30, 0],
    list(np.linspace(1, 2, 40)), [3] + [1 + 1e-8 * k for k in range(10)],
])
def test_refinement_of_clustered_eigenvalues(eigenvalues):
    r = np.random.default_rng(len(eigenvalues))
    d = len(eigenvalues)
    q, _ = np.linalg.qr(r.normal(size=(d, d)))
    a = (q * np.array(eigenvalues)) @ q.T
    a = (a + a.T) / 2
    e, x = whitening.refined_eigenvectors(a)
    size = max(eigenvalues) or 1
    assert np.abs(x.T @ x - np.eye(d)).max() < 1e-14
    assert np.abs(a @ x - x * e).max() < 4e-15 * size * d
    assert (np.diff(e) <= 0).all() and np.abs(e - np.sort(eigenvalues)[::-1]).max() < 1e-14 * size * d


def test_exact_sums_and_deviations_beyond_64_bits():
    n, s = 10**12, [10**17 + 3, 5]
    run = whitening.projector(n, s, np.eye(2), np.ones(2))
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([[1.5, -2.0]])], names=["vec_id", "vector"])
    [out] = list(run([batch]))
    x = [1536 + 100000, -2048 + 100000]
    assert int(out.column("deviation")[0].as_py()) == sum((n * a - b) ** 2 for a, b in zip(x, s))


WORDS = "alpha beta, gamma's delta. epsilon? zeta; é ça <|endoftext|> 12.5".split()


def check_packing(found, texts, capacity, end):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {d: library.encode(t or "", add_special_tokens=False).ids + [end] for d, t in texts.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        whole = ids[r.doc_id]
        part = np.array(whole[r.start : r.start + r.length], "<u4")
        assert (r.doc_tokens, r.ids_crc32, len(part)) == (len(whole), zlib.crc32(part.tobytes()), r.length)
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for d, whole in ids.items():
        at = 0
        for start, length in sorted(pieces[d]):
            assert start == at
            at += length
        assert at == len(whole)
    sizes = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        sizes.append(at)
    assert all(s <= capacity and s & (s - 1) == 0 for s in sizes)
    return sizes


@pytest.mark.parametrize("capacity, group", [(64, 10_000), (64, 20), (1, 5), (4096, 10)])
def test_tree_packing(spark, monkeypatch, capacity, group):
    monkeypatch.setattr(tree_packing, "GROUP_ROWS", group)
    r = random.Random(capacity + group)
    texts = {i: " ".join(r.choice(WORDS) for _ in range(int(r.expovariate(0.06)))) for i in range(120)}
    texts |= {200: None, 201: "", 202: " ".join(WORDS) * 400, 203: "\n", 204: texts[1], 205: texts[1]}
    rows = [(i, t, 7, 8, 9, b"") for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int, part int, offset int, ids binary")
    path = public_tokenizers.path("word_bpe_49k.json")
    sizes = check_packing(tree_packing.pack(docs, "doc_id", "text", path, capacity, 2).collect(), texts, capacity, 2)
    groups = -(-len(texts) // group)
    assert sum(s < capacity for s in sizes) <= groups * 3 * capacity.bit_length()
    assert tree_packing.pack(docs.limit(0), "doc_id", "text", path, capacity).count() == 0
    twice = docs.where("doc_id = 5").union(docs.where("doc_id = 5")).selectExpr("CAST(NULL AS LONG) AS doc_id", "text")
    repeated = tree_packing.pack(twice, "doc_id", "text", path, capacity).collect()
    assert {x.doc_id for x in repeated} == {None} and sum(x.length for x in repeated) == 2 * repeated[0].doc_tokens
    with pytest.raises(ValueError):
        tree_packing.pack(docs, "doc_id", "text", path, 100)


def test_first_fit_takes_the_first_bin_that_holds():
    r = np.random.default_rng(1)
    for n in (1, 2, 7, 300):
        lengths = r.integers(1, 100, n)
        bins, offsets, rooms = tree_packing.first_fit_decreasing(lengths, 100)
        free, expected = [], {}
        for i in np.argsort(-lengths, kind="stable").tolist():
            b = next((k for k, room in enumerate(free) if room >= lengths[i]), None)
            if b is None:
                free.append(100)
                b = len(free) - 1
            expected[i] = (b, 100 - free[b])
            free[b] -= int(lengths[i])
        assert {i: (int(bins[i]), int(offsets[i])) for i in range(n)} == expected and rooms.tolist() == free


def test_word_ids_of_chunks(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    r = random.Random(8)
    alphabet = [*"ab éçÉß×÷İ.,!?;:*#$%&|'\n\t-12<>Ā̸ ", "<|endoftext|>", "  ", "word"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(40))) for _ in range(3000)] + ["", None]
    for size in (8_000_000, 50):
        monkeypatch.setattr(tokenizing, "CHUNK_BYTES", size)
        found = tokenizing.word_ids(path, 1)([None if t is None else t.encode() for t in texts])
        assert [x.tolist() for x in found] == [library.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_pieces_encoded_together(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    calls, encode = [], tokenizing.encode_pieces
    monkeypatch.setattr(tokenizing, "encode_pieces", lambda t, pieces: calls.append(len(pieces)) or encode(t, pieces))
    for pieces in (["word", "a|b", "é\t'S", "", "|", "<|endoftext|>", "x" * 50], ["|"], ["a"], [f"w{i}" for i in range(3000)]):
        found = tokenizing.encode_joined(library, pieces)
        expected = [library.encode(p, add_special_tokens=False).ids for p in pieces]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == expected
    assert sum(calls) < 100
    # A separator that occurs otherwise parts nothing.
    monkeypatch.setattr(tokenizing, "SEPARATOR", "ab")
    assert [len(ids) // 4 for ids in tokenizing.encode_joined(library, ["AB", "c"])] == [1, 1]


def test_memo_keeps_what_a_repeated_corpus_holds(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    calls, encode = [], tokenizing.encode_pieces
    monkeypatch.setattr(tokenizing, "encode_pieces", lambda t, pieces: calls.append(sum(map(len, pieces))) or encode(t, pieces))
    ids_of = tokenizing.word_ids(path, 1)
    texts = [" ".join(f"q{i}" for i in range(at, at + 5000)).encode() for at in range(0, 300_000, 5000)] * 2
    first = sum(len(x) for x in ids_of(texts))
    met = sum(calls)
    assert sum(len(x) for x in ids_of(texts)) == first and sum(calls) == met


def test_workers_forget_pieces():
    path = public_tokenizers.path("word_bpe_49k.json")
    ids_of = tokenizing.word_ids(path, 1)
    first = [x.tolist() for x in ids_of([b"some words", b"more"])]
    assert tokenizing.load(path)[1]["new"]
    next(minhash_dedup.sketcher()(iter([])), None)
    assert not any(tokenizing.load(path)[1].values())
    assert [x.tolist() for x in ids_of([b"some words", b"more"])] == first
