"""Importance resampling, packing along a curve, periodic runs: each query against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from fieldgauge.llm.importance import crc32_of, resample
from fieldgauge.llm.packing import WordEncoder, hilbert, pack, tokenizer_path
from fieldgauge.llm.periodic_runs import periodic_runs, runs_of, stretches
from fieldgauge.llm.queries import op11_resample, op12_pack, op13_runs

DOCUMENTS = "doc_id long, text string, lang string, score double, key string"


def corpus():
    """Nulls, empty and blank texts, repeats, ties, a long text, marks and other scripts."""
    rng = random.Random(3)
    words = ["alpha", "beta", "Gamma", "δέλτα", "naïve", "x1", "don't", "İstanbul", "ΣΑΣ", "w" * 70, "ein", "zwei", "ét", "３"]
    texts = [None, "", " \t\n ", "one", "!!! ???", "a b c\x1fd\x85e", "́ x́", " ".join(["same"] * 40), " ".join(["p", "q", "r"] * 30)]
    texts += [" ".join(rng.choices(words, k=rng.randint(1, 80))) for _ in range(60)]
    texts += ["\n".join(rng.choices(words, k=9_000)), "a b c d e f g " * 2_600]
    rows = [(i, t, "en", 0.5, "k") for i, t in enumerate(texts)]
    return [*rows, (9, texts[9], "de", None, None), (9, "another text under that id " * 5, None, 1.0, "x"), (None, "no id " * 20, None, None, None)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(corpus(), DOCUMENTS).repartition(3).write.parquet(f"{base}/documents.parquet")
    items = [("i1", "alpha beta alpha"), ("i2", None), ("i3", "zwei ΔΈΛΤΑ x1")]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{base}/benchmark.parquet")
    return base


def ascii_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_resample(rows, items, max_words=1, buckets=10_000, percent=10, least=20):
    def found(text):
        w = ascii_words(text)
        return [" ".join(w[i : i + n]) for n in range(1, max_words + 1) for i in range(len(w) - n + 1)]

    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    counts = [[0] * buckets, [0] * buckets]
    for texts, into in (([r[1] for r in rows], counts[0]), (items, counts[1])):
        for f in (f for t in texts for f in found(t)):
            into[bucket(f)] += 1
    s, t = sum(counts[0]), sum(counts[1])
    gain = [math.floor(1000 * math.log((b + 1) * (s + buckets) / ((a + 1) * (t + buckets)))) for a, b in zip(*counts, strict=True)]
    out = []
    for doc_id, text, *_ in rows:
        f = found(text)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(ascii_words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296.0)))])
    eligible = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    drawn = [id(r) for r in eligible[: percent * len(eligible) // 100]]
    return sorted(((r[0], *r[2:], drawn.index(id(r)) + 1 if id(r) in drawn else None) for r in out), key=repr)


ITEMS = ["alpha beta alpha", None, "zwei ΔΈΛΤΑ x1"]


def test_op11_equals_brute_force(spark, folder):
    got = op11_resample(spark, folder)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_resample(corpus(), ITEMS)


@pytest.mark.parametrize("max_words", [1, 3])
def test_resample_by_more_words_and_other_shares(spark, max_words):
    rows = corpus()[:60]
    target = spark.createDataFrame([(t,) for t in ITEMS], "text string")
    got = resample(spark.createDataFrame(rows, DOCUMENTS), target, percent=55, buckets=97, max_words=max_words).drop("n_words")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_resample(rows, ITEMS, max_words, 97, 55)


def test_resample_of_empty_tables(spark):
    some, none = spark.createDataFrame(corpus()[:12], DOCUMENTS), spark.createDataFrame([], DOCUMENTS)
    assert resample(none, some).collect() == [] and resample(none, none).collect() == []
    assert sorted((r["doc_id"], r["n_features"]) for r in resample(some, none).collect()) == [(r[0], len(ascii_words(r[1]))) for r in corpus()[:12]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=20)), st.integers(0, 5000))
def test_crc_matrices(features, long):
    features = [*features, b"x" * long, b"y" * long]
    assert crc32_of(features).tolist() == [zlib.crc32(f) for f in features]


ENCODER = WordEncoder(tokenizer_path())
TOKENIZER = Tokenizer.from_file(tokenizer_path())


def encoded(texts):
    return [[*TOKENIZER.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"aBK.,;:!?'s &ΣςÉé\u0301\u0345İß\n\t\r\x01\x0b\x1c\x1f\x85\xa0\u3000中🙂가ᄀ1٣|<>", "<|endoftext|>", "'ll", "the"]), max_size=40).map("".join), max_size=6))
def test_ids_by_words_are_those_of_whole_texts(texts):
    assert [[*ids.tolist(), 2] for ids in ENCODER(pa.array(texts, pa.string()))] == encoded(texts)


def check_pieces(pieces, want, length):
    """Every id of every document in one piece, no gaps, sequences full but for powers of two."""
    parts = {}
    for p in pieces:
        parts.setdefault(p["sequence_id"], []).append(p)
    assert sorted(parts) == list(range(len(parts)))
    for sequence, held in sorted(parts.items()):
        held.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in held] == np.cumsum([0, *[p["length"] for p in held]])[:-1].tolist()
        total = sum(p["length"] for p in held)
        assert total == length or (total & (total - 1) == 0 and total < length and sequence >= sum(map(len, want)) // length)
    by_document = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        by_document.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
    return by_document


@pytest.mark.parametrize("length", [4096, 100])
def test_packed_pieces_hold_every_id_once(spark, length):
    rows = [r for r in corpus() if r[0] is not None and r[0] != 9]
    want = {r[0]: ids for r, ids in zip(rows, encoded([r[1] for r in rows]), strict=True)}
    pieces = pack(spark.createDataFrame(rows, DOCUMENTS).repartition(5), length=length).collect()
    for (doc_id, tokens), held in check_pieces(pieces, want.values(), length).items():
        held.sort(key=lambda p: p["start"])
        assert [p["start"] for p in held] == np.cumsum([0, *[p["length"] for p in held]])[:-1].tolist()
        assert np.concatenate([np.frombuffer(p["ids"], "<u4") for p in held]).tolist() == want[doc_id] and tokens == len(want[doc_id])
    assert {p["doc_id"] for p in pieces} == set(want)


def test_op12_digests(spark, folder):
    want = sorted((r[0] is None, r[0] or 0, ids) for r, ids in zip(corpus(), encoded([r[1] for r in corpus()]), strict=True))
    pieces = op12_pack(spark, folder).collect()
    held = check_pieces(pieces, [w[2] for w in want], 4096)
    assert sum(p["length"] for p in pieces) == sum(len(w[2]) for w in want)
    for p in pieces:
        whole = [w[2] for w in want if (w[0], w[1]) == (p["doc_id"] is None, p["doc_id"] or 0) and len(w[2]) == p["doc_tokens"]]
        assert any(zlib.crc32(np.array(w[p["start"] : p["start"] + p["length"]], "<u4").tobytes()) == p["ids_crc32"] for w in whole)
    assert len(held) == len({(w[0], w[1], len(w[2])) for w in want})


def test_pack_of_an_empty_table_and_equal_texts(spark):
    assert pack(spark.createDataFrame([], DOCUMENTS)).collect() == []
    pieces = pack(spark.createDataFrame([(i % 7, "the same text", "en", 0.0, "") for i in range(500)], DOCUMENTS), length=64).collect()
    assert sum(p["length"] for p in pieces) == 500 * 4 and max(p["offset"] + p["length"] for p in pieces) == 64


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_hilbert_neighbours(dims, bits):
    points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    keys = hilbert(points, bits)
    assert sorted(keys.tolist()) == list(range(len(points)))
    along = points[np.argsort(keys)]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


def test_like_documents_are_neighbours(spark):
    rng = random.Random(5)
    topics = [[f"{t}word{i}" for i in range(30)] for t in "abcd"]
    rows = [(i, " ".join(rng.choices(topics[i % 4], k=60)), "en", 0.0, "") for i in range(200)]
    pieces = pack(spark.createDataFrame(rows, DOCUMENTS)).collect()
    order = [p["doc_id"] % 4 for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"]))]
    assert sum(a == b for a, b in zip(order, order[1:], strict=False)) > 0.8 * len(order)


def brute_runs(words, least=12):
    """Every period in ascending order: maximal stretches of words equal at that distance."""
    _, ids = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True)
    found = []
    for period in range(1, len(ids) // 2 + 1):
        same = np.concatenate([[False], ids[period:] == ids[:-period], [False]]).astype(int)
        for i, j in zip(np.flatnonzero(np.diff(same) > 0).tolist(), np.flatnonzero(np.diff(same) < 0).tolist(), strict=True):
            n = j - i + period
            if n >= max(least, 2 * period) and not any(s <= i and s + m >= i + n and period % p == 0 for s, m, p in found):
                found.append((i, n, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=50), st.integers(1, 6), st.sampled_from([2, 5, 12]))
def test_runs_equal_brute_force(words, times, least):
    words = words[:10] * times + words
    assert runs_of(words, least) == brute_runs(words, least)
    ids, owner = np.array(words * 2), np.repeat([0, 1], len(words))
    found = [(s + a, n, p) for s, e in stretches(ids, owner, least) for a, n, p in runs_of(ids[s:e].tolist(), least)]
    want = brute_runs(words, least)
    assert sorted(found) == sorted([*want, *[(s + len(words), n, p) for s, n, p in want]])


def test_op13_equals_brute_force(spark, folder):
    want = []
    for doc_id, text, *_ in corpus():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words)
        top = min(((-m, s, p) for s, m, p in runs), default=None)
        kept = [w for i, w in enumerate(words) if not any(s + p <= i < s + m for s, m, p in runs)]
        lines = "".join(f"{s},{m},{p}\n" for s, m, p in runs)
        sums = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, " ".join(kept))]
        want.append((doc_id, len(runs), *((top[1], -top[0], top[2], -1000 * top[0] // top[2]) if top else (None,) * 4), *sums))
    got = op13_runs(spark, folder)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_periodic_runs_without_rows(spark):
    assert periodic_runs(spark.createDataFrame([], DOCUMENTS)).collect() == []
    only = periodic_runs(spark.createDataFrame([(None, None, None, None, None)], DOCUMENTS), fold=True).collect()
    assert [tuple(r) for r in only] == [(None, [], "")]
