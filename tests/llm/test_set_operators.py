"""Operators on the corpus as a whole, against brute force on small tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fieldgauge.llm import line_dedup, nearest as ann
from fieldgauge.llm.components import components
from fieldgauge.llm.decontamination import contamination, without_contaminated
from fieldgauge.llm.mixing import mix, rake
from fieldgauge.llm.ngram_join import similar_documents
from fieldgauge.llm.sharding import shard

VOCABULARY = [a + b + c for a in "bdfg" for b in "aeiou" for c in "lmnr"]


def union_find(items, links):
    parent = {i: i for i in items}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in items}


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    got = {r["id"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = union_find({x for e in links for x in e}, links)
    assert {i: want[i] for i in got} == got and all(want[i] == i for i in set(want) - set(got))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture(scope="module")
def corpus(spark):
    """Texts with copies, near copies, a shared passage, repeated rows and odd texts."""
    rng = random.Random(7)
    shared = " ".join(rng.choices(VOCABULARY, k=40))
    texts = []
    for _ in range(60):
        words = rng.choices(VOCABULARY, k=rng.randint(20, 120))
        texts.append(" ".join(words))
    for _ in range(60):  # near copies, a large group of one among them
        words = texts[0 if rng.random() < 0.5 else rng.randrange(60)].split()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
        texts.append(" ".join(words))
    texts += [shared + " " + " ".join(rng.choices(VOCABULARY, k=25)) for _ in range(30)]
    texts += texts[:15] + [texts[3]] * 20 + ["", " \n ", "one", "one", "One two", "É é x y", "é É x y", "a b c d e " * 3000]
    rows = [(i, t, "en", "hot" if i % 3 else f"s{i % 5}", len(t)) for i, t in enumerate(texts)]
    rows += [(len(rows), None, None, None, None), rows[4], rows[4]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").cache()


def word_shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_join_equals_brute_force(spark, corpus, size, percent):
    sets = {r["doc_id"]: word_shingles(r["text"], size) for r in corpus.collect()}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = union_find(sets, links)
    got = similar_documents(corpus.withColumn("n", F.lit("clash")), size, percent).collect()
    assert len(got) == corpus.count()
    assert all(r["component_id"] == want[r["doc_id"]] and r["n_shingles"] == len(sets[r["doc_id"]]) for r in got)


def test_join_of_rows_without_id_and_of_nothing(spark):
    rows = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e"), (3, "a b c d e")], "doc_id long, text string")
    assert sorted(map(tuple, similar_documents(rows).collect()), key=str) == [(3, 2, 3), (None, 2, None), (None, 2, None)]
    assert similar_documents(rows.limit(0)).count() == 0


def brute_windows(text, items, size=10):
    lowered = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    words, hit, named = lowered(text), set(), set()
    for item_id, item in items:
        w = lowered(item)
        for s in range(max(1, len(w) - size + 1)) if w else []:
            window = w[s : s + size]
            for at in range(len(words) - len(window) + 1):
                if words[at : at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    named.add(str(item_id))
    return len(words), len(hit), sorted(named)


def test_contamination_equals_brute_force(spark):
    rng = random.Random(9)
    words = VOCABULARY[:30] + ["É", "x1"]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([2, 4, 9, 10, 14, 25])))) for i in range(25)]
    items += [(90, items[3][1]), (91, None), (92, "?!"), (10, items[0][1])]
    texts = []
    for _ in range(60):
        parts = rng.choices(words, k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            piece = (rng.choice(items)[1] or "").split()
            parts[rng.randint(0, len(parts)) : 0] = piece[rng.randint(0, 3) :]
        texts.append(", ".join(parts).upper() if rng.random() < 0.2 else " ".join(parts))
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(100, None, "x"), (101, "", "x"), (5, texts[5], "x"), (5, "other text", "x"), (None, items[4][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string")
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("w", F.lit(1))
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items"], r["contaminated"]) for r in contamination(docs, bench).collect())
    want = []
    for i, t, _ in rows:
        n, h, named = brute_windows(t, items)
        want.append((str(i), n, h, len(named), named, h > 0))
    assert got == sorted(want)
    left = without_contaminated(docs, bench)
    assert left.columns == docs.columns and left.count() == sum(not w[5] for w in want)
    nothing = contamination(docs, bench.limit(0)).collect()
    assert len(nothing) == len(rows) and not any(r["contaminated"] for r in nothing)
    assert contamination(docs.limit(0), bench).count() == 0


def test_short_items_only(spark):
    docs = spark.createDataFrame([(1, "the cat sat"), (2, "a dog")], "doc_id long, text string")
    got = contamination(docs, spark.createDataFrame([("k", "Cat")], "item_id string, text string")).collect()
    assert sorted((r["doc_id"], r["n_hit"], r["items"]) for r in got) == [(1, 1, ["k"]), (2, 0, [])]


def test_raking_meets_the_marginals(spark):
    rng = random.Random(4)
    cells = [(s, lang, rng.randint(1, 500)) for s in "abcde" for lang in ("x", "y", None)]
    frame = spark.createDataFrame(cells, "source string, lang string, tokens long")
    got = rake(frame, {"source": 0.5, "lang": 0.7}).collect()
    total = sum(c[2] for c in cells)
    for place, (name, power) in enumerate({"source": 0.5, "lang": 0.7}.items()):
        sums, raked = defaultdict(float), defaultdict(float)
        for c in cells:
            sums[c[place]] += c[2]
        for r in got:
            raked[r[name]] += r["weight"]
        norm = sum(v**power for v in sums.values())
        assert all(raked[v] == pytest.approx(sums[v] ** power / norm * total, rel=1e-6) for v in sums)


def test_mix_keeps_the_budget_in_expectation(spark, corpus):
    got = mix(corpus, keep_share=0.6).collect()
    assert len(got) == corpus.count()
    assert sum(r["chance"] * r["tokens"] for r in got) == pytest.approx(0.6 * sum(r["tokens"] for r in got), rel=1e-6)
    lot = lambda i: int(hashlib.md5(str(i).encode()).hexdigest()[:13], 16) / 2**52
    assert all(r["kept"] == (lot(r["doc_id"]) < r["chance"]) for r in got)
    clash = corpus.withColumns({"tokens": F.lit("t"), "kept": F.lit("k"), "ratio": F.lit("r")})
    assert mix(clash).filter("kept").count() > 0
    assert mix(corpus.limit(0)).count() == 0
    empty = spark.createDataFrame([(1, None, None, None), (None, "", "s", "en")], "doc_id long, text string, source string, lang string")
    assert mix(empty).count() == 2


def test_shards_are_even_and_slots_gapless(spark, corpus):
    sizes = {i: len((t or "").encode()) + 1 for i, t in corpus.select("doc_id", "text").collect()}
    got = shard(corpus.withColumn("size", F.lit("clash")), shards=4).collect()
    assert len(got) == corpus.count()
    assert all(r["size"] == sizes[r["doc_id"]] and r["law"] == "bytes" and r["grown_shard"] is None for r in got)
    crc = {i: zlib.crc32((t or "").encode()) for i, t in corpus.select("doc_id", "text").collect()}
    assert all(r["text_crc32"] == crc[r["doc_id"]] for r in got)
    loads, slots = defaultdict(int), defaultdict(list)
    for r in got:
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(loads) <= {0, 1, 2, 3}  # one text holds half of all bytes
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(loads.values()) - min(loads.values()) <= 2 * max(sizes.values())
    assert shard(corpus.limit(0), shards=4).count() == 0


def test_equal_texts_stay_together_unless_they_unbalance(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices(VOCABULARY, k=20)) if i % 4 else f"copy {i % 5}") for i in range(4000)]
    got = shard(spark.createDataFrame(rows, "doc_id long, text string"), shards=4).collect()
    where = defaultdict(set)
    for r in got:
        where[r["text_crc32"]].add(r["shard"])
    assert sum(len(s) > 1 for s in where.values()) <= 3
    hot = shard(spark.createDataFrame([(i, "the same text") for i in range(1000)], "doc_id long, text string"), target_bytes=14 * 250).collect()
    loads = defaultdict(int)
    for r in hot:
        loads[r["shard"]] += r["size"]
    assert len(loads) == 4 and max(loads.values()) - min(loads.values()) <= 14


def test_lines_equal_brute_force(spark):
    rng = random.Random(6)
    letters = lambda k: " ".join(rng.choices(VOCABULARY, k=k))
    base = [letters(rng.randint(1, 25)) for _ in range(40)]
    near = lambda x: x[: len(x) // 2] + rng.choice("xyz") + x[len(x) // 2 + 1 :]
    rows = [(i, "\n".join(rng.choice([x, x.upper(), near(x), letters(8), ""]) for x in rng.sample(base, 5))) for i in range(50)]
    rows += [(50, None), (51, ""), (52, "\n\n"), (7, rows[7][1]), (53, "ab"), (54, "ab"), (55, "w " * 40_000)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").withColumn("bands", F.lit(1))).collect()
    places = defaultdict(list)
    for i, t in sorted(set(rows), key=lambda r: r[0]):
        for n, line in enumerate((t or "").split("\n")):
            if line_dedup.normal(line):
                places[line_dedup.normal(line)].append((i, n))
    kinds = list(places)
    sets = [{x[j : j + 5] for j in range(max(1, len(x) - 4))} for x in kinds]
    links = [(a, b) for a, b in itertools.combinations(range(len(kinds)), 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    groups = defaultdict(list)
    for k, label in union_find(range(len(kinds)), links).items():
        groups[label] += places[kinds[k]]
    keep = {min(p) for p in groups.values()}
    assert len(got) == len(rows)
    wanted = {i: t and "\n".join(x for n, x in enumerate(t.split("\n")) if not line_dedup.normal(x) or (i, n) in keep) for i, t in rows}
    assert all(r["text"] == wanted[r["doc_id"]] for r in got)
    assert all(r["n_lines"] == (0 if t is None else len(t.split("\n"))) for r in got for t in [dict(rows)[r["doc_id"]]])
    assert line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sketches_prune_long_lines_and_lose_no_link(spark):
    rng = random.Random(9)
    lines, pairs = [], []
    for size in (3, 60, 255, 257, 700, 1023, 1030, 5000):
        text = "".join(rng.choices("abcdefghij ", k=size))
        for share in (0.01, 0.02, 0.2):  # of the characters, changed at one place or everywhere
            lines += [text, text + "".join(rng.choices("klmno", k=int(size * 10 * share))), "".join(rng.choice("xyz") if rng.random() < share else c for c in text)]
            pairs += [(len(lines) - 3, len(lines) - 2), (len(lines) - 3, len(lines) - 1)]
    sizes, _, sketch = line_dedup.described(lines)
    rows = [(i, int(n), k) for i, (n, k) in enumerate(zip(sizes, sketch.to_pylist(), strict=True))]
    known = spark.createDataFrame(rows, "id long, n int, sketch array<long>")
    pruned = line_dedup._pruner(known, known.select("id"), 80)
    kept = {(r["a"], r["b"]) for r in pruned(spark.createDataFrame(pairs, "a long, b long")).collect()}
    sets = [set(line_dedup.exact_set(x).tolist()) for x in lines]
    linked = {(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert linked and linked <= kept
    short = known.select("id", "n", *line_dedup._short_sketch())
    sides = [short.select(*[F.col(c).alias(f"{side}_{c}") for c in short.columns]) for side in "ab"]
    met = spark.createDataFrame(pairs, "a long, b long").join(sides[0], F.col("a") == F.col("a_id")).join(sides[1], F.col("b") == F.col("b_id"))
    passed = met.filter(line_dedup._may_match(80)(lambda c: F.col(f"a_{c}"), lambda c: F.col(f"b_{c}")))
    assert kept <= {(r["a"], r["b"]) for r in passed.collect()}
    assert not any(100 * len(sets[a] & sets[b]) < 50 * len(sets[a] | sets[b]) for a, b in kept if min(sizes[a], sizes[b]) > 50)


def exact_neighbours(vectors, queries, k):
    want = {}
    for q in queries:
        scored = sorted((-float((np.array(v) * np.array(vectors[q])).sum()), i) for i, v in vectors.items() if i != q)
        want[q] = [i for _, i in scored[:k]]
    return want


def test_neighbours_by_recall_and_order(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 24))
    vectors = {i: (centres[i % 12] + 0.6 * rng.standard_normal(24)) * (1 + i % 3) for i in range(1500)}
    for i in range(700, 1100):
        vectors[i] = vectors[700]  # one vector held by a quarter of the rows
    frame = spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in vectors.items()], "vec_id long, embedding array<double>, leaf int")
    got = defaultdict(list)
    for r in ann.nearest(frame, F.col("vec_id") % 20 == 0, leaf_rows=128).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    want = exact_neighbours(vectors, range(0, 1500, 20), 20)
    assert set(got) == set(want)
    assert np.mean([len({i for _, i, _ in got[q]} & set(want[q])) / 20 for q in want]) >= 0.9
    for q, rows in got.items():
        assert [r for r, _, _ in rows] == list(range(1, len(rows) + 1))
        assert rows == sorted(rows, key=lambda x: (-x[2], x[1]))
        assert all(s == pytest.approx(float(np.dot(vectors[q], vectors[i])), rel=1e-12) for _, i, s in rows)


def test_unusable_vectors_take_no_part(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (1, [0.5, 0.5]), (2, [nan, 1.0]), (3, [1.0, None]), (4, [1.0]), (None, [1.0, 1.0]), (5, [float("inf"), 0.0]), (1, [0.5, 0.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert [tuple(r) for r in ann.nearest(frame, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 1, 0.5)]
    assert ann.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.nearest(frame.filter("vec_id = 20"), F.col("vec_id") % 20 == 0).count() == 0


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(11)
    item = " ".join(rng.choices(VOCABULARY, k=14))
    texts = [" ".join(rng.choices(VOCABULARY, k=rng.randint(15, 80))) for _ in range(240)]
    toxic = [i for i in range(240) if i % 6 == 1]
    for i in toxic:
        words = texts[i].split()
        for _ in range(4):
            words.insert(rng.randrange(len(words)), rng.choice(["zurkig", "zurkan"]))
        texts[i] = " ".join(words)
    texts[10] += " " + item
    texts[20] = texts[18]
    texts += [None, "", "word"]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(240)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns
        kept[name] = {r["doc_id"] for r in after.collect()}
        docs = spark.createDataFrame([r for r in rows if r[0] in kept[name]], schema)
    assert set(range(243)) - kept["toxicity"] == set(toxic)
    assert kept["toxicity"] - kept["near_duplicates"] == {20}
    assert kept["near_duplicates"] - kept["decontamination"] == {10}
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in final} == kept["mixing"] and {r["shard"] for r in final} <= set(range(8))


def test_texts_that_share_an_id_are_judged_apart(spark):
    rng = random.Random(12)
    one, two, three = (" ".join(rng.choices(VOCABULARY, k=40)) for _ in range(3))
    rows = [(1, one, "a"), (1, two, "a"), (2, one, "a"), (2, three, "a"), (3, two, "a"), (4, three, "b"), (4, three, "a"), (5, None, "a"), (5, "", "a"), (None, one, "a"), (None, one, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = corpus_pipeline.keep_one_of_each(spark, docs, "").collect()
    want = [(1, one, "a"), (1, two, "a"), (2, three, "a"), (5, None, "a"), (5, "", "a"), (None, one, "a"), (None, one, "a")]
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, want))
