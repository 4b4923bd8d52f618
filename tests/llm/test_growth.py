"""What operators keep on disk and move, and that the results stay those of brute force."""

import glob
import itertools
import os
import random
import time
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldgauge.llm import components, key_meeting, line_dedup, mixing, ngram_join, sharding, tables


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


def test_a_stored_table_leaves_no_shuffle_files(spark):
    folders = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    files = lambda: {f for d in folders for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)}
    before, setting = files(), spark.conf.get(tables.SHUFFLE_CLEANUP)
    kept = tables.stored(spark.range(20_000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert {tuple(r) for r in kept.collect()} == {(k, len(range(k, 20_000, 7))) for k in range(7)}
    deadline = time.time() + 10  # files are removed beside the query
    while files() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get(tables.SHUFFLE_CLEANUP) == setting
    with pytest.raises(Exception):
        tables.stored(spark.range(3).select(F.raise_error(F.lit("broken"))), "broken")
    assert spark.conf.get(tables.SHUFFLE_CLEANUP) == setting


def test_lines_of_small_and_crowded_keys_equal_brute_force(spark):
    rng = random.Random(12)
    letters = lambda k: "".join(rng.choices("abcdefghijklmnop ", k=k)).strip()
    changed = lambda x: x[: (i := rng.randrange(len(x)))] + "#" + x[i + 1 :]
    lines = []
    for copies in (1, 2, 3, line_dedup.LISTED, line_dedup.LISTED + 1, 60):
        base = letters(90)
        lines += [base, *[changed(base) for _ in range(copies - 1)]]
    rng.shuffle(lines)
    rows = [(i, x) for i, x in enumerate(lines)]
    sets = [{x[j : j + 5] for j in range(len(x) - 4)} for x in map(line_dedup.normal, lines)]
    links = [(a, b) for a, b in itertools.combinations(range(len(lines)), 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    first = union_find(range(len(lines)), links)
    groups = defaultdict(list)
    for i, label in first.items():
        groups[label].append(i)
    keep = {min(g) for g in groups.values()}
    got = {r["doc_id"]: r["n_kept"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: int(i in keep) for i, _ in rows} and 5 < len(keep) < len(rows) / 2


def test_pairs_of_small_keys_are_listed_and_only_crowded_keys_go_on(spark):
    size = line_dedup.LISTED + 1
    groups = {10: [1, 2], 11: [1, 2], 12: [3, 4, 5], 13: list(range(20, 20 + size)), 14: [6]}
    bands = defaultdict(list)
    for key, ids in groups.items():
        for i in ids:
            bands[i].append(key)
    rows = [(i, 30, keys, [7, 7, 7, 0]) for i, keys in bands.items()]
    described = spark.createDataFrame(rows, "id long, n int, bands array<long>, sketch array<long>")
    pairs, crowded = line_dedup._met(described, 80)
    assert {tuple(r) for r in pairs.collect()} == {(1, 2), (3, 4), (3, 5), (4, 5)}
    assert {(r["key"], r["gid"]) for r in crowded.collect()} == {(13, i) for i in groups[13]}
    wide = {(r["key"], r["gid"]) for r in crowded.collect()}
    bound, line_dedup.BROADCAST_KEYS = line_dedup.BROADCAST_KEYS, 0  # the other plan
    try:
        pairs, crowded = line_dedup._met(described, 80)
        assert {tuple(r) for r in pairs.collect()} == {(1, 2), (3, 4), (3, 5), (4, 5)} and {(r["key"], r["gid"]) for r in crowded.collect()} == wide
    finally:
        line_dedup.BROADCAST_KEYS = bound


def test_more_links_join_components_and_only_links_between_them_are_followed(spark, monkeypatch):
    own = spark.createDataFrame([(i, i) for i in range(12)], "id long, label long")
    first, second = [(5, 4), (4, 3), (9, 8), (8, 7), (11, 10)], [(3, 5), (5, 4), (7, 9), (9, 5), (1, 0)]
    followed, whole = [], components.components
    monkeypatch.setattr(components, "components", lambda edges: followed.append({frozenset(r) for r in edges.collect()}) or whole(edges))
    for bound in (components.BROADCAST_LINKS, 0):
        monkeypatch.setattr(components, "BROADCAST_LINKS", bound)
        labels = components._merged(own, spark.createDataFrame(first, "a long, b long"))
        labels = components._merged(labels, spark.createDataFrame(second, "a long, b long"))
        assert {r["id"]: r["label"] for r in labels.collect()} == union_find(range(12), first + second)
        assert followed[-1] == {frozenset((7, 3)), frozenset((1, 0))}

def test_bucket_counts_reach_the_driver_as_columns(spark, monkeypatch):
    texts = ["a b c d e", "a b c d", None, "x", ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    monkeypatch.setattr(type(df), "toPandas", lambda self: pytest.fail("rows are held as objects"))
    table = ngram_join.bucket_frequencies(df, 4, 64)
    want = np.zeros(64, dtype=np.int64)
    for t in texts:
        for h in ngram_join.shingle_set(t, 4).tolist():
            want[h % 64] += 1
    assert table.tolist() == want.tolist() and want.sum() == 4


def test_sweeps_over_cells_shuffle_nothing(spark, monkeypatch):
    plans, keep = [], mixing.stored
    monkeypatch.setattr(mixing, "stored", lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df, label))
    rows = [(s, l, t, 10 + i) for i, (s, l, t) in enumerate((s, l, t) for s in ("a", "b", None) for l in ("x", "y") for t in ("p", "q"))]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    raked = mixing.rake(cells, mixing.FLATTENING).collect()
    sweeps = [p for p in plans if "Window" in p]
    assert sweeps and not any("Exchange" in p for p in sweeps)
    for place, power in enumerate(mixing.FLATTENING.values()):
        sums, have = {}, {}
        for r in raked:
            sums[r[place]] = sums.get(r[place], 0) + r["tokens"]
            have[r[place]] = have.get(r[place], 0) + r["weight"]
        flat = {k: v**power for k, v in sums.items()}
        assert all(abs(have[k] / sum(sums.values()) - flat[k] / sum(flat.values())) < 1e-6 for k in sums)


def test_passes_of_a_level_do_not_join_the_levels_before_it(spark, monkeypatch):
    joins, select = [], sharding._select
    monkeypatch.setattr(sharding, "_select", lambda rows, *a: joins.append(rows._jdf.queryExecution().optimizedPlan().toString().count("Join ")) or select(rows, *a))
    rows = [(i, "x" * (1 + i * 37 % 101)) for i in range(64)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), shards=8).collect()
    assert len(joins) >= 6 and max(joins) <= 3
    assert len(got) == 64 and {r["shard"] for r in got} == set(range(8))


def test_lines_that_share_a_key_by_chance_go_no_further_and_no_link_is_lost(spark, monkeypatch):
    rng = random.Random(5)
    text = lambda k: "".join(rng.choices("abcdefghijklmnop ", k=k))
    changed = lambda x, k: "".join("#" if j in at else c for j, c in enumerate(x)) if (at := set(rng.sample(range(len(x)), k))) else x
    chance = [text(rng.choice([30, 95, 130, 400, 1500])) for _ in range(40)]
    families = [[x, *[changed(x, 1 + len(x) // 400) for _ in range(copies - 1)], x[: -max(1, len(x) // 20)]] for x, copies in ((text(128), 20), (text(190), 3), (text(760), 2), (text(28), 2))]
    lines = chance + [x for family in families for x in family]
    sizes, _, sketch = line_dedup.described(lines)
    # all lines share key 77; those of even place share another one; each line is there twice, some keys are nobody else's
    rows = [(i, int(n), [77, 2**63 - 1 - i, *([-5] if i % 2 == 0 else [])], k) for i, (n, k) in enumerate(zip(sizes, sketch.to_pylist(), strict=True))]
    described = spark.createDataFrame(rows * 2, "id long, n int, bands array<long>, sketch array<long>")
    sets = [set(line_dedup.exact_set(x).tolist()) for x in lines]
    links = {(a, b) for a, b in itertools.combinations(range(len(lines)), 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert len(links) > 150
    results = []
    for held, most in ((4, 28), (1, 16)):  # all at once, and in several shares
        monkeypatch.setattr(key_meeting, "HELD", held)
        monkeypatch.setattr(key_meeting, "MOST_BITS", most)
        pairs, crowded = line_dedup._met(described, 80)
        listed, groups = [tuple(r) for r in pairs.collect()], defaultdict(set)
        for r in crowded.collect():
            groups[r["key"]].add(r["gid"])
        met = set(listed) | {p for ids in groups.values() for p in itertools.combinations(sorted(ids), 2)}
        assert links <= met and len(set(listed)) == len(listed) and all(a < b for a, b in listed)
        assert {i for ids in groups.values() for i in ids} <= set(range(40, 61)) and max(map(len, groups.values())) == 21
        assert not any(a < 40 or b < 40 for a, b in listed)
        results.append((sorted(listed), sorted(map(sorted, groups.values()))))
    assert results[0] == results[1]


def test_lines_are_described_where_they_are_read_and_descriptions_do_not_stay(spark, monkeypatch):
    kept, bound = [], line_dedup.BROADCAST_LINES
    stored = line_dedup.stored
    texts = ["one line of some length here\nanother line, which is different", "One line  of some length here\nthird"]

    def watched(df, label, *more):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        kept.append((label, "text" in plan and "Join" in plan, stored(df, label, *more)))
        return kept[-1][-1]

    monkeypatch.setattr(line_dedup, "stored", watched)
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", 0)  # as on a large table
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {0: texts[0], 1: "third"} and bound
    assert {label for label, joins, _ in kept if joins} <= {"texts"}  # texts move for lines that may link, and for the result
    folders = {label: df.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:") for label, _, df in kept if label in ("described", "lines")}
    assert not os.path.exists(folders["described"]) and os.path.exists(folders["lines"])
