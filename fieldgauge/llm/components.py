"""Distributed union-find, and linking of similar items without listing all pairs of a group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from fieldgauge.llm.tables import stored

HUB_ROUNDS, HUBS, JITTER = 2, 4, 0.15
#: Links and labels (16 bytes each) that may be broadcast; more are joined by a shuffle.
BROADCAST_LINKS = 500_000


def components(edges: DataFrame) -> DataFrame:
    """(id, label) for every end of an edge (a, b): label is the least id it is connected with.

    Large-star and small-star steps alternate until nothing changes: every round each node hangs
    its neighbours on the least one it knows, so paths shorten geometrically. Each round is
    written to the shared folder, and only a count and a sum come to the driver.
    """
    pair = [F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")]
    current, mark = stored(edges.filter("a <> b").select(*pair).distinct(), "edges"), None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = stored(small.unionByName(smallest.withColumnRenamed("m", "v")).distinct(), "edges")
        seen = current.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(2**40))).alias("h")).first()
        if seen == mark:
            break
        mark = seen
    roots = current.select(F.col("v").alias("id"), F.col("v").alias("label"))
    return current.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(roots).distinct()


def link(
    postings: DataFrame,
    members: DataFrame,
    may_match: Callable[[Callable[[str], Column], Callable[[str], Column]], Column],
    pruned: Callable[[DataFrame], DataFrame],
    verified: Callable[[DataFrame], DataFrame],
    rounds: int = HUB_ROUNDS,
    links: DataFrame | None = None,
) -> DataFrame:
    """Components of all items with a verified link: (id, label), items alone labelled by themselves.

    ``postings`` has key, band, gid and whatever ``may_match`` reads; two groups are candidates
    where they share a key and pass it. ``members`` has gid and id, one row an item. ``pruned``
    drops pairs (a, b) that cannot link, at little cost, and adds a ``distance``; ``verified``
    keeps those that do link. ``links`` are pairs known to link already.

    In a few rounds each group meets ``HUBS`` hubs of every key it has (and each member the first
    of its group), and only the nearest hub is verified; what that joins needs no further
    comparison. Hubs are the groups whose keys are met most often, as those stand in the middle
    of a crowd of near copies, with some chance so that rounds differ. Then every remaining candidate pair that still lies in two components is
    verified. So no link between components is missed, and a group of thousands of near copies
    costs a few comparisons each instead of one for each pair.
    """
    own = members.select("id", F.col("id").alias("label"))
    labels = own
    postings = stored(postings.join(_popularity(postings), "gid"), "postings")
    labelled = postings.withColumns({"low": F.col("gid"), "high": F.col("gid")})
    if links is not None:
        labels = _merged(own, links)
        labelled = _still_open(postings, members, labels)
    for seed in range(rounds):
        read = [F.col(c) for c in labelled.columns if c not in ("key", "band")]
        chance = [F.pmod(F.xxhash64(F.lit(seed * HUBS + i), F.col("gid")), F.lit(1000)) / 1000 for i in range(HUBS)]
        ranked = [F.max(F.struct((F.col("popularity") * (1 - JITTER * u * int(seed + i > 0))).alias("o"), *read)) for i, u in enumerate(chance)]
        hubs = labelled.groupBy("key", "band").agg(F.array_distinct(F.transform(F.array(*ranked), lambda x: x.dropFields("o"))).alias("x"))
        hubs = hubs.select("key", "band", F.inline("x")).withColumnsRenamed({c: f"h_{c}" for c in labelled.columns if c not in ("key", "band")})
        near = labelled.join(hubs, ["key", "band"]).filter(
            (F.col("gid") != F.col("h_gid")) & ~_settled("low", "high", "h_low", "h_high") & may_match(lambda c: F.col(c), lambda c: F.col(f"h_{c}"))
        )
        met = pruned(near.groupBy(F.col("gid").alias("a"), F.col("h_gid").alias("b")).agg(F.count("*").alias("shared")))
        pairs = met.groupBy("a").agg(F.min(F.struct("distance", -F.col("shared"), "b")).alias("x")).select("a", "x.b")
        if seed == 0:
            pairs = pairs.unionByName(members.filter("gid <> id").select(F.col("gid").alias("a"), F.col("id").alias("b")))
        labels = _merged(labels, verified(stored(_distinct(pairs), "pairs")))
        labelled = _still_open(postings, members, labels)
    left = labelled
    other = left.select("key", *[F.col(c).alias(f"o_{c}") for c in left.columns if c != "key"])
    groups = left.join(other, "key").filter(
        (F.col("gid") < F.col("o_gid")) & ~_settled("low", "high", "o_low", "o_high") & may_match(lambda c: F.col(c), lambda c: F.col(f"o_{c}"))
    )
    groups = groups.select(F.col("gid").alias("g"), F.col("o_gid").alias("o")).distinct()
    within = _group_labels(members, labels).filter("low < high").select(F.col("gid").alias("g"), F.col("gid").alias("o"))
    known = members.join(labels, "id")
    first = known.select(F.col("gid").alias("g"), F.col("id").alias("a"), F.col("label").alias("la"))
    second = known.select(F.col("gid").alias("o"), F.col("id").alias("b"), F.col("label").alias("lb"))
    pairs = groups.unionByName(within).join(first, "g").join(second, "o").filter("la <> lb")
    pairs = pruned(_distinct(pairs.select("a", "b"))).select("a", "b")
    return _merged(labels, verified(stored(pairs, "pairs")))


def _popularity(postings: DataFrame) -> DataFrame:
    """(gid, popularity): how many other groups its keys meet, each key's count once."""
    met = postings.groupBy("key").agg(F.count("*").alias("c"))
    return postings.select("key", "gid").join(met, "key").groupBy("gid").agg(F.sum("c").alias("popularity"))


def _settled(low: str, high: str, other_low: str, other_high: str) -> Column:
    """All members of both groups are in one component."""
    return (F.col(low) == F.col(high)) & (F.col(other_low) == F.col(other_high)) & (F.col(low) == F.col(other_low))


def _group_labels(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(gid, low, high): least and greatest label of each group."""
    return members.join(labels, "id").groupBy("gid").agg(F.min("label").alias("low"), F.max("label").alias("high"))


def _still_open(postings: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
    """Postings of keys whose groups are not yet all in one component, with the group labels."""
    labelled = stored(postings.join(_group_labels(members, labels), "gid"), "labelled")
    keys = labelled.groupBy("key").agg(F.min("low").alias("l"), F.max("high").alias("h")).filter("l < h").select("key")
    return stored(labelled.join(keys, "key", "left_semi"), "open")


def _distinct(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()


def _few(df: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast if it is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_LINKS else df


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The label of every item with more links (a, b). Only links between components are followed,
    from label to label: a label is the least id of its component, so the least of several is too."""
    found = stored(links, "links")
    for end in ("a", "b"):
        found = _few(found).join(labels.select(F.col("id").alias(end), F.col("label").alias(f"l{end}")), end)
        found = stored(found, "links") if end == "a" else found
    between = stored(found.filter("la <> lb").select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct(), "between")
    if between.isEmpty():
        return labels
    lower = stored(components(between).select(F.col("id").alias("label"), F.col("label").alias("lower")), "lower")
    return stored(labels.join(_few(lower), "label", "left").select("id", F.coalesce("lower", "label").alias("label")), "labels")
