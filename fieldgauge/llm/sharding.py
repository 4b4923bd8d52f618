"""Sharding by a k-d tree over document metadata, balanced by bytes.

Nodes are split at weighted medians along their widest dimension until the leaves hold the
target bytes. A median is found by summing bytes in value bins, all nodes of a level at once,
and refining the bin that holds it: tasks send at most ``BINS`` sums a node, no node is ever
gathered. Rows with equal values are ordered by text checksum and then by id, so equal texts
stay together unless one text alone would unbalance its leaf; then its copies are divided.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from fieldgauge.llm.tables import stored
from fieldgauge.session import shuffle_partitions

DIMENSIONS = ("chars", "wide_bytes", "text_crc32")
BINS = 4096
#: A boundary may miss its place by this share of a leaf to keep equal texts together.
TOGETHER = 0.01


def metadata(documents: DataFrame) -> DataFrame:
    """Id, bytes and the dimensions of the tree; a NULL text counts as an empty one."""
    text = F.coalesce("text", F.lit(""))
    return documents.select(
        F.col("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.char_length(text).cast("long").alias("chars"),
        (F.octet_length(text) - F.char_length(text)).cast("long").alias("wide_bytes"),
    )


def _order_id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**62)))


def _descend(nodes: DataFrame, splits: dict[int, dict]) -> DataFrame:
    """Move rows of split nodes to their children 2n+1 and 2n+2."""
    spark = nodes.sparkSession
    schema = StructType([StructField(n, LongType()) for n in ("node", "__dim", "__v", "__c", "__i")])
    # as many rows as nodes of one level, fewer than leaves
    table = spark.createDataFrame([(n, s["dim"], *s["cut"]) for n, s in splits.items()], schema)
    value = F.element_at(F.array(*DIMENSIONS), F.col("__dim").cast("int") + 1)
    here = F.struct(value.alias("v"), F.col("text_crc32").alias("c"), _order_id().alias("i"))
    cut = F.struct(F.col("__v").alias("v"), F.col("__c").alias("c"), F.col("__i").alias("i"))
    child = F.when(F.col("__dim").isNull(), F.col("node")).when(here <= cut, 2 * F.col("node") + 1).otherwise(2 * F.col("node") + 2)
    return nodes.join(F.broadcast(table), "node", "left").withColumn("node", child).drop("__dim", "__v", "__c", "__i")


def _select(rows: DataFrame, key: Column, state: dict[int, dict], low: str, high: str) -> None:
    """Find for each node the key at which its bytes pass ``want``; sets ``cut_key`` and ``before``.

    ``state[node]`` holds the key range in ``low`` and ``high``, ``want`` and ``before``, and the
    rows are those of the node that tie on the keys found so far.
    """
    spark = rows.sparkSession
    open_nodes = {n for n in state}
    schema = StructType([StructField(n, LongType()) for n in ("node", "__lo", "__hi", "__w")])
    while open_nodes:
        ranges = [(n, state[n][low], state[n][high], max(1, -(-(state[n][high] - state[n][low] + 1) // BINS))) for n in open_nodes]
        table = F.broadcast(spark.createDataFrame(ranges, schema))
        # sums of at most BINS bins for each node of the level
        sums = (
            rows.join(table, "node")
            .withColumn("__k", key)
            .filter(F.col("__k").between(F.col("__lo"), F.col("__hi")))
            .groupBy("node", F.expr("(__k - __lo) div __w").alias("bin"))
            .agg(F.sum("size").alias("bytes"))
            .collect()
        )
        by_node: dict[int, list] = {n: [] for n in open_nodes}
        for r in sums:
            by_node[r["node"]].append((r["bin"], r["bytes"]))
        for n, lo, hi, width in ranges:
            s, before = state[n], state[n]["before"]
            for b, bytes_ in sorted(by_node[n]):
                last = b, bytes_
                if before + bytes_ >= s["want"]:
                    break
                before += bytes_
            else:
                before -= last[1]
            s[low], s[high], s["before"], s["here"] = lo + last[0] * width, min(hi, lo + (last[0] + 1) * width - 1), before, last[1]
            if width == 1:
                open_nodes.discard(n)


def shard_tree(meta: DataFrame, target_bytes: int | None = None, shards: int | None = None) -> DataFrame:
    """Add ``shard``: leaves of the k-d tree, numbered from 0 in tree order.

    ``meta`` has the columns of :func:`metadata` and should be a stored table, as it is read a
    few times per level.
    """
    total = meta.agg(F.sum("size").alias("t")).first()["t"] or 0
    leaves = {0: shards or max(1, math.ceil(total / target_bytes))}
    widths = meta.agg(*[F.min(d).alias(f"min_{d}") for d in DIMENSIONS], *[F.max(d).alias(f"max_{d}") for d in DIMENSIONS]).first()
    whole = [max(1, (widths[f"max_{d}"] or 0) - (widths[f"min_{d}"] or 0)) for d in DIMENSIONS]
    nodes = meta.withColumn("node", F.lit(0).cast("long"))
    while total and any(n > 1 for n in leaves.values()):
        level = {n for n, k in leaves.items() if k > 1}
        extent = (
            nodes.filter(F.col("node").isin(sorted(level)))
            .groupBy("node")
            .agg(
                F.sum("size").alias("bytes"),
                *[f(c).alias(f"{name}_{i}") for i, c in enumerate(DIMENSIONS) for name, f in (("min", F.min), ("max", F.max))],
                F.min("text_crc32").alias("c_min"), F.max("text_crc32").alias("c_max"),
                F.min(_order_id()).alias("i_min"), F.max(_order_id()).alias("i_max"),
            )
            .collect()
        )  # fmt: skip  one row a node
        state = {}
        for r in extent:
            n, k = r["node"], leaves[r["node"]]
            spread = [(r[f"max_{i}"] - r[f"min_{i}"]) / whole[i] for i in range(len(DIMENSIONS))]
            dim = max(range(len(DIMENSIONS)), key=lambda i: (spread[i], -i))
            state[n] = {
                "dim": dim, "want": r["bytes"] * (k // 2) / k, "before": 0, "leaf": r["bytes"] / k, "v_lo": r[f"min_{dim}"], "v_hi": r[f"max_{dim}"],
                "c_lo": r["c_min"], "c_hi": r["c_max"], "i_lo": r["i_min"], "i_hi": r["i_max"],
            }
        splits = _boundaries(nodes, state)
        nodes = stored(_descend(nodes, splits), "nodes")  # else each pass of the next level plans and joins all levels before it
        grown = {n: k for n, k in leaves.items() if n not in splits}
        for n in level - set(splits):  # a node without rows is one leaf
            grown[n] = 1
        for n in splits:
            grown[2 * n + 1], grown[2 * n + 2] = leaves[n] // 2, leaves[n] - leaves[n] // 2
        leaves = grown
    order = {n: i for i, n in enumerate(_in_order(0, set(leaves)))}
    table = meta.sparkSession.createDataFrame(list(order.items()), "node long, shard int")
    return nodes.join(F.broadcast(table), "node").drop("node")


def _boundaries(nodes: DataFrame, state: dict[int, dict]) -> dict[int, dict]:
    """Cut of each node as (value, checksum, id): rows up to it go left."""
    spark = nodes.sparkSession
    dims = F.broadcast(spark.createDataFrame([(n, s["dim"]) for n, s in state.items()], "node long, __d int"))
    valued = nodes.join(dims, "node").withColumn("__value", F.element_at(F.array(*DIMENSIONS), F.col("__d") + 1))
    _select(valued, F.col("__value"), state, "v_lo", "v_hi")
    cuts = F.broadcast(spark.createDataFrame([(n, s["v_lo"]) for n, s in state.items()], "node long, __v long"))
    tied = valued.join(cuts, "node").filter(F.col("__value") == F.col("__v"))
    _select(tied, F.col("text_crc32"), state, "c_lo", "c_hi")
    heavy = {}
    for n, s in state.items():
        left, right = s["want"] - s["before"], s["before"] + s["here"] - s["want"]
        if min(left, right) <= TOGETHER * s["leaf"]:
            s["cut"] = (s["v_lo"], s["c_lo"] - 1, 2**62) if left < right else (s["v_lo"], s["c_lo"], 2**62)
        else:
            heavy[n] = s
    if heavy:
        texts = F.broadcast(spark.createDataFrame([(n, s["c_lo"]) for n, s in heavy.items()], "node long, __c long"))
        copies = tied.join(texts, "node").filter(F.col("text_crc32") == F.col("__c"))
        _select(copies, _order_id(), heavy, "i_lo", "i_hi")
        for s in heavy.values():
            s["cut"] = (s["v_lo"], s["c_lo"], s["i_lo"])
    return {n: {"dim": s["dim"], "cut": s["cut"]} for n, s in state.items()}


def _in_order(node: int, leaves: set[int]) -> list[int]:
    if node in leaves:
        return [node]
    return _in_order(2 * node + 1, leaves) + _in_order(2 * node + 2, leaves)


def with_slots(sharded: DataFrame) -> DataFrame:
    """Add ``slot``: places 0, 1, ... within each shard, ordered by id.

    Rows are range-partitioned by (shard, id), numbered inside their partition as they are
    written, and the counts of earlier partitions are added, so a shard is never one task.
    """
    parts = max(1, shuffle_partitions(sharded.sparkSession))
    keys = ["shard", "doc_id", "text_crc32"]
    place = F.monotonically_increasing_id()
    written = stored(
        sharded.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumns(
            {"__part": F.shiftright(place, 33), "__row": place.bitwiseAND(F.lit(2**33 - 1))}
        ),
        "slots",
    )
    runs = written.groupBy("shard", "__part").agg(F.count("*").alias("__n"), F.min("__row").alias("__first"))
    # one row for each partition and each shard in it
    earlier = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("__offset", F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).drop("__n", "__first")
    return (
        written.join(runs, ["shard", "__part"])
        .withColumn("slot", (F.col("__row") + F.col("__offset")).cast("long"))
        .drop("__part", "__row", "__offset")
    )


def shard(documents: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Give either the number of shards (leaves get an equal part of the bytes) or the bytes of a
    leaf. Law ``bytes``: sizes are near equal. NULL texts count one byte and share the checksum
    of the empty text; a NULL id is ordered first; repeated rows get a slot each; an empty table
    gives no rows; other columns are ignored.
    """
    meta = stored(metadata(documents), "metadata")
    placed = with_slots(shard_tree(meta, target_bytes, shards))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
