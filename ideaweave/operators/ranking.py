"""Exact ranks inside groups without putting a group in one task."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage


def rank_within(df: DataFrame, group_col: str, order_cols: list, partitions: int | None = None) -> DataFrame:
    """Adds ``rank`` (1-based) inside each group by ``order_cols`` (which must make rows unique).

    Range-partitions by (group, order), fixes the partitions with a checkpoint, counts rows
    per (partition, group) -- at most partitions + groups values reach the driver -- then
    numbers rows inside each partition with an offset per (partition, group). A group holding
    a third of all rows is spread over many tasks like any other range.
    """
    spark = df.sparkSession
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [group_col] + list(order_cols)
    ranged = cut_lineage(df.repartitionByRange(p, *keys).sortWithinPartitions(*keys)
                         .withColumn("_pid", F.spark_partition_id()))
    counts = sorted((r[0], r[1], r[2]) for r in ranged.groupBy("_pid", group_col).count().collect())
    offsets, seen = {}, {}
    for pid, g, n in counts:
        offsets[(pid, g)] = seen.get(g, 0)
        seen[g] = seen.get(g, 0) + n
    schema = T.StructType(ranged.schema.fields + [T.StructField("rank", T.LongType())])

    def fn(it):
        done: dict = {}  # rows of (pid, group) already numbered in earlier batches of this task
        for pdf in it:
            if pdf.empty:
                continue
            pdf = pdf.sort_values(keys, kind="stable")
            pid = int(pdf["_pid"].iloc[0])
            g = pdf[group_col]
            base = g.map(lambda x: offsets.get((pid, x), 0) + done.get((pid, x), 0))
            rank = base + g.groupby(g, sort=False).cumcount() + 1
            for x, n in g.value_counts(sort=False).items():
                done[(pid, x)] = done.get((pid, x), 0) + int(n)
            yield pdf.assign(rank=rank.astype("int64").to_numpy())

    return ranged.mapInPandas(fn, schema).drop("_pid")


def dense_index(df: DataFrame, col: str, name: str = "idx") -> DataFrame:
    """``(col, name)`` with name = 0-based position of ``col`` in sorted order, computed distributed."""
    one = df.select(col).withColumn("_g", F.lit(0))
    return rank_within(one, "_g", [col]).select(col, (F.col("rank") - 1).cast("int").alias(name))


def at_positions(df: DataFrame, group_col: str, want: list, schema: str, id_col: str = "idea_id",
                 fanout: int = 1 << 16, leaf: int = 4096) -> DataFrame:
    """The ids at given positions (1-based, id order) of groups: ``want`` rows with a ``rank`` -> the
    rows without group and rank, with the id.

    No group is sorted: ids are counted in equal ranges (at most ``fanout`` counts reach the driver,
    or one per group), and ranges that hold a wanted position are counted again in finer ones until
    they have at most ``leaf`` rows; only rows of those are numbered. ``want`` is a list of the
    caller, so its size bounds the ranges that are followed.
    """
    from pyspark.sql import Window

    spark = df.sparkSession
    names = [c.split()[0] for c in schema.split(", ")]
    g, r = names.index(group_col), names.index("rank")
    rows = df.select(F.col(group_col).alias("_g"), F.col(id_col).alias("_id"))
    open_ = {}  # range key -> (group, lowest id, highest id, rows, positions before)
    for x in rows.groupBy("_g").agg(F.min("_id"), F.max("_id"), F.count(F.lit(1))).collect():
        open_[(x[0], 0)] = (x[0], x[1], x[2], x[3], 0)
    spots: dict = {}
    for x in want:
        spots.setdefault((x[g], 0), set()).add(x[r])
    rows = rows.withColumn("_b", F.lit(0).cast("long"))
    level = 0
    while True:
        hit = {k: v for k, v in open_.items() if k in spots}
        if all(v[3] <= leaf or v[1] == v[2] for v in hit.values()):
            break
        per = max(2, fanout // max(len(hit), 1))
        cut = {k: max(1, -(-(v[2] - v[1] + 1) // per)) for k, v in hit.items()}
        table = spark.createDataFrame([(k[0], k[1], i * per, v[1], cut[k]) for i, (k, v) in enumerate(hit.items())],
                                      "_g int, _b long, _base long, _lo long, _w long")
        rows = (rows.join(F.broadcast(table), ["_g", "_b"])
                .select("_g", "_id", (F.col("_base") + F.floor((F.col("_id") - F.col("_lo")) / F.col("_w"))).alias("_b")))
        counts = sorted((x[0], x[1], x[2], x[3], x[4]) for x in
                        rows.groupBy("_g", "_b").agg(F.min("_id"), F.max("_id"), F.count(F.lit(1))).collect())
        nxt, moved = {}, {}
        base = {i * per: k for i, k in enumerate(hit)}
        run: dict = {}
        for grp, b, lo, hi, n in counts:
            parent = base[b // per * per]
            before = run.get(parent, hit[parent][4])
            run[parent] = before + n
            nxt[(grp, b)] = (grp, lo, hi, n, before)
            found = {p for p in spots[parent] if before < p <= before + n}
            if found:
                moved[(grp, b)] = found
        open_, spots, level = nxt, moved, level + 1
    ends = [(k[0], k[1], open_[k][4], p) for k, ps in spots.items() if k in open_ for p in ps]
    if not ends:
        return spark.createDataFrame([], ", ".join([c for i, c in enumerate(schema.split(", ")) if i not in (g, r)] + [f"{id_col} long"]))
    ranges = F.broadcast(spark.createDataFrame(sorted({e[:3] for e in ends}), "_g int, _b long, _before long"))
    inside = Window.partitionBy("_g", "_b").orderBy("_id")
    numbered = rows.join(ranges, ["_g", "_b"]).withColumn("rank", F.row_number().over(inside) + F.col("_before"))
    asked = F.broadcast(spark.createDataFrame(want, schema).withColumnRenamed(group_col, "_g"))
    return numbered.join(asked, ["_g", "rank"]).select(*[c for i, c in enumerate(names) if i not in (g, r)], F.col("_id").alias(id_col))
