"""Shards that keep linked documents together: balanced label propagation under quotas.

Documents are linked if they share a hub (an equal text, a site, both ends of a link). Each round a
document sees how many members of its hub every shard holds and asks for the fullest shard that has
room; as many are let in as the shard's quota allows. Hubs start whole, in the shard of their hash; of
a shard over its quota, hubs that fit elsewhere ask as a whole for a shard with room, so only hubs
larger than the room are split. Hubs are counted before anything is joined, so a hub of a third of all
documents is one row of counts. Documents without links then fill the shards
up to sizes at most one apart. Everything here is Spark expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadweir.llm.common import staged, tidy_shuffles

#: Buckets in which rows are numbered side by side: their counts are the only rows that meet.
BUCKETS = 1024
#: Parts of a whole in which quotas are let out.
FINE = 1_000_000


def numbered(rows: DataFrame, group: Column, bucket: Column, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``, a number from 0 without gaps within each group, in parallel buckets.

    There may be few groups and at most :data:`BUCKETS` buckets in each; that product bounds the
    offsets, which are broadcast.
    """
    rows = rows.withColumn("_g", group).withColumn("_b", bucket)
    counts = rows.groupBy("_g", "_b").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    offsets = F.broadcast(counts.select("_g", "_b", F.coalesce(before, F.lit(0)).alias("_o")))
    place = F.row_number().over(Window.partitionBy("_g", "_b").orderBy(*order)) - 1
    return rows.withColumn("_p", place).join(offsets, ["_g", "_b"]).withColumn(name, F.col("_o") + F.col("_p")).drop("_g", "_b", "_o", "_p")


def _listed(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _loads(labels: DataFrame, shards: int) -> list[int]:
    """How many documents each shard holds: one row of ``shards`` numbers."""
    row = labels.agg(*[F.count(F.when(F.col("shard") == k, 1)) for k in range(shards)]).first()
    return list(row)


def propagate(members: DataFrame, shards: int, quota: int, rounds: int) -> DataFrame:
    """``row``, ``shard`` of every document of ``members`` (``row``, ``hub``), after ``rounds`` of propagation.

    A document with several hubs asks for the shard that they ask for most.
    """
    start = F.pmod(F.xxhash64("hub"), F.lit(shards)).cast("int")
    labels = staged(members.groupBy("row").agg(F.min(start).alias("shard")), "labels")
    for turn in range(rounds):
        loads = _loads(labels, shards)
        room = [max(0, quota - n) for n in loads]
        # the share of a shard's hubs that is to leave it
        out = _listed([FINE * max(0, n - quota) // max(1, n) for n in loads])
        seen = members.join(labels, "row")
        counts = seen.groupBy("hub").agg(
            F.count("*").alias("size"),
            F.array(*[F.count(F.when(F.col("shard") == k, 1)) for k in range(shards)]).alias("held"),
        )
        open_ = _listed(room)
        # shards that hold nothing of a hub are seen by each hub in another order
        turned = F.xxhash64("hub", F.lit(turn))
        best = F.array_max(
            F.transform(
                "held",
                lambda n, k: F.when(
                    F.get(open_, k) > 0,
                    F.struct(n.alias("n"), F.when(n == 0, F.pmod(turned + k, F.lit(shards))).otherwise(0).alias("t"), (-k).alias("k")),
                ),
            )
        )
        counts = counts.select("hub", "size", "held", best.alias("best")).where(F.col("best").isNotNull())
        wish = seen.join(counts, "hub").select(
            "row",
            "shard",
            F.when(F.col("size") <= F.get(open_, -F.col("best.k")), F.xxhash64("hub")).otherwise(F.xxhash64("row")).alias("mark"),
            (
                (F.pmod(F.xxhash64("hub", F.lit(turn), F.lit("out")), F.lit(FINE)) < F.get(out, F.col("shard")))
                & (F.col("size") <= F.get(open_, -F.col("best.k")))
            ).alias("leaves"),
            (-F.col("best.k")).cast("int").alias("to"),
            F.col("best.n").alias("there"),
            F.get("held", F.col("shard")).alias("here"),
        )
        gain = F.struct((F.col("there") - F.col("here")).alias("gain"), (-F.col("to")).alias("k"), "mark")
        wish = wish.where(F.col("leaves") | (F.col("there") > F.col("here")) | ((F.col("there") == F.col("here")) & (F.col("to") < F.col("shard"))))
        wish = staged(wish.groupBy("row").agg(F.max(gain).alias("w")), "wishes")
        asked = _loads(wish.select((-F.col("w.k")).alias("shard")), shards)
        if not sum(asked):
            break
        share = _listed([FINE if n <= r else FINE * r // n for n, r in zip(asked, room)])
        to = (-F.col("w.k")).cast("int")
        let_in = wish.where(F.pmod(F.col("w.mark"), F.lit(FINE)) < F.get(share, to)).select("row", to.alias("to"))
        labels = labels.join(let_in, "row", "left").select("row", F.coalesce("to", "shard").alias("shard"))
        labels = staged(labels, "labels")
    return labels


def balance(rows: DataFrame, members: DataFrame, shards: int, rounds: int = 6) -> DataFrame:
    """``row``, ``shard`` int and ``slot`` long (gapless from 0) of all ``rows`` (column ``row``, unique).

    Counts are at most one apart. ``members`` (``row``, ``hub``) are the linked documents; a hub with
    one member is no link. What a shard holds beyond its size after the last round, and all documents
    without links, fill the free slots of all shards. Empty tables give empty results.
    """
    spark = rows.sparkSession
    with tidy_shuffles(spark):
        total = rows.count()
        quota = -(-total // shards)
        linked = members.join(members.groupBy("hub").agg(F.count("*").alias("size")).where("size > 1"), "hub")
        linked = staged(linked.select("row", "hub", (F.col("size") * 20 > quota).alias("big")), "linked")
        labels = propagate(linked.select("row", "hub"), shards, quota, rounds)
        hubs = linked.groupBy("row").agg(F.min(F.struct("hub", "big")).alias("h")).select("row", "h.hub", "h.big")

        def in_order(n: int) -> Column:
            # small hubs lie in one bucket each and before the big ones, which are the ones to be split
            big = n // 2 + F.pmod(F.xxhash64("hub"), F.lit(n // 32)) * 16 + F.pmod(F.xxhash64("row"), F.lit(16))
            return F.when(F.col("big"), big).otherwise(F.pmod(F.xxhash64("hub"), F.lit(n // 2)))

        near = in_order(BUCKETS)
        placed = numbered(labels.join(hubs, "row"), F.col("shard"), near, ["hub", "row"], "slot")
        placed = staged(placed.select("row", "shard", "slot"), "placed")
        loads = _loads(placed, shards)
        sizes = [total // shards + (k < total % shards) for k in range(shards)]
        stay = placed.where(F.col("slot") < F.get(_listed(sizes), F.col("shard")))
        half = BUCKETS // 2
        spread = F.when(F.col("hub").isNotNull(), in_order(half)).otherwise(half + F.pmod(F.xxhash64("row"), F.lit(half)))
        # linked ones come first and hub by hub, so that what is left of a hub stays together
        rest = rows.select("row").join(stay, "row", "left_anti").join(hubs, "row", "left")
        rest = numbered(rest, F.lit(0), spread, ["hub", "row"], "n")
        filled = [min(a, b) for a, b in zip(loads, sizes)]
        free = [b - a for a, b in zip(filled, sizes)]
        ends = [sum(free[: k + 1]) for k in range(shards)]
        shard = reduce(lambda x, k: F.when(F.col("n") < ends[k], k).otherwise(x), reversed(range(shards)), F.lit(None))
        rest = rest.withColumn("shard", shard.cast("int"))
        first = _listed([f - (e - w) for f, e, w in zip(filled, ends, free)])
        rest = rest.select("row", "shard", (F.col("n") + F.get(first, F.col("shard"))).alias("slot"))
        return staged(stay.unionByName(rest), "balanced")


def cut(shards: DataFrame, members: DataFrame) -> DataFrame:
    """For each hub of several members: ``members`` and ``parts``, the number of shards it lies in."""
    held = members.join(shards.select("row", "shard"), "row").groupBy("hub", "shard").agg(F.count("*").alias("n"))
    return held.groupBy("hub").agg(F.sum("n").alias("members"), F.count("*").alias("parts")).where("members > 1")


def shard_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 24) -> DataFrame:
    """Documents in ``shards`` shards of equal counts, those of equal texts together where they fit.

    Columns: ``key``, ``size`` (UTF-8 bytes plus 8; null: none), ``text_crc32``, ``law`` ('rows'),
    ``shard``, ``slot``, ``grown_shard`` (null: this law does not hold shards in place). Repeated rows
    and null keys are documents like any other. Other columns play no part.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = staged(
        docs.select(
            F.col(f"`{key}`"),
            F.monotonically_increasing_id().alias("row"),
            (F.octet_length(body) + 8).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.md5(body).alias("hub"),
        ),
        "rows",
    )
    placed = balance(rows, rows.select("row", "hub"), shards)
    return rows.join(placed, "row").select(
        key, "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
