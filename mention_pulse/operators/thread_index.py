"""Roots of reply threads kept from landing to landing: new posts join what is known of their parents.

A table of links has one snapshot a landing and, in all, every landed post: with its root and the
hops to it; or waiting, with the missing post its chain ends at and the hops to that; or neither, where the
root is more than `max_hops` away. A landing looks up the parents of its posts and the posts that waited for
one of them, resolves these few among themselves by pointer doubling, and writes them alone: threads
that got no post are neither resolved nor written again. A post may land before or after its parent.

Defined results: a post that landed before is left as it was, in whatever landing it comes again; of
rows with one id in one landing the smallest parent counts; rows without an id are left out; replies
in a circle have no root.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mention_pulse.operators.skew import (
    HOT_ROWS,
    MAX_DIM_ROWS,
    copy_to_slices,
    hot_keys,
    is_small,
    join_dimension,
    slice_rows,
)
from mention_pulse.sources import tables
from mention_pulse.sources.tables import kept

LINKS = T.StructType(
    [
        T.StructField("ID", T.LongType()),
        T.StructField("ROOT", T.LongType()),
        T.StructField("UP", T.LongType()),
        T.StructField("HOPS", T.IntegerType()),
        T.StructField(tables.RUN, T.StringType()),
    ]
)
_STATE = ["ID", "ROOT", "UP", "HOPS"]


def _places(base: str) -> tuple[str, str]:
    return f"{base}/links", f"{base}/link_runs"


def _links(spark: SparkSession, base: str) -> DataFrame:
    folder, runs = _places(base)
    return tables.read_snapshots(spark, folder, tables.current_chain(spark, runs), LINKS)


def _latest(links: DataFrame) -> DataFrame:
    """One row per post: what the last landing that moved it knew, as hops only ever grow."""
    order = F.struct("HOPS", F.col("ROOT").isNotNull())
    last = F.max_by(F.struct("ROOT", "UP", "HOPS"), order).alias("last")
    return links.groupBy("ID").agg(last).select("ID", "last.*")


def _commit(spark: SparkSession, base: str, run_id: str, rows: DataFrame, chain: list[str]) -> None:
    folder, runs = _places(base)
    tables.write_snapshot(rows.select(*_STATE), folder, run_id, order=["ID"])
    tables.commit_run(spark, runs, run_id, chain=[*chain, run_id])


def _refuse_committed(spark: SparkSession, base: str, run_id: str) -> None:
    if not tables.read_manifest(spark, _places(base)[1]).filter(F.col("run_id") == run_id).isEmpty():
        raise ValueError(f"run {run_id} is committed already")


def _jump(state: DataFrame, max_hops: int, hot_rows: int) -> DataFrame:
    """Every pointer moved to where its target points; posts that very many point to are sliced."""
    counts = state.filter("UP IS NOT NULL").groupBy("UP").agg(F.count(F.lit(1)).alias("_n"))
    hot = kept(hot_keys(counts, "UP", "_n", hot_rows), "hot_targets")
    upper = state.select(*(F.col(c).alias(f"_{c}") for c in _STATE))
    upper = copy_to_slices(upper, "_ID", hot).withColumnRenamed("_slice", "_copy")
    same = (F.col("UP") == F.col("_ID")) & (F.col("_slice") == F.col("_copy"))
    moved = slice_rows(state, "UP", "ID", hot).join(upper, same, "left")
    hops = F.col("HOPS") + F.coalesce(F.col("_HOPS"), F.lit(0))
    near = hops <= max_hops
    met = F.col("_ID").isNotNull()
    return moved.select(
        "ID",
        F.when(near, F.when(met, F.col("_ROOT")).otherwise(F.col("ROOT"))).alias("ROOT"),
        F.when(near, F.when(met, F.col("_UP")).otherwise(F.col("UP"))).alias("UP"),
        F.least(hops, F.lit(max_hops + 1)).alias("HOPS"),
        "own",
    )


def land_threads(
    spark: SparkSession,
    posts: DataFrame,
    base: str,
    run_id: str,
    max_hops: int = 5,
    post_id: str = "tweet_id",
    parent: str = "parent_id",
    max_rows: int = MAX_DIM_ROWS,
    hot_rows: int = HOT_ROWS,
) -> None:
    """Take newly landed posts into the index under `base`; `max_hops` has to stay the same over all landings.

    Up to `max_rows` asked ids travel to the index; with more, its narrow rows are shuffled by id.
    A landing that failed is repeated under its run id and replaces what it left; a committed one is refused.
    """
    _refuse_committed(spark, base, run_id)
    chain = tables.current_chain(spark, _places(base)[1])
    known = _links(spark, base).drop(tables.RUN)
    ids = posts.filter(F.col(post_id).isNotNull()).groupBy(F.col(post_id).cast("bigint").alias("ID"))
    landed = kept(ids.agg(F.min(F.col(parent).cast("bigint")).alias("UP")), "landed")
    asked = kept(landed.select("ID").union(landed.select("UP")).filter("ID IS NOT NULL").distinct(), "asked")
    wanted = F.broadcast(asked) if is_small(asked, max_rows) else asked
    old = kept(_latest(known.join(wanted, "ID", "left_semi")), "known")
    fresh = kept(landed.join(old.select("ID"), "ID", "left_anti"), "fresh")
    new_ids = fresh.select(F.col("ID").alias("_new"))
    waited = join_dimension(
        known.filter("UP IS NOT NULL"), new_ids, "UP", "_new", "ID", max_rows=max_rows, hot_rows=hot_rows
    )
    waited = kept(waited.select(*_STATE), "waited")
    is_root = F.col("UP").isNull()
    started = fresh.select(
        "ID", F.when(is_root, F.col("ID")).alias("ROOT"), "UP", F.when(is_root, 0).otherwise(1).alias("HOPS")
    )
    own = started.unionByName(waited).withColumn("own", F.lit(True))
    others = old.join(waited.select("ID"), "ID", "left_anti").withColumn("own", F.lit(False))
    state = kept(own.unionByName(others), "links0")
    # each round doubles the hops a pointer spans, so these rounds go beyond `max_hops`
    for n in range(1, max_hops.bit_length() + 1):
        state = kept(_jump(state, max_hops, hot_rows), f"links{n}")
    _commit(spark, base, run_id, state.filter("own"), chain)


def read_roots(spark: SparkSession, base: str, run_id: str | None = None, post_id: str = "tweet_id") -> DataFrame:
    """(post_id, root_id, hops) of every reply whose root is known; with `run_id`, of those that run resolved."""
    links = _links(spark, base).filter("ROOT IS NOT NULL AND HOPS > 0")
    if run_id is not None:
        links = links.filter(F.col(tables.RUN) == run_id)
    return links.select(F.col("ID").alias(post_id), F.col("ROOT").alias("root_id"), F.col("HOPS").alias("hops"))


def read_waiting(spark: SparkSession, base: str, post_id: str = "tweet_id") -> DataFrame:
    """(post_id, missing_id) of replies whose chain ends at a post that has not landed."""
    waiting = _latest(_links(spark, base)).filter("UP IS NOT NULL")
    return waiting.select(F.col("ID").alias(post_id), F.col("UP").alias("missing_id"))


def compact_threads(spark: SparkSession, base: str, run_id: str) -> None:
    """Make one snapshot of all landings, without the rows that later landings made void."""
    _refuse_committed(spark, base, run_id)
    _commit(spark, base, run_id, _latest(_links(spark, base)), [])
