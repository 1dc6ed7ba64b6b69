"""Grouping by verified links, from buckets of likely partners, without all pairs of a bucket. DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._spark import cut, store

#: From two members' marks (functions from a mark's name to its column), whether they may be similar.
Fit = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]

#: Buckets up to this size are paired at once: each member has fewer partners than this.
SMALL = 8


def components(edges: DataFrame) -> DataFrame:
    """(id, label): the connected components of the links (a, b), by alternating large and small stars.

    The label is a component's least id. Every round moves each link towards the least id in sight, and rounds are
    logarithmic in number; a node's neighbours are never brought together, only their minimum is.
    """
    links = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        links = cut(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        # done once every node has one link, to a node that has none to a lesser one
        ends = links.select(F.col("u").alias("x"), F.lit(1).alias("low"), F.lit(0).alias("high")).unionByName(links.select(F.col("v").alias("x"), F.lit(0).alias("low"), F.lit(1).alias("high")))
        if not ends.groupBy("x").agg(F.sum("low").alias("low"), F.max("high").alias("high")).agg(F.max((F.col("low") + F.col("high") > 1) & (F.col("low") > 0))).first()[0]:
            break
    return links.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(links.select(F.col("v").alias("id"), F.col("v").alias("label"))).distinct()


def crowded(buckets: DataFrame, marks: list[str]) -> DataFrame:
    """Buckets (bucket, id, *marks) that have two or more members, with n (their size) and a leader for each."""
    dealt = buckets.repartition("bucket")
    counts = dealt.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    return led_by(store(dealt.join(counts, "bucket")), marks)


def led_by(members: DataFrame, marks: list[str]) -> DataFrame:
    """The members (bucket, id, *marks, n) of buckets, with a leader for each bucket; ``members`` is a stored table."""
    # of a large bucket, the member that shares most buckets with others leads: the text that copies were made from
    many = members.filter(F.col("n") > SMALL)
    known = many.groupBy("id").agg(F.sum("n").alias("known"))
    leaders = many.join(known, "id").groupBy("bucket").agg(F.max(F.struct("known", F.xxhash64("id").alias("h"), "id", *marks)).alias("leader"))
    leaders = leaders.select("bucket", F.col("leader.id").alias("lead_id"), *[F.col(f"leader.{m}").alias(f"lead_{m}") for m in marks])
    return store(members.join(leaders, "bucket", "left"))


def links(members: DataFrame, marks: list[str], fit: Fit, verify: Callable[[DataFrame], DataFrame], finish: Callable[[DataFrame, DataFrame], DataFrame], more: DataFrame | None = None) -> DataFrame:
    """Verified links (a, b) that connect whatever the verified pairs of all buckets (of :func:`crowded`) connect.

    ``fit`` says from two members' marks whether they may be similar; ``verify`` gets distinct pairs (a, b) and returns
    those that are.

    Members of small buckets are all paired. In a large one, every member is paired with its leader. What that leaves open
    are the members outside the bucket's largest component (outliers): ``finish`` gets the members of large buckets and
    the links so far, and gives all links, once outliers have been compared with the others. A pair that isn't tried then
    is between two members of the largest component.
    """
    few = members.filter(F.col("n") <= SMALL).select("bucket", "id", *marks)
    pairs = few.join(renamed(few, marks), "bucket").filter((F.col("id") < F.col("lead_id")) & fit(F.col, led)).select(*ordered("id", "lead_id"))
    many = members.filter(F.col("n") > SMALL)
    stars = many.filter((F.col("id") != F.col("lead_id")) & fit(F.col, led)).select(*ordered("id", "lead_id"))
    pairs = pairs.unionByName(stars)
    found = cut(verify((pairs if more is None else pairs.unionByName(more)).distinct()))
    return finish(many, found) if many.take(1) else found


def led(column: str) -> Column:
    return F.col(f"lead_{column}")


def renamed(rows: DataFrame, marks: list[str]) -> DataFrame:
    return rows.select("bucket", *[F.col(c).alias(f"lead_{c}") for c in ["id", *marks]])


def ordered(x: str, y: str) -> tuple[Column, Column]:
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


#: Members of a bucket that an outlier meets in one task.
BLOCK_MEMBERS = 2048


def finish_inside(many: DataFrame, found: DataFrame, marks: list[str], fit: Fit, far: Fit, first: Fit, verify: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Compares outliers with all other components' members of their bucket inside one join: for a ``fit`` that lets little pass.

    A large bucket is cut into blocks of members, and each of its outliers goes to all of them: no task gets a whole bucket.
    In a first round an outlier is verified against the closest member of each component only (by ``far``): most outliers
    belong to a component of near copies, and are connected by that. The second round verifies every pair that is left.
    Near copies share most of their buckets: a pair is made in that one alone of which ``first`` holds. What comes back
    are links that connect the same, not the links found.
    """
    for closest in (True, False):
        label = components(found)
        # stars stand for what the links so far connect: later rounds start from them
        found = label.filter("id != label").select(F.col("label").alias("a"), F.col("id").alias("b"))
        state = cut(many.select("bucket", "id", *marks).join(label, "id", "left").withColumn("label", F.coalesce("label", "id")))
        parts = state.groupBy("bucket", "label").agg(F.count("*").alias("n"))
        main = parts.groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("main"), F.count("*").alias("parts"), F.sum("n").alias("members")).filter("parts > 1")
        main = main.select("bucket", F.col("main.label").alias("main"), F.ceil(F.col("members") / BLOCK_MEMBERS).cast("int").alias("blocks"))
        open_ = state.join(main, "bucket").withColumn("block", F.pmod(F.xxhash64("id", F.lit(2)), F.col("blocks")).cast("int"))
        every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
        outliers = open_.filter("label != main").select("bucket", every, *[F.col(c).alias(f"lead_{c}") for c in ["id", *marks, "label"]])
        if not outliers.take(1):
            return found
        near = outliers.join(open_.drop("main", "blocks"), ["bucket", "block"]).filter((F.col("label") != F.col("lead_label")) & fit(F.col, led) & first(F.col, led))
        if closest:
            near = near.groupBy("lead_id", "label").agg(F.min_by("id", far(F.col, led)).alias("id"))
        found = cut(found.unionByName(verify(near.select(*ordered("id", "lead_id")).distinct())).distinct())
    return found
