"""All links at a threshold between sets that share keys, without comparing all pairs of a group.

The sets that share a key form a group. Its most central member (whose keys many others share) leads it, and every member is
compared with its leaders: pairs grow with the members, not with their square. What is left are pairs with one leader whose
components differ, at least one of them outside the leader's component; they are found by their differences from the leader.
No group is capped: members of one component need no more comparisons, the others get them all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .graph import components

#: Where all pairs of members that meet would be more than so many for each row, members meet one of their meeting first, as long as
#: that halves the pairs. What is left is compared in pairs, so no link is lost.
PAIRS_EACH = 4


def link(members: DataFrame, percent: int, compare: Callable[[DataFrame], DataFrame], differences: Callable[[DataFrame], DataFrame], pairs: DataFrame | None = None) -> DataFrame:
    """(node, component) of every linked node that is not the smallest of its component. members (written): node, n (size of its
    set), key, members (how many share the key); pairs: more pairs (a, b) to be compared. compare keeps the linked ones of pairs
    (a, b); differences adds diff to rows (x, lead, ...): the hashes by which their sets differ, those that x has first."""
    weights = members.groupBy("node").agg(F.sum("members").alias("weight"))
    order = F.struct("weight", (-F.col("node")).alias("minus"), "n")
    leaders = members.join(weights, "node").groupBy("key").agg(F.max(order).alias("top")).select("key", (-F.col("top.minus")).alias("lead"), F.col("top.n").alias("lead_n"))
    leaders = materialize(leaders, "leaders")  # so that the join with them can split the members of a key
    led = members.join(leaders, "key").where("node <> lead").select(F.col("node").alias("x"), "n", "lead", "lead_n").distinct()
    led = materialize(led, "led")
    alike = F.least("n", "lead_n") * 100 >= F.greatest("n", "lead_n") * percent
    first = led.where(alike).select(F.col("x").alias("a"), F.col("lead").alias("b"))
    found = components(compare(first if pairs is None else first.unionByName(pairs)))

    # second look: pairs below one leader whose components differ, at least one of them outside the leader's component
    placed = _placed(led, found)
    open_ = placed.groupBy("lead").agg(F.max("outside").alias("open"), F.count("*").alias("below")).where("open and below > 1").select("lead")
    placed = materialize(placed.join(open_, "lead"), "placed")
    if placed.isEmpty():
        return found
    rows, before = materialize(differences(placed), "differences"), None
    while True:
        meetings = _meetings(rows, percent)
        work = _work(meetings)
        if work <= PAIRS_EACH * rows.count() or before is not None and work > before // 2:
            break
        before = work
        # many would meet: each with one of its meeting first, and what that links need not meet any more
        found = components(_alike(_with_one(meetings), rows, percent).unionByName(_as_edges(found)))
        rows = materialize(_placed(rows.drop("at", "outside"), found), "differences")
    return components(_alike(_pairs(meetings, percent), rows, percent).unionByName(_as_edges(found)))


def _as_edges(found: DataFrame) -> DataFrame:
    return found.select(F.col("node").alias("a"), F.col("component").alias("b"))


def _placed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows (x, lead, ...) with the component of x, and whether it is not that of its leader."""
    at = found.select(F.col("node").alias("x"), F.col("component").alias("at"))
    lead_at = found.select(F.col("node").alias("lead"), F.col("component").alias("lead_at"))
    placed = rows.join(at, "x", "left").withColumn("at", F.coalesce("at", "x")).join(lead_at, "lead", "left")
    return placed.withColumn("outside", F.col("at") != F.coalesce("lead_at", "lead")).drop("lead_at")


def linked_below(rows: DataFrame, percent: int) -> DataFrame:
    """All links (a, b) below leaders between members of different components. rows: lead, x, n, lead_n, at, outside, diff."""
    return _alike(_pairs(_meetings(rows, percent), percent), rows, percent)


def _meetings(rows: DataFrame, percent: int) -> DataFrame:
    """The members below a leader by the hashes at which pairs of them must meet: x (its set differs from the leader's in dx
    hashes) and y link only if their differences share at least (dx + dy - most) / 2 of them, where most is what two linked sets
    may differ in, share * (nx + ny). If x is outside the leader's component, dx > share * (nx + n of the leader), so they share more
    than (dy + share * (n of the leader - ny)) / 2: the differences meet in prefixes, what was added to the leader's set first.
    What many members lack of it stands behind, mostly beyond the prefix."""
    share = (100 - percent) / (100 + percent)
    d, n = F.size("diff"), F.col("n")
    half = F.greatest(F.lit(1), F.expr(f"(size(diff) * {100 + percent} + {100 - percent} * (lead_n - n)) div {2 * (100 + percent)} + 1"))
    whole = F.greatest(F.lit(1), F.ceil(d - share * n * (1 + 100 / percent) - 1e-9))
    # an outside member meets outside ones by the first `reach` of its hashes (kind 0), inside ones by all of its prefix (kind 1)
    reach = (d - half + 1).cast("int")
    prefix = F.when(F.col("outside"), F.greatest(reach, (d - whole + 1).cast("int"))).otherwise(reach)
    each = rows.select("lead", "x", "at", "outside", "n", d.alias("d"), reach.alias("reach"), F.posexplode(F.slice("diff", F.lit(1), prefix)).alias("pos", "hash"))
    out = each.where("outside and pos < reach")
    # where outside members of several components meet: `main` is the one with most members, the smallest of equals
    counts = out.groupBy("lead", "hash", "at").agg(F.count("*").alias("k"))
    met = counts.groupBy("lead", "hash").agg(F.max_by("at", F.struct("k", -F.col("at"))).alias("main"), F.count("*").alias("ats")).where("ats > 1").drop("ats")
    both = each.groupBy("lead", "hash").agg(F.max("outside").alias("some"), F.min("outside").alias("all")).where("some and not all").select("lead", "hash", F.lit(None).cast("long").alias("main"))
    meetings = out.join(met, ["lead", "hash"]).withColumn("kind", F.lit(0)).unionByName(each.join(both, ["lead", "hash"]).withColumn("kind", F.lit(1)))
    return materialize(meetings.drop("reach"), "meetings")


def _work(meetings: DataFrame) -> int:
    """How many pairs would meet."""
    first = F.sum(F.expr("int(if(kind = 0, at <> main, outside))")).alias("first")
    second = F.sum(F.expr("int(kind = 0 or not outside)")).alias("second")
    return meetings.groupBy("lead", "hash", "kind").agg(first, second).agg(F.sum(F.expr("first * second"))).first()[0] or 0


def _with_one(meetings: DataFrame) -> DataFrame:
    """Pairs (lead, x_a, x_b) of each member with one of those that it meets, the same for all; with an inside one where there is one."""
    order = F.struct("outside", F.xxhash64("x").alias("h"), "x", "at")
    one = materialize(meetings.groupBy("lead", "hash", "kind").agg(F.min(order).alias("one")), "met")
    return meetings.join(one, ["lead", "hash", "kind"]).where("at <> one.at").select("lead", F.col("x").alias("x_a"), F.col("one.x").alias("x_b")).distinct()


def _pairs(meetings: DataFrame, percent: int) -> DataFrame:
    """Pairs (lead, x_a, x_b) of members that meet, of different components, as many as can be linked."""
    share = (100 - percent) / (100 + percent)

    def side(k: str, chosen: DataFrame) -> DataFrame:
        return chosen.select("lead", "hash", "kind", *(F.col(c).alias(f"{c}_{k}") for c in ("x", "at", "n", "d", "pos")), *(["main"] if k == "b" else []))

    # where the first hash in common stands bounds how many can follow: as many as the pair needs?
    rest = F.least(F.col("d_a") - F.col("pos_a"), F.col("d_b") - F.col("pos_b"))
    enough = rest * 2 >= F.col("d_a") + F.col("d_b") - share * (F.col("n_a") + F.col("n_b")) - 1e-9
    apart = F.expr("at_a <> at_b and (kind = 1 or at_b = main or x_a < x_b)")
    a, b = side("a", meetings.where("if(kind = 0, at <> main, outside)")), side("b", meetings.where("kind = 0 or not outside"))
    return a.join(b, ["lead", "hash", "kind"]).where(apart & enough).select("lead", "x_a", "x_b").distinct()


def _alike(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs that are linked, as edges (a, b): the differences give the exact similarity."""
    a, b = (rows.select("lead", *(F.col(c).alias(f"{c}_{k}") for c in ("x", "n", "diff"))) for k in "ab")
    differ = F.size("diff_a") + F.size("diff_b") - 2 * F.size(F.array_intersect("diff_a", "diff_b"))
    total = F.col("n_a") + F.col("n_b")
    links = pairs.join(a, ["lead", "x_a"]).join(b, ["lead", "x_b"]).where((total - differ) * 100 >= (total + differ) * percent)
    return links.select(F.col("x_a").alias("a"), F.col("x_b").alias("b"))
