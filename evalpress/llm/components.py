"""Connected components, and classes of nodes that meet in buckets."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalpress.llm.common import small, staged

#: longs of parity bits per set
PARITY_WORDS = 16


def star_edges(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """Edges (u, v) with v < u and the components of ``edges``.  Large and small
    stars alternate until nothing changes, or for ``rounds`` rounds; only
    minima are taken per node, so a hub never gathers its neighbours."""
    now = edges.select("u", "v").where("u <> v")
    mark = None
    for _ in range(rounds or 60):
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        root = down.groupBy("u").agg(F.min("v").alias("m"))
        near = (down.join(root, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(root.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        now = staged(near)
        if rounds:
            continue
        got = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if got == mark:
            break
        mark = got
    return now


def least_linked(stars: DataFrame) -> DataFrame:
    """(node, label) of every node of the star edges: the least node it points to, itself for a centre."""
    return stars.union(stars.select("v", "v")).groupBy("u").agg(F.min("v").alias("label")).withColumnRenamed("u", "node")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (u, v): the least node that it is linked to."""
    return least_linked(star_edges(edges))


def most_apart(x: str, y: str, least: float) -> tuple[Column, Column]:
    """How far apart two weighted sets of probability Jaccard similarity
    ``least`` or more can be: (only, differ), the weight of the items that only
    one has, and the sum of the differences of all items' weights.  ``x`` and
    ``y`` name structs or tables with n, the weight of a set, and r, its part
    beyond the first occurrence of each item.

    Let S be the sum of max(x_i, y_i), and e the differences in common items.
    A term 1 / sum_i max(x_i/x_d, y_i/y_d) is at most max(x_d, y_d) / S, so the
    similarity is at most 1 - only / S.  With shares p and q of an item in the
    sets it is at most the sum of min(p, q), so S <= many + (1 - least) few.
    This bounds ``only``, and ``differ`` = 2 S - n - n.  As S is also
    (n + n + only + e) / 2 and e <= r + r, only (1 + least) <= (1 - least)
    (n + n + r + r), and with e added (1 + least) differ <= (1 - least) (n + n)
    + 2 (r + r).  Without repeated items that is the bound of the Jaccard similarity."""
    n, r = F.col(f"{x}.n") + F.col(f"{y}.n"), F.col(f"{x}.r") + F.col(f"{y}.r")
    few, many = F.least(f"{x}.n", f"{y}.n"), F.greatest(f"{x}.n", f"{y}.n")
    far = 1 - least
    return (F.least((many + few * far) * far, (n + r) * (far / (1 + least))) + 1e-6,
            F.least(many - few + few * (2 * far), (n * far + r * 2) / (1 + least)) + 1e-6)


def bucket_classes(buckets: DataFrame, sets: Callable[[DataFrame], DataFrame],
                   verify: Callable[[DataFrame, DataFrame], DataFrame],
                   shared: Callable[[DataFrame], DataFrame], parities: Callable[[DataFrame], DataFrame],
                   least: float, stars: int = 5) -> DataFrame:
    """(node, label): components of the verified links among nodes that share
    a bucket; nodes without a link are left out.

    ``buckets``: (key, node), staged; ``sets`` gives the staged item sets of
    nodes; ``verify`` keeps the true links of pairs (a, b), given the sets of
    their nodes.  Instead of all pairs of a bucket, each round takes one hub per
    bucket and pairs it with the members of other classes, so a bucket of n
    alike nodes costs n pairs.  The first hubs are the nodes with most company,
    the next those with fewest items of their own, the others are drawn among
    nodes with about as few.  Buckets that still hold several classes after the
    rounds get their pairs between different classes, each pair in one bucket,
    so no link between classes is missed: left out are only pairs further apart than ``most_apart`` allows links of
    ``least`` similarity.  ``shared`` gives (node, n, u, r) of sets, their weight,
    that of the items that no other node of an open bucket has, and that beyond
    the first occurrence of each item.  Two sets have u + u of items that only
    one has, and at most min(n - u) in common.  ``parities`` gives (node, bits,
    kinds) of sets: ``PARITY_WORDS`` longs each, whose bits are the parities of
    the occurrences, and of the different items, of as many residues; each bit
    in which two sets differ needs an occurrence, or item, that only one of them
    has.  A round without new links is the last before the pairs.
    Classes between the rounds need not be whole (two classes may be one
    component), so two rounds of stars do there."""
    company = staged(buckets.join(buckets.groupBy("key").agg(F.count("*").alias("_c")).where("_c > 1"), "key")
                     .groupBy("node").agg(F.sum("_c").alias("c"), F.collect_list("key").alias("keys")))  # at most its bands
    rows = company.select(F.explode("keys").alias("key"), "node", (-F.col("c")).cast("double").alias("rank"),
                          F.lit(0.0).alias("n"), F.lit(0.0).alias("u"), F.lit(0.0).alias("r"))
    links = labels = own = None

    def labelled() -> DataFrame:
        if labels is None:
            return rows.withColumn("label", F.col("node"))
        return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))

    def alike(x: str, y: str) -> Column:
        n, u = (lambda k: F.col(f"{k}.n")), (lambda k: F.col(f"{k}.u"))
        only, differ = most_apart(x, y, least)
        common = F.least(n(x) - u(x), n(y) - u(y))
        return (u(x) + u(y) <= only) & (n(x) + n(y) - common * 2 <= differ)

    def few_differ(x: str, y: str) -> Column:
        def bits(name: str) -> Column:
            return sum((F.bit_count(F.col(f"{x}.{name}")[k].bitwiseXOR(F.col(f"{y}.{name}")[k])) for k in range(PARITY_WORDS)), F.lit(0))

        only, differ = most_apart(x, y, least)
        return (bits("kinds") <= only) & (bits("bits") <= differ)

    turn = 0
    while turn <= stars:
        now = staged(labelled())
        hubs = (now.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min(F.struct(
            (F.col("rank") if turn < 2 else F.floor(F.col("rank") * 50)).alias("rank"), F.xxhash64("node", F.lit(turn)).alias("draw"), "node", "label", "n", "u", "r")).alias("y"))
            .where("lo <> hi").select("key", "y"))
        if turn < stars:
            pairs = (now.alias("x").join(hubs, "key").where((F.col("x.label") != F.col("y.label")) & alike("x", "y"))
                     .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct())
        else:
            left = staged(now.join(hubs.select("key"), "key").join(company.select("node", "keys"), "node")
                          .join(parities(own), "node"))
            once = F.array_min(F.array_intersect("x.keys", "y.keys")) == F.col("x.key")
            pairs = (left.alias("x").join(left.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.label") < F.col("y.label"))
                                          & alike("x", "y") & few_differ("x", "y") & once)
                     .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")))
        pairs = staged(pairs)
        none = pairs.isEmpty()
        last = none or turn >= stars - 1
        if not none:
            nodes = staged(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
            of_pairs = sets(nodes) if own is None else own.join(small(nodes), "node", "left_semi")
            found = staged(verify(pairs, of_pairs).select(F.col("a").alias("u"), F.col("b").alias("v")))
            last = last or found.isEmpty()
            links = star_edges(found if links is None else links.union(found), None if last else 2)
            labels = least_linked(links)
        elif links is not None and turn < stars:
            links = star_edges(links)
            labels = least_linked(links)
        if turn == 0:  # only open buckets go on, without nodes that have too many items of their own
            now = labelled()
            keys = now.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
            held = staged(now.join(keys, "key").select("key", "node"))
            own = sets(held.select("node").distinct())
            known = shared(own).where(F.col("n") - F.col("u") >= F.col("n") * least)
            rows = staged(held.join(known, "node").select("key", "node", (F.col("u") / F.col("n")).alias("rank"),
                                                          *[F.col(k).cast("double").alias(k) for k in ("n", "u", "r")]))
        turn = stars if last and turn < stars else turn + 1
    return labels if labels is not None else buckets.select("node", F.col("node").alias("label")).limit(0)
