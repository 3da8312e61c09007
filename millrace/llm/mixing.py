"""Mixing sources to target weights by hierarchical budgeting.

A token budget flows down a tree (domain, language, source). At each node it is shared among
the children by weight. A child that cannot use its share (its documents, repeated at most
``epochs`` times, hold fewer tokens) gets what it can use, and its siblings share the rest by
weight; only what a whole subtree cannot use goes to the siblings of its parent, because a
node's budget never exceeds what lies below it. Each leaf then takes whole epochs of its
documents and a prefix of one more epoch, in an order that the seed and the epoch determine.
A prefix ends where the next document does not fit, so leaves fall short of their shares. What
they leave lets prefixes reach one document further: first among siblings, then within the
domain, last in the whole tree.

DataFrame functions only. The prefix is found from token sums of slices of the seeded order;
running sums are formed within a slice, so a leaf with a third of all rows is no hot group.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

LEVELS = ("domain", "lang", "source")
#: Leaves up to this number are broadcast (a row each); more are joined by key.
BROADCAST_LEAVES = 20_000


def token_count(text: str = "text") -> Column:
    """Number of runs of other characters than space and 0x09-0x0D."""
    return F.size(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"),
                           lambda w: w != "")).cast("bigint")


def _weight(weights: Mapping[str, int], name: Column) -> Column:
    """Weight of a node from its name; names that are not listed weigh 1."""
    if not weights:
        return F.lit(1).cast("bigint")
    listed = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(int(v)))])
    return F.coalesce(F.get(F.array(F.try_element_at(listed, name)), F.lit(0)), F.lit(1)).cast("bigint")


def leaf_budgets(leaves: DataFrame, weights: Mapping[str, Mapping[str, int]], budget: Column,
                 levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """``levels..., share`` from ``levels..., room`` (the tokens that a leaf can use).

    ``weights[level][name]`` are whole numbers; a node of weight 0 gets nothing. Shares are
    rounded down. Nulls in a level are a node like others.
    """
    nodes = leaves.withColumn("_room", F.col("room"))
    for level in levels:  # what lies below a node of weight 0 cannot be used
        nodes = nodes.withColumn("_room", F.when(
            _weight(weights.get(level, {}), F.coalesce(F.col(level), F.lit(""))) > 0, F.col("_room")).otherwise(0))
    whole = nodes.agg(F.coalesce(F.sum("_room"), F.lit(0)).alias("_all"), budget.alias("_budget"))
    parents = whole.select(F.least("_all", "_budget").alias("share"))
    for depth, level in enumerate(levels):
        path, upper = list(levels[:depth + 1]), list(levels[:depth])
        children = nodes.groupBy(*path).agg(F.sum("_room").alias("room"))
        children = children.withColumn("w", _weight(weights.get(level, {}), F.coalesce(F.col(level), F.lit(""))))
        if depth:
            above = parents.select(*[F.col(c).alias(f"p_{c}") for c in upper], "share")
            match = F.expr(" and ".join(f"{c} <=> p_{c}" for c in upper))
            children = children.join(above, match).select(*path, "room", "w", "share")
        else:
            # One row: the budget of the root.
            children = children.join(F.broadcast(parents))
        parents = _share(children, path, upper).select(*path, "share")
    return parents


def _share(children: DataFrame, path: list[str], upper: list[str]) -> DataFrame:
    """Water-filling among siblings, in whole numbers: those with the least room for their
    weight are filled first, and the others share what they leave."""
    level = path[-1]
    usable = F.when(F.col("w") > 0, F.col("room").cast("double") / F.col("w"))
    order = Window.partitionBy(*upper).orderBy(usable.asc_nulls_first(), F.col(level).asc_nulls_first())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    family = Window.partitionBy(*upper)
    ranked = (children.withColumn("room_before", F.coalesce(F.sum("room").over(before), F.lit(0)))
              .withColumn("w_onward", F.sum("w").over(onward)))
    full = ranked.withColumn("is_full", F.expr("room * w_onward <= w * (share - room_before)"))
    summed = (full.withColumn("full_room", F.sum(F.expr("if(is_full, room, 0)")).over(family))
              .withColumn("open_w", F.sum(F.expr("if(is_full, 0, w)")).over(family)))
    return summed.withColumn("share", F.expr(
        "case when is_full then room when open_w = 0 then 0 else w * (share - full_room) div open_w end"))


def _extended(prefixes: DataFrame) -> DataFrame:
    """``leaf, upto_most`` from ``leaf, rest, used, next_upto``: how far a leaf's prefix goes.

    The tokens that the leaves of a family leave (``rest - used``) pay for whole next documents, the
    shortest first, as far as they go; what is left goes to the family above. The root's last
    document may cost more than is left.
    """
    names = [F.col(f"leaf.p_{c}") for c in LEVELS]
    order = [F.col("size").asc(), *[n.asc_nulls_first() for n in names]]
    rows = (prefixes.withColumn("size", F.col("next_upto") - F.col("used"))
            .withColumn("left", F.col("rest") - F.col("used")).withColumn("given", F.lit(False)))
    for depth in reversed(range(len(LEVELS))):
        family = Window.partitionBy(*names[:depth])
        open_size = F.when(F.col("given"), 0).otherwise(F.col("size"))
        paid = F.when(F.col("given"), F.col("size")).otherwise(0)
        rows = (rows.withColumn("pool", F.sum(F.col("left") - paid).over(family))
                .withColumn("upward", F.sum(open_size).over(
                    family.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))))
        fits = F.col("upward") <= F.col("pool") if depth else F.col("upward") - F.col("size") < F.col("pool")
        rows = rows.withColumn("given", F.col("given") | fits)
    return rows.select("leaf", F.when(F.col("given"), F.col("next_upto")).otherwise(F.col("rest")).alias("upto_most"))


def mix(docs: DataFrame, weights: Mapping[str, Mapping[str, int]], domain: Column, percent: int = 100,
        epochs: int = 1, seed: int = 0, reach: bool = False) -> DataFrame:
    """Rows of ``docs`` (``row``), drawn to ``weights``: ``row, domain, n_tokens, epoch``.

    The budget is ``percent`` of all tokens of ``docs``. A document is drawn once for each
    epoch it is part of. The prefix of a leaf's last epoch takes documents in seeded order
    while their running token sum stays within what is left of the leaf's share; one document
    longer than what is left ends it. The tokens that leaves leave in this way take one more document each of
    other prefixes, the shortest first, among siblings, then in the domain, then anywhere. All together
    reach the sum of the shares and exceed it by less than the last such document. With ``reach`` every prefix takes the document in which it ends
    instead: no leaf falls short, and each exceeds its share by less than one of its documents, so all
    together exceed the budget by less than the sum of the longest document of each leaf.

    Null or wordless texts have no tokens: they belong to every epoch of their leaf, but to
    the prefix only up to where it ends. Null languages, sources and domains are leaves of
    their own. Order is by a digest of seed, epoch, id and text, so repeated rows tie and are
    interchangeable. An empty table gives no rows; texts are counted whole.
    """
    spark = docs.sparkSession
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), domain.alias("domain"),
                       "lang", "source", token_count().alias("n_tokens"))
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    leaves = leaves.withColumn("room", F.col("tokens") * epochs)
    shares = leaf_budgets(leaves, weights, F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * percent / 100))
    named_shares = shares.select(*[F.col(c).alias(f"p_{c}") for c in LEVELS], "share")
    leaf_of = F.expr(" and ".join(f"{c} <=> p_{c}" for c in LEVELS))
    plan = leaves.join(named_shares, leaf_of).select(
        *[f"p_{c}" for c in LEVELS],
        F.when(F.col("tokens") > 0, F.expr("share div tokens")).otherwise(0).alias("whole"),
        F.when(F.col("tokens") > 0, F.col("share") % F.col("tokens")).otherwise(0).alias("rest"))
    small = leaves.limit(BROADCAST_LEAVES + 1).count() <= BROADCAST_LEAVES
    named = rows.join(F.broadcast(plan) if small else plan, leaf_of)
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"),
                              F.coalesce(F.col("row")["doc_id"].cast("string"), F.lit("")),
                              F.md5(F.coalesce(F.col("row")["text"], F.lit("")))))
    leaf = F.struct("p_domain", "p_lang", "p_source")
    placed = (named.withColumn("place", order).withColumn("leaf", leaf)
              .withColumn("slice", F.substr("place", F.lit(1), F.lit(3))))
    ahead = Window.partitionBy("leaf").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (placed.groupBy("leaf", "slice").agg(F.sum("n_tokens").alias("tokens"))
              .select("leaf", "slice", F.coalesce(F.sum("tokens").over(ahead), F.lit(0)).alias("base")))
    within = Window.partitionBy("leaf", "slice").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.join(slices, ["leaf", "slice"]).withColumn("upto", F.col("base") + F.sum("n_tokens").over(within))
    if reach:
        taken = F.col("upto") - F.col("n_tokens") < F.col("rest")
    else:
        # One row a leaf.
        beyond = F.col("upto") > F.col("rest")
        prefixes = (summed.where("rest > 0").groupBy("leaf").agg(
            F.first("rest").alias("rest"), F.coalesce(F.max(F.when(~beyond, F.col("upto"))), F.lit(0)).alias("used"),
            F.min(F.when(beyond, F.col("upto"))).alias("next_upto")))
        most = _extended(prefixes)
        summed = summed.join(F.broadcast(most) if small else most, "leaf", "left")
        taken = F.col("upto") <= F.col("upto_most")
    drawn = F.concat(
        F.when(F.col("whole") > 0, F.sequence(F.lit(0), F.col("whole").cast("int") - 1))
        .otherwise(F.array().cast("array<int>")),
        F.when((F.col("rest") > 0) & taken, F.array(F.col("whole").cast("int")))
        .otherwise(F.array().cast("array<int>")))
    return summed.select("row", "domain", "n_tokens", F.explode(drawn).alias("epoch"))
