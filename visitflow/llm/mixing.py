"""Mixing sources to target weights by hierarchical budgets, in DataFrame functions only.

The rows form a tree: domain, language, source. A token budget flows down it:
each node's budget goes to its children in proportion to their weights, and a
child that holds less (its tokens times ``max_epochs``) takes what it holds and
leaves the rest to its siblings. Capacities are summed over whole subtrees first,
so a shortage is made up by siblings as long as they hold tokens, and only what
the whole subtree lacks is passed on to the parent's siblings.

Each leaf then reads its rows in seeded epochs: epoch ``e`` orders them by
``md5(seed|e|doc_id|md5(text))``. Whole epochs that fit the budget are taken in full;
of the next one the longest prefix that fits. The prefix's end is found by
4,096 key buckets for each leaf, then inside one bucket, so no leaf is sorted whole.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitflow.llm.common import stored, word_count

LEVELS = ("domain", "lang", "source")
#: Domains that the digits of a source's name choose from.
DOMAINS = ("web", "books", "forum", "reference")
#: Integer weights of siblings; "*" is any other name.
WEIGHTS: Mapping[str, Mapping[str, int]] = {
    "domain": {"web": 40, "books": 20, "forum": 20, "reference": 20, "*": 20},
    "lang": {"en": 55, "fr": 15, "de": 15, "es": 15, "*": 10},
    "source": {"*": 1},
}
TOTAL_SHARE = 0.8
MAX_EPOCHS = 2
SEED = 11
#: A leaf table of at most this many rows is broadcast (about 100 bytes a row).
BROADCAST_LEAVES = 50_000
BUCKET_DIGITS = 3
UNKNOWN = "unknown"


def domain_of(source: Column) -> Column:
    """Domain of a source: its name's first digits modulo the number of domains; none: the first."""
    digits = F.substring(F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9]+)", 1), 1, 9)
    at = F.coalesce(F.when(digits != "", digits).cast("long"), F.lit(0)) % len(DOMAINS)
    return F.element_at(F.array(*[F.lit(d) for d in DOMAINS]), (at + 1).cast("int"))


def _weight(level: str, name: Column, weights: Mapping[str, Mapping[str, int]]) -> Column:
    table = weights.get(level, {})
    out = F.lit(int(table.get("*", 1))).cast("long")
    for key, value in table.items():
        if key != "*":
            out = F.when(name == key, F.lit(int(value)).cast("long")).otherwise(out)
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the tree's levels, tokens and a text hash under names of their own."""
    text, source = F.col("text").cast("string"), F.col("source").cast("string")
    return docs.withColumns(
        {
            "_mix_domain": domain_of(source),
            "_mix_lang": F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)),
            "_mix_source": F.coalesce(source, F.lit(UNKNOWN)),
            "_mix_tokens": word_count(text),
            "_mix_text": F.md5(F.coalesce(text, F.lit("")).cast("binary")),
            "_mix_id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        }
    )


def _order_key(epoch: Column, seed: int) -> Column:
    """Place of a row in an epoch of its leaf: a 32-digit key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.col("_mix_id"), F.col("_mix_text")))


def _pour(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Split each parent's ``budget`` over its children (``capacity``, ``weight``).

    Children are visited by how soon they run dry (capacity over weight). One
    runs dry if its share of what is left, among those left, is at least its capacity.
    """
    dryness = F.col("capacity").cast("double") / F.col("weight").cast("double")
    line = Window.partitionBy(*parent).orderBy(dryness, name)
    nodes = (
        nodes.withColumn("before", F.sum("capacity").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("capacity"))
        .withColumn("left_weight", F.sum("weight").over(line.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn(
            "dry",
            F.col("capacity").cast("double") * F.col("left_weight").cast("double")
            <= F.col("weight").cast("double") * (F.col("budget") - F.col("before")).cast("double"),
        )
    )
    family = Window.partitionBy(*parent)
    wet_weight = F.sum(F.when(~F.col("dry"), F.col("weight")).otherwise(0)).over(family)
    dry_tokens = F.sum(F.when(F.col("dry"), F.col("capacity")).otherwise(0)).over(family)
    share = F.floor(
        F.try_divide(F.col("weight").cast("double") * (F.col("budget") - dry_tokens).cast("double"), wet_weight.cast("double"))
    ).cast("long")
    poured = F.when(F.col("dry"), F.col("capacity")).otherwise(F.least(share, F.col("capacity")))
    return nodes.withColumn("poured", poured).drop("budget", "before", "left_weight", "dry")


def leaf_budgets(
    leaves: DataFrame, weights: Mapping[str, Mapping[str, int]], total_share: float, max_epochs: int
) -> DataFrame:
    """Budget of each leaf: columns of the levels, ``tokens`` (one epoch) and ``budget``.

    ``leaves`` has the levels and ``tokens``, one row a leaf: tens to thousands of
    rows. Leaves under a node of weight 0, or without tokens, get 0.
    """
    live = F.col("tokens") > 0
    for level in LEVELS:
        leaves = leaves.withColumn(f"w_{level}", _weight(level, F.col(level), weights))
        live = live & (F.col(f"w_{level}") > 0)
    leaves = leaves.withColumn("capacity", F.when(live, F.col("tokens") * max_epochs).otherwise(0))
    out = leaves.where("capacity > 0")
    held = leaves.agg(F.sum("tokens"), F.sum("capacity")).first()
    total = min(int((held[0] or 0) * total_share), held[1] or 0)
    budgets, parent = None, []
    for level in LEVELS:
        nodes = out.groupBy(*parent, level, F.col(f"w_{level}").alias("weight")).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.join(budgets, parent) if parent else nodes.withColumn("budget", F.lit(total).cast("long"))
        poured = _pour(nodes, parent, level)
        parent = [*parent, level]
        budgets = poured.select(*parent, F.col("poured").alias("budget"))
    return leaves.select(*LEVELS, "tokens").join(budgets, list(LEVELS), "left").fillna({"budget": 0})


def epoch_cuts(
    docs: DataFrame,
    weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """One row a leaf: levels, ``tokens``, ``budget``, ``full`` epochs and the next epoch's ``cut`` key."""
    rows = stored(
        _keyed(docs).select(
            F.col("_mix_domain").alias("domain"),
            F.col("_mix_lang").alias("lang"),
            F.col("_mix_source").alias("source"),
            F.col("_mix_tokens").alias("n"),
            "_mix_id",
            "_mix_text",
        ),
        "mix-rows",
    )
    leaves = stored(rows.groupBy(*LEVELS).agg(F.sum("n").alias("tokens")), "mix-leaves")
    budgets = stored(
        leaf_budgets(leaves, weights, total_share, max_epochs)
        .withColumn("full", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0).cast("int"))
        .withColumn("rest", F.col("budget") - F.col("full") * F.col("tokens")),
        "mix-budgets",
    )
    keyed = (
        rows.join(_small(budgets), list(LEVELS))
        .where("rest > 0")
        .withColumn("key", _order_key(F.col("full") + 1, seed))
        .withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    )
    sums = keyed.groupBy(*LEVELS, "rest", "bucket").agg(F.sum("n").alias("n"))
    line = Window.partitionBy(*LEVELS).orderBy("bucket")  # 4,096 rows a leaf at most
    edge = (
        sums.withColumn("upto", F.sum("n").over(line))
        .where("upto > rest")
        .groupBy(*LEVELS)
        .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before"))).alias("edge"))
        .select(*LEVELS, F.col("edge.bucket").alias("bucket"), F.col("edge.before").alias("before"))
    )
    edge = stored(edge, "mix-edges")
    inside = keyed.join(_small(edge), [*LEVELS, "bucket"])
    keys = inside.groupBy(*LEVELS, "rest", "before", "key").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("key"))
    ends = (
        keys.withColumn("upto", F.col("before") + upto)
        .where("upto <= rest")
        .groupBy(*LEVELS)
        .agg(F.max("key").alias("end"))
    )
    return stored(
        budgets.join(edge, list(LEVELS), "left")
        .join(ends, list(LEVELS), "left")
        .select(*LEVELS, "tokens", "budget", "full", F.coalesce("end", "bucket", F.lit("")).alias("cut")),
        "mix-cuts",
    )


def _small(leaves: DataFrame) -> DataFrame:
    """Broadcast a leaf table whose size has been checked; larger ones are joined by shuffle."""
    return F.broadcast(leaves) if leaves.count() <= BROADCAST_LEAVES else leaves


def mix(
    docs: DataFrame,
    weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    epoch_column: str | None = None,
) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang, source) in the target mix.

    The budget is ``total_share`` of all words, at most what ``max_epochs`` readings
    of the weighted leaves hold. A row appears once for each epoch that takes it;
    ``epoch_column`` names a column for the epoch (from 1). All columns of ``docs``
    are kept, also ones named like the tree's levels.

    A null language or source is the leaf "unknown"; a null doc_id orders as "".
    Null and empty texts hold no words: such a row is taken wherever its key lies
    in the part of an epoch that is taken. Rows alike in doc_id and text have one
    key and are taken together. A leaf without words gets no budget and yields no
    rows. A text of any length counts with all its words and is taken whole or not at all.
    An empty table gives an empty result.
    """
    names = docs.columns
    cuts = epoch_cuts(docs, weights, total_share, max_epochs, seed).select(
        *[F.col(level).alias(f"_mix_{level}") for level in LEVELS],
        F.col("full").alias("_mix_full"),
        F.col("cut").alias("_mix_cut"),
        F.col("budget").alias("_mix_budget"),
    )
    more = F.when(_order_key(F.col("_mix_full") + 1, seed) <= F.col("_mix_cut"), 1).otherwise(0)
    taken = (
        _keyed(docs)
        .join(_small(cuts), [f"_mix_{level}" for level in LEVELS])
        .where("_mix_budget > 0")
        .withColumn("_mix_upto", F.col("_mix_full") + more)
        .where("_mix_upto > 0")
        .withColumn("_mix_epoch", F.explode(F.sequence(F.lit(1), F.col("_mix_upto"))))
    )
    extra = [F.col("_mix_epoch").alias(epoch_column)] if epoch_column else []
    return taken.select(*[F.col(f"`{c}`") for c in names if c != epoch_column], *extra)


def mixed_report(docs: DataFrame, **settings) -> DataFrame:
    """What the mix takes, without the texts: doc_id, domain, lang, source, n_tokens, epoch."""
    chosen = mix(docs.select("doc_id", "text", "lang", "source"), epoch_column="epoch", **settings)
    source = F.col("source").cast("string")
    return chosen.select(
        "doc_id",
        domain_of(source).alias("domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(source, F.lit(UNKNOWN)).alias("source"),
        word_count(F.col("text").cast("string")).alias("n_tokens"),
        "epoch",
    )
