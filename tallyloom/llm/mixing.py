"""Mixing sources to target weights by hierarchical budgeting, in DataFrame functions only.

The token budget flows down the tree domain - language - source by weight. A node never gets more than its documents can
give (its tokens times the allowed epochs); what it cannot take goes to its siblings, and only what a whole group of
siblings cannot take goes to the level above. Within a leaf, whole epochs are taken first; of the last, partial epoch, a
prefix of the documents in a seeded order.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.llm.common import SPACE, Scratch, fits

#: Hex digits of the order key that make a bucket; a leaf's cut is looked for in one bucket only.
BUCKET_DIGITS = 4
MAX_BROADCAST_LEAVES = 100_000
LEVELS = ("domain", "lang", "source")


@dataclass(frozen=True)
class Mix:
    """Target weights by level and name (the same under every parent); names not listed weigh ``default``."""

    domains: Mapping[str, float] = field(default_factory=dict)
    langs: Mapping[str, float] = field(default_factory=dict)
    sources: Mapping[str, float] = field(default_factory=dict)
    domain_of: Mapping[str, str] = field(default_factory=dict)
    default: float = 1.0
    budget_share: float = 0.5
    max_epochs: int = 2
    seed: int = 17

    def weight(self, level: int) -> Column:
        given = (self.domains, self.langs, self.sources)[level]
        return _lookup(f"_{LEVELS[level]}", {k: float(v) for k, v in given.items()}, F.lit(float(self.default)))


def _lookup(column: str, table: Mapping, default: Column) -> Column:
    if not table:
        return default
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col(column)), default)


def leaves(docs: DataFrame, mix: Mix) -> list[Column]:
    """The tree path of a document; null names count as empty ones."""
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    domain = F.lit("other")
    if mix.domain_of:
        pairs = [F.lit(x) for kv in mix.domain_of.items() for x in kv]
        domain = F.coalesce(F.element_at(F.create_map(*pairs), source), domain)
    return [domain.alias("_domain"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("_lang"), source.alias("_source")]


def token_count(text: str = "text") -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), f"{SPACE}+"), "")).cast("long")


def fill(nodes: DataFrame, parents: list[str], given: str, room: str, weight: str, out: str) -> DataFrame:
    """Divide ``given`` (the parent's share) among siblings by weight, none above its ``room``.

    Siblings in order of room per weight: the level that the open ones reach once the first i are full is
    (given - their room) / weight of the rest, and its largest value over i is the true level.
    """
    group = Window.partitionBy(*parents)
    order = group.orderBy(F.col(room) / F.col(weight), *LEVELS_IN(nodes))
    before = F.coalesce(F.sum(room).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum(weight).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = nodes.withColumn("_level", (F.col(given) - before) / rest)
    level = level.withColumn("_level", F.max("_level").over(group))
    return level.withColumn(out, F.greatest(F.lit(0.0), F.least(F.col(room), F.col("_level") * F.col(weight)))).drop("_level")


def LEVELS_IN(nodes: DataFrame) -> list[str]:
    return [f"_{name}" for name in LEVELS if f"_{name}" in nodes.columns]


def budgets(supply: DataFrame, mix: Mix) -> DataFrame:
    """Tokens granted to each leaf, from (path, supply) rows; a leaf of weight 0 or without tokens gets none."""
    path = [f"_{name}" for name in LEVELS]
    nodes = supply.select(
        *path, F.col("supply").cast("double").alias("supply"), (F.col("supply") * float(mix.max_epochs)).alias("room2"),
        F.lit(0).alias("_all"), *[mix.weight(i).alias(f"weight{i}") for i in range(3)],
    )
    nodes = nodes.filter((F.col("supply") > 0) & (F.col("weight0") > 0) & (F.col("weight1") > 0) & (F.col("weight2") > 0))
    given = nodes.groupBy("_all").agg((F.sum("supply") * mix.budget_share).alias("given"))
    # Each level's nodes with the room of all that hangs below; the top three tables are as small as the tree.
    mid = nodes.groupBy("_all", "_domain", "_lang", "weight0", "weight1").agg(F.sum("room2").alias("room1"))
    top = mid.groupBy("_all", "_domain", "weight0").agg(F.sum("room1").alias("room0"))
    top = fill(top.join(given, "_all"), ["_all"], "given", "room0", "weight0", "given0")
    mid = fill(mid.join(top.select("_domain", "given0"), "_domain"), ["_domain"], "given0", "room1", "weight1", "given1")
    low = nodes.join(mid.select("_domain", "_lang", "given1"), ["_domain", "_lang"])
    low = fill(low, ["_domain", "_lang"], "given1", "room2", "weight2", "granted")
    return low.select(*path, "supply", "granted")


def order_key(mix: Mix, epoch: Column, id_col: str) -> Column:
    """The seeded order of an epoch, as 32 hex digits."""
    return F.md5(F.concat_ws("-", F.lit(mix.seed).cast("string"), epoch.cast("string"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


def cuts(tokens: DataFrame, mix: Mix, scratch: Scratch) -> DataFrame:
    """Per leaf: whole epochs to take, and the last order key taken of the epoch after them (empty: none).

    Two steps keep any leaf apart from a single task: tokens per bucket of keys find the one bucket in which the budget
    ends, and only that bucket's rows are added up one by one. Rows of equal key (the same id) are taken together.
    """
    path = [f"_{name}" for name in LEVELS]
    supply = tokens.groupBy(*path).agg(F.sum("tokens").alias("supply"))
    plan = budgets(supply, mix).select(
        *path, F.floor(F.col("granted") / F.col("supply")).cast("int").alias("epochs"),
        (F.col("granted") - F.floor(F.col("granted") / F.col("supply")) * F.col("supply")).alias("part"),
    )
    plan = scratch.write(plan, "plan")
    few = fits(plan, MAX_BROADCAST_LEAVES)
    near = F.broadcast if few else (lambda df: df)
    keyed = tokens.join(near(plan), path).select(*path, "tokens", "epochs", "part", order_key(mix, F.col("epochs"), "doc_id").alias("key"))
    keyed = keyed.withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    sums = keyed.groupBy(*path, "part", "bucket").agg(F.sum("tokens").alias("n"))
    upto = Window.partitionBy(*path).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("total", F.sum("n").over(upto))
    over = sums.filter(F.col("total") > F.col("part"))
    edge = scratch.write(over.groupBy(*path).agg(F.min_by(F.struct("bucket", (F.col("total") - F.col("n")).alias("before")), "bucket").alias("e")).select(*path, "e.*"), "edge")
    inside = keyed.join(near(edge), [*path, "bucket"])
    upto = Window.partitionBy(*path).orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("total", F.col("before") + F.sum("tokens").over(upto)).filter(F.col("total") <= F.col("part"))
    last = inside.groupBy(*path).agg(F.max("key").alias("last"))
    # Nothing of the edge bucket taken: all keys below the bucket's prefix are.
    cut = plan.join(edge.select(*path, "bucket"), path, "left").join(last, path, "left")
    return scratch.write(
        cut.select(*path, "epochs", F.when(F.col("bucket").isNull(), F.lit("g")).otherwise(F.coalesce("last", "bucket")).alias("last")), "cuts"
    )


def select(docs: DataFrame, mix: Mix, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(tokens, cuts): the counted documents, and the cut of each leaf; see :func:`taken` for the rows."""
    counted = scratch.write(docs.select("doc_id", *leaves(docs, mix), token_count().alias("tokens")), "tokens")
    return counted, cuts(counted, mix, scratch)


def taken(rows: DataFrame, cut: DataFrame, mix: Mix) -> DataFrame:
    """``rows`` (with the path columns and doc_id) once per epoch in which they are taken, with column ``_epoch``."""
    path = [f"_{name}" for name in LEVELS]
    joined = rows.join(F.broadcast(cut) if fits(cut, MAX_BROADCAST_LEAVES) else cut, path)
    part = order_key(mix, F.col("epochs"), "doc_id") <= F.col("last")
    n = F.col("epochs") + part.cast("int")
    return joined.withColumn("_n", n).filter("_n > 0").withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).drop("_n", "epochs", "last")


def mixture(docs: DataFrame, mix: Mix) -> DataFrame:
    """doc_id, domain, lang, source, tokens and epoch of every taken document, once per epoch.

    Null languages and sources are names of their own (empty); a null or empty text has no tokens, costs nothing and is
    taken when its key lies in the prefix of a leaf that has tokens; repeated rows of one id are taken together;
    an empty table gives no rows; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    counted, cut = select(docs, mix, scratch)
    rows = taken(counted, cut, mix).select("doc_id", *[F.col(f"_{n}").alias(n) for n in LEVELS], "tokens", F.col("_epoch").alias("epoch"))
    return scratch.finish(rows)


def mixed_documents(docs: DataFrame, mix: Mix) -> DataFrame:
    """The taken documents with all their columns, in the order of no particular task; one row per epoch taken.

    The texts are not shuffled: every row is held against its leaf's cut.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    _, cut = select(docs, mix, scratch)
    packed = docs.select("doc_id", *leaves(docs, mix), F.struct("*").alias("_row"))
    return taken(packed, cut, mix).select("_row.*")
