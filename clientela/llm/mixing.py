"""Mix sources, languages and topics to target weights by iterative proportional fitting.

Tokens are counted for each cell (a combination of source, language and topic
that occurs). Each value of a dimension has a factor, and a cell's probability is
the budget times the factors of its values, and one at most. The factors are raked:
dimension by dimension they are set so that the expected tokens of each value meet
its target, where cells that are at one stay there and the others make up for them.
This goes on until no value misses its target by more than ``tolerance``. Shares and
budget then hold together for the probabilities that are drawn with, not only for
weights before a cut. The draw is a hash of the document, so it is the same in every
run, with any partitioning and after a lost executor.

Everything is a DataFrame expression. Cells are as many as combinations occur,
however many documents there are, and a source with a third of all documents is
added up before the shuffle. A step adds the cells up by value, in one task up to
``CELLS_OF_A_TASK`` cells and by a shuffle and a join beyond, and each round writes its
cells; no task holds more. The driver sees totals and
the largest miss.

Targets: shares that are given are demands, and ``ValueError`` says if they cannot be
met with the budget. Shares to a power are wishes: a value is asked for no more tokens
than it has and the others for more. Should such wishes contradict each other, the
probabilities of the last round are used and the column ``miss`` tells how far off they
are; ``strict`` makes that an error too.

Defined results: nulls in source, language or topic are a value of their own, apart from
any text; null, empty and blank texts have no tokens and are kept as their cell asks (a
cell without tokens: never); rows with one doc_id share their draw; a null doc_id draws
like any other id; a given share of a value without tokens is left out and the others
scaled up, and it is an error if none is left; an empty table gives an empty table; other
columns are passed through by ``mixed``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from clientela.functions.storage import materialise

NONE = "(none)"
SPACE = "[ \\t-\\r]+"
CELLS_OF_A_TASK = 50_000
STALL = 10  # rounds in which the largest miss must fall by a hundredth


@dataclass(frozen=True)
class Target:
    """Shares of a dimension: those given, or its own shares to a power below one (flatter)."""

    power: float = 0.5
    shares: Mapping[str, float] | None = None


@dataclass(frozen=True)
class MixConfig:
    targets: Mapping[str, Target] = field(default_factory=lambda: {
        "source": Target(0.5), "lang": Target(0.7), "topic": Target(0.8),
    })
    budget: float = 0.5  # expected share of all tokens that is kept
    tolerance: float = 1e-10  # largest relative miss of a target
    rounds: int = 200  # at most; a round takes each dimension once
    strict: bool = False  # raise on wishes that contradict each other, too
    seed: int = 17

    def __post_init__(self) -> None:
        if not 0 < self.budget <= 1:
            raise ValueError(f"the budget is a share of all tokens above 0: {self.budget}")


def token_count(text: Column) -> Column:
    """Words of a text."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != ""))


def topic_of(text: Column, tokens: Column) -> Column:
    """What kind of text it is: tables, shouting, or prose by length."""
    return (
        F.when(text.contains(" | "), "table")
        .when(text.contains("!!"), "shout")
        .when(tokens < 150, "short")
        .when(tokens >= 1000, "long")
        .otherwise("prose")
    )


def with_cell(docs: DataFrame, topic: Column | None = None) -> DataFrame:
    """All columns, and the document's cell as ``_source``, ``_lang``, ``_topic``, ``_tokens``.

    ``topic`` is a topic that the caller knows; without it the kind of text stands for it.
    """
    counted = docs.withColumn("_tokens", token_count(F.col("text")).cast("long"))
    return counted.withColumns({
        "_source": F.col("source"),
        "_lang": F.col("lang"),
        "_topic": topic_of(F.col("text"), F.col("_tokens")) if topic is None else topic,
    })


def draw(key: Column, seed: int) -> Column:
    """A number in [0, 1) from a hash of the key."""
    text = F.concat(F.coalesce(key.cast("string"), F.lit(NONE)), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def _quotient(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _exact(number: str, over: str = "") -> str:
    """A sum that does not depend on the order of the rows, so that every run takes the same steps."""
    return f"CAST(sum(CAST({number} AS DECIMAL(32, 20))) {over} AS DOUBLE)"


def _wishes(cells: DataFrame, name: str, target: Target, budget: float) -> DataFrame:
    """value, limit (the share of the budget that all its tokens are) and wish."""
    values = cells.groupBy(F.col(f"_{name}").alias("value")).agg(
        F.sum("tokens").cast("double").alias("tokens"), F.expr(_exact("share")).alias("limit")
    )
    if target.shares is None:
        wish = F.pow("limit", F.lit(target.power))
    else:
        wish = F.lit(0.0)
        for value, share in target.shares.items():
            same = F.col("value").eqNullSafe(F.lit(value))
            wish = F.when(same, F.lit(float(share))).otherwise(wish)
    wish = F.when(F.col("tokens") > 0, wish).otherwise(0.0)
    limit = F.col("limit") / budget
    return materialise(values.select("value", limit.alias("limit"), wish.alias("wish")), "wishes")


def _targets(cells: DataFrame, name: str, target: Target, budget: float) -> DataFrame:
    """The target of each value ``at`` of a dimension; they add up to one."""
    wishes = _wishes(cells, name, target, budget)
    limit = F.col("limit") if target.shares is None else F.lit(float("inf"))
    total = wishes.agg(F.expr(_exact("wish"))).first()[0]
    if not total:
        raise ValueError(f"no value of {name} that has a target has tokens")
    scale, full = 1.0 / total, 0
    while True:
        # Values that are asked for all they have; each pass can only find more of them.
        marked = wishes.withColumn("over", F.col("wish") * scale >= limit)
        used, free, count = marked.agg(
            F.expr(_exact("if(over, limit, 0D)")),
            F.expr(_exact("if(over, 0D, wish)")),
            F.expr("count_if(over AND wish > 0)"),
        ).first()
        if count == full or not free:
            break
        scale, full = max(0.0, 1.0 - used) / free, count
    share = F.least(F.col("wish") * scale, limit) if free else limit
    return wishes.select(F.col("value").alias("at"), share.alias(f"target_{name}"))


def _with_sums(cells: DataFrame, name: str, most: float, tasks: int) -> DataFrame:
    """The cells with ``full`` and ``free``: sums of their value over cells at one and below.

    Cells of one task stay in it: windows keep the plan of a round short. More of them
    are added up before a shuffle, since one value may hold most cells. The sums are equal.
    """
    full = f"if(times >= {most!r}D, share * {most!r}D, 0D)"
    free = f"if(times >= {most!r}D, 0D, share * times)"
    if tasks == 1:
        over = f"OVER (PARTITION BY _{name})"
        return cells.withColumns({
            "full": F.expr(_exact(full, over)), "free": F.expr(_exact(free, over))
        })
    sums = cells.groupBy(F.col(f"_{name}").alias("at")).agg(
        F.expr(_exact(full)).alias("full"), F.expr(_exact(free)).alias("free")
    )
    return cells.join(sums, F.expr(f"_{name} <=> at"))


def _adjusted(cells: DataFrame, name: str, most: float, tasks: int) -> DataFrame:
    """The cells after a step in one dimension; ``miss``: how far its values were off before."""
    step = f"""CASE WHEN full + free = 0 THEN 1D
        WHEN target_{name} <= full THEN try_divide(target_{name}, full + free)
        WHEN free > 0 THEN try_divide(target_{name} - full, free)
        ELSE 1D END"""
    off = f"abs(full + free - target_{name})"
    miss = f"if(target_{name} > 0, try_divide({off}, target_{name}), {off})"
    rest = [c for c in cells.columns if c not in ("times", "miss")]
    return _with_sums(cells, name, most, tasks).selectExpr(
        *(f"`{c}`" for c in rest), f"times * {step} AS times", f"greatest(miss, {miss}) AS miss"
    )


def raked_cells(docs_with_cell: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """_source, _lang, _topic, documents, tokens, weight, probability and miss of each cell."""
    keys = [f"_{name}" for name in cfg.targets]
    counted = docs_with_cell.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("documents"), F.sum("_tokens").alias("tokens")
    )
    counted = materialise(counted, "cells")
    total, number = counted.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    # A task for each CELLS_OF_A_TASK cells: where one is enough, sums need no shuffle.
    tasks = max(1, -(-number // CELLS_OF_A_TASK))
    counted = counted.coalesce(tasks)
    if not total:
        nothing = {name: F.lit(0.0) for name in ("weight", "probability", "miss")}
        return counted.withColumns(nothing)
    cells = counted.withColumns({
        "share": F.col("tokens") / F.lit(float(total)), "times": F.lit(1.0), "miss": F.lit(0.0)
    })
    for name, target in cfg.targets.items():
        targets = _targets(cells, name, target, cfg.budget)
        cells = cells.join(targets, F.col(f"_{name}").eqNullSafe(F.col("at"))).drop("at")
    most = 1.0 / cfg.budget
    miss, least = 0.0, [float("inf")]
    for _ in range(cfg.rounds):
        cells = cells.withColumn("miss", F.lit(0.0))
        for name in cfg.targets:
            cells = _adjusted(cells, name, most, tasks)
        # One written table for each round: a step's sums are used by the steps after it.
        cells = materialise(cells, "raked").coalesce(tasks)
        miss = cells.agg(F.max("miss")).first()[0]
        # Targets that contradict each other keep their distance.
        least.append(min(miss, *least[-1:]))
        if miss <= cfg.tolerance or (len(least) > STALL and least[-1] > 0.99 * least[-1 - STALL]):
            break
    given = any(target.shares is not None for target in cfg.targets.values())
    if miss > cfg.tolerance and (given or cfg.strict):
        raise ValueError(
            f"the targets cannot be met with a budget of {cfg.budget} of all tokens: "
            f"after {len(least) - 1} rounds a share is {miss:.2%} off"
        )
    times = F.least(F.col("times"), F.lit(most))
    probability = F.when(F.col("tokens") > 0, F.least(F.lit(1.0), times * cfg.budget))
    return cells.select(
        *keys,
        "documents",
        "tokens",
        (F.col("share") * times).alias("weight"),
        probability.otherwise(0.0).alias("probability"),
        F.lit(miss).alias("miss"),
    )


def with_expected_shares(cells: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """The cells with ``_source_share`` and so on: the value's share of all tokens expected."""
    expected = F.sum(F.col("tokens") * F.col("probability"))
    total = float(cells.agg(expected).first()[0] or 0.0)
    for name in cfg.targets:
        share = _quotient(expected, F.lit(total)).alias(f"_{name}_share")
        sums = cells.groupBy(F.col(f"_{name}").alias("at")).agg(share)
        cells = cells.join(sums, F.col(f"_{name}").eqNullSafe(F.col("at"))).drop("at")
    return cells


def with_probability(docs_with_cell: DataFrame, cells: DataFrame, cfg: MixConfig) -> DataFrame:
    """Every document with its cell's columns, ``_probability`` and ``_kept``.

    The cells are few: Spark sends them.
    """
    keys = [f"_{name}" for name in cfg.targets]
    same = F.lit(True)
    known = cells.drop("documents", "tokens", "weight", "miss")
    known = known.withColumnRenamed("probability", "_probability")
    for key in keys:
        known = known.withColumnRenamed(key, f"{key}_of_cell")
        same = same & F.col(key).eqNullSafe(F.col(f"{key}_of_cell"))
    both = docs_with_cell.join(known, same).drop(*(f"{key}_of_cell" for key in keys))
    return both.withColumn("_kept", draw(F.col("doc_id"), cfg.seed) < F.col("_probability"))


def mixed(
    docs: DataFrame, cfg: MixConfig = MixConfig(), topic: Column | None = None
) -> DataFrame:
    """The documents drawn, with the columns they came with. ``topic`` uses those columns."""
    # The row travels as one struct, so its names meet none of those used here.
    row = F.struct(*docs.columns).alias("row")
    own = topic_of(F.col("text"), token_count(F.col("text"))) if topic is None else topic
    columns = ["doc_id", "source", "lang", "text"]
    celled = with_cell(docs.select(row, *columns, own.alias("own_topic")), F.col("own_topic"))
    cells = materialise(raked_cells(celled, cfg), "mix")
    kept = with_probability(celled, cells, cfg).filter("_kept")
    return kept.select("row.*")
