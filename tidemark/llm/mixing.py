"""Temperature mixing of sources, by DataFrame functions alone.

A source's share of all tokens is raised to an exponent between 0 (all sources
alike) and 1 (as they are) and normalised. The exponent is bisected until the
weights reach a target entropy, or until no source is repeated more often than
allowed. Weights become whole documents by block permutations: a document's key is
a seeded hash, a block a range of keys, the blocks of a source come in an order of
their own, and a source's budget is filled block by block. The block in which the
budget ends is cut at a key.

No window holds more than the blocks of a 1/1024 of a source, or one block.

Defined results: null text counts as empty; a null source is a source of its own;
the documents of a source without any token cost nothing and appear once; rows of
one identifier share its key and are taken together. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import staged, whole_text

BLOCK_ROWS = 1024
PARTS = 1024
KEY_BITS = 60
HALVINGS_A_PASS, PASSES = 5, 5
NEVER, ALWAYS = -1, 1 << KEY_BITS
WORDS = r"[^\x20\x09-\x0D]+"


def _hash(*parts: Column | str) -> Column:
    """Sixty bits of MD5: the same on every engine."""
    text = F.concat_ws(":", *(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def document_key(id: Column, seed: int) -> Column:
    return _hash(f"doc{seed}", F.coalesce(id.cast("string"), F.lit("")))


def _probe(log_share: Column, exponents: list[float], entropy: bool) -> list[Column]:
    """Entropy of the weights, or the ratio of most to least repetitions."""
    out = []
    for i, a in enumerate(exponents):
        if entropy:
            z, mean = F.sum(F.exp(a * log_share)), F.sum(F.exp(a * log_share) * a * log_share)
            out.append((F.log(z) - mean / z).alias(f"p{i}"))
        else:
            out.append(((F.max(-log_share) - F.min(-log_share)) * (1 - a)).alias(f"p{i}"))
    return out


def bisected_exponent(shares: DataFrame, entropy: float | None = None, max_epochs: float | None = None) -> float:
    """Largest exponent whose weights have at least `entropy` (as a fraction of the
    most there can be), or the smallest that repeats no source more than
    `max_epochs` times as often as any other. Five halvings are read off one pass."""
    if (entropy is None) == (max_epochs is None):
        raise ValueError("give a target entropy or a repetition limit, not both")
    live = shares.where("tokens > 0").select(F.log("share").alias("l"))
    count = live.count()
    if not count:
        return 1.0
    target = entropy * math.log(count) if entropy is not None else math.log(max_epochs)
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        cells = 1 << HALVINGS_A_PASS
        grid = [low + (high - low) * i / cells for i in range(cells + 1)]
        found = live.agg(*_probe(F.col("l"), grid, entropy is not None)).collect()[0]
        if entropy is not None:
            at = max((i for i in range(cells + 1) if found[i] >= target), default=0)
            low, high = (grid[at], grid[at + 1]) if at < cells else (grid[at], grid[at])
        else:
            at = min((i for i in range(cells + 1) if found[i] <= target), default=cells)
            low, high = (grid[at - 1], grid[at]) if at else (grid[at], grid[at])
        if low == high:
            break
    return low if entropy is not None else high


def source_weights(
    rows: DataFrame, entropy: float | None = None, max_epochs: float | None = None, budget: float | None = None
) -> DataFrame:
    """source, tokens, n_rows, share, weight, epochs from rows of (source, tokens).

    `budget` is the size of the mixture in multiples of all tokens; without one the
    mixture is the smallest that shows every document at least once."""
    totals = staged(
        rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n_rows")), "mix-sources"
    )
    every = totals.agg(F.sum("tokens")).collect()[0][0] or 0
    shares = totals.withColumn("share", F.col("tokens") / F.lit(float(every or 1)))
    exponent = bisected_exponent(shares, entropy, max_epochs)
    heated = F.when(F.col("tokens") > 0, F.exp(exponent * F.log("share"))).otherwise(0.0)
    norm = shares.agg(F.sum(heated)).collect()[0][0] or 1.0
    weighted = shares.withColumn("weight", heated / norm)
    per_token = F.col("weight") / F.col("share")
    if budget is None:
        least = weighted.where("tokens > 0").agg(F.min(per_token)).collect()[0][0] or 1.0
        epochs = per_token / least
    else:
        epochs = per_token * budget
    # Rounded, so that one whole epoch is not missed by the last bit of a product.
    return weighted.withColumn("epochs", F.when(F.col("tokens") > 0, F.round(epochs, 9)).otherwise(1.0))


def _block(key: Column, bits: int) -> Column:
    return F.shiftright(key, KEY_BITS - bits)


def block_plan(rows: DataFrame, weights: DataFrame, seed: int) -> tuple[DataFrame, int]:
    """of_source, of_block, weight, epochs, whole, cut: a document of the block appears
    `whole` times, and once more if its key is at most `cut`. And the bits of a
    key that name its block."""
    most = weights.agg(F.max("n_rows")).collect()[0][0] or 1
    bits = max(0, math.ceil(math.log2(most / BLOCK_ROWS))) if most > BLOCK_ROWS else 0
    cells = rows.groupBy("source", _block(F.col("key"), bits).alias("block")).agg(F.sum("tokens").alias("cell"))
    order = _hash(f"block{seed}", F.coalesce("source", F.lit("")), F.col("block"))
    cells = staged(
        cells.withColumn("order", order).withColumn("part", F.shiftright("order", KEY_BITS - PARTS.bit_length() + 1)), "mix-blocks"
    )
    zero = F.lit(0).cast("long")
    parts = cells.groupBy("source", "part").agg(F.sum("cell").alias("size"))
    parts = parts.select(
        F.col("source").alias("in_source"), F.col("part").alias("in_part"), F.coalesce(F.sum("size").over(Window.partitionBy("source").orderBy("part").rowsBetween(*_earlier())), zero).alias("base")
    )
    placed = cells.join(parts, F.col("source").eqNullSafe(F.col("in_source")) & (F.col("part") == F.col("in_part")))
    within = Window.partitionBy("source", "part").orderBy("order", "block").rowsBetween(*_earlier())
    placed = placed.withColumn("from", F.col("base") + F.coalesce(F.sum("cell").over(within), zero))
    named_weights = weights.select(F.col("source").alias("of_source"), "weight", "epochs", "tokens")
    joined = placed.join(named_weights, F.col("source").eqNullSafe(F.col("of_source"))).select(
        "source", "block", "cell", "from", "weight", "epochs", F.floor("epochs").alias("whole"),
        ((F.col("epochs") - F.floor("epochs")) * F.col("tokens") - F.col("from")).alias("room"),
    )
    planned = staged(joined, "mix-plan")
    ends_here = (F.col("room") >= 0) & (F.col("room") < F.col("cell"))
    ending = planned.where(ends_here).select(F.col("source").alias("in_source"), F.col("block").alias("in_block"), "room")
    named = rows.select("source", _block(F.col("key"), bits).alias("block"), "key", "tokens")
    cut_rows = named.join(ending, F.col("source").eqNullSafe(F.col("in_source")) & (F.col("block") == F.col("in_block")))
    up_to = Window.partitionBy("source", "block").orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = (
        cut_rows.withColumn("filled", F.sum("tokens").over(up_to))
        .where("filled <= room")
        .groupBy(F.col("source").alias("at_source"), F.col("block").alias("at_block"))
        .agg(F.max("key").alias("at"))
    )
    cut = F.when(F.col("room") >= F.col("cell"), ALWAYS).when(ends_here, F.coalesce("at", F.lit(NEVER))).otherwise(NEVER)
    found = planned.join(cuts, F.col("source").eqNullSafe(F.col("at_source")) & (F.col("block") == F.col("at_block")), "left")
    plan = found.select(
        F.col("source").alias("of_source"), F.col("block").alias("of_block"), "weight", "epochs", "whole", cut.alias("cut")
    )
    return staged(plan, "mix-cuts"), bits


def _earlier() -> tuple[int, int]:
    return Window.unboundedPreceding, -1


def mixture(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 42,
    entropy: float | None = None,
    max_epochs: float | None = None,
    budget: float | None = None,
    carry: list[str] | None = None,
) -> DataFrame:
    """struct `doc` of the columns `carry` (all by default), source, n_tokens,
    weight, epochs, block and copies: how often the document appears."""
    carry = docs.columns if carry is None else carry
    tagged = docs.select(
        F.struct(*carry).alias("doc"),
        F.col(source).cast("string").alias("source"),
        F.regexp_count(whole_text(text), F.lit(WORDS)).cast("long").alias("tokens"),
        document_key(F.col(id), seed).alias("key"),
    )
    rows = staged(tagged.select("source", "tokens", "key"), "mix-rows")
    weights = staged(source_weights(rows, entropy, max_epochs, budget), "mix-weights")
    plan, bits = block_plan(rows, weights, seed)
    tagged = tagged.withColumn("block", _block(F.col("key"), bits))
    return tagged.join(plan, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("block") == F.col("of_block"))).select(
        "doc",
        "source",
        F.col("tokens").alias("n_tokens"),
        "weight",
        "epochs",
        "block",
        (F.col("whole") + F.when(F.col("key") <= F.col("cut"), 1).otherwise(0)).alias("copies"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, each as often as the mixture holds it."""
    repeated = mixture(docs, **options).where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select("doc.*")
