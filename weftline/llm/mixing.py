"""Mixing sources to target weights that change over training time.

Time runs from 0 to 1.  Each source has a weight at each of the knots, linear in between, and the weights of all
sources add up to 1 at every knot, hence always.  The integral D(t) of a source's weight is its demand up to t as a
share of the token budget.  A source supplies its documents in a hashed order, again and again if demand exceeds
supply; the document that begins at token c of that supply trains at the t where budget * D(t) = c, a quadratic in
closed form within each segment between knots.

``budget=None`` takes the least budget at which every document trains at least once (so nothing is lost, and
sources rarer than their weight repeat); a smaller number drops what no demand reaches.

Running token counts use two levels, so that a source holding most of the corpus needs no single task: sums by
(source, bucket of the hashed id), a running sum over buckets, and one within each bucket.

Defined results: NULL texts count as empty and documents of no token as 1 token; a NULL source is the source '';
rows that agree in id, source and tokens are separate documents, numbered and hashed one by one, and NULL ids count as '', so
that neither fills a bucket; ties in position go by source, id, epoch; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import ship, stored

KNOTS = (0.0, 0.5, 1.0)
DIGITS = 3  # hex digits of the hashed id: buckets of a source


def temperature(supply: Column) -> list[Column]:
    """Raw weights at KNOTS: in proportion to supply first, to its square root at the end."""
    return [supply, F.sqrt(supply * F.sqrt(supply)), F.sqrt(supply)]


def demands(supply: DataFrame, knots=KNOTS, raw=temperature) -> DataFrame:
    """``source, supply, w, cum``: normalised weights at the knots, and demand up to each knot; one row for each source."""
    weights = raw(F.col("supply").cast("double"))
    every = Window.partitionBy()
    flat = supply.select("source", "supply", *[w.alias(f"r{i}") for i, w in enumerate(weights)])
    flat = flat.select("source", "supply", *[(F.col(f"r{i}") / F.sum(f"r{i}").over(every)).alias(f"w{i}") for i in range(len(knots))])
    cum: list[Column] = [F.lit(0.0)]
    for i in range(1, len(knots)):
        cum.append(cum[-1] + (F.col(f"w{i - 1}") + F.col(f"w{i}")) * F.lit((knots[i] - knots[i - 1]) / 2))
    return flat.select("source", "supply", F.array(*[f"w{i}" for i in range(len(knots))]).alias("w"), F.array(*cum).alias("cum"))


def invert(share: Column, knots=KNOTS) -> Column:
    """The time at which demand reaches ``share``, from columns ``w`` and ``cum``."""
    out = None
    for i in reversed(range(len(knots) - 1)):
        w0, w1, h = F.col("w")[i], F.col("w")[i + 1], knots[i + 1] - knots[i]
        r = share - F.col("cum")[i]
        root = F.sqrt(F.greatest(w0 * w0 + r * (w1 - w0) * F.lit(2 / h), F.lit(0.0)))
        t = F.least(F.lit(knots[i]) + F.when(r > 0, r * 2 / (w0 + root)).otherwise(0.0), F.lit(knots[i + 1]))
        out = t if out is None else F.when(share < F.col("cum")[i + 1], t).otherwise(out)
    return out


def schedule(docs: DataFrame, budget: float | None = None, knots=KNOTS, raw=temperature, digits: int = DIGITS) -> DataFrame:
    """``doc_id, source, tokens, epoch, position`` in training order: a row each time that a document trains."""
    ship(docs.sparkSession)
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.when(F.col("copy") > 0, F.concat(F.lit(":"), F.col("copy").cast("string"))).otherwise("")))
    count = F.greatest(F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0)), F.lit(1)).cast("long")
    slim = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), count.alias("tokens")).groupBy("doc_id", "source", "tokens").agg(F.count("*").cast("int").alias("n"))
    slim = slim.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select("doc_id", "source", "tokens", key.alias("key"))
    slim = stored(slim.withColumn("bucket", F.substring("key", 1, digits)))
    sums = slim.groupBy("source", "bucket").agg(F.sum("tokens").alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = stored(sums.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))))
    supply = sums.groupBy("source").agg(F.sum("n").alias("supply"))
    plan = demands(supply, knots, raw)
    last = F.col("cum")[len(knots) - 1]
    total = F.lit(float(budget)) if budget is not None else F.max(F.col("supply") / last).over(Window.partitionBy())
    plan = plan.withColumn("budget", total)
    inside = Window.partitionBy("source", "bucket").orderBy("key", F.asc_nulls_last("doc_id"), "tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = slim.withColumn("c", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(sums.select("source", "bucket", "base"), ["source", "bucket"])
    placed = placed.join(plan, "source").withColumn("c", (F.col("c") + F.col("base")).cast("double"))
    times = F.ceil((F.col("budget") * last - 0.5 - F.col("c")) / F.col("supply"))
    placed = placed.where(times > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), (times - 1).cast("int"))))
    position = F.round(invert((F.col("epoch") * F.col("supply") + F.col("c")) / F.col("budget"), knots), 9)
    return placed.select("doc_id", "source", "tokens", "epoch", position.alias("position")).orderBy("position", "source", F.asc_nulls_last("doc_id"), "epoch")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents in training order, each as often as it trains; columns as they came.

    Rows are matched to the schedule by (doc_id, source, tokens); rows that agree in all three train together,
    at the first position of any of them.
    """
    count = F.greatest(F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0)), F.lit(1)).cast("long")
    tag = docs.withColumns({"__s": F.coalesce("source", F.lit("")), "__t": count, "__i": F.col("doc_id")})
    plan = schedule(docs, **options).groupBy("doc_id", "source", "tokens", "epoch").agg(F.min("position").alias("__p"))
    plan = plan.select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("tokens").alias("__tokens"), F.col("epoch").alias("__e"), "__p")
    on = F.col("__i").eqNullSafe(F.col("__id")) & (F.col("__s") == F.col("__source")) & (F.col("__t") == F.col("__tokens"))
    return tag.join(plan, on).orderBy("__p", "__s", F.asc_nulls_last("__i"), "__e").select(*docs.columns)
