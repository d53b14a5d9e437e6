r"""Mixing sources to target weights by Efraimidis-Spirakis sampling (operator 7).

Sizes are words (``[^\x20\x09-\x0D]+``).  Sources in code-point order (null last) get the
weights in turn and share the whole corpus's size by them; a target stops at ``MAX_EPOCHS``
times its source's size and the excess is shared again among the rest until none is above:
the level at which ``sum(min(level * weight, cap))`` is the whole, found by a few small
aggregates over the table of sources.

A target first takes complete epochs of its source, then a fraction: every document has the
key ``-ln(u) / weight`` (u from a hash of the row and the seed, weight its quality weight),
and documents are taken in ascending key order until the remaining budget is met; the
document at the edge is taken if that comes nearer to it.  The order is never built: the
span of a source's keys is cut into 1024 parts, a prefix sum over their sizes finds the one
where the budget ends, and that part is cut again until it holds at most 2000 rows, which
alone are ordered.  What results is one cut per source, so a document's decision needs its
own row and its source's cut.  A source of any size is spread over all tasks.

Edge cases: null or empty texts have size 0 and take 0; a null source is a source; rows that
repeat in id and text share a key and are taken or left together; with no words at all every
target is 0; an empty table gives no rows; extra columns are ignored (``repeated`` keeps them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from myosig.functions import broadcast_if_small
from myosig.llm.common import written
from myosig.operators.index import with_row_index

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SEED = 7
#: Parts that a pass cuts a span of keys into, and the rows at which a span is ordered instead.
BUCKETS, BUCKET_ROWS = 1024, 2000
MIN_QUALITY = 0.05


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """Share of a text's characters that are letters or white space, squared, at least ``MIN_QUALITY``."""
    share = F.length(F.regexp_replace(text, r"[^\p{L}\s]+", "")) / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.coalesce(share * share, F.lit(0.0)), F.lit(MIN_QUALITY))


def _keys(doc_id: Column, text: Column, weight: Column, seed: int) -> tuple[Column, Column]:
    """The sampling key, and the row's hash that breaks ties."""
    h = F.xxhash64(doc_id, text, F.lit(seed))
    u = (F.pmod(h, F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / weight, h


def _slim(docs: DataFrame, weight: Column | None, seed: int) -> DataFrame:
    text = F.col("text").cast("string")
    key, h = _keys(F.col("doc_id"), text, quality_weight(text) if weight is None else weight, seed)
    return docs.select(F.col("doc_id"), F.col("source").cast("string").alias("source"), words(text).alias("size"), key.alias("key"), h.alias("h"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target of every source of (source, size) rows."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_row_index(sources, [F.col("source").asc_nulls_last()], name="place")
    weight = F.get(F.array(*map(F.lit, weights)), (F.col("place") % len(weights)).cast("int"))
    table = written(ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * max_epochs).alias("cap")), "mix-sources")
    whole, level = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0], 0.0
    while True:
        full = F.col("weight") * level > F.col("cap")
        held, free = table.agg(F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0)), F.sum(F.when(~full, F.col("weight")))).first()
        raised = (whole - held) / free if free else level
        if raised <= level:
            break
        level = raised
    return table.select("source", "source_size", F.least(F.col("weight") * level, F.col("cap").cast("double")).alias("target"))


def brackets(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source with a budget: the span of keys in which it ends, and the words before that span.

    Returns source, budget, before, lo, hi, n: ``n`` rows have a key from ``lo`` to ``hi``, at most
    ``BUCKET_ROWS`` of them unless all have one key.  Each pass cuts every span into ``BUCKETS`` even
    parts and goes on with the part where the budget ends, from its least to its largest key, so it holds
    for any weights: the two ends never share a part.
    """
    span = rows.groupBy("source").agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.count(F.lit(1)).alias("n"))
    s, p = span.alias("s"), plan.where("budget > 0").alias("p")
    found = s.join(p, F.col("s.source").eqNullSafe(F.col("p.source"))).select("s.source", "p.budget", F.lit(0).cast("long").alias("before"), "s.lo", "s.hi", "s.n")
    found = written(found, "mix-spans")
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # at most BUCKETS rows
    while found.where((F.col("n") > BUCKET_ROWS) & (F.col("lo") < F.col("hi"))).limit(1).count():
        place = F.when(F.col("hi") > F.col("lo"), (F.col("key") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BUCKETS).otherwise(0.0)
        parts = _within(rows, found).withColumn("part", F.least(F.floor(place), F.lit(BUCKETS - 1)))
        parts = parts.groupBy("source", "budget", "before", "part").agg(
            F.sum("size").alias("held"), F.min("key").alias("lo"), F.max("key").alias("hi"), F.count(F.lit(1)).alias("n")
        )
        parts = parts.withColumn("before", F.col("before") + F.coalesce(F.sum("held").over(earlier), F.lit(0)))
        ends = parts.where("before < budget and before + held >= budget")
        found = written(ends.select("source", "budget", "before", "lo", "hi", "n"), "mix-spans")
    return found


def _within(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """The rows whose key lies in their source's span."""
    r, s = rows.alias("r"), broadcast_if_small(spans).alias("s")
    near = F.col("r.source").eqNullSafe(F.col("s.source")) & F.col("r.key").between(F.col("s.lo"), F.col("s.hi"))
    return r.join(s, near).select("s.source", "s.budget", "s.before", "s.lo", "s.hi", "r.size", "r.key", "r.h")


def cuts(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source: epochs, and the last (key, h) that the fractional selection takes.

    A null ``cut_h`` means only keys below ``cut_key``, a null ``cut_key`` no row.
    ``rows`` (source, size, key, h) is read several times: pass a written table.
    """
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
    plan = plan.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    edge = brackets(rows, plan)
    inside = _within(rows, edge).groupBy("source", "budget", "before", "key", "h").agg(F.sum("size").alias("size"))
    upto = F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy("key", "h"))
    # nearest: the document at the edge goes in if half of it or more is within the budget
    last = inside.withColumn("upto", upto).where("upto - size / 2 <= budget").groupBy("source").agg(F.max(F.struct("key", "h")).alias("inner"))
    p, e, last = plan.alias("p"), edge.alias("e"), last.alias("l")
    out = p.join(e, F.col("p.source").eqNullSafe(F.col("e.source")), "left").join(last, F.col("p.source").eqNullSafe(F.col("l.source")), "left")
    return out.select(
        "p.source", "p.source_size", "p.target", "p.epochs", F.coalesce("l.inner.key", "e.lo").alias("cut_key"), F.col("l.inner.h").alias("cut_h")
    )


def _decide(rows: DataFrame, cut: DataFrame) -> DataFrame:
    """Adds source_size, target and times (how often a row is taken) to rows of (source, key, h)."""
    r, c = rows.alias("r"), broadcast_if_small(cut).alias("c")
    key, last = F.col("r.key"), F.col("c.cut_key")
    taken = (key < last) | ((key == last) & (F.col("r.h") <= F.col("c.cut_h")))
    times = F.col("c.epochs") + F.coalesce(taken, F.lit(False)).cast("int")
    return r.join(c, F.col("r.source").eqNullSafe(F.col("c.source"))).select("r.*", "c.source_size", "c.target", times.alias("times"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, weight: Column | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken and times of every document."""
    rows = written(_slim(docs, weight, seed), "mix-rows")
    cut = written(cuts(rows, targets(rows, weights, max_epochs)), "mix-cuts")
    return _decide(rows, cut).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "times")


def repeated(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The mixed corpus: every document as often as it is taken, with all of its columns."""
    rows = written(_slim(docs, None, seed), "mix-rows")
    cut = written(cuts(rows, targets(rows, weights, max_epochs)), "mix-cuts")
    text = F.col("text").cast("string")
    key, h = _keys(F.col("doc_id"), text, quality_weight(text), seed)
    wrapped = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("source").cast("string").alias("source"), key.alias("key"), h.alias("h"))
    kept = _decide(wrapped, cut).where("times > 0")
    return kept.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
