"""Mixing sources to target weights.

Tokens are aggregated per source, each source's target follows from its weight, and its repetition
rate is target / size.  A document is emitted floor(rate) times, plus one copy with probability equal
to the fraction, decided by a hash of its id: reruns and lost executors change nothing.  Which slice
of the hash a source uses is chosen once, so that even a small source comes near its target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.common import WORD, materialise

WEIGHTS = (5, 2, 1)       # of the sources by code point, repeating
MAX_RATE = 3              # no source is repeated more often than this
MAX_BROADCAST_SOURCES = 20_000
SALTS = 64
DRAWS = 16                # hash slices to choose from, four to a hash


def n_words(column: str = "text"):
    """Words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """(source, source_size, target) from (source, size) rows; NULL is a source of its own, the last.

    Targets share the total size by weight; a source whose share exceeds ``max_rate`` times its size
    stops there and the excess goes to the others by weight, until none is above.  That fixed point
    is min(max_rate * size, level * weight): with the sources ordered by size / weight, the stopped
    ones are a prefix, and the level is (total - max_rate * their sizes) / (weight of the others).
    The windows run over one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumn("at", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("at") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight.cast("long"))
    everything = Window.partitionBy()
    first = Window.orderBy(F.col("source_size") / F.col("weight"), "at").rowsBetween(Window.unboundedPreceding, -1)
    stopped, gone = F.coalesce(F.sum("source_size").over(first), F.lit(0)), F.coalesce(F.sum("weight").over(first), F.lit(0))
    # level if exactly the sources before this one stop; it is the right one at the first source not reaching its limit
    level = (F.sum("source_size").over(everything) - max_rate * stopped) / (F.sum("weight").over(everything) - gone)
    levels = ranked.withColumn("level", level)
    fits = F.col("level") * F.col("weight") <= max_rate * F.col("source_size")
    final = F.first(F.when(fits, F.col("level")), ignorenulls=True).over(
        Window.orderBy(F.col("source_size") / F.col("weight"), "at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    limit = (max_rate * F.col("source_size")).cast("double")
    return (levels.withColumn("final", final)
            .select("source", "source_size", F.least(limit, F.coalesce(F.col("final") * F.col("weight"), limit)).alias("target")))


def _with_targets(docs: DataFrame, plan: DataFrame, source: str, key: str = "doc_id") -> DataFrame:
    """``docs`` joined null-safely to its source's row: a broadcast of checked size, else a salted join."""
    if plan.count() <= MAX_BROADCAST_SOURCES:
        return docs.join(F.broadcast(plan), docs[source].eqNullSafe(plan["source_"]))
    salted = docs.withColumn("salt_", F.pmod(F.xxhash64(key), F.lit(SALTS)))
    copies = plan.withColumn("plan_salt_", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(copies.hint("merge"), salted[source].eqNullSafe(copies["source_"]) & (F.col("salt_") == F.col("plan_salt_")))


def draws(id_column) -> list:
    """``DRAWS`` numbers in [0, 1) per id, each a slice of a hash of it (NULL hashes as the empty text)."""
    text = F.coalesce(id_column.cast("string"), F.lit(""))
    hashes = [F.md5(F.concat(F.lit(f"mix {k}:"), text)) for k in range(DRAWS // 4)]
    return [F.conv(F.substring(h, 8 * j + 1, 8), 16, 10).cast("double") / F.lit(4294967296.0) for h in hashes for j in range(4)]


def _rate(size, target):
    return F.when(size > 0, target / size).otherwise(F.lit(0.0))


def plan_sources(sizes: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """(source_, source_size_, target_, draw_): one row per source, as a written table.

    Any of the ``DRAWS`` hash slices is a fair Bernoulli draw; ``draw_`` is the one with which the
    source's taken words come nearest its target (the first of equals).
    """
    targets = source_targets(sizes, weights, max_rate).toDF("source_", "source_size_", "target_")
    joined = _with_targets(sizes, materialise(targets, "mix-targets"), "source")
    rate = _rate(F.col("source_size_"), F.col("target_"))
    extra = [F.sum(F.when(u < rate - F.floor(rate), F.col("size")).otherwise(0)) for u in draws(F.col("doc_id"))]
    base = F.sum(F.floor(rate) * F.col("size"))
    sums = joined.groupBy("source_", "source_size_", "target_").agg(F.array(*[F.abs(base + e - F.first("target_")) for e in extra]).alias("off"))
    return materialise(sums.select("source_", "source_size_", "target_",
                                   (F.array_position("off", F.array_min("off")) - 1).cast("int").alias("draw_")), "mix-plan")


def copies_column(id_column):
    """Times a document is emitted: floor(rate) plus a Bernoulli copy for the fraction."""
    rate = _rate(F.col("source_size_"), F.col("target_"))
    u = F.element_at(F.array(*draws(id_column)), F.col("draw_") + 1)
    return (F.floor(rate) + F.when(u < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def plan_mix(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) of every row; reads the texts once.

    Sizes are written as a narrow table first, as they are needed for the totals and again per row.
    An empty or NULL text has size 0 and takes none; repeated rows of an id share its decision.
    """
    sizes = materialise(docs.select("doc_id", "source", n_words().alias("size")), "mix-sizes")
    joined = _with_targets(sizes, plan_sources(sizes), "source").withColumn("copies", copies_column(F.col("doc_id")))
    return joined.select("doc_id", "size", F.col("source_size_").alias("source_size"), F.col("target_").alias("target"), "copies",
                         (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it, all columns kept."""
    sizes = materialise(docs.select("doc_id", "source", n_words().alias("size")), "mix-sizes")
    wanted = docs.columns
    clear = docs.toDF(*[f"c{i}" for i in range(len(wanted))])     # input names cannot clash with the plan's
    key, source = f"c{wanted.index('doc_id')}", f"c{wanted.index('source')}"
    joined = _with_targets(clear, plan_sources(sizes), source, key).withColumn("copies_", copies_column(F.col(key)))
    copies = joined.where("copies_ > 0").withColumn("copy_", F.explode(F.sequence(F.lit(1).cast("long"), "copies_")))
    return copies.select(*clear.columns).toDF(*wanted)


#: The same plan in DuckDB.
PLAN_SQL = rf"""
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
ranked AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sizes GROUP BY source),
weighted AS (SELECT *, {list(WEIGHTS)}[place % {len(WEIGHTS)} + 1] AS weight FROM ranked),
levels AS (
  SELECT *, (sum(source_size) OVER () - {MAX_RATE} * coalesce(sum(source_size) OVER lower_ones, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER lower_ones, 0)) AS level
  FROM weighted
  WINDOW lower_ones AS (ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(CAST({MAX_RATE} * source_size AS DOUBLE), coalesce(
           (SELECT level FROM levels WHERE level * weight <= {MAX_RATE} * source_size ORDER BY source_size / weight, place LIMIT 1) * weight,
           CAST({MAX_RATE} * source_size AS DOUBLE))) AS target
  FROM levels),
drawn AS (
  SELECT s.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate, slice,
         CAST('0x' || substr(md5('mix ' || (slice // 4) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), 8 * (slice % 4) + 1, 8) AS BIGINT)
           / 4294967296.0 AS u
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source, range({DRAWS}) r(slice)),
copied AS (SELECT *, CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS copies FROM drawn),
chosen AS (
  SELECT source, slice FROM (SELECT source, slice, abs(sum(copies * size) - any_value(target)) AS off FROM copied GROUP BY source, slice)
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY off, slice) = 1)
SELECT doc_id, size, source_size, target, copies * size AS taken
FROM copied c JOIN chosen h ON c.source IS NOT DISTINCT FROM h.source AND c.slice = h.slice
"""
