"""Mixing sources to target weights: repetition rates per source, whole and hash-drawn copies.

Sources are ranked by code point, null last, and weigh 1, 2, 3, 1, 2, 3, ... They share all
words (``[^\\x20\\x09-\\x0D]+``) of the corpus by weight, but no source gets more than
``MOST_COPIES`` times its own words; what it leaves is shared by the others, by weight again.
A document is emitted floor(rate) times, and once more if its hash, as a number in [0, 1),
is below the rate's fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spanloom.operators.skew import ranged_row_number
from spanloom.staging import stage

MOST_COPIES = 3
WEIGHTS = (1, 2, 3)
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words of a text as a long, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def draw(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the seed, the id and the text alone."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), doc_id.cast("string"), text))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) from (source, size) rows; one row per source.

    Targets are the fixed point of sharing by weight under the limit: each round shares what
    the limited sources leave, and limits those that would get more. A round is one aggregate
    over the sources; only three numbers of it come to the driver.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = stage(
        sources.withColumn("_all", F.lit(0)).withColumn("_null", F.col("source").isNull()), "sources"
    )
    ranked = ranged_row_number(sources, "_all", ["_null", "source"], "_rank")
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]),
        ((F.col("_rank") - 1) % len(weights) + 1).cast("int"),
    ).cast("bigint")
    ranked = stage(ranked.select("source", "source_size", weight.alias("_weight")), "weights")
    most = MOST_COPIES * F.col("source_size")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    limited, level = -1, 0.0
    while True:
        over = F.lit(level) * F.col("_weight") > most
        used, open_weight, found = ranked.agg(
            F.sum(F.when(over, most)), F.sum(F.when(~over, F.col("_weight"))), F.count_if(over)
        ).first()
        if found == limited:
            break
        limited = found
        level = (total - (used or 0)) / open_weight if open_weight else 0.0
    over = F.lit(level) * F.col("_weight") > most
    target = F.when(over, most.cast("double")).otherwise(F.lit(level) * F.col("_weight"))
    return ranked.select("source", "source_size", target.alias("target"))


def _with_copies(rows: DataFrame, targets: DataFrame, seed: str) -> DataFrame:
    """``rows`` (with source, _draw) with source_size, target and the long _copies."""
    targets = targets.withColumnRenamed("source", "_source")
    joined = rows.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    # A source without a word costs nothing: its documents stay once.
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(1.0)
    whole = F.floor(rate)
    return joined.withColumn(
        "_copies", whole + F.when(F.col("_draw") < rate - whole, 1).otherwise(0)
    )


def mix_sizes(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """What the mix takes: doc_id, size, source_size, target, taken for every document.

    ``size`` is 0 for a null text and ``taken`` is size times copies. Null is a source like any
    other. Repeated rows draw alike, as their id and text are the same; an empty table gives
    an empty one, and a corpus without words has target 0 everywhere.
    """
    sized = stage(
        docs.select(
            "doc_id", "source", words(F.col("text")).alias("size"),
            draw(F.col("doc_id"), F.col("text"), seed).alias("_draw"),
        ),
        "sizes",
    )
    mixed = _with_copies(sized, source_targets(sized), seed)
    return mixed.select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("_copies")).alias("taken"),
    )


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mixed corpus: every document as often as it is drawn, with the columns of ``docs``.

    The columns ``doc_id``, ``text`` and ``source`` are used; others are passed through,
    whatever their names. Cases are those of ``mix_sizes``.
    """
    names = docs.columns
    sizes = docs.select("source", words(F.col("text")).alias("size"))
    targets = source_targets(sizes).select(
        F.col("source").alias("source"), "source_size", "target"
    )
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), "source",
        draw(F.col("doc_id"), F.col("text"), seed).alias("_draw"),
    )
    drawn = _with_copies(row, targets, seed).where(F.col("_copies") > 0)
    copies = F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int")))
    return drawn.select("_row", copies.alias("_copy")).select("_row.*")


ORACLE = r"""
with d as (
  select doc_id, source,
         cast(coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
         cast(('0x' || substr(md5(concat_ws(':', 'mix', cast(doc_id as varchar), text)), 1, 13)) as bigint)
           / 4503599627370496.0::double as u
  from documents),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
w as (select *, cast((row_number() over (order by source is null, source) - 1) % 3 + 1 as bigint) as weight from s),
-- Limited are the sources of the smallest size / weight, up to the first that is within its limit.
o as (select *, row_number() over (order by source_size::double / weight, source is null, source) as place, sum(3 * source_size) over p as used, sum(weight) over p as gone,
             sum(source_size) over () as total, sum(weight) over () as all_weight
      from w window p as (order by source_size::double / weight, source is null, source
                          rows between unbounded preceding and 1 preceding)),
l as (select *, (total - coalesce(used, 0)) / (all_weight - coalesce(gone, 0))::double as level from o),
c as (select coalesce(arg_min(level, place) filter (level * weight <= 3 * source_size), 0) as level from l),
t as (select w.source, w.source_size, case when c.level * w.weight > 3 * w.source_size
             then (3 * w.source_size)::double else c.level * w.weight end as target from w, c),
r as (select d.*, t.source_size, t.target, case when t.source_size > 0 then t.target / t.source_size else 1.0 end as rate
      from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, target,
       cast(size * (floor(rate) + case when u < rate - floor(rate) then 1 else 0 end) as bigint) as taken
from r
"""
