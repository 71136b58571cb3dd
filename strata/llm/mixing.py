"""Mixing sources to target weights by capped water-filling.

Each source has a weight. The mix takes ``share`` times all words; a source's
target is its weight's part of them, but at most ``epochs`` times the words it
has. What a clamped source cannot take is shared by weight among the others,
until no target is above its clamp: every target is min(clamp, level * weight)
for one level, found by raising the level until the clamped set settles.

Sampling is seeded: with a target of e times its words, a source gives floor(e)
whole repetitions of every document and, in the order of a seeded hash of id
and text, one more of some documents until the target is met. The document at
the cut gives its first words, so every source takes its target to the word.

DataFrame functions only. Per-source numbers are aggregated before anything
is ordered; a source that holds a third of all rows is one row, then at most
``BUCKETS`` rows. Only the rows of the bucket at a source's cut are ordered one
by one, by ranges, so that also copies without end of one document share tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
#: Steps of the seeded order within a source.
BUCKETS = 4096
SEED = 9


def n_words(text_col: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def draw(id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> Column:
    """A document's place in the seeded order: md5("seed:id:text") in hex. A
    null id is "null", a null text empty. Only repeated rows share a place."""
    known = F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("null"))
    return F.md5(F.concat(F.lit(f"{seed}:"), known, F.lit(":"), F.coalesce(F.col(text_col), F.lit(""))).cast("binary"))


def bucket(place: Column, buckets: int = BUCKETS) -> Column:
    """The step of the order that a place falls into: its first eight digits, modulo ``buckets``."""
    return F.conv(F.substring(place, 1, 8), 16, 10).cast("long") % buckets


def ranked(sources: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``sources`` with ``rank`` (0, 1, ...) in the given order, without
    collecting them in one task: range partitions are ranked on their own, and
    each adds the rows of those before it."""
    placed = written(sources.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()), name)
    counts = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("n"))  # one row for each partition
    before = counts.select("_pid", (F.sum("n").over(Window.orderBy("_pid")) - F.col("n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_pid").orderBy(*order)) - 1
    return placed.withColumn("_in", inside).join(before, "_pid").withColumn("rank", F.col("_in") + F.col("_before")).drop("_pid", "_in", "_before")


def cyclic_weights(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, source_col: str = "source") -> DataFrame:
    """Sources by code point, null last, with the weights repeating."""
    rows = ranked(sources, [F.col(source_col).asc_nulls_last()], "mix-sources")
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    return rows.withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")).cast("long")).drop("rank")


def water_fill(sources: DataFrame, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """``sources`` (source_size, weight) with ``target``. Empty sources and
    sources of weight 0 get 0. If all clamps together are below the share,
    every source of positive weight gets its clamp.

    Each round is one aggregation of the sources into one row: the words of
    those clamped at the present level and the weight of the rest. The level
    only rises, so the rounds end when the clamped set stays the same.
    """
    cap = F.col("source_size") * epochs
    usable = F.col("weight") > 0
    level, clamped_before = 0.0, None
    while True:
        clamped = usable & (cap <= F.lit(level) * F.col("weight"))
        x = sources.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(clamped, cap)).alias("full"), F.count(F.when(clamped, 1)).alias("n"),
            F.sum(F.when(usable & ~clamped, F.col("weight"))).alias("weight"),
        ).first()
        rest = (x["all"] or 0) * share - (x["full"] or 0)
        if not x["weight"] or rest <= 0 or x["n"] == clamped_before:
            break
        level, clamped_before = rest / x["weight"], x["n"]
    if not x["weight"]:  # all are clamped
        return sources.withColumn("target", F.when(usable, cap.cast("double")).otherwise(0.0))
    target = F.least(cap.cast("double"), F.lit(level) * F.col("weight"))
    return sources.withColumn("target", F.when(usable, target).otherwise(0.0))


def words_before(rows: DataFrame, source: str, place: str, size: str) -> DataFrame:
    """``rows`` with ``_llm_before``: the words of the rows before each in its
    source, by place; copies in any order. Range partitions sum up on their own,
    and each adds what earlier ones hold of its first source."""
    order = [F.col(source).asc_nulls_first(), F.col(place), F.col("_llm_copy")]
    single = written(rows.withColumn("_llm_copy", F.monotonically_increasing_id()), "mix-cut")  # copies of one document are dealt out
    placed = written(single.repartitionByRange(*order).withColumn("_llm_pid", F.spark_partition_id()), "mix-cut-order")
    held = placed.groupBy(source, "_llm_pid").agg(F.sum(size).alias("n"))  # few rows: a source and a partition
    earlier = Window.partitionBy(source).orderBy("_llm_pid").rowsBetween(Window.unboundedPreceding, -1)
    bases = held.select(F.col(source).alias("_llm_s"), F.col("_llm_pid").alias("_llm_p"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_llm_base"))
    inside = Window.partitionBy(source, "_llm_pid").orderBy(place, "_llm_copy").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("_llm_in", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    out = summed.join(bases, F.col(source).eqNullSafe(F.col("_llm_s")) & (F.col("_llm_pid") == F.col("_llm_p")))
    return out.withColumn("_llm_before", F.col("_llm_in") + F.col("_llm_base")).drop("_llm_in", "_llm_base", "_llm_s", "_llm_p", "_llm_pid", "_llm_copy")


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: int = SEED,
) -> DataFrame:
    """``(doc_id, source, size, place, source_size, target, whole, taken)`` for every row.

    ``taken`` counts words, repeats included: ``whole`` repetitions and, where
    the seeded order says so, a further one or, for one row of a source, a part
    of one. Null and empty texts have size 0 and give 0; a null source is a
    source like any other. Null ids and repeated ids are told apart by their
    texts; which of several equal rows gives more is arbitrary, the amounts are
    not. An empty table gives no rows. Other columns are not read.
    """
    rows = written(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), n_words(text_col).alias("size"),
            draw(id_col, text_col, seed).alias("place"),
        ),
        "mix-sizes",
    )
    steps = rows.groupBy("source", bucket(F.col("place")).alias("b")).agg(F.sum("size").alias("words"))
    sources = steps.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = written(water_fill(written(cyclic_weights(sources, weights), "mix-weights"), share, epochs), "mix-targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("whole", whole).withColumn("extra", F.floor(F.col("target") - F.col("whole") * F.col("source_size")).cast("long"))
    by_source = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    cuts = written(
        steps.withColumnRenamed("source", "s")
        .withColumn("earlier", F.coalesce(F.sum("words").over(by_source), F.lit(0)))
        .join(targets, F.col("s").eqNullSafe(F.col("source")))
        .withColumn("left", F.col("extra") - F.col("earlier"))
        .select("s", "b", "words", "left", "source_size", "target", "whole"),
        "mix-steps",
    )
    placed = rows.withColumn("_b", bucket(F.col("place"))).join(cuts, F.col("source").eqNullSafe(F.col("s")) & (F.col("_b") == F.col("b")))
    at_cut = (F.col("left") > 0) & (F.col("left") < F.col("words"))  # one bucket of a source at most
    plain = placed.filter(~at_cut).withColumn("more", F.when(F.col("left") > 0, F.col("size")).otherwise(F.lit(0).cast("long")))
    cut = words_before(placed.filter(at_cut), "source", "place", "size")
    cut = cut.withColumn("more", F.least("size", F.greatest(F.lit(0).cast("long"), F.col("left") - F.col("_llm_before"))))
    names = ["doc_id", "source", "size", "place", "source_size", "target", "whole"]
    return plain.unionByName(cut.drop("_llm_before")).select(*names, (F.col("whole") * F.col("size") + F.col("more")).alias("taken"))


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", n_chars_col: str = "n_chars", seed: int = SEED, **options
) -> DataFrame:
    """The mix itself, with the columns of ``docs``: every document as often as
    it is taken whole, then once more with its first words if a part is taken.

    A document taken 0 times goes. The whole repetitions keep the text as it
    is; a part ends after its last word taken. ``n_chars``, if there is such a
    column, follows the text. Columns of ``docs`` whose names begin with
    ``_llm_`` are in the way and raise.
    """
    names = docs.columns
    if any(c.startswith("_llm_") for c in names):
        raise ValueError("columns beginning with _llm_ are used inside")
    # Equal rows of a source take alike, but for those that the cut goes through: one group of a source.
    taken = mix(docs, id_col, text_col, source_col, seed=seed, **options).groupBy("source", "place").agg(
        F.min("taken").alias("_llm_low"), F.max("taken").alias("_llm_high"), F.sum("taken").alias("_llm_sum"), F.count(F.lit(1)).alias("_llm_n"),
        F.max("whole").alias("_llm_whole"),
    )
    taken = written(taken.withColumnsRenamed({"source": "_llm_source", "place": "_llm_place"}), "mix-taken")
    sized = docs.withColumn("_llm_size", n_words(text_col)).withColumn("_llm_at", draw(id_col, text_col, seed))
    of = F.col(source_col).cast("string").eqNullSafe(F.col("_llm_source")) & (F.col("_llm_at") == F.col("_llm_place"))
    alike = sized.join(taken.filter("_llm_low = _llm_high"), of).withColumn("_llm_taken", F.col("_llm_low"))
    # Written on their own, so that Spark sees how few they are and the texts need not be dealt for them.
    cut = sized.join(written(taken.filter("_llm_low < _llm_high"), "mix-taken-cut"), of)
    # Of n equal rows some take one more, one a part: they are counted off, by the words before them.
    numbered = words_before(cut, "_llm_source", "_llm_place", "_llm_size")
    extra = F.col("_llm_sum") - F.col("_llm_n") * F.col("_llm_whole") * F.col("_llm_size")
    more = F.least("_llm_size", F.greatest(F.lit(0).cast("long"), extra - F.col("_llm_before")))
    numbered = numbered.withColumn("_llm_taken", F.col("_llm_whole") * F.col("_llm_size") + more).select(*alike.columns)
    rows = alike.unionByName(numbered)
    times = F.expr("CASE WHEN _llm_size > 0 THEN _llm_taken div _llm_size ELSE 0 END")
    part = F.expr("CASE WHEN _llm_size > 0 THEN _llm_taken % _llm_size ELSE 0 END")
    rows = rows.withColumn("_llm_part", part).withColumn(
        "_llm_take", F.explode(F.concat(F.array_repeat(F.lit(0).cast("long"), times.cast("int")), F.when(F.col("_llm_part") > 0, F.array("_llm_part")).otherwise(F.array().cast("array<bigint>"))))
    )
    ends = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"  # a piece is a word with the blanks before it
    cut = F.array_join(F.slice(F.split(F.col(text_col), ends), F.lit(1), F.col("_llm_take").cast("int")), "")
    first = F.when(F.col("_llm_take") > 0, cut).otherwise(F.col(text_col))
    new = {text_col: first}
    if n_chars_col in names:
        new[n_chars_col] = F.when(F.col("_llm_take") > 0, F.length(first)).otherwise(F.col(n_chars_col)).cast(docs.schema[n_chars_col].dataType)
    return rows.select(*[new[c].alias(c) if c in new else F.col(c) for c in names])


#: DuckDB SQL for the contract's query. The level of the water is solved from
#: the sources in the order of clamp by weight.
SQL = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(text, '')) AS place
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER]::BIGINT AS weight
  FROM d GROUP BY source
), o AS (
  SELECT *, (SELECT sum(source_size) FROM s)::DOUBLE * 1.5 AS mix,
    coalesce(sum(2 * source_size) OVER w, 0)::BIGINT AS full_before, (sum(weight) OVER ()) - coalesce(sum(weight) OVER w, 0) AS weight_left
  FROM s WINDOW w AS (ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT max((mix - full_before) / weight_left::DOUBLE) AS level FROM o
), t AS (
  SELECT source, source_size, least((2 * source_size)::DOUBLE, level * weight) AS target FROM s, l
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t
), r AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY ('0x' || substr(place, 1, 8))::BIGINT % {BUCKETS}, place, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM d
)
SELECT doc_id, size, source_size, target, (whole * size + least(size, greatest(0, floor(target - whole * source_size)::BIGINT - before)))::BIGINT AS taken
FROM r JOIN e ON r.source IS NOT DISTINCT FROM e.source
"""
