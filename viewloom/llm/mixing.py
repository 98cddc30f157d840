"""Mixing sources to target weights by Pareto order sampling.

Targets per source come from weights that repeat in the order of the sources, with a limit on how often
a source may be repeated; what a limit leaves over is shared again by weight. Every document
gets the certain whole copies of its source, and the rest of the target is drawn with unequal probabilities: a document's
inclusion probability is its weight (its size, unless a propensity is given) times one factor per source, at most 1, such
that the words to be expected are those of the rest. Documents are ranked by random odds divided by inclusion odds, and taken
in this order up to the source's remaining words.

Ranks are never computed by one task per source. Order values are dealt into ``BUCKETS`` ranges, their
sums per range give the range where the target is met, and only that range is ordered in full. Documents
that are too long for what is left are passed over, and further rounds of the same kind follow until no document fits.
Everything is built-in expressions; random numbers are hashes, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewloom.session import cut_lineage

BUCKETS = 4096
#: Rounds of the comparison SQL, more than the given tables take; a round without documents changes nothing.
SQL_ROUNDS = 14


def word_count(text: Column) -> Column:
    """Runs of anything but blanks and the codes 9 to 13; none in a null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def random_unit(seed: int, *ids: Column) -> Column:
    """A number strictly between 0 and 1 from 52 bits of a hash; a null id counts as the empty text."""
    key = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(i.cast("string"), F.lit("")) for i in ids])
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("bigint") + 0.5) / float(1 << 52)


def source_targets(sized: DataFrame, source: str, weights: tuple[int, ...], budget: float, max_repeats: int) -> DataFrame:
    """(source, source_size, target): one row per source; ``sized`` has the column ``size``.

    The table has one row per source, so its windows need no partitions.
    """
    sums = sized.groupBy(F.col(source).alias("source")).agg(F.sum("size").alias("source_size"))
    nth = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("nth") - 1, F.lit(len(weights))) + 1).cast("int"))
    whole = Window.partitionBy(F.lit(0))
    listed = (
        sums.withColumn("nth", nth)
        .withColumn("weight", weight.cast("bigint"))
        .withColumn("total", F.sum("source_size").over(whole))
        .withColumn("full", F.col("source_size") * max_repeats)
        .withColumn("level", F.col("full") / F.col("weight"))
    )
    # Sources reach their limit in the order of ``level``; the rest shares what they leave.
    order = Window.partitionBy(F.lit(0)).orderBy("level", "nth")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("total") * budget - F.coalesce(F.sum("full").over(before), F.lit(0))
    shared = listed.withColumn("share", left / F.sum("weight").over(after))
    first = F.min(F.when(F.col("share") <= F.col("level"), F.struct("level", "nth", "share"))).over(whole)
    limited = F.least(F.col("full").cast("double"), F.col("weight") * F.col("first.share"))
    return shared.withColumn("first", first).select(
        "source", "source_size", F.coalesce(limited, F.col("full").cast("double")).alias("target")
    )


def _to_source(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Join a table with a row per source; no hint, so Spark checks its size. Null matches null."""
    renamed = table.withColumnRenamed("source", "_s")
    return rows.join(renamed, rows["source"].eqNullSafe(renamed["_s"])).drop("_s")


def _drawn(nth: int) -> Column:
    """Whether round ``nth`` takes the row."""
    past = F.col(f"cross_{nth}").isNull() | (F.col("bucket") < F.col(f"cross_{nth}"))
    here = (F.col("bucket") == F.col(f"cross_{nth}")) & (F.col("odds") <= F.col(f"cut_{nth}"))
    return (F.col("size") > 0) & (F.col("size") <= F.col(f"left_{nth}")) & F.coalesce(past | here, F.lit(False))


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (print, part and more) with ``nth``: equal prints numbered from 1, each part by itself and then part after part."""
    counts = rows.groupBy("print", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("print").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("print", "part", F.coalesce(before, F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("print", "part").orderBy(F.lit(0)))
    return rows.withColumn("nth", within).join(offsets, ["print", "part"]).withColumn("nth", F.col("nth") + F.col("offset"))


def _lucky(sized: DataFrame, seed: int) -> DataFrame:
    """``sized`` (_doc, source, key, size, weight, mark) with ``luck``: random odds, other ones for every row.

    A key that stands once in its source gives the random number itself. Rows that share theirs get numbers by the key, their
    text's fingerprint ``mark`` and, for equal ones, a count; which of the equal rows has which count makes no difference.
    """

    def luck(*ids: Column) -> Column:
        u = random_unit(seed, *ids)
        return (u / (1 - u)).alias("luck")

    shared = cut_lineage(sized.groupBy("source", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("source", "key"))
    columns = ["_doc", "source", "size", "weight"]
    if shared.isEmpty():
        return sized.select(*columns, luck(F.col("key")))
    s = shared.select(F.col("source").alias("_s"), F.col("key").alias("_k"))
    same = sized["source"].eqNullSafe(s["_s"]) & (sized["key"] == s["_k"])
    alone = sized.join(s, same, "left_anti").select(*columns, luck(F.col("key")))
    whole = F.md5(F.concat_ws("|", F.coalesce("source", F.lit("")), "key", "mark"))
    tied = cut_lineage(sized.withColumn("part", F.spark_partition_id()).join(s, same, "left_semi").withColumn("print", whole))
    return alone.unionByName(_numbered(tied).select(*columns, luck(F.col("key"), F.col("print"), F.col("nth"))))


def _factors(rows: DataFrame, state: DataFrame) -> DataFrame:
    """(source, factor): a document's inclusion probability is its weight times the factor, at most 1.

    With it, sizes times probabilities add up to what is left of the source; null stands for no bound, where all documents fit.
    Every step finds the documents that are certain by now and shares the rest among the others; it ends when no step changes
    a factor, after as many steps as there are levels of certainty, usually two or three.
    """
    free = _to_source(rows, state.select("source", "left_0")).where((F.col("size") > 0) & (F.col("size") <= F.col("left_0")))
    sums = [F.sum(F.col("size") * F.col("weight")).alias("rest"), F.lit(0.0).alias("sure"), F.first("left_0").alias("left")]
    factors = None
    while True:
        # The sums are a row per source.
        table = cut_lineage(
            free.groupBy("source").agg(*sums).select("source", F.when(F.col("rest") > 0, (F.col("left") - F.col("sure")) / F.col("rest")).alias("factor"))
        )
        if factors is not None:
            old = factors.select(F.col("source").alias("_o"), F.col("factor").alias("old"))
            if table.join(old, table["source"].eqNullSafe(old["_o"])).where(~F.col("factor").eqNullSafe(F.col("old"))).isEmpty():
                return table
        factors = table
        free = _to_source(free.drop("factor"), table)
        certain = F.coalesce(F.col("factor") * F.col("weight") >= 1, F.lit(True))
        sums = [
            F.sum(F.when(certain, 0.0).otherwise(F.col("size") * F.col("weight"))).alias("rest"),
            F.sum(F.when(certain, F.col("size")).otherwise(0)).cast("double").alias("sure"),
            F.first("left_0").alias("left"),
        ]


def _order(factor: Column) -> Column:
    """Random odds over inclusion odds; documents that are certain come first."""
    chance = F.coalesce(F.least(F.col("weight") * factor, F.lit(1.0)), F.lit(1.0))
    return F.when(chance >= 1, 0.0).otherwise(F.col("luck") * (1 - chance) / F.greatest(chance, F.lit(1e-300)))


def _any_drawn(rounds: int) -> Column:
    out = F.lit(False)
    for nth in range(rounds):
        out = out | _drawn(nth)
    return out


def started(targets: DataFrame) -> DataFrame:
    """A row per source with its certain copies and what is left for the draw."""
    per_copy = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    state = targets.withColumn("certain", per_copy.cast("bigint"))
    return cut_lineage(state.withColumn("left_0", F.col("target") - F.col("certain") * F.col("source_size")))


def draw(rows: DataFrame, state: DataFrame) -> tuple[DataFrame, int]:
    """``state`` with the limits of every round, and the number of rounds; ``rows`` has source, size, bucket and odds.

    A round takes at least the first document that fits, so the rounds end.
    """
    nth = 0
    while True:
        left = F.col(f"left_{nth}")
        free = _to_source(rows, state).where((F.col("size") > 0) & (F.col("size") <= left) & ~_any_drawn(nth))
        ranges = free.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.first(left).alias("left"))
        summed = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
        met = ranges.withColumn("reached", summed).groupBy("source").agg(
            F.min(F.when(F.col("reached") > F.col("left"), F.struct("bucket", (F.col("reached") - F.col("words")).alias("before")))).alias("met"),
            F.max("reached").alias("all"),
        )
        met = cut_lineage(met.select("source", F.col("met.bucket").alias("cross"), F.col("met.before").alias("before"), "all"))
        if met.isEmpty():
            return state, nth
        # Only the range where the target is met is put in order; equal order values go together.
        near = _to_source(free, met).where(F.col("bucket") == F.col("cross"))
        equal = near.groupBy("source", "odds").agg(F.sum("size").alias("words"), F.first(left).alias("left"), F.first("before").alias("before"))
        running = F.sum("words").over(Window.partitionBy("source").orderBy("odds")) + F.col("before")
        cuts = (
            equal.withColumn("reached", running)
            .where(F.col("reached") <= F.col("left"))
            .groupBy("source")
            .agg(F.max("odds").alias("cut"), F.max("reached").alias("taken"))
        )
        m, c = met.withColumnRenamed("source", "_m"), cuts.withColumnRenamed("source", "_c")
        joined = state.join(m, state["source"].eqNullSafe(m["_m"]), "left").join(c, state["source"].eqNullSafe(c["_c"]), "left")
        words = F.when(F.col("cross").isNull(), F.coalesce("all", F.lit(0))).otherwise(F.coalesce("taken", "before"))
        state = cut_lineage(
            joined.select(
                *state.columns,
                F.col("cross").alias(f"cross_{nth}"),
                F.col("cut").alias(f"cut_{nth}"),
                (left - words).alias(f"left_{nth + 1}"),
            )
        )
        nth += 1
        # Rows of one order value that together are too long would be met again and again.
        if state.where(F.col(f"left_{nth}") < F.col(f"left_{nth - 1}")).isEmpty():
            return state, nth


def mixture(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights: tuple[int, ...] = (1, 2, 3),
    budget: float = 1.0,
    max_repeats: int = 3,
    propensity: Column | None = None,
    seed: int = 42,
) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken (size times copies).

    Sources in code point order, null last, get ``weights`` in turn and share ``budget`` times all words; a target
    is at most ``max_repeats`` times its source. Documents of one source are drawn with probabilities in proportion to
    ``propensity`` (positive), to their sizes without one. Documents without words are not drawn: they get the certain
    copies, of no words.
    Rows that share key and source are drawn one by one, each by a place of its own. Columns of ``docs`` with the names
    of results are replaced.
    """
    sized = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("_doc"),
        F.col(source).alias("source"),
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"),
        word_count(F.col(text)).alias("size"),
        (word_count(F.col(text)).cast("double") if propensity is None else F.greatest(propensity.cast("double"), F.lit(1e-9))).alias("weight"),
        F.md5(F.coalesce(F.col(text), F.lit(""))).alias("mark"),
    )
    full = _lucky(sized, seed)
    rows = cut_lineage(full.drop("_doc"))
    state = started(source_targets(rows, "source", weights, budget, max_repeats))
    factors = _factors(rows, state)
    known = factors.select(F.col("source").alias("_f"), "factor")
    state = cut_lineage(state.join(known, state["source"].eqNullSafe(known["_f"]), "left").drop("_f"))
    bucket = F.least(F.floor(BUCKETS * (F.col("odds") / (1 + F.col("odds")))), F.lit(BUCKETS - 1)).cast("int")

    def ordered(frame: DataFrame) -> DataFrame:
        joined = _to_source(frame, state.select("source", "factor")).withColumn("odds", _order(F.col("factor")))
        return joined.drop("factor", "luck", "weight").withColumn("bucket", bucket)

    state, rounds = draw(cut_lineage(ordered(rows)), state)
    copies = F.col("certain") + _any_drawn(rounds).cast("bigint")
    placed = _to_source(ordered(full), state).select("_doc", "size", "source_size", "target", copies.alias("copies"))
    own = [F.col("_doc").getField(c).alias(c) for c in docs.columns if c not in ("size", "source_size", "target", "copies", "taken")]
    return placed.select(*own, "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", **options) -> DataFrame:
    """Every document as often as the mix takes it, with its own columns and ``copy`` from 1, which replaces one of that name."""
    own = F.struct(*[F.col(c) for c in docs.columns]).alias("_mixed")
    rows = docs.select(own, F.col(text).alias("_words"), F.col(source).alias("_from"), F.col(key).alias("_name"))
    taken = mixture(rows, "_words", "_from", "_name", **options).where(F.col("copies") > 0)
    each = taken.select("_mixed", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"))
    return each.select(*[F.col("_mixed").getField(c).alias(c) for c in docs.columns if c != "copy"], F.col("_copy").alias("copy"))


def mixture_sql(documents: str, extra: str = "") -> str:
    """DuckDB SQL of ``mixture`` with its default options over a table: the rule itself, without ranges."""
    rounds = []
    for nth in range(SQL_ROUNDS):
        before = "ranked" if nth == 0 else f"round_{nth - 1}"
        rounds.append(
            f"""
run_{nth} AS MATERIALIZED (
  SELECT r, sum(size) OVER (PARTITION BY source ORDER BY odds RANGE UNBOUNDED PRECEDING) AS reached
  FROM {before} WHERE NOT drawn AND size > 0 AND size <= remaining
),
new_{nth} AS MATERIALIZED (
  SELECT b.*, coalesce(run_{nth}.reached <= b.remaining, false) AS now FROM {before} b LEFT JOIN run_{nth} USING (r)
),
round_{nth} AS MATERIALIZED (
  SELECT * EXCLUDE (now) REPLACE (drawn OR now AS drawn,
    remaining - sum(CASE WHEN now THEN size ELSE 0 END) OVER (PARTITION BY source) AS remaining)
  FROM new_{nth}
)"""
        )
    return f"""
sized AS (
  SELECT row_number() OVER () AS r, *, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size
  FROM {documents}
),
sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source ASC NULLS LAST) AS nth
  FROM sized GROUP BY source
),
listed AS (
  SELECT *, (nth - 1) % 3 + 1 AS weight, sum(source_size) OVER () AS total, 3 * source_size AS full_size,
    CAST(3 * source_size AS DOUBLE) / ((nth - 1) % 3 + 1) AS level
  FROM sums
),
shared AS (
  SELECT *, CAST(total - coalesce(sum(full_size) OVER (ORDER BY level, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / sum(weight) OVER (ORDER BY level, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM listed
),
targets AS (
  SELECT source, source_size,
    coalesce(least(CAST(full_size AS DOUBLE),
      weight * (SELECT arg_min(share, (level, nth)) FROM shared WHERE share <= level)), CAST(full_size AS DOUBLE)) AS target
  FROM shared
),
started AS MATERIALIZED (
  SELECT sized.*, source_size, target,
    CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS certain,
    target - CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END * source_size AS remaining,
    u / (1 - u) AS luck
  FROM (SELECT *, (CAST('0x' || substr(md5('42|' || key || CASE WHEN n > 1 THEN '|' || print || '|' || nth ELSE '' END), 1, 13) AS BIGINT) + 0.5)
          / 4503599627370496.0::DOUBLE AS u
        FROM (SELECT *, count(*) OVER (PARTITION BY source, key) AS n, row_number() OVER (PARTITION BY print) AS nth
              FROM (SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') AS key,
                      md5(coalesce(source, '') || '|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))) AS print
                    FROM sized) k) n) sized
  JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
),
steps AS (
  SELECT source, size, place,
    (remaining - coalesce(sum(size) OVER (PARTITION BY source ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(CAST(size AS DOUBLE) * size) OVER (PARTITION BY source ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS factor
  FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size DESC) AS place FROM started WHERE size > 0 AND size <= remaining) f
),
factors AS (SELECT source, arg_min(factor, place) AS factor FROM steps WHERE factor * size < 1 GROUP BY source),
ranked AS MATERIALIZED (
  SELECT s.*, false AS drawn, CASE WHEN f.factor * s.size < 1 THEN luck * (1 - f.factor * s.size) / greatest(f.factor * s.size, 1e-300) ELSE 0 END AS odds
  FROM started s LEFT JOIN factors f ON s.source IS NOT DISTINCT FROM f.source
),{",".join(rounds)}{extra}"""
