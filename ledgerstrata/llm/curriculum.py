"""Mixing sources to target weights along a time-varying curriculum, in DataFrame functions only.

Each source has a weight schedule over training progress 0 to 1, linear between given points. The integral
of the schedule is the source's weight in the whole mix, from which its target in words follows (``targets``).
The demand for a source up to a moment is its target times the integral so far. The documents of a source
lie one after another in a fixed random order, as often as it takes; each gets the moment at which demand
reaches its first word: the inverse of the integral, a quadratic per stretch of the schedule. Sorting all
documents by this moment gives the training order.

Running sums are taken in two steps: within slices of a source of a few thousand documents, and
over one sum per slice, so a source that holds most documents is no single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerstrata.config import cut_lineage

#: (progress, weight) points; sources take the schedules in turn. Their integrals are 5, 2 and 1.
SCHEDULES = (((0.0, 2.5), (1.0, 7.5)), ((0.0, 2.0), (1.0, 2.0)), ((0.0, 1.5), (1.0, 0.5)))
#: Size of the mix, as a share of all words.
SHARE = (3, 2)
#: How often a document is taken at most.
REPEATS = 2
#: Documents of a slice, about.
SLICE_ROWS = 4096
_HEX_DIGITS = 8


def integral(schedule: Sequence[tuple[float, float]]) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]))


def _check(schedule: Sequence[tuple[float, float]]) -> None:
    times = [t for t, _ in schedule]
    if times[0] != 0 or times[-1] != 1 or any(b <= a for a, b in zip(times, times[1:])) or any(w < 0 for _, w in schedule) or not integral(schedule):
        raise ValueError(f"a schedule rises from progress 0 to 1 and has weights of 0 or more, not all 0: {schedule}")


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, place``: words of each document and its place in the random order of its source."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    id_ = F.col("doc_id").cast("long")
    return docs.select(
        id_.alias("doc_id"), F.col("source").cast("string").alias("source"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        F.md5(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), text)).alias("place"))


def targets(sizes: DataFrame, schedules: Sequence = SCHEDULES, share: tuple[int, int] = SHARE, repeats: int = REPEATS) -> DataFrame:
    """``source, source_size, turn, target`` of sources ``source, source_size`` (one row each).

    Sources by code point, null last, take the schedules in turn. Targets are shares of the mix by weight, at
    most ``repeats`` times the source's size; what is cut off goes to the others by weight until none is above.
    With sources ordered by (limit / weight), those that reach their limit come first. If the first k do, the rest
    gets (mix - their limits) / (weight of the rest) per unit of weight; the true level is the largest of these.
    """
    for schedule in schedules:
        _check(schedule)
    weights = F.array(*[F.lit(float(integral(s))) for s in schedules])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sizes.withColumn("turn", ((F.row_number().over(by_name) - 1) % len(schedules)).cast("int"))
    rows = rows.withColumn("weight", F.get(weights, F.col("turn"))).withColumn("limit", F.col("source_size") * repeats)
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    mix = F.sum("source_size").over(everything) * share[0]
    rows = rows.withColumn("rest", mix - share[1] * F.coalesce(F.sum("limit").over(before), F.lit(0)))
    rows = rows.withColumn("rest_weight", (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))) * share[1])
    level = F.max(F.col("rest") / F.col("rest_weight")).over(everything)
    target = F.least(F.col("limit").cast("double"), F.col("weight") * level)
    return rows.select("source", "source_size", "turn", target.alias("target"))


def moment(part: Column, turn: Column, schedules: Sequence = SCHEDULES) -> Column:
    """Progress at which a schedule has used up ``part`` (0 to 1) of its integral."""
    choice = F.lit(None).cast("double")
    for i, schedule in enumerate(schedules):
        used, stretches = 0.0, F.lit(1.0)
        total, ends = integral(schedule), []
        for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
            need = part * F.lit(total) - F.lit(used)
            root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + F.lit(2 * (w1 - w0) / (t1 - t0)) * need))
            # Without need the progress is t0, also where the weight begins at 0.
            inside = F.lit(float(t0)) + F.when(need <= 0, 0.0).otherwise(F.lit(2.0) * need / (F.lit(float(w0)) + root))
            used += (t1 - t0) * (w0 + w1) / 2
            ends.append((used / total, inside, float(t1)))
        for end, inside, t1 in reversed(ends):
            stretches = F.when(part <= end, F.least(inside, F.lit(t1))).otherwise(stretches)
        choice = F.when(turn == i, stretches).otherwise(choice)
    return choice


def planned(docs: DataFrame, schedules: Sequence = SCHEDULES, share: tuple[int, int] = SHARE, repeats: int = REPEATS) -> DataFrame:
    """``doc_id, place, size, source, source_size, target, copies``, one row per document.

    ``copies``: nr, words and position of each copy taken. The mix takes exactly the rounded target of each source: the
    last copy may be cut short.
    """
    rows = cut_lineage(sized(docs))
    digits, n = 0, rows.count()
    while digits < _HEX_DIGITS and n > SLICE_ROWS << 4 * digits:
        digits += 1
    # Null-safe keys; a slice is a range of places.
    rows = rows.select("doc_id", "size", "place", F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("name"),
                       F.substring("place", 1, digits).alias("slice"))
    slices = cut_lineage(rows.groupBy("no_source", "name", "slice").agg(F.sum("size").alias("words")))
    of_source = Window.partitionBy("no_source", "name").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = slices.groupBy("no_source", "name").agg(F.sum("words").alias("source_size"))
    sizes = sizes.select(F.when(~F.col("no_source"), F.col("name")).alias("source"), "source_size")
    plan = cut_lineage(targets(sizes, schedules, share, repeats))
    plan = plan.withColumn("no_source", F.col("source").isNull()).withColumn("name", F.coalesce("source", F.lit("")))
    slices = slices.withColumn("base", F.coalesce(F.sum("words").over(of_source), F.lit(0))).drop("words").join(plan, ["no_source", "name"])
    rows = rows.join(cut_lineage(slices), ["no_source", "name", "slice"])
    within = Window.partitionBy("no_source", "name", "slice").orderBy("place", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("begin", F.col("base") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.withColumn("end", F.floor(F.col("target") + 0.5).cast("long"))
    copies = []
    for nr in range(repeats):
        begin = F.col("begin") + F.col("source_size") * nr
        words = F.greatest(F.lit(0), F.least(F.col("size"), F.col("end") - begin))
        at = moment(begin / F.col("target"), F.col("turn"), schedules)
        copies.append(F.struct(F.lit(nr).alias("nr"), words.cast("long").alias("words"), F.when(words > 0, at).alias("position")))
    taken = F.filter(F.array(*copies), lambda c: c["words"] > 0)
    return rows.select("doc_id", "place", "size", "source", "source_size", "target", taken.alias("copies"))


def mixed(docs: DataFrame, schedules: Sequence = SCHEDULES, share: tuple[int, int] = SHARE, repeats: int = REPEATS) -> DataFrame:
    """What the mix takes of each document: ``doc_id, size, source_size, target, taken, position``, sorted by position.

    ``taken`` counts words, repeats included; ``position`` is the progress (0 to 1) at which its first copy is read, null where
    nothing is taken (those rows come last). Null and empty texts, and texts of white space, have size 0 and are never taken; a mix without words takes nothing.
    A null source is one source, the last. Null ids are allowed; repeated rows are documents of their own; rows of equal id and
    text share a place and may swap. Other columns are not read; an empty table gives no rows.
    """
    plan = planned(docs, schedules, share, repeats)
    out = plan.select("doc_id", "size", "source_size", "target", F.aggregate("copies", F.lit(0).cast("long"), lambda n, c: n + c["words"]).alias("taken"),
                      F.get("copies", F.lit(0))["position"].alias("position"))
    return cut_lineage(out).orderBy(F.col("position").asc_nulls_last(), "doc_id")


def training_order(docs: DataFrame, schedules: Sequence = SCHEDULES, share: tuple[int, int] = SHARE, repeats: int = REPEATS) -> DataFrame:
    """The documents as they are read: the columns of ``docs``, and ``copy``, ``words`` (of the text, from its start) and ``position``.

    One row per copy, sorted by position. Rows without a word are left out. Columns of ``docs`` that clash with the new names stay, renamed ``<name>_``.
    """
    own = {c: f"{c}_" if c in ("copy", "words", "position") else c for c in docs.columns}
    id_ = F.col("doc_id").cast("long")
    place = F.md5(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col("text").cast("string"), F.lit(""))))
    # Rows of one place are alike in id and text; they are numbered so that each meets its own plan.
    whole = docs.select(place.alias("_place"), F.col("source").cast("string").alias("_source"), F.struct(*[F.col(c).alias(n) for c, n in own.items()]).alias("_doc"))
    same = ["_place", "_source"]
    whole = whole.withColumn("_nr", F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(0))))
    plan = planned(docs, schedules, share, repeats).select(F.col("place").alias("_place"), F.col("source").alias("_source"), "copies")
    plan = plan.withColumn("_nr", F.row_number().over(Window.partitionBy(*same).orderBy(F.to_json("copies"))))
    both = whole.alias("d").join(plan.alias("p"), F.col("d._place").eqNullSafe(F.col("p._place")) & F.col("d._source").eqNullSafe(F.col("p._source")) & (F.col("d._nr") == F.col("p._nr")))
    out = both.select("d._doc.*", F.explode("copies").alias("_copy"))
    out = out.select(*own.values(), F.col("_copy.nr").alias("copy"), F.col("_copy.words").alias("words"), F.col("_copy.position").alias("position"))
    return cut_lineage(out).orderBy("position", "doc_id", "copy")


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS place FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn FROM sized GROUP BY source),
weighed AS (SELECT *, CASE turn WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, 2 * source_size AS cap FROM sources),
levels AS (
  SELECT max((3 * total - 2 * caps)::DOUBLE / (2 * (total_weight - weights))) AS level FROM (
    SELECT sum(source_size) OVER () AS total, sum(weight) OVER () AS total_weight,
           coalesce(sum(cap) OVER before, 0) AS caps, coalesce(sum(weight) OVER before, 0) AS weights
    FROM weighed WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))),
plan AS (SELECT source, source_size, turn, least(cap::DOUBLE, weight * level) AS target FROM weighed, levels),
placed AS (
  SELECT s.doc_id, s.size, p.source_size, p.turn, p.target, floor(p.target + 0.5)::BIGINT AS stop,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized s JOIN plan p ON p.source IS NOT DISTINCT FROM s.source),
parts AS (SELECT *, CASE WHEN target > 0 THEN start::DOUBLE / target END AS part, greatest(0, least(size, stop - start)) AS once FROM placed)
SELECT doc_id, size, source_size, target, (once + greatest(0, least(size, stop - start - source_size)))::BIGINT AS taken,
  CASE WHEN once > 0 THEN CASE
    WHEN part <= 0 THEN 0.0::DOUBLE
    WHEN turn = 0 THEN least(1.0, 2.0 * (part * 5.0) / (2.5 + sqrt(greatest(0.0, 6.25 + 10.0 * (part * 5.0)))))
    WHEN turn = 1 THEN least(1.0, 2.0 * (part * 2.0) / (2.0 + sqrt(greatest(0.0, 4.0 + 0.0 * (part * 2.0)))))
    ELSE least(1.0, 2.0 * (part * 1.0) / (1.5 + sqrt(greatest(0.0, 2.25 + -2.0 * (part * 1.0))))) END END AS position
FROM parts
"""
