"""Mixing sources to target weights by a low-discrepancy schedule over shuffled blocks of equal size."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.shared import stored
from martloom.operators.joins import salted_join

WEIGHTS = (5, 2, 1)
# Words the mix takes, as a part of all words: 3 / 2. No source gives more than MOST times its own.
SHARE = (3, 2)
MOST = 2
BLOCK_WORDS = 1000
SEED = 13
# Rows of a bucket of a running total, on average, and slots laid out by one row.
BUCKET_ROWS = 256
SLOTS_AT_ONCE = 4096
# Bits of the keys that shuffle documents.
KEY_BITS = 60


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def running_total(rows: DataFrame, group: str, key: str, bits: int, value: str, name: str, ties: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` over the rows of its group that come before, by ``key`` and ``ties``.

    ``key`` is a number of ``bits`` bits, spread evenly. Its leading bits deal a
    group into buckets, sums of buckets into buckets of buckets, so that no
    window holds more than some hundred rows of a group, or the square root of
    their number, however hot the group is.
    """
    count = rows.count()
    fine_bits = min(bits, ceil(log2(max(count / BUCKET_ROWS, 1))))
    coarse_bits = fine_bits // 2
    dealt = rows.withColumn("_fine", F.shiftright(key, bits - fine_bits)).withColumn(
        "_coarse", F.shiftright("_fine", fine_bits - coarse_bits)
    )
    fine = dealt.groupBy(group, "_coarse", "_fine").agg(F.sum(value).alias("_sum"))
    coarse = fine.groupBy(group, "_coarse").agg(F.sum("_sum").alias("_sum"))

    def before(frame: DataFrame, by: list[str], order: list[str], total: str, out: str) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return frame.withColumn(out, F.coalesce(F.sum(total).over(window), F.lit(0)))

    coarse = before(coarse, [group], ["_coarse"], "_sum", "_a").drop("_sum")
    fine = before(fine, [group, "_coarse"], ["_fine"], "_sum", "_b").drop("_sum")
    offsets = fine.join(coarse, [group, "_coarse"]).select(group, "_fine", (F.col("_a") + F.col("_b")).alias("_offset"))
    own = before(dealt.drop("_coarse"), [group, "_fine"], [key, *ties], value, "_own")
    placed = own.join(offsets, [group, "_fine"]).withColumn(name, F.col("_offset") + F.col("_own"))
    return placed.select(*rows.columns, name)


def _numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``number``, their place by code point from 0, NULL last.

    Sorted by ranges and written, so that the places within a range and the
    number of rows before it belong together; only rows per range meet in a task.
    """
    ranged = sources.withColumn("_last", F.col("source").isNull()).repartitionByRange("_last", "source")
    own = Window.partitionBy("_part").orderBy("_last", "source")
    part = stored(ranged.withColumn("_part", F.spark_partition_id()), "sources")
    counts = part.groupBy("_part").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    placed = part.withColumn("_own", F.row_number().over(own) - 1).join(F.broadcast(before), "_part")
    return placed.withColumn("number", F.col("_before") + F.col("_own")).drop("_before", "_own", "_last")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST) -> DataFrame:
    """``sources`` (``source``, ``source_size``) with ``number``, ``weight``, ``target`` and ``quota``, the whole words of it.

    The sources in order have the ``weights`` in turn, and together a part
    ``share`` of all words. A target above ``most`` times its source stops there,
    and what is left is shared by weight between the others, until none is above.
    Each round is one aggregate over the sources; sums are whole numbers.
    """
    numbered = _numbered(sources)
    cycle = F.array(*[F.lit(w) for w in weights])
    weighted = stored(numbered.withColumn("weight", F.element_at(cycle, (F.col("number") % len(weights) + 1).cast("int")).cast("long")), "weighted")
    parts, whole = share
    wide = "decimal(38,0)"
    total = weighted.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    # A source is above if weight * rest / (whole * weights) > most * size, with
    # rest / whole the words that those not stopped share.
    rest, shared, stopped = total * parts, None, F.lit(False)
    while True:
        sums = weighted.agg(
            F.coalesce(F.sum(F.when(stopped, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~stopped, F.col("weight"))), F.lit(0)),
        ).first()
        now = (total * parts - whole * most * sums[0], sums[1])
        if now == (rest, shared):
            break
        rest, shared = now
        stopped = F.col("weight").cast(wide) * F.lit(rest).cast(wide) > F.col("source_size").cast(wide) * F.lit(whole * most * shared).cast(wide)
    capped = F.col("source_size") * most
    free = F.col("weight") * F.lit(rest)
    below = F.lit(max(whole * (shared or 0), 1))
    target = F.when(stopped, capped.cast("double")).otherwise(free.cast("double") / below.cast("double"))
    quota = F.when(stopped, capped).otherwise(F.floor(free.cast(wide) / below.cast(wide)).cast("long"))
    return weighted.select("source", "source_size", "number", "weight", "_part", target.alias("target"), quota.alias("quota"))


def _reversed(value: Column, bits: int) -> Column:
    """The ``bits`` lowest bits of a number in reverse: van der Corput's points, times 2^bits."""
    return F.conv(F.reverse(F.lpad(F.bin(value), bits, "0")), 2, 10).cast("long")


def schedule(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``number`` of the source, ``rank`` and ``slot`` of every block the mix takes.

    A source takes as many blocks as hold its ``quota``, n in all. With m the least
    power of two from n on, slot i is given the i-th point of van der Corput's
    sequence, i with its bits reversed over m, and goes to the source in whose part
    of the cumulative block counts the point falls. The first m points are all
    multiples of 1/m, so a part holds at least its source's blocks; they are taken
    in the order of slots, and a source that has all its blocks leaves its later
    slots out. Here a source lists the points in its part, and finds their slots.
    """
    taken = sources.select("number", "_part", F.ceil(F.col("quota") / F.lit(block_words)).cast("long").alias("blocks")).filter("blocks > 0")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = taken.groupBy("_part").agg(F.sum("blocks").alias("_n"))
    before = per_part.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    own = Window.partitionBy("_part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    summed = taken.withColumn("_own", F.coalesce(F.sum("blocks").over(own), F.lit(0))).join(F.broadcast(before), "_part")
    n = taken.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0]
    bits = max(1, ceil(log2(max(n, 2))))
    m, wide = 1 << bits, "decimal(38,0)"

    def point(at: Column) -> Column:
        """The first multiple of 1/m from ``at``/n on."""
        return F.ceil(at.cast(wide) * F.lit(m).cast(wide) / F.lit(max(n, 1)).cast(wide)).cast("long")

    start = F.col("_before") + F.col("_own")
    spans = summed.select("number", "blocks", point(start).alias("lo"), (point(start + F.col("blocks")) - 1).alias("hi"))
    chunks = spans.select("number", "blocks", "hi", F.explode(F.sequence("lo", "hi", F.lit(SLOTS_AT_ONCE).cast("long"))).alias("at"))
    spread = chunks.repartition("number", "at")
    points = spread.select("number", "blocks", F.explode(F.sequence("at", F.least("hi", F.col("at") + SLOTS_AT_ONCE - 1))).alias("point"))
    slots = points.select("number", "blocks", _reversed(F.col("point"), bits).alias("slot"), F.lit(1).cast("long").alias("_one"))
    ranked = running_total(stored(slots, "slots"), "number", "slot", bits, "_one", "rank")
    return ranked.filter(F.col("rank") < F.col("blocks")).select("number", "rank", "slot")


def mixture(
    documents: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: tuple[int, int] = SHARE,
    most: int = MOST,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """The documents laid out, and the parts of them that the mix takes.

    The first table has a row per document: ``doc_id``, ``size``, ``source_size``,
    ``target``, ``number`` of the source and ``start``, the document's first word in
    its source once shuffled (rows of no words share one with the next). The
    second has the parts, ``slot``, ``number``, ``start``, ``first_word`` and ``words``:
    slot after slot, each some words of a document, is the mix.
    """
    # Shuffled by a hash of the number; its leading bits are one integer in every engine.
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")), 256)
    key = F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")
    sized = stored(
        documents.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), words(F.col("text")).alias("size"), key.alias("key")),
        "sized",
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    told = stored(targets(sources, weights, share, most), "targets")
    # NULL is a source like others, so the join needs a name for it.
    named = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    described = told.select(named.alias("_source"), "number", "source_size", "target", "quota")
    joined = salted_join(sized.withColumn("_source", named).drop("source"), described, "_source").drop("_source")
    laid = stored(running_total(joined, "number", "key", KEY_BITS, "size", "start", ["doc_id", "size"]), "laid-out")
    last = F.col("start") + F.col("size")
    ranges = laid.filter("size > 0").select(
        "number", "start", "size", "quota", F.explode(F.array(F.lit(0).cast("long"), F.col("source_size"))).alias("again")
    )
    # The source once more after its end, and of that what the quota reaches.
    a, b = F.col("start") + F.col("again"), F.least(last + F.col("again"), F.col("quota"))
    ranges = ranges.select("number", "start", a.alias("a"), b.alias("b")).filter("a < b")
    blocks = ranges.select("*", F.explode(F.sequence(F.floor(F.col("a") / block_words), F.floor((F.col("b") - 1) / block_words))).alias("rank"))
    from_, upto = F.greatest("a", F.col("rank") * block_words), F.least("b", (F.col("rank") + 1) * block_words)
    pieces = blocks.select("number", "rank", "start", (from_ - F.col("a")).alias("first_word"), (upto - from_).alias("words"))
    parts = pieces.join(schedule(told, block_words), ["number", "rank"]).select("slot", "number", "start", "first_word", "words")
    return laid.select("doc_id", "size", "source_size", "target", "number", "start"), parts


def mixed(documents: DataFrame, **options) -> DataFrame:
    """How much of every document the mix takes, one row per row; ``options`` as for :func:`mixture`.

    ``documents`` needs ``doc_id``, ``text`` and ``source``. Returns ``doc_id``, ``size``
    (its words), ``source_size``, ``target`` of its source, ``taken`` (words, repeats
    counted) and ``first_slot`` (NULL if nothing of it is taken).

    A source gives the whole words of its target. They are taken from its
    documents in shuffled order, from the beginning again after the end, so
    no document gives more than twice its size. A NULL or empty text has no
    words and gives none. A NULL source is a source, the last one. A NULL
    ``doc_id`` stays NULL. Repeated rows each count; they are next to each
    other in the shuffled order, so which of them is cut does not matter.
    Other columns are not read; an empty table gives an empty result.

    A hot source is dealt out by the leading bits of the documents' hashes and of
    the slots' numbers; parts and slots meet by source and block.
    """
    laid, parts = mixture(documents, **options)
    taken = parts.groupBy("number", "start").agg(F.sum("words").alias("_taken"), F.min("slot").alias("_slot"))
    found = laid.join(taken, ["number", "start"], "left")
    has = F.col("size") > 0
    return found.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.when(has, F.coalesce("_taken", F.lit(0))).otherwise(0).cast("long").alias("taken"),
        F.when(has, F.col("_slot")).alias("first_slot"),
    )
