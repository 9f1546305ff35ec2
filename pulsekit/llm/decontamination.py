"""Benchmark decontamination by winnowed word fingerprints, in DataFrame functions alone.

A *window* is ``span`` consecutive words of an item; an item with fewer words
is one window.  A document word is hit if it lies in an occurrence of a
window.  The steps:

1. *Winnow.*  Every document is cut into segments of ``step`` words that
   overlap by ``span - 1``, so each window lies whole in one.  Of ``gram``-word
   hashes, the least of each ``span - gram + 1`` consecutive ones is kept: any
   ``span`` words that a document shares with an item have the same least
   hash, so no shared window is missed.  Windows shorter than ``span`` are
   their own only gram.
2. *Join* the fingerprints of documents and items by equality.
3. *Extend* each hit to the ``span`` words that it stands for, and keep those
   whose words equal a window's, word for word.
4. *Count.*  Words under the windows found are counted once by a running
   maximum of their ends.  Documents that hold the same set of windows share
   one list of items, made once per set, so a passage in very many documents
   and items never gives a row for each pair of both.

The sides joined by broadcast are counted first; above ``broadcast_rows``
rows they meet by shuffle, where a frequent key stands on one row of one side
only and the other is split by adaptive execution.

Memory: a task holds the words of one text (about 12 bytes a text byte)
and the hashes of one segment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pulsekit.llm.common import PREFIX, written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> Column:
    """Words of a text, A-Z in lower case; none for null."""
    return F.regexp_extract_all(F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER), F.lit(WORD), F.lit(0))


def _shorter(array: str, by: int) -> Column:
    return F.slice(array, 1, F.greatest(F.size(array) - by, F.lit(0)))


def _grams(hashes: str, level: int, gram: int) -> Column:
    """A hash of each ``gram`` consecutive words; ``level`` keeps windows of different lengths apart."""
    return F.transform(_shorter(hashes, gram - 1),
                       lambda x, i: F.xxhash64(F.lit(level), x, *(F.get(hashes, i + j) for j in range(1, gram))))


def _least(grams: str, width: int) -> Column:
    """The least hash of each ``width`` consecutive ones."""
    if width == 1:
        return F.col(grams)
    return F.transform(_shorter(grams, width - 1), lambda x, i: F.least(x, *(F.get(grams, i + j) for j in range(1, width))))


class _Levels:
    """Window lengths in use, each with its gram length and winnowing width."""

    def __init__(self, lengths: list[int], span: int, gram: int):
        self.of = {n: (gram, span - gram + 1) if n == span else (n, 1) for n in sorted(lengths)}

    def winnowed(self, rows: DataFrame, array: str) -> DataFrame:
        """Adds ``least_<length>``: the least hash of the window that starts at each word."""
        rows = rows.withColumn("hashes", F.transform(array, lambda x: F.xxhash64(x)))
        for n, (gram, width) in self.of.items():
            rows = rows.withColumn("grams", _grams("hashes", n, gram)).withColumn(f"least_{n}", _least("grams", width)).drop("grams")
        return rows.drop("hashes")


def _windows(items: DataFrame, item_id: str, text: str, span: int, gram: int) -> tuple[DataFrame, _Levels]:
    """Each window of each item once: its length, words, digest and fingerprint."""
    rows = items.select(F.col(item_id).alias("item"), words(text).alias("words"))
    rows = rows.withColumn("length", F.least(F.size("words"), F.lit(span))).filter("length > 0")
    starts = F.sequence(F.lit(0), F.size("words") - F.col("length"))
    rows = rows.withColumn("at", F.explode(starts)).select(
        "item", "length", F.slice("words", F.col("at") + 1, F.col("length")).alias("w"))
    rows = written(rows.distinct(), "item-windows")
    levels = _Levels([r["length"] for r in rows.select("length").distinct().collect()], span, gram)  # at most ``span`` values
    rows = levels.winnowed(rows, "w")
    first = F.coalesce(*(F.when(F.col("length") == n, F.get(f"least_{n}", F.lit(0))) for n in levels.of), F.lit(0).cast("long"))
    same = F.concat_ws(" ", "w")
    return rows.select("item", "length", same.alias("same"), F.md5(same).alias("window"), first.alias("print")), levels


def _bounded(df: DataFrame, limit: int, array: str | None = None) -> DataFrame:
    """``df`` to be broadcast if it has at most ``limit`` rows, or entries of ``array``."""
    n = df.agg(F.sum(F.size(array))).first()[0] or 0 if array else df.limit(limit + 1).count()
    return F.broadcast(df) if n <= limit else df


def _found(leasts: str, length: int, step: int) -> Column:
    """Places of a segment's own windows whose least hash is among ``met``, with their length."""
    marked = F.transform(leasts, lambda x, i: F.struct(F.array_contains("met", x).alias("is"), i.alias("i"), F.lit(length).alias("n")))
    return F.transform(F.filter(marked, lambda s: s["is"] & (s["i"] < step)), lambda s: F.struct(s["i"].alias("i"), s["n"].alias("n")))


def _segments(rows: DataFrame, keep: list[str], text: str, step: int, span: int) -> DataFrame:
    """Rows of a segment each: ``at`` (its first word), ``w`` (its words), ``n_words`` (of the document)."""
    rows = rows.select(*keep, words(text).alias("words")).withColumn("n_words", F.size("words").cast("long"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(step))
    return rows.withColumn("at", F.explode(starts)).select(
        *keep, "n_words", "at", F.slice("words", F.col("at") + 1, step + span - 1).alias("w"))


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", span: int = 10, gram: int = 5, step: int = 4096,
                 broadcast_rows: int = 200_000) -> DataFrame:
    """``docs`` with the words that they share with ``items``.

    Adds n_words, n_hit (words in an occurrence of a window), n_items and
    items (ids of the items with such windows, as strings in string order).

    Null texts have no words, and neither have texts of white space or
    punctuation alone; they are not hit.  Rows with one id and text have one
    answer, each its own row.  Items without words have no window; a null
    item id hits words but is not listed; items of one id count as one.
    Columns of ``docs`` that start with ``__pk_`` must not be there; all
    others, whatever their names, are kept, but for the four added.
    """
    if not 1 <= gram <= span:
        raise ValueError("grams must be no longer than the span")
    k, h = PREFIX + "id", PREFIX + "text"
    key = [k, h]
    keyed = docs.select(F.col(doc_id).cast("string").alias(k), F.xxhash64(text).alias(h), F.col(text).alias("text"))
    keyed = keyed.withColumn(k, F.coalesce(F.concat(F.lit("="), k), F.lit("")))
    found, levels = _windows(items, item_id, item_text, span, gram)
    found = written(found, "windows")

    # 1: fingerprints of every document
    leasts = [f"least_{n}" for n in levels.of]
    prints = F.array_distinct(F.concat(*leasts)) if leasts else F.array().cast("array<bigint>")
    winnowed = written(levels.winnowed(_segments(keyed, key, "text", step, span), "w").select(*key, "n_words", "at", prints.alias("prints")),
                       "prints")

    # 2: those that items have too
    wanted = _bounded(found.select("print").distinct(), broadcast_rows)
    met = winnowed.select(*key, "at", F.explode("prints").alias("print")).join(wanted, "print")
    met = written(met.groupBy(*key, "at").agg(F.collect_set("print").alias("met")), "met")

    # 3: the windows that they stand for
    some = _bounded(met.select(*key).distinct(), broadcast_rows)
    again = levels.winnowed(_segments(keyed.join(some, key), key, "text", step, span).join(_bounded(met, broadcast_rows, "met"), [*key, "at"]), "w")
    places = [_found(c, n, step) for n, c in zip(levels.of, leasts, strict=True)]
    places = F.concat(*places) if places else F.array().cast("array<struct<i:int,n:int>>")
    spans = again.withColumn("place", F.explode(places)).select(
        *key, (F.col("at") + F.col("place.i")).cast("long").alias("start"), F.col("place.n").cast("long").alias("length"),
        F.concat_ws(" ", F.slice("w", F.col("place.i") + 1, F.col("place.n"))).alias("same"))
    known = _bounded(found.select("same", "window").distinct(), broadcast_rows)
    hits = written(spans.join(known, "same").select(*key, "start", "length", "window").distinct(), "hits")

    # 4: words under them, and the items of each set of windows
    order = Window.partitionBy(*key).orderBy("start", "length")
    before = F.coalesce(F.max(F.col("start") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fresh = F.greatest(F.col("start") + F.col("length") - F.greatest(before, F.col("start")), F.lit(0))
    n_hit = hits.withColumn("fresh", fresh).groupBy(*key).agg(F.sum("fresh").alias("n_hit"))
    held = hits.select(*key, "window").distinct()
    sets = held.groupBy(*key).agg(F.struct(*(F.bit_xor(F.xxhash64("window", F.lit(seed))).alias(f"x{seed}") for seed in (0, 1)),
                                           F.count(F.lit(1)).alias("n")).alias("set"))
    sets = written(sets, "window-sets")
    one = sets.groupBy("set").agg(F.min(F.struct(*key)).alias("one")).select("set", F.col(f"one.{k}").alias(k), F.col(f"one.{h}").alias(h))
    listed = (held.join(one, key).select("set", "window").join(found.select("window", F.col("item").cast("string").alias("item")).distinct(), "window")
              .groupBy("set").agg(F.sort_array(F.collect_set("item")).alias("items")))
    result = (n_hit.join(sets, key).join(listed, "set").select(*key, F.col("n_hit").alias(PREFIX + "hit"), F.col("items").alias(PREFIX + "items")))

    n = PREFIX + "n"
    counts = winnowed.filter("at = 0").select(*key, F.col("n_words").alias(n)).dropDuplicates(key)
    counts = counts.join(result, key, "left")
    new = ("n_words", "n_hit", "n_items", "items")
    out = docs.withColumn(k, F.coalesce(F.concat(F.lit("="), F.col(doc_id).cast("string")), F.lit(""))).withColumn(h, F.xxhash64(text))
    out = out.join(counts, key)
    items_of = F.coalesce(F.col(PREFIX + "items"), F.array().cast("array<string>"))
    return out.select(*(F.col(c) for c in docs.columns if c not in new), F.col(n).alias("n_words"),
                      F.coalesce(PREFIX + "hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.size(items_of).cast("long").alias("n_items"), items_of.alias("items"))
