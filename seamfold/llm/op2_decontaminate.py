"""Benchmark decontamination by spaced seeds, with DataFrame functions only.

A mask laid over consecutive words ignores the positions marked 0. Its hashes are taken
at every place of the benchmark and of the documents and joined; around each place where
two agree, the windows of SPAN words that hold it are compared word by word and count if
enough words are equal. The masks are shorter than a window, so each has several places
in it, and wherever two words of a window differ, some mask finds a place that ignores
both. An item that is shorter than a window is one window; its seeds are runs of its
words, of which it has one more than words may differ, so that one of them is equal.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamfold.llm.core import prepare, scratch

#: Together they find any SPAN words of which all but two are equal.
MASKS = ("11101011", "110100111")
SPAN = 13
#: Benchmark hashes that are broadcast, about 250 bytes each; more are joined by a shuffle.
BROADCAST = 400_000
#: Ids of documents that are broadcast.
BROADCAST_IDS = 1_000_000


def word_codes(text: Column) -> Column:
    """Hashes of the words of a text: runs of letters and digits, lower-cased."""
    return F.transform(F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), ""), lambda w: F.xxhash64(w))


def _seed(codes: str, at: Column, k: int) -> Column:
    """The hash under mask k of the words from a position on; null beyond the text's end."""
    hashed = F.xxhash64(F.lit(k), *(F.get(codes, at + i) for i, x in enumerate(MASKS[k]) if x == "1"))
    return F.when(at + len(MASKS[k]) <= F.size(codes), hashed)


def runs(n: int, least: float) -> list[tuple[int, int]]:
    """(place, length) of the runs that an item of n words is cut into, one of which is equal wherever the item is found."""
    parts = 1 + max(k for k in range(n) if n - k >= least * n)
    cuts = [n * k // parts for k in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _run(codes: str, at: Column, length: int) -> Column:
    """The hash of so many words from a position on."""
    return F.when(at + length <= F.size(codes), F.xxhash64(F.lit(-length), *(F.get(codes, at + i) for i in range(length))))


def _around(codes: str, at: str) -> tuple[Column, Column]:
    """The words that windows around a hash may hold, and the place of the first of them in the text."""
    start = F.greatest(F.col(at) - F.col("before"), F.lit(0))
    stop = F.least(F.col(at) - F.col("before") + F.col("last") + F.col("n"), F.size(codes))
    return F.slice(codes, start + 1, F.greatest(stop - start, F.lit(0))), start


def _agreeing(least: float) -> tuple[Column, Column]:
    """Which words around a hash are equal, and the windows (i, j, n, equal) there that are equal enough.

    Reads the places i and j of the hash in a document and an item, the words near and part
    around them with the places i0 and j0 of their first ones, both texts' sizes, and n, before
    and last: the words of a window, how far before the hash the first one may start, and how many more there are.
    """
    first = lambda t, at: F.col(at) - F.col("before") + t
    places = F.sequence(F.lit(0), F.col("last") + F.col("n") - 1)
    word = lambda words, at, start, k: F.when(first(k, at) >= F.col(start), F.get(words, first(k, at) - F.col(start)))
    equal = F.transform(places, lambda k: F.when(word("near", "i", "i0", k) == word("part", "j", "j0", k), 1).otherwise(0))
    window = lambda t: F.struct(first(t, "i").alias("i"), first(t, "j").alias("j"), F.aggregate(F.slice(F.col("same"), t + 1, F.col("n")), F.lit(0), lambda a, x: a + x).alias("equal"))
    whole = lambda w: (w.i >= 0) & (w.j >= 0) & (w.i + F.col("n") <= F.col("size")) & (w.j + F.col("n") <= F.col("item_size")) & (w.equal >= least * F.col("n"))
    return equal, F.filter(F.transform(F.sequence(F.lit(0), F.col("last")), window), whole)


def overlaps(docs: DataFrame, bench: DataFrame, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", broadcast: int = BROADCAST) -> DataFrame:
    """(doc_id, item_id, n_hits, first_word, last_word, best) for each document and item that overlap.

    They overlap if SPAN consecutive words of each are equal in at least the share least
    of their places (with the default, in all but two); an item of fewer words is compared
    as a whole with as many words. For a share that lets more than two words differ, only
    windows in which a mask agrees are found. n_hits counts the pairs of places, in the document and in the item, whose
    windows agree; first_word and last_word (exclusive) bound the words of the document
    under them, counted from 0; best is the largest share of equal words. Texts of fewer
    words than are compared, null and empty texts and null ids overlap with nothing. Equal ids
    are reported together, and repeated rows as one. Other columns, also of equal names in both tables, are
    ignored. Empty tables give no rows.

    The benchmark's hashes are broadcast if they are at most so many, which is counted first;
    more are joined by a shuffle, and documents with a hit are read again. A hit carries the
    words around it only, so that memory is linear in the longest text.
    """
    prepare(docs.sparkSession)
    items = bench.select(F.col(item_col).cast("long").alias("item_id"), word_codes(F.col(item_text)).alias("item")).where("item_id is not null and size(item) > 0")
    long = items.where(f"size(item) >= {SPAN}").select("*", F.posexplode("item").alias("j", "word"))
    masked = lambda k: F.struct(_seed("item", F.col("j"), k).alias("seed"), F.lit(SPAN - len(MASKS[k])).alias("before"))
    seeds = long.select("item_id", "item", "j", F.lit(SPAN).alias("n"), F.explode(F.array(*map(masked, range(len(MASKS)))).alias("x")).alias("x")).select("item_id", "j", "n", "x.seed", "x.before", F.col("x.before").alias("last"), "item")
    sizes = [r[0] for r in items.select(F.size("item")).where(f"size(item) < {SPAN}").distinct().collect()]  # fewer than SPAN rows
    for n in sizes:
        cut = F.explode(F.array(*(F.struct(F.lit(at).alias("j"), _run("item", F.lit(at), length).alias("seed"), F.lit(at).alias("before")) for at, length in runs(n, least))))
        short = items.where(F.size("item") == n).select("item_id", "item", cut.alias("x"))
        seeds = seeds.unionByName(short.select("item_id", "x.j", F.lit(n).alias("n"), "x.seed", "x.before", F.lit(0).alias("last"), "item"))
    part, j0 = _around("item", "j")
    seeds = seeds.where("seed is not null").select("seed", "item_id", "j", "n", "before", "last", F.size("item").alias("item_size"), part.alias("part"), j0.alias("j0"))
    lengths = sorted({length for n in sizes for _, length in runs(n, least)})

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    coded = docs.select("doc_id", F.xxhash64("text").alias("mark"), word_codes(F.col("text")).alias("codes"))
    # the outer form keeps Spark from deriving a filter that would hash all words twice
    spots = coded.select("doc_id", "mark", "codes", F.posexplode_outer("codes").alias("i", "code"))
    own = F.array(*(_seed("codes", F.col("i"), k) for k in range(len(MASKS))), *(_run("codes", F.col("i"), k) for k in lengths))
    tried = spots.select("doc_id", "mark", "codes", "i", F.explode_outer(own).alias("seed"))
    near, i0 = _around("codes", "i")
    # made by a generator right after the join, in its generated code, so that no row has a document's words
    held = F.explode_outer(F.array(F.struct(near.alias("near"), i0.alias("i0"), F.size("codes").alias("size")))).alias("x")
    kept = ["doc_id", "item_id", "i", "j", "n", "before", "last", "item_size", "part", "j0"]
    if seeds.count() <= broadcast:
        met = tried.join(F.broadcast(seeds), "seed").where("doc_id is not null").select(*kept, held)
    else:
        hits = tried.drop("codes").join(seeds, "seed").where("doc_id is not null").drop("seed")
        again = coded.join(hits.select("doc_id", "mark").distinct(), ["doc_id", "mark"], "left_semi").dropDuplicates(["doc_id", "mark"])
        met = hits.join(again, ["doc_id", "mark"]).select(*kept, held)
    same, windows = _agreeing(least)
    met = met.select(*kept, "x.near", "x.i0", "x.size")
    found = met.select(*kept, "i0", "size", same.alias("same")).select("doc_id", "item_id", "n", F.explode(windows).alias("w"))
    places = found.groupBy("doc_id", "item_id", "n", "w.i", "w.j").agg(F.max("w.equal").alias("equal"))
    return places.groupBy("doc_id", "item_id").agg(F.count("*").alias("n_hits"), F.min("i").cast("long").alias("first_word"), F.max(F.col("i") + F.col("n")).cast("long").alias("last_word"), F.max(F.col("equal") / F.col("n").cast("double")).alias("best"))


def decontaminate(docs: DataFrame, bench: DataFrame, least: float = 0.8) -> DataFrame:
    """The rows of docs that overlap with no item; the columns stay. Null ids stay, and null, empty and short texts.

    All rows of an id go if one does. An empty benchmark leaves docs as they are.
    """
    gone = scratch(overlaps(docs, bench, least).select("doc_id").distinct(), "gone")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
