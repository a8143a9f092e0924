"""N-gram Jaccard join: documents linked by the similarity of their shingle sets.

T-occurrence search. Keys are word shingles; every set is ordered by how often its
keys occur (once, some times, often; by hash within), and a set that reaches the
similarity must share one of another's first n - ceil(t*n) + 1 keys. Only those
postings are built, and of them only the ones that occur in more than one set. Sets
that meet in a list are then searched with DivideSkip (setjoin.search).

Nodes of the search are sets, told apart by their digests, so documents with equal sets
are searched once and rows that repeat an id keep a set each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamfold.llm.core import as_long, ngrams, prepare, scratch, send, trimmed, word_hashes
from seamfold.llm.graph import components
from seamfold.llm.repeats import may_hold, members, repeated
from seamfold.llm.setjoin import LONG, degrees, link, postings, rare_prefix

def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text, A-Z lower-cased."""
    return np.unique(ngrams(word_hashes((text or "").encode().lower().split()), words))


def _texts(batch: pa.RecordBatch):
    return batch.column(1).to_pylist()


def _digest(s: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None


def jaccard_components(docs: DataFrame, words: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id", text_col: str = "text", links: bool = True) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) for every row of docs.

    Two documents are linked if den * |both| >= num * |either| over their sets of
    distinct shingles of so many words (of fewer words: the whole sequence as one).
    component_id is the smallest id that links reach; n_links counts all other sets that
    the row's set is linked to, equal sets being one; it is left out if links is
    False. Null and empty texts have the empty set and are linked with nothing; a null id
    stays alone with a null component and reaches no other document. Rows that repeat an id
    are one document: what any of them is linked to is connected. Other columns are
    ignored. No rows give no rows.

    Equal sets are found by a 128-bit digest. Sets are compared by 64-bit shingle hashes.
    """
    spark = prepare(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def all_keys(batch):
        for text in _texts(batch):
            yield shingles(text, words)

    some, often = (send(spark, f) for f in repeated(docs, all_keys, (2, LONG)))

    def outline(batches):
        for batch in batches:
            n, digest, keys, places = [], [], [], []
            for text in _texts(batch):
                s = shingles(text, words)
                n.append(len(s))
                digest.append(_digest(s))
                head, at, _ = rare_prefix(s, some.value, often.value, num, den)
                keys.append(as_long(head))
                places.append(at)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int64()))], names=["doc_id", "n", "digest", "keys", "places"])

    outlines = scratch(docs.mapInArrow(trimmed(outline), "doc_id long, n long, digest binary, keys array<long>, places array<long>").withColumn("node", F.xxhash64("digest")), "outlines")
    named = outlines.where("digest is not null and doc_id is not null")
    groups = scratch(named.groupBy("node").agg(F.min("doc_id").alias("first")), "groups")
    heads = named.where("size(keys) > 0").join(groups.select("node", F.col("first").alias("doc_id")), ["node", "doc_id"], "left_semi").dropDuplicates(["node"])
    posts = postings(heads.select("node", "n", "keys", "places"))

    def load_sets(nodes: DataFrame) -> DataFrame:
        """The nodes' sets, each from the first document that has it."""
        wanted = scratch(nodes.join(groups, "node"), "wanted")
        ids_of = send(spark, members(wanted.select("first").distinct(), "first"))

        def sets(batches):
            for batch in batches:
                ids = batch.column(0)
                at = np.flatnonzero(may_hold(ids_of.value, ids.fill_null(-1).to_numpy(zero_copy_only=False)) & ids.is_valid().to_numpy(zero_copy_only=False))
                made = [(_digest(k), k.tobytes()) for k in (shingles(batch.column(1)[int(i)].as_py(), words) for i in at)]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), *(pa.array([m[i] for m in made], pa.binary()) for i in (0, 1))], names=["first", "digest", "keys"])

        made = docs.mapInArrow(trimmed(sets), "first long, digest binary, keys binary").where("digest is not null")
        return made.select(F.xxhash64("digest").alias("node"), "first", "keys").join(wanted, ["node", "first"], "left_semi").dropDuplicates(["node"]).select("node", "keys")

    found, sets = link(posts, load_sets, num, den)
    # what rows with one id are linked to belongs together
    several = named.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b")
    whole = found
    if several.limit(1).count():
        ties = named.select("doc_id", "node").join(several.select("doc_id", "a"), "doc_id").where("a <> node").select("a", F.col("node").alias("b"))
        whole = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(ties))
    placed = scratch(whole.join(groups, "node"), "placed")
    least = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    moved = placed.join(least, "component").select("node", "component_id")
    if links:
        moved = moved.join(degrees(scratch(found, "found"), sets, num, den), "node", "left")
    answers = groups.join(moved, "node", "left").withColumn("component_id", F.coalesce("component_id", "first")).drop("first")
    out = ["doc_id", "n_shingles", F.when(F.col("named"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")]
    if links:
        out.append(F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    rows = outlines.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("digest").isNotNull(), F.col("node")).alias("node"), (F.col("digest").isNotNull() & F.col("doc_id").isNotNull()).alias("named"))
    return rows.join(answers, "node", "left").select(*out)


def keep_first(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of docs that are the first of their component; the columns stay.

    Rows that share an id stay or go together; null ids, null and empty texts stay.
    """
    comps = jaccard_components(docs, words, num, den, links=False)
    later = comps.where("n_shingles > 0 and component_id < doc_id").select("doc_id").distinct()
    return docs.join(later, "doc_id", "left_anti").select(*docs.columns)
