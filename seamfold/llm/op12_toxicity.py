"""Toxicity by weak supervision: many voters, a model of how right they are, a linear classifier.

1. Words and stems (first bytes of words) that are far more, or far less, frequent in
   toxic texts than in others are listed, from all labelled rows that may be learned from;
   near copies count once.
2. Voters look at every text: lexicons that the listed words are dealt to, stems of each
   length, how many and how dense they are, and patterns of punctuation. What they say of
   a text is a number of 16 bits, so that all that the corpus says is 65,536 counts.
3. A generative model of these counts, with two classes, an accuracy for each voter in
   each class and weights for the pairs of voters that agree more or less than their
   accuracies explain, is fitted by expectation-maximisation, every sum over the 65,536
   states taken in full. Labels tell the class of some of the rows.
4. Its posteriors are the labels of a logistic regression over the listed words and stems,
   fitted on a bounded sample and applied to all texts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamfold.llm.core import as_long, mix, prepare, scratch, send, trimmed
from seamfold.llm.op5_quality import BROADCAST_LABELS, held_out
from seamfold.llm.scan import Scanner, Words

#: Bytes of the stems that are looked at, of words that are longer.
STEMS = (4, 5, 6, 7)
#: How much more frequent in one class a word must be for the classifier, and for the voters.
LIFT, STRONG = 3.0, 8.0
#: Words and stems that the model knows, at most; those that tell most.
ENTRIES = 200_000
#: Rows, and listed words of rows, that the classifier is fitted on, at most about.
FIT_ROWS, FIT_SLOTS = 20_000, 8_000_000
LEXICONS, VOTERS, EDGES = 6, 16, 24
#: Words that a sketch's shingles have; texts that share their least shingle are taken for near copies.
SHINGLE = 8
_STATES = 1 << VOTERS
_SPACE = bytes(b for b in range(128) if not (chr(b).isalnum() or b == ord("'")))
_FLUSH = 1 << 20


class Features:
    """The distinct words of some documents as words and stems."""

    def __init__(self) -> None:
        self.scanner = Scanner(_SPACE)

    def chunks(self, texts: pa.Array):
        """Words, each one's place among the chunk's distinct ones, and (kind, whose stems they are, hashes) of these."""
        for words in self.scanner.chunks(texts):
            hashes, first, place = np.unique(words.hashes(), return_index=True, return_inverse=True)
            kinds = [(0, np.arange(len(hashes)), hashes)]
            for n in STEMS:
                own = np.flatnonzero(words.lengths[first] > n)
                lengths = np.full(len(own), n)
                kinds.append((n, own, self.scanner.finish(self.scanner.hashes(words.raw, words.starts[first[own]], lengths), lengths, n)))
            yield words, place, kinds


def sketches(words: Words, hashes: np.ndarray) -> np.ndarray:
    """The least hash of each document's shingles; of fewer words, of the whole; 0 without words."""
    counts = words.counts()
    ends = np.cumsum(counts)
    g = np.zeros(len(hashes), np.uint64)
    last = ends[words.doc]
    at = np.arange(len(hashes))
    for k in range(SHINGLE):
        inside = at + k < last
        g = np.where(inside, mix(g + hashes[np.minimum(at + k, len(hashes) - 1)]), g)
    whole = (at + SHINGLE <= last) | (at == last - counts[words.doc])
    g[~whole] = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.zeros(words.n_docs, np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        out[full] = np.minimum.reduceat(g, (ends - counts)[full])
    return out


def likelihood_ratio(n1: str, n0: str, t1: int, t0: int):
    """G of a word's occurrence against the class: twice the logarithm of how much likelier the counts are with it."""
    part = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
    a, b = F.col(n1).cast("double"), F.col(n0).cast("double")
    with_, total = a + b, float(t1 + t0)
    return 2 * (part(a, with_ * t1 / total) + part(b, with_ * t0 / total) + part(t1 - a, (total - with_) * t1 / total) + part(t0 - b, (total - with_) * t0 / total))


class Lexicon:
    """Listed words and stems: hashes ascending, their kinds, and the logarithms of their lifts."""

    def __init__(self, hashes: np.ndarray, kinds: np.ndarray, lift: np.ndarray) -> None:
        order = np.argsort(hashes)
        self.hashes, self.kinds, self.lift = hashes[order], kinds[order], lift[order]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of hashes, or -1."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)


class Voters:
    """What the voters say of documents, and which listed words and stems these have."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon, self.features = lexicon, Features()
        self.loud, self.masked = np.zeros(256, bool), np.zeros(256, bool)
        self.loud[list(b"!?")], self.masked[list(b"#$%&*@")] = True, True
        strong = lexicon.lift >= math.log(STRONG)
        # which voter a listed word or stem makes fire, or -1
        self.voter = np.full(len(strong), -1)
        words = strong & (lexicon.kinds == 0)
        self.voter[words] = (lexicon.hashes[words] % np.uint64(LEXICONS)).astype(np.int64)
        for i, n in enumerate(STEMS):
            self.voter[strong & (lexicon.kinds == n)] = LEXICONS + i
        self.voter[lexicon.lift <= -math.log(STRONG)] = VOTERS - 1

    def _runs(self, words: Words, of: np.ndarray, n: int) -> np.ndarray:
        """Documents with n such bytes in a row."""
        hit = of[words.raw]
        run = hit[: len(hit) - n + 1].copy() if len(hit) >= n else np.zeros(0, bool)
        for k in range(1, n):
            run &= hit[k : len(hit) - n + 1 + k]
        at = np.flatnonzero(run)
        doc = lambda i: np.searchsorted(words.offsets, i, side="right") - 1
        return doc(at)[doc(at) == doc(at + n - 1)]

    def __call__(self, texts: pa.Array):
        """(votes, listed): a number and an array of places in the lexicon for each document, in order."""
        for words, place, kinds in self.features.chunks(texts):
            votes = np.zeros(words.n_docs, np.int64)
            n_distinct = len(kinds[0][2])
            strong, owners, listed = np.zeros(n_distinct, bool), [], []
            for _, own, hashes in kinds:
                at = self.lexicon.find(hashes)
                known = np.flatnonzero(at >= 0)
                owners.append(own[known])
                listed.append(at[known])
                fires = self.voter[at[known]]
                strong[own[known[(fires >= 0) & (fires < VOTERS - 1)]]] = True
            # (document, distinct word) for all words that are listed somehow, then (document, listed)
            owner, entry = np.concatenate(owners), np.concatenate(listed)
            order = np.argsort(owner, kind="stable")
            owner, entry = owner[order], entry[order]
            n_each = np.bincount(owner, minlength=n_distinct)
            hit = np.flatnonzero(n_each[place] > 0)
            pairs = np.unique(words.doc[hit] * max(1, n_distinct) + place[hit])
            doc, word = pairs // max(1, n_distinct), pairs % max(1, n_distinct)
            times = n_each[word]
            start = (np.cumsum(n_each) - n_each)[word]
            within = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
            size = max(1, len(self.lexicon.hashes))
            both = np.unique(np.repeat(doc, times) * size + entry[np.repeat(start, times) + within])
            whose, entries = both // size, both % size
            fires = self.voter[entries]
            np.bitwise_or.at(votes, whose[fires >= 0], np.int64(1) << fires[fires >= 0])
            at = LEXICONS + len(STEMS)
            votes[np.bincount(doc, strong[word], words.n_docs) >= 2] |= 1 << at
            tokens = np.flatnonzero(strong[place])
            votes[np.bincount(words.doc[tokens], minlength=words.n_docs) * 100 >= np.maximum(words.counts(), 1)] |= 1 << (at + 1)
            near = (np.diff(tokens) <= 10) & (np.diff(words.doc[tokens]) == 0)
            votes[words.doc[tokens[1:][near]]] |= 1 << (at + 2)
            votes[self._runs(words, self.loud, 2)] |= 1 << (at + 3)
            votes[self._runs(words, self.masked, 3)] |= 1 << (at + 4)
            cuts = np.searchsorted(whose, np.arange(words.n_docs + 1))
            yield from ((int(v), entries[a:b]) for v, a, b in zip(votes, cuts, cuts[1:], strict=False))


class LabelModel:
    """P(class) and P(votes | class), the latter of log-linear form with weights for voters and some pairs of them."""

    def __init__(self) -> None:
        bits = np.arange(_STATES)[:, None] >> np.arange(VOTERS) & 1
        self.bits, self.edges, self.phi = bits.astype(np.float64), [], bits.astype(np.float64)
        self.prior, self.weights = 0.5, np.zeros((2, VOTERS))

    def _log(self, weights: np.ndarray) -> np.ndarray:
        """Log-probabilities of all states."""
        z = self.phi @ weights
        top = z.max()
        return z - top - math.log(np.exp(z - top).sum())

    def posterior(self) -> np.ndarray:
        """P(toxic | votes) for all states."""
        one, zero = (self._log(w) for w in self.weights[::-1])
        z = math.log(self.prior) - math.log(1 - self.prior) + one - zero
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))

    def rates(self) -> np.ndarray:
        """How often each voter speaks in each class."""
        return np.stack([np.exp(self._log(w)) @ self.bits for w in self.weights])

    def _climb(self, y: int, counts: np.ndarray, steps: int, ridge: float = 1.0) -> None:
        """Newton steps towards the weights that make counts likeliest."""
        seen, n, w = self.phi.T @ counts, counts.sum(), self.weights[y]
        value = lambda w: float(counts @ self._log(w)) - ridge / 2 * float(w @ w)
        for _ in range(steps):
            p = np.exp(self._log(w))
            mean = self.phi.T @ p
            hessian = n * ((self.phi * p[:, None]).T @ self.phi - np.outer(mean, mean)) + ridge * np.eye(len(w))
            move = np.linalg.solve(hessian, seen - n * mean - ridge * w)
            now, share = value(w), 1.0
            while share > 1e-3 and value(w + share * move) < now:
                share /= 2
            w = w + share * move if share > 1e-3 else w
            if share <= 1e-3 or np.abs(move).max() < 1e-4:
                break
        self.weights[y] = w

    def _correlated(self, shares: list[np.ndarray], least: float = 0.1) -> list[tuple[int, int]]:
        """Pairs of voters whose votes go together within a class more, or less, than they would by chance; the strongest first."""
        found: dict[tuple[int, int], float] = {}
        for c in shares:
            p = c / max(c.sum(), 1e-9)
            mean = p @ self.bits
            cov = (self.bits * p[:, None]).T @ self.bits - np.outer(mean, mean)
            sd = np.sqrt(np.maximum(np.diag(cov), 0))
            for i in range(VOTERS):
                for j in range(i):
                    if sd[i] * sd[j] > 1e-6:
                        found[j, i] = max(found.get((j, i), 0.0), abs(cov[i, j] / (sd[i] * sd[j])))
        return sorted((e for e, r in found.items() if r >= least), key=lambda e: -found[e])[:EDGES]

    def fit(self, unlabelled: np.ndarray, negative: np.ndarray, positive: np.ndarray, rounds: int = 8) -> LabelModel:
        """Counts of states among rows without a label, and with label 0 and 1, at least one of each."""
        known = (negative, positive)
        self.prior = positive.sum() / (positive.sum() + negative.sum())
        for y in (0, 1):
            self._climb(y, known[y], 8)
        for dependent in (False, True):
            shares = self._shares(unlabelled, known)
            if dependent:
                self.edges = self._correlated(shares)
                self.phi = np.concatenate([self.bits, *(self.bits[:, [i]] * self.bits[:, [j]] for i, j in self.edges)], axis=1)
                self.weights = np.concatenate([self.weights, np.zeros((2, len(self.edges)))], axis=1)
            for _ in range(rounds):
                before = self.posterior()
                for y in (0, 1):
                    self._climb(y, shares[y], 3)
                self.prior = float(shares[1].sum() / (shares[0].sum() + shares[1].sum()))
                shares = self._shares(unlabelled, known)
                if np.abs(self.posterior() - before) @ unlabelled <= 1e-4 * max(1.0, unlabelled.sum()):
                    break
        return self

    def _shares(self, unlabelled: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
        q = self.posterior()
        return [known[0] + unlabelled * (1 - q), known[1] + unlabelled * q]


def logistic(rows: list[np.ndarray], n: int, target: np.ndarray, weight: np.ndarray, ridge: float = 1.0, steps: int = 250) -> np.ndarray:
    """Weights, the bias last, of the regression of targets in 0..1 on which of n features rows have; full gradients, scaled by their history."""
    flat = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w, m, v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    scale = weight / weight.sum()
    for t in range(1, steps + 1):
        z = np.bincount(owner, w[flat], len(rows)) + w[-1]
        gap = scale * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target)
        g = np.append(np.bincount(flat, gap[owner], n), gap.sum())
        g[:-1] += ridge / weight.sum() * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.2 * min(1.0, 3 * (1 - t / steps)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return w


def _labelled(docs: DataFrame, labels: DataFrame, label: str, folds: int) -> DataFrame:
    """(doc_id, text, y) of the rows that may be learned from."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("y in (0, 1) and doc_id is not null").where(~held_out("doc_id", folds)).groupBy("doc_id").agg(F.max("y").alias("y"))
    known = F.broadcast(known) if known.count() <= BROADCAST_LABELS else known
    return docs.join(known, "doc_id")


def lexicon_of(rows: DataFrame, entries: int = ENTRIES) -> Lexicon | None:
    """The words and stems of (doc_id, text, y) that tell the classes apart; None without rows of both.

    What is listed is likelier to go with a class than the luckiest of as many words without any
    relation to it, and LIFT times as frequent there. Near copies count once.
    """

    def sketch(batches):
        features = Features()
        for batch in batches:
            found = [sketches(w, w.hashes()) for w in features.scanner.chunks(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(as_long(np.concatenate([*found, np.zeros(0, np.uint64)])))], names=["doc_id", "y", "sketch"])

    one = rows.select("doc_id", "text", "y").mapInArrow(trimmed(sketch), "doc_id long, y int, sketch long").groupBy("sketch", "y").agg(F.min("doc_id").alias("doc_id"))
    one = scratch(one, "sketched")
    n = {r["y"]: r["count"] for r in one.groupBy("y").count().collect()}
    if len(n) < 2:
        return None
    first = one.select("doc_id")
    rows = rows.join(F.broadcast(first) if sum(n.values()) <= BROADCAST_LABELS else first, "doc_id", "left_semi").select("text", "y")

    def count(batches):
        features, held, size = Features(), [], 0

        def flush():
            kind, h, n1, n = (np.concatenate(c) for c in zip(*held, strict=True))
            hs, first, place = np.unique(h, return_index=True, return_inverse=True)
            sums = [np.bincount(place, x).astype(np.int64) for x in (n1, n - n1)]
            return pa.RecordBatch.from_arrays([pa.array(kind[first].astype(np.int32)), pa.array(as_long(hs)), pa.array(sums[0]), pa.array(sums[1])], names=["kind", "h", "n1", "n0"])

        for batch in batches:
            y = batch.column(1).to_numpy().astype(np.float64)
            for words, place, kinds in features.chunks(batch.column(0)):
                for kind, own, hashes in kinds:
                    hs, to = np.unique(hashes, return_inverse=True)
                    of = np.full(len(kinds[0][2]), -1)
                    of[own] = to
                    f = of[place]
                    spots = np.unique(words.doc[f >= 0] * max(1, len(hs)) + f[f >= 0])
                    doc, f = spots // max(1, len(hs)), spots % max(1, len(hs))
                    held.append((np.full(len(hs), kind), hs, np.bincount(f, y[words.first + doc], len(hs)), np.bincount(f, minlength=len(hs)).astype(np.float64)))
                    size += len(hs)
                if size >= _FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    counts = scratch(rows.mapInArrow(trimmed(count), "kind int, h long, n1 long, n0 long").groupBy("kind", "h").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")), "tallies")
    least = 2 * math.log(max(2, counts.count()))
    lift = F.log((F.col("n1") + 0.5) / (n[1] + 1.0)) - F.log((F.col("n0") + 0.5) / (n[0] + 1.0))
    told = counts.select("kind", "h", likelihood_ratio("n1", "n0", n[1], n[0]).alias("g"), lift.alias("lift"))
    table = told.where((F.col("g") >= least) & (F.abs("lift") >= math.log(LIFT))).orderBy(F.desc("g"), "h").limit(entries).toArrow()
    return Lexicon(table["h"].to_numpy().astype(np.int64).view(np.uint64), table["kind"].to_numpy(), table["lift"].to_numpy())


def toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, threshold: float = 0.5, entries: int = ENTRIES, fit_rows: int = FIT_ROWS, fit_slots: int = FIT_SLOTS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs, scored by whole texts.

    Learns from labels 0 and 1 of ids whose crc32 is not divisible by folds; of several labels
    of one id the largest holds, other labels and null ids are left aside. Word counts and
    votes cover all rows, repeated ones each time; the classifier is fitted on a sample by hash of at most about
    fit_rows rows, half of them likely toxic if there are so many, and fit_slots listed words.
    Null and empty texts are rows without words; null ids are not held out. Labels of one
    class only give a constant score, no labels 0.5; no rows give none. Other columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text"))
    result = lambda scored: scored.select("doc_id", F.coalesce(held_out("doc_id", folds), F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
    rows = _labelled(docs, labels, label, folds)
    lexicon = lexicon_of(rows, entries)
    if lexicon is None:
        y = rows.agg(F.max("y")).first()[0]
        return result(docs.select("doc_id", F.lit(0.5 if y is None else 1 / (1 + math.exp(-4.0 if y else 4.0))).alias("score")))
    shared = send(spark, lexicon)

    def vote(batches):
        voters = Voters(shared.value)
        for batch in batches:
            said = list(voters(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v for v, _ in said], pa.int32()), pa.array([e.astype(np.int32).tobytes() for _, e in said], pa.binary())], names=["doc_id", "votes", "listed"])

    voted = scratch(docs.mapInArrow(trimmed(vote), "doc_id long, votes int, listed binary"), "votes")
    # at most 3 * 2**16 rows
    tally = _labelled(voted.select("doc_id", "votes"), labels, label, folds).groupBy("votes", "y").count().collect()
    known = np.zeros((2, _STATES))
    for r in tally:
        known[r.y, r.votes] = r["count"]
    everything, slots = np.zeros(_STATES), 0
    for r in voted.groupBy("votes").agg(F.count("*").alias("n"), F.sum(F.length("listed")).alias("bytes")).collect():
        everything[r.votes], slots = r.n, slots + r.bytes // 4
    model = LabelModel().fit(np.maximum(everything - known.sum(axis=0), 0), *known)
    posterior = model.posterior()

    # half of the sample from each side of the posterior, weighted by what it stands for
    likely = posterior >= 0.5
    share = [min(1.0, fit_rows / 2 / max(1.0, everything[likely == side].sum()), fit_slots / max(1, slots)) for side in (False, True)]
    told = send(spark, (posterior, likely, share))

    def take(batches):
        q, side, part = told.value
        for batch in batches:
            v = batch.column(1).to_numpy()
            least = np.where(side[v], part[1], part[0])
            drawn = batch.column(3).to_numpy() < (least * (1 << 30)).astype(np.int64)
            v, least = v[drawn], least[drawn]
            yield pa.RecordBatch.from_arrays([batch.column(3).filter(pa.array(drawn)), pa.array(q[v]), pa.array(1 / least), batch.column(2).filter(pa.array(drawn))], names=["lot", "q", "weight", "listed"])

    lot = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id", "votes", "listed"), F.lit(1 << 30))
    sample = voted.select("doc_id", "votes", "listed", lot.alias("lot")).mapInArrow(take, "lot long, q double, weight double, listed binary")
    n = len(lexicon.hashes)

    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by([("lot", "ascending"), ("q", "ascending")])
        own = [np.frombuffer(x.as_buffer(), np.int32) for x in table["listed"]]
        w = logistic(own, n, table["q"].to_numpy(), table["weight"].to_numpy())
        return pa.table({"weight": pa.array([w.tobytes()], pa.binary())})

    fitted = sample.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(train, "weight binary").first()
    weights = send(spark, np.frombuffer(bytes(fitted[0])) if fitted else np.append(np.zeros(n), math.log(model.prior / (1 - model.prior))))

    def score(batches):
        w = weights.value
        for batch in batches:
            z = np.array([w[np.frombuffer(x.as_buffer(), np.int32)].sum() for x in batch.column(1)]) + w[-1]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())], names=["doc_id", "score"])

    return result(voted.select("doc_id", "listed").mapInArrow(score, "doc_id long, score double"))
