"""Toxicity by nearest labelled examples: exact TF-IDF cosine on a block-max inverted index, calibrated votes."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import islice
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, discard, stored
from .hashing import blocks, text_buffer
from .thresholds import hash_rank
from .tokens import word_hashes

#: Labelled examples, those of smallest hashed id.
EXAMPLES = 8192
#: Words that bear on no label but are let in by chance, expected over all words of the examples.
CHANCE = 0.001
#: Slots of the document counts of words that are not indexed.
SLOTS = 1 << 20
#: Neighbours that vote, examples of a block.
NEIGHBOURS, BLOCK = 16, 64
#: Terms that one in so many examples hold are multiplied as whole rows, for so many texts at once.
OFTEN, TOGETHER = 8, 64
#: Weight of the examples' share of toxic ones in a vote.
PRIOR = 0.01


def _terms(data, offsets):
    """For each row its distinct words' hashes and counts."""
    own, first = word_hashes(data, offsets)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        yield np.unique(own[a:b], return_counts=True)


def _rows_terms(batch):
    data, offsets = text_buffer(batch["text"])
    for _, _, block, at in blocks(data, offsets):
        yield from _terms(block, at)


def _example_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for toxic, (term, _) in zip(batch["toxic"].to_pylist(), _rows_terms(batch), strict=True):
            yield pa.record_batch([pa.array(np.full(len(term), toxic, np.int32)), pa.array(term.view(np.int64))], names=["toxic", "term"])


def _document_counts(words):
    """(slot, n): in how many of a task's rows a slot's words occur; slot -1 counts the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, rows = np.zeros(words.value.size, np.int64), 0
        for batch in batches:
            for term, _ in _rows_terms(batch):
                count[np.unique(words.value.slots(term))] += 1
                rows += 1
        if rows:
            found = np.flatnonzero(count)
            yield pa.record_batch([pa.array(np.r_[-1, found]), pa.array(np.r_[rows, count[found]])], names=["slot", "n"])

    return run


def _weigh(words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [words.value.weigh(term, n) for term, n in _rows_terms(batch)]
            yield pa.record_batch([batch["doc_id"], batch["toxic"], pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([f[1] for f in found], pa.list_(pa.float64()))], names=["doc_id", "toxic", "term", "weight"])

    return run


class Words:
    """The indexed words in order of their hashes, and the idf of all words: of an indexed one its own, of others their slot's.

    An indexed word's idf counts 1 + `evidence` times, if that is given.
    """

    def __init__(self, names: np.ndarray, slots: int = SLOTS, evidence: np.ndarray | None = None):
        names = names.astype(np.uint64)
        order = np.argsort(names)
        self.names, self.others = names[order], slots
        self.evidence = np.zeros(len(names)) if evidence is None else np.maximum(evidence, 0)[order]
        self.size, self.rows = len(self.names) + slots, 0
        self.df, self.idf = np.ones(self.size, np.int64), np.zeros(self.size)

    def __getstate__(self) -> dict:
        """Packed, as it is sent to all tasks: most slots hold small counts."""
        own = len(self.names)
        return {"names": self.names, "others": self.others, "rows": self.rows, "idf": self.idf[:own], "df": zlib.compress(self.df[own:].tobytes(), 1)}

    def __setstate__(self, packed: dict) -> None:
        self.names, self.others, self.rows = packed["names"], packed["others"], packed["rows"]
        self.size = len(self.names) + self.others
        self.idf = np.concatenate([packed["idf"], np.log((self.rows + 1) / np.frombuffer(zlib.decompress(packed["df"]), np.int64))])

    def slots(self, term: np.ndarray) -> np.ndarray:
        out = (term % np.uint64(self.others)).astype(np.int64) + len(self.names)
        if len(self.names):
            at = np.minimum(np.searchsorted(self.names, term), len(self.names) - 1)
            out = np.where(self.names[at] == term, at, out)
        return out

    def count(self, slot: np.ndarray, n: np.ndarray) -> None:
        """Takes the document counts: idf log((rows + 1) / rows with the word)."""
        self.rows = int(n[slot < 0].sum())
        self.df[slot[slot >= 0]] = n[slot >= 0]
        self.idf = np.log((self.rows + 1) / self.df)
        self.idf[: len(self.names)] *= 1 + self.evidence

    def weigh(self, term: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A text's indexed words and their weights (1 + log n) idf in the unit vector of all its words."""
        at = self.slots(term)
        w = (1 + np.log(n)) * self.idf[at]
        norm = np.sqrt((w * w).sum())
        own = at < len(self.names)
        return (at[own], w[own] / norm) if norm > 0 else (at[:0], w[:0])


def ragged(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges first..last-1 in a row, and the range of each."""
    n = last - first
    which = np.repeat(np.arange(len(n)), n)
    return np.arange(len(which)) - (np.cumsum(n) - n)[which] + first[which], which


class Index:
    """Posting lists of the examples by term, in runs of one block of examples, with each run's largest weight."""

    def __init__(self, n_terms: int, ids: np.ndarray, toxic: np.ndarray, example: np.ndarray, term: np.ndarray, weight: np.ndarray):
        heaviest = np.full(len(ids), n_terms)
        by_weight = np.lexsort((term, weight))
        heaviest[example[by_weight]] = term[by_weight]
        order = np.lexsort((ids, heaviest))  # like examples meet in a block
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.ids, self.toxic = ids[order], toxic[order]
        self.n_blocks = -(-len(ids) // BLOCK)
        posting = np.lexsort((place[example], term))
        # places as short as they may be: most of the time goes into reading them
        self.place, self.weight, term = place.astype(np.min_scalar_type(len(ids)))[example[posting]], weight[posting], term[posting]
        run = np.flatnonzero(np.r_[True, (np.diff(term) != 0) | (np.diff((self.place // BLOCK).astype(np.int64)) != 0)]) if len(term) else np.zeros(0, np.int64)
        self.run = np.r_[run, len(term)]
        self.run_block = self.place[run].astype(np.int64) // BLOCK
        self.run_most = np.maximum.reduceat(self.weight, run) if len(run) else np.zeros(0)
        self.term_run = np.searchsorted(term[run], np.arange(n_terms + 1))
        self._spread()

    def _spread(self) -> None:
        """Terms that a quarter of the blocks hold have their runs, and the runs' largest weights, as rows by block as well; frequent ones their weights by place."""
        often = np.flatnonzero(OFTEN * np.diff(self.run[self.term_run]) >= max(self.n_blocks, 1) * BLOCK)
        self.rows = {t: k for k, t in enumerate(often.tolist())}
        self.row = np.full(len(self.term_run) - 1, -1)
        self.row[often] = np.arange(len(often))
        postings, row = ragged(self.run[self.term_run[often]], self.run[self.term_run[often + 1]])
        self.often = np.zeros((len(often), self.n_blocks * BLOCK))
        self.often[row, self.place[postings]] = self.weight[postings]
        wide = np.flatnonzero(4 * np.diff(self.term_run) >= max(self.n_blocks, 1))
        self.wide = np.full(len(self.term_run) - 1, -1)
        self.wide[wide] = np.arange(len(wide))
        runs, row = ragged(self.term_run[wide], self.term_run[wide + 1])
        self.wide_run, self.wide_most = np.full((len(wide), self.n_blocks), -1, np.int32), np.zeros((len(wide), self.n_blocks))
        self.wide_run[row, self.run_block[runs]] = runs
        self.wide_most[row, self.run_block[runs]] = self.run_most[runs]

    def __getstate__(self) -> dict:
        """Packed, as it is sent to all tasks: runs as short as they may be, nothing that follows from the rest."""
        short = {name: getattr(self, name).astype(np.min_scalar_type(int(getattr(self, name).max(initial=0)))) for name in ("run", "term_run")}
        return {"ids": self.ids, "toxic": self.toxic, "n_blocks": self.n_blocks, "place": self.place, "weight": self.weight} | short

    def __setstate__(self, packed: dict) -> None:
        self.__dict__.update({name: x.astype(np.int64) if name in ("run", "term_run") else x for name, x in packed.items()})
        first = self.run[:-1]
        self.run_block = self.place[first].astype(np.int64) // BLOCK
        self.run_most = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        self._spread()

    def nearest(self, at: np.ndarray, w: np.ndarray, k: int, leave: int | None = None, share: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of highest cosine above 0 (ties: smaller id), exact: blocks whose bound is too low are passed over.

        `share` is what `together` tells with the text, if it was asked.
        """
        hit, cos, floor, done, step = np.zeros(0, np.int64), np.zeros(0), 0.0, 0, -(-2 * k // BLOCK)
        row = self.wide[at]
        narrow, wide = row < 0, row[row >= 0]
        runs, which = ragged(self.term_run[at[narrow]], self.term_run[at[narrow] + 1])
        if not len(runs) and not len(wide):
            return hit, cos
        wide_w, block, narrow_w = w[~narrow], self.run_block[runs], w[narrow][which]
        bound = np.bincount(block, narrow_w * self.run_most[runs], self.n_blocks) + wide_w @ self.wide_most[wide]
        order = np.argsort(-bound, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        while done < len(order) and bound[order[done]] > 0 and bound[order[done]] >= floor - 1e-12:
            if done and 2 * (np.count_nonzero(bound >= floor - 1e-12) - done) > len(order):
                # most blocks are left: the terms' lists as they lie are quicker than runs picked from them
                found = self._cosines(at, w, share)
                place = np.flatnonzero((found > 0) & (found >= floor - 1e-12))
                place = place[rank[place // BLOCK] >= done]
                hit, cos, floor = self._best(hit, cos, place, found[place], k, leave)
                break
            mine = np.flatnonzero((rank[block] >= done) & (rank[block] < done + step))
            more = self.wide_run[wide[:, None], order[done : done + step]]
            held = more >= 0
            of_step, of_term = np.r_[runs[mine], more[held]], np.r_[narrow_w[mine], np.broadcast_to(wide_w[:, None], more.shape)[held]]
            posting, of = ragged(self.run[of_step], self.run[of_step + 1])
            place = (rank[self.run_block[of_step]][of] - done) * BLOCK + self.place[posting] % BLOCK
            found = np.bincount(place, of_term[of] * self.weight[posting])
            ok = np.flatnonzero((found > 0) & (found >= floor - 1e-12))
            hit, cos, floor = self._best(hit, cos, order[done + ok // BLOCK] * BLOCK + ok % BLOCK, found[ok], k, leave)
            done += step
            step *= 4
        return hit, cos

    def together(self, texts: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Each text (terms, weights) with the frequent terms' part of its cosine with each place: one product for TOGETHER texts."""
        texts = iter(texts)
        while few := list(islice(texts, TOGETHER)):
            held = np.zeros((TOGETHER, len(self.often)))  # as many rows always, so that sums don't hang on which texts meet
            for k, (at, w) in enumerate(few):
                row = self.row[at]
                held[k, row[row >= 0]] = w[row >= 0]
            yield from ((at, w, share) for (at, w), share in zip(few, held @ self.often, strict=False))

    def _cosines(self, at: np.ndarray, w: np.ndarray, share: np.ndarray | None) -> np.ndarray:
        """The cosine of each place: the lists of the rarer terms, and the frequent ones' share."""
        if share is None:
            _, _, share = next(self.together([(at, w)]))
        rare = self.row[at] < 0
        at, w = at[rare], w[rare]
        a, b = self.run[self.term_run[at]], self.run[self.term_run[at + 1]]
        lists = list(zip(a.tolist(), b.tolist(), strict=True))
        if not lists:
            return share
        found = np.concatenate([self.weight[x:y] for x, y in lists])
        found *= np.repeat(w, b - a)
        return share + np.bincount(np.concatenate([self.place[x:y] for x, y in lists]), found, self.n_blocks * BLOCK)

    def _best(self, hit, cos, place, found, k: int, leave: int | None):
        """The k best of those held and those found, and the cosine that others must reach."""
        if leave is not None:
            found, place = found[self.ids[place] != leave], place[self.ids[place] != leave]
        if len(found) > 4 * k:
            near = found >= np.partition(found, len(found) - k)[len(found) - k] - 1e-11
            found, place = found[near], place[near]
        hit, cos = np.concatenate([hit, place]), np.concatenate([cos, found])
        best = np.lexsort((self.ids[hit], -np.round(cos, 12)))[:k]
        hit, cos = hit[best], cos[best]
        return hit, cos, cos[-1] if len(cos) == k else 0.0

    def vote(self, hit: np.ndarray, cos: np.ndarray, prior: float) -> float:
        """Share of toxic neighbours, weighed by one over the distance 1 - cosine (0.05 at least) beyond that of a text that shares nothing.

        The examples' share of toxic ones votes with weight PRIOR: far neighbours alone tell little, however alike their labels are.
        """
        w = 1 / np.maximum(1 - cos, 0.05) - 1
        return float(((w * self.toxic[hit]).sum() + PRIOR * prior) / (w.sum() + PRIOR))


def calibration(vote: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A rising step function from vote to share of toxic examples: pooled adjacent violators over equal votes."""
    order = np.argsort(vote, kind="stable")
    pools: list[list[float]] = []  # first vote, toxic, all
    for v, y in zip(vote[order].tolist(), toxic[order].tolist(), strict=True):
        if pools and pools[-1][0] == v:
            pools[-1][1] += y
            pools[-1][2] += 1
        else:
            pools.append([v, y, 1])
    out: list[list[float]] = []
    for p in pools:
        out.append(p)
        while len(out) > 1 and out[-2][1] * out[-1][2] >= out[-1][1] * out[-2][2]:
            last = out.pop()
            out[-1][1] += last[1]
            out[-1][2] += last[2]
    return np.array([p[0] for p in out]), np.array([p[1] / p[2] for p in out])


class Model:
    """The words, the index, and the calibration, which asks for each example without itself."""

    def __init__(self, words: Words, index: Index, vectors: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, toxic: np.ndarray, k: int):
        self.words, self.index, self.k = words, index, k
        self.prior = float(toxic.mean()) if len(toxic) else 0.0
        votes, truth, lone = [], [], []
        for (at, w, share), own, y in zip(index.together(vectors), ids.tolist(), toxic.tolist(), strict=True):
            hit, cos = index.nearest(at, w, k, own, share)
            if len(hit):
                votes.append(index.vote(hit, cos, self.prior))
                truth.append(y)
            else:
                lone.append(y)
        self.steps = calibration(np.array(votes), np.array(truth)) if votes else (np.zeros(0), np.zeros(0))
        self.alone = float(np.mean(lone)) if lone else self.prior

    def scores(self, texts: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[float, list[dict]]]:
        """The score and the nearest examples of each text, told as its distinct words and their counts."""
        for at, w, share in self.index.together(self.words.weigh(term, n) for term, n in texts):
            hit, cos = self.index.nearest(at, w, self.k, None, share)
            if not len(hit) or not len(self.steps[0]):
                yield self.alone, []
                continue
            step = max(int(np.searchsorted(self.steps[0], self.index.vote(hit, cos, self.prior), side="right")) - 1, 0)
            yield float(self.steps[1][step]), [{"doc_id": int(self.index.ids[h]), "toxic": int(self.index.toxic[h]), "cosine": float(c)} for h, c in zip(hit[:3], cos[:3], strict=True)]

    def score(self, term: np.ndarray, n: np.ndarray) -> tuple[float, list[dict]]:
        return next(self.scores([(term, n)]))


def evidence_bound(words: int, chance: float = CHANCE) -> float:
    """The likelihood ratio statistic that `chance` of `words` words without bearing on the labels pass on average."""
    return NormalDist().inv_cdf(min(chance / max(words, 1), 1) / 2) ** 2


def _share(o, e):
    """o log(o / e), 0 where o is 0."""
    return F.when(o > 0, o * F.log(o / e)).otherwise(0.0)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", examples: int = EXAMPLES, chance: float | None = CHANCE, k: int = NEIGHBOURS, slots: int = SLOTS) -> Model:
    """The model of at most `examples` labelled rows, those of smallest hashed id; `labels` (doc_id, toxic) holds training rows only.

    Indexed are all words of the examples whose presence goes with the label beyond chance: likelihood ratio (G)
    statistic over the examples, as many as there are. Without a `chance`, all words of the examples are indexed, and
    each word's weight is 1 + G times its TF-IDF in texts and norms. Norms are over all words of a text. Document counts are taken
    over all documents: of each indexed word exactly, of the others by hash in `slots` slots.
    """
    tell = docs.sparkSession.sparkContext.broadcast
    use = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).withColumn("r", hash_rank(F.col("doc_id"))).orderBy("r", "doc_id").limit(examples)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    known = stored(rows.join(F.broadcast(use.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))
    n, pos = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    a, c = F.col("a"), F.col("c")
    found = stored(known.select("toxic", "text").mapInArrow(_example_terms, "toxic int, term long").groupBy("term").agg(F.sum("toxic").cast("double").alias("a"), F.count("*").cast("double").alias("c")))
    names, evidence = np.zeros(0, np.int64), None
    if chance is None and not 0 < pos < n:
        names = found.select("term").toArrow()["term"].to_numpy()  # the words of the examples
    elif 0 < pos < n:
        p = pos / n
        g = 2 * (_share(a, c * p) + _share(c - a, c * (1 - p)) + _share(pos - a, (n - c) * p) + _share(n - c - pos + a, (n - c) * (1 - p)))
        told = found.select("term", g.alias("g"))
        if chance is not None:
            told = told.where(F.col("g") > evidence_bound(found.count(), chance))
        told = told.toArrow()  # words of the examples
        names, evidence = told["term"].to_numpy(), told["g"].to_numpy() if chance is None else None
    words = Words(names.view(np.uint64), slots, evidence)
    known_words = tell(words)
    counts = rows.select("text").mapInArrow(_document_counts(known_words), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # at most one row a slot
    words.count(counts["slot"].to_numpy(), counts["n"].to_numpy())
    known_words.unpersist()
    known_words = tell(words)
    vectors = known.mapInArrow(_weigh(known_words), "doc_id long, toxic int, term array<long>, weight array<double>").toArrow().sort_by("doc_id").combine_chunks()
    known_words.unpersist()
    discard(known, found)
    at, w = ([np.asarray(x.values) for x in vectors[name]] for name in ("term", "weight"))
    ids, toxic = vectors["doc_id"].to_numpy(), vectors["toxic"].to_numpy().astype(float)
    example = np.repeat(np.arange(len(ids)), [len(t) for t in at])
    index = Index(len(names), ids, toxic, example, np.concatenate([*at, np.zeros(0, np.int64)]), np.concatenate([*w, np.zeros(0)]))
    return Model(words, index, list(zip(at, w, strict=True)), ids, toxic, k)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(model.value.scores(_rows_terms(batch)))
            yield pa.record_batch([batch["doc_id"], pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], EVIDENCE)], names=["doc_id", "score", "evidence"])

    return run


EVIDENCE = pa.list_(pa.struct([("doc_id", pa.int64()), ("toxic", pa.int64()), ("cosine", pa.float64())]))
SCORE_SCHEMA = "doc_id long, score double, evidence array<struct<doc_id:bigint,toxic:bigint,cosine:double>>"


def held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One row for each document: doc_id, held_out, score, predicted, evidence (nearest examples).

    Learned from labelled rows whose crc32(id as text) mod 5 is not 0. `options` are those of `fit`. A score is the calibrated vote of the nearest
    examples. The index holds words of `examples` texts alone, the counts `slots` slots, whatever the input; both are
    told to all tasks, and the texts are scored where they are read.

    Null or empty text, or none of the indexed words: the share of toxic examples among those without neighbours. Null
    ids count as the empty text for the fold. Without labelled rows all scores are 0; with labels of one kind alone all
    scores are that label. Of an id that repeats with other texts the smallest text is the example. Repeated rows are
    each scored. Empty table: no rows.
    """
    bounded_batches(docs.sparkSession)
    model = fit(docs, labels.where(~held_out(F.col("doc_id"))), text, doc_id, **options)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    scored = rows.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model)), SCORE_SCHEMA)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"), "evidence")
