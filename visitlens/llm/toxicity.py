"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are whole words and the first four to seven letters of words; those that tell the labels apart
best (log-likelihood ratio over a bounded sample of labelled documents) keep a dimension of their
own, all other words share one. Document frequencies are counted over all documents. Bounded numbers of labelled documents of either label are the
examples.

The examples' vectors form an inverted index with postings in blocks of examples, and the greatest
weight of every term in every block. A document first gets an upper bound of its cosine with any
example of each block; blocks are then scored from the highest bound down, until no bound reaches
the k-th best cosine found. So the k neighbours are exact.

Neighbours vote with weights that fall with the angle; the share of toxic votes is turned into a
probability by isotonic regression on the examples' own votes (each without itself), weighted to the
frequencies of the labels. The neighbours are kept as evidence.

Defined results: an empty or null text, or one without words, has no neighbours and scores the
frequency of label 1 among the labels; without examples every score is that, or 0 without labels;
equal cosines go to the example first in the index; repeated rows are scored each for itself; an empty
table gives no rows; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import (
    arrow_schema, held_out, ids_and_texts, kind_of, labelled_sample, map_batches, one_label, read, rows_batch,
)

EXAMPLES_PER_LABEL = 2048
LEARN_PER_LABEL = 4096
CACHED_TERMS = 500_000  # of all vectors a task remembers: some 60 MB
TERMS = 512
LEAST_DOCUMENTS = 4
PREFIXES = (4, 5, 6, 7)
NEIGHBOURS = 15
BLOCK = 256
CACHED_WORDS = 300_000
SEED = 3

WORD = re.compile(r"\w+")


def terms_of(word: str) -> list[str]:
    return ["=" + word[:64], *("^" + word[:n] for n in PREFIXES if len(word) >= n)]


def learn_terms(
    sample: DataFrame, most: int = TERMS, least: int = LEAST_DOCUMENTS,
) -> list[str]:
    """The terms that tell the labels apart best, in that order."""
    def count(batches: Iterator) -> Iterator:
        for batch in batches:
            found: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist()):
                words = set(WORD.findall((text or "").lower()))
                found[label].update({term for word in words for term in terms_of(word)})
                found[label]["documents"] += 1
            rows = [(term, label, n) for label, counts in found.items() for term, n in counts.items()]
            yield rows_batch(rows, target)

    schema = "term string, label int, n long"
    target = arrow_schema(schema)
    counted = (
        map_batches(sample, count, schema).groupBy("term")
        .agg(*(F.sum(F.when(F.col("label") == x, F.col("n")).otherwise(0)).alias(name) for x, name in ((0, "clean"), (1, "toxic"))))
    )
    whole = {row["term"]: row for row in counted.filter("term = 'documents'").collect()}
    if not whole or not whole["documents"]["clean"] or not whole["documents"]["toxic"]:
        return []
    clean, toxic = float(whole["documents"]["clean"]), float(whole["documents"]["toxic"])
    total = F.col("clean") + F.col("toxic")
    part = lambda n, share: F.when(n > 0, n * F.log(n / (total * share))).otherwise(0.0)
    ratio = part(F.col("toxic"), toxic / (toxic + clean)) + part(F.col("clean"), clean / (toxic + clean))
    best = (
        counted.filter((F.col("term") != "documents") & (total >= least) & (F.col("toxic") * clean > F.col("clean") * toxic))
        .orderBy(F.round(ratio, 9).desc(), "term").limit(most).collect()
    )
    return [row["term"] for row in best]


def weigh(terms: list[str], docs: DataFrame) -> tuple[list[tuple[str, float]], float]:
    """The terms with their inverse document frequency over all of ``docs``, and that of the shared dimension."""
    known = frozenset(terms)
    schema = "term string, n long"
    target = arrow_schema(schema)

    def count(batches: Iterator) -> Iterator:
        found: Counter = Counter()
        seen: dict[str, tuple[str, ...]] = {}
        for batch in batches:
            for text in batch["text"].to_pylist():
                words = set(WORD.findall(text.lower()))
                held: set = set()
                for word in words:
                    own = seen.get(word)
                    if own is None:
                        if len(seen) > CACHED_WORDS:
                            seen.clear()
                        own = seen[word] = tuple(t for t in terms_of(word) if t in known)
                    held.update(own)
                found.update(held)
                found["documents"] += 1
                found["worded"] += bool(words)
        yield rows_batch(list(found.items()), target)

    counted = map_batches(ids_and_texts(docs), count, schema).groupBy("term").agg(F.sum("n").alias("n"))
    df = dict(counted.collect()) if terms else {}
    idf = lambda n: math.log((df.get("documents", 0) + 1) / (n + 1)) + 1
    return [(term, idf(df.get(term, 0))) for term in terms], idf(df.get("worded", 0))


class Vectoriser:
    """Sparse unit vectors; the last dimension is shared by all words."""

    def __init__(self, terms: list[tuple[str, float]], shared: float):
        self._place = {term: i for i, (term, _) in enumerate(terms)}
        self._idf = [weight for _, weight in terms]
        self._shared = shared
        self._words: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str) -> dict[int, float]:
        words = Counter(WORD.findall(text.lower()))
        if not words:
            return {}
        if len(self._words) > CACHED_WORDS:
            self._words.clear()
        counts: Counter = Counter()
        for word, n in words.items():
            places = self._words.get(word)
            if places is None:
                places = tuple(self._place[t] for t in terms_of(word) if t in self._place)
                self._words[word] = places
            for place in places:
                counts[place] += n
        vector = {place: (1 + math.log(n)) * self._idf[place] for place, n in sorted(counts.items())}
        vector[len(self._idf)] = (1 + math.log(sum(words.values()))) * self._shared
        length = math.sqrt(sum(v * v for v in vector.values()))
        return {place: v / length for place, v in vector.items()}


class BlockMax:
    """Inverted index over examples with the greatest weight of each term in each block."""

    def __init__(self, examples: list[dict[int, float]], n_terms: int, block: int = BLOCK):
        import numpy as np

        self.block, self.size = block, len(examples)
        self.n_blocks = -(-self.size // block)
        term, owner, weight = [], [], []
        for number, vector in enumerate(examples):
            term += vector.keys()
            owner += [number] * len(vector)
            weight += vector.values()
        term, owner = np.array(term, np.int64), np.array(owner, np.int64)
        weight = np.array(weight, np.float64)
        order = np.lexsort((owner, term))
        self.owner, self.weight = owner[order], weight[order]
        cell = term[order] * self.n_blocks + self.owner // block
        self.starts = np.searchsorted(cell, np.arange(n_terms * self.n_blocks + 1))
        greatest = np.zeros(n_terms * self.n_blocks)
        np.maximum.at(greatest, cell, self.weight)
        self.greatest = greatest.reshape(n_terms, self.n_blocks)

    def nearest(self, vector: dict[int, float], k: int, without: int = -1) -> tuple:
        """Numbers and cosines of the ``k`` nearest examples, exactly; ``without`` leaves one out."""
        import numpy as np

        terms, weights = np.array(list(vector), np.int64), np.array(list(vector.values()))
        if not len(terms) or not self.size:
            return np.zeros(0, np.int64), np.zeros(0)
        bounds = weights @ self.greatest[terms]
        numbers, cosines, least = np.zeros(0, np.int64), np.zeros(0), -1.0
        for block in np.argsort(-bounds, kind="stable"):
            if len(numbers) == k and bounds[block] < least - 1e-9:
                break
            low = block * self.block
            scores = np.zeros(min(self.block, self.size - low))
            for term, weight in zip(terms, weights):
                at = term * self.n_blocks + block
                a, b = self.starts[at], self.starts[at + 1]
                if a < b:
                    scores[self.owner[a:b] - low] += weight * self.weight[a:b]
            own = np.arange(low, low + len(scores))
            keep = own != without
            numbers, cosines = np.r_[numbers, own[keep]], np.r_[cosines, scores[keep]]
            order = np.lexsort((numbers, -np.round(cosines, 9)))[:k]
            numbers, cosines = numbers[order], cosines[order]
            least = np.round(cosines[-1], 9) if len(cosines) else -1.0
        return numbers, cosines


def vote(numbers, cosines, labels) -> float:
    """Share of label 1 among the neighbours, weighted by the inverse of the angle."""
    import numpy as np

    weights = 1 / (0.001 + np.arccos(np.clip(cosines, -1, 1)))
    return float((weights * labels[numbers]).sum() / weights.sum())


def isotonic(votes, labels, weights) -> list[tuple[float, float]]:
    """Points of the non-decreasing step function nearest to the labels."""
    pools: list[list[float]] = []  # low vote, high vote, weight, weighted labels
    for v, y, w in sorted(zip(votes, labels, weights)):
        if pools and pools[-1][1] == v:
            pools[-1][2] += w
            pools[-1][3] += w * y
        else:
            pools.append([v, v, w, w * y])
        while len(pools) > 1 and pools[-2][3] * pools[-1][2] >= pools[-1][3] * pools[-2][2]:
            _, high, w1, s1 = pools.pop()
            pools[-1] = [pools[-1][0], high, pools[-1][2] + w1, pools[-1][3] + s1]
    return [point for low, high, w, s in pools for point in {(low, s / w): 0, (high, s / w): 0}]


class Model:
    """Examples, their index and the calibration; small enough, by its parameters, to travel to tasks."""

    def __init__(self, terms, shared, ids, labels, index, curve, prior, k):
        self.terms, self.shared, self.ids, self.labels = terms, shared, ids, labels
        self.index, self.curve, self.prior, self.k = index, curve, prior, k

    @classmethod
    def learn(
        cls, docs: DataFrame, labels: DataFrame, per_label: int = EXAMPLES_PER_LABEL, learn_per_label: int = LEARN_PER_LABEL,
        most_terms: int = TERMS, k: int = NEIGHBOURS, block: int = BLOCK, seed: int = SEED,
    ) -> Model:
        import numpy as np

        shares = dict(one_label(labels, "toxic").filter(~held_out()).groupBy("label").count().collect())
        prior = shares.get(1, 0) / max(1, sum(shares.values()))
        sample = labelled_sample(docs, labels, "toxic", learn_per_label, seed, by_label=True)
        terms, shared = weigh(learn_terms(sample, most_terms), docs)
        schema = "doc_id long, label int, place array<int>, weight array<double>"
        target = arrow_schema(schema)

        def vectors(batches: Iterator) -> Iterator:
            make = Vectoriser(terms, shared)
            for batch in batches:
                rows = []
                for doc_id, label, text in zip(*(batch[c].to_pylist() for c in ("doc_id", "label", "text"))):
                    vector = make(text or "")
                    if vector:
                        rows.append((doc_id, label, list(vector), list(vector.values())))
                yield rows_batch(rows, target)

        chosen = labelled_sample(docs, labels, "toxic", per_label, seed, by_label=True)
        rows = map_batches(chosen, vectors, schema).collect() if shares else []
        # Examples of one label and one leading term share blocks, which keeps the bounds of blocks tight.
        rows.sort(key=lambda r: (r["label"], r["place"][max(range(len(r["place"])), key=lambda i: r["weight"][i])], r["doc_id"]))
        found = [dict(zip(r["place"], r["weight"])) for r in rows]
        known = np.array([r["label"] for r in rows], dtype=np.float64)
        index = BlockMax(found, len(terms) + 1, block)
        votes, truth, weights = [], [], []
        held = {label: max(1, int((known == label).sum())) for label in (0, 1)}
        for number, vector in enumerate(found):
            near = index.nearest(vector, k, without=number)
            if len(near[0]):
                votes.append(vote(*near, known))
                truth.append(known[number])
                weights.append((prior if known[number] else 1 - prior) / held[int(known[number])])
        curve = isotonic(votes, truth, weights)
        return cls(terms, shared, [r["doc_id"] for r in rows], known, index, curve, prior, k)

    def scorer(self):
        """A function of a text: score, neighbours' ids and cosines. Equal vectors are searched once."""
        import numpy as np

        make = Vectoriser(self.terms, self.shared)
        xs, ys = ([p[i] for p in self.curve] for i in (0, 1))
        seen: dict = {}
        held = 0

        def score(text: str) -> tuple[float, list[int], list[float]]:
            nonlocal held
            vector = make(text)
            key = tuple(vector.items())
            if key not in seen:
                if held > CACHED_TERMS:
                    seen.clear()
                    held = 0
                held += len(key) + 8
                numbers, cosines = self.index.nearest(vector, self.k)
                if len(numbers) and xs:
                    value = float(np.interp(vote(numbers, cosines, self.labels), xs, ys))
                else:
                    value = float(self.prior)
                seen[key] = value, [self.ids[n] for n in numbers], cosines.tolist()
            return seen[key]

        return score

    def score(self, docs: DataFrame) -> DataFrame:
        """doc_id, held_out, score, predicted, and the neighbours that voted with their cosines."""
        schema = (f"doc_id {kind_of(docs, 'doc_id')}, held_out boolean, score double, predicted int, "
                  "neighbours array<bigint>, cosines array<double>")
        target, model = arrow_schema(schema), self

        def work(batches: Iterator) -> Iterator:
            score = model.scorer()
            for batch in batches:
                rows = []
                for text in batch["text"].to_pylist():
                    value, near, cosines = score(text)
                    rows.append((value, int(value >= 0.5), near, cosines))
                yield rows_batch(rows, target, batch["doc_id"], batch["held_out"])

        return map_batches(ids_and_texts(docs).select("doc_id", held_out().alias("held_out"), "text"), work, schema)

    def clean(self, docs: DataFrame) -> DataFrame:
        """The rows, with all their columns, that are not predicted toxic."""
        place, model = docs.columns.index("text"), self

        def work(batches: Iterator) -> Iterator:
            import pyarrow as pa

            score = model.scorer()
            for batch in batches:
                keep = [score(text or "")[0] < 0.5 for text in batch.column(place).to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))

        return map_batches(docs, work, docs.schema)


def op1_block_max_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return Model.learn(docs, read(spark, sf_dir, "labels")).score(docs)
