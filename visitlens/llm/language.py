"""Language identification with hyperdimensional profiles.

Every letter (and the gap between words) has a random vector of +1 and -1. An n-gram's vector binds
its letters' vectors: the vector of each letter is permuted (rotated) by its place and all are
multiplied element by element. A document's vector bundles (sums) its n-grams' vectors, a language's
prototype bundles the unit vectors of its learning documents, and a document goes to the prototype
with the greatest cosine.

Learning takes at most ``per_language`` documents of each language, those of least id hash.

Defined results: a null text, an empty one, or one without letters is ``und`` with score 0; ties go
to the language first in the alphabet; with nothing learned every document is ``und``; repeated rows
are predicted each for itself; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import held_out, ids_and_texts, kind_of, map_batches, read, sample_by_hash

DIMENSIONS = 1024
GRAM = 3
PER_LANGUAGE = 1500
UNKNOWN = "und"
CACHED_GRAMS = 100_000
CHUNK_DOCS = 64
CHUNK_GRAMS = 300_000
SLICE_GRAMS = 8192
SEED = 7


def letter_codes(text: str):
    """Code points of the lower-cased text; each run of anything but letters becomes one 0."""
    import numpy as np

    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if not len(points):
        return points
    distinct, place = np.unique(points, return_inverse=True)
    letter = np.array([chr(p).isalpha() for p in distinct.tolist()])
    codes = np.where(letter[place], points, 0)
    gap = codes == 0
    keep = ~(gap & np.r_[False, gap[:-1]])
    codes = codes[keep]
    return np.concatenate([np.zeros(int(codes[0] != 0), np.uint32), codes, np.zeros(int(codes[-1] != 0), np.uint32)])


def gram_codes(text: str, gram: int):
    """One 64-bit number per n-gram of the text, 21 bits for each letter; none without letters."""
    import numpy as np

    codes = letter_codes(text).astype(np.int64)
    if len(codes) < gram or not codes.any():
        return np.zeros(0, np.int64)
    packed = np.zeros(len(codes) - gram + 1, np.int64)
    for place in range(gram):
        packed = (packed << 21) | codes[place:len(codes) - gram + 1 + place]
    return packed


class Vectors:
    """Vectors of n-grams, made when first met and remembered up to a bound."""

    def __init__(self, dimensions: int, gram: int, seed: int):
        self._dimensions, self._gram, self._seed = dimensions, gram, seed
        self._letters: dict = {}
        self._clear()

    def _clear(self) -> None:
        import numpy as np

        self._rows: dict = {}
        self._table = np.zeros((1024, self._dimensions), np.int8)

    def _letter(self, code: int):
        import numpy as np

        if code not in self._letters:
            random = np.random.default_rng([self._seed, code])
            self._letters[code] = random.integers(0, 2, self._dimensions, dtype=np.int8) * 2 - 1
        return self._letters[code]

    def _bind(self, packed: int):
        import numpy as np

        bound = np.ones(self._dimensions, np.int8)
        for place in range(self._gram):
            code = (packed >> (21 * (self._gram - 1 - place))) & 0x1FFFFF
            bound = bound * np.roll(self._letter(code), self._gram - 1 - place)
        return bound

    def of(self, grams):
        import numpy as np

        if len(self._rows) + len(grams) > max(CACHED_GRAMS, len(grams)):
            self._clear()
        rows = np.empty(len(grams), np.int64)
        for i, packed in enumerate(grams.tolist()):
            row = self._rows.get(packed)
            if row is None:
                row = self._rows[packed] = len(self._rows)
                if row >= len(self._table):
                    self._table = np.concatenate([self._table, np.zeros_like(self._table)])
                self._table[row] = self._bind(packed)
            rows[i] = row
        return self._table[rows].astype(np.float32)


def chunks(texts: list[str], gram: int) -> Iterator[list]:
    """N-grams of some texts at a time: at most CHUNK_DOCS texts, and CHUNK_GRAMS where one has not more."""
    codes, held = [], 0
    for text in texts:
        found = gram_codes(text, gram)
        if codes and (len(codes) == CHUNK_DOCS or held + len(found) > CHUNK_GRAMS):
            yield codes
            codes, held = [], 0
        codes.append(found)
        held += len(found)
    if codes:
        yield codes


def bundles(texts: list, vectors: Vectors, gram: int):
    """One unit vector per text; zero where it has no letters."""
    import numpy as np

    out = []
    for codes in chunks([text or "" for text in texts], gram):
        owner = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        grams, place = np.unique(np.concatenate(codes), return_inverse=True)
        sums = np.zeros((len(codes), vectors._dimensions), np.float32)
        # Slices of SLICE_GRAMS n-grams: neither their counts nor their vectors grow with a long text.
        order = np.argsort(place, kind="stable") if len(grams) > SLICE_GRAMS else None
        ends = None if order is None else np.searchsorted(place[order], np.arange(0, len(grams) + SLICE_GRAMS, SLICE_GRAMS))
        for at, part in enumerate(range(0, len(grams), SLICE_GRAMS)):
            width = min(SLICE_GRAMS, len(grams) - part)
            here = slice(None) if order is None else order[ends[at]:ends[at + 1]]
            counts = np.bincount(owner[here] * width + place[here] - part, minlength=len(codes) * width)
            sums += counts.reshape(len(codes), width).astype(np.float32) @ vectors.of(grams[part:part + width])
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        out.append(np.where(length > 0, sums / np.maximum(length, 1e-30), 0))
    return np.concatenate(out) if out else np.zeros((0, vectors._dimensions), np.float32)


def profiles(
    docs: DataFrame, per_language: int = PER_LANGUAGE, dimensions: int = DIMENSIONS, gram: int = GRAM, seed: int = SEED,
) -> tuple[list[str], list[list[float]]]:
    """Languages in the alphabet's order and their prototypes, learned from rows that are not held out.

    One vector per language and task is collected.
    """
    learning = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    chosen = sample_by_hash(learning.select("doc_id", F.col("lang").cast("string").alias("lang")), per_language, seed, "lang")
    chosen = chosen.select("doc_id", "lang").distinct()
    rows = learning.select("doc_id", F.col("lang").cast("string").alias("lang"), "text").join(
        F.broadcast(chosen), ["doc_id", "lang"], "left_semi"
    )

    def bundle(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        vectors, sums = Vectors(dimensions, gram, seed), {}
        for batch in batches:
            languages = np.array(batch["lang"].to_pylist(), dtype=object)
            unit = bundles(batch["text"].to_pylist(), vectors, gram)
            for language in set(languages.tolist()):
                sums[language] = sums.get(language, 0) + unit[languages == language].sum(axis=0, dtype=np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.float64()))],
            ["lang", "bundle"],
        )

    total: dict[str, list[float]] = {}
    for row in map_batches(rows, bundle, "lang string, bundle array<double>").sort("lang").collect():
        before = total.get(row["lang"])
        total[row["lang"]] = row["bundle"] if before is None else [a + b for a, b in zip(before, row["bundle"])]
    languages = sorted(language for language, bundle in total.items() if any(bundle))
    return languages, [total[language] for language in languages]


def predict(docs: DataFrame, languages: list[str], prototypes: list[list[float]], gram: int = GRAM, seed: int = SEED) -> DataFrame:
    """doc_id, held_out, lang_pred, score (cosine with the nearest prototype) and the margin to the second."""
    dimensions = len(prototypes[0]) if prototypes else 1

    def compare(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        vectors = Vectors(dimensions, gram, seed)
        table = np.array(prototypes, dtype=np.float64).reshape(len(languages), dimensions)
        table = (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-30)).astype(np.float32)
        names = np.array([*languages, UNKNOWN], dtype=object)
        for batch in batches:
            n = batch.num_rows
            if len(languages):
                unit = bundles(batch["text"].to_pylist(), vectors, gram)
                cosine = unit @ table.T
                best = np.where(unit.any(axis=1), cosine.argmax(axis=1), len(languages))
                ordered = np.sort(np.c_[np.full((n, 1), -1, np.float32), cosine], axis=1)
                score, margin = np.clip(ordered[:, -1], 0, 1), ordered[:, -1] - ordered[:, -2]
                score = np.where(best < len(languages), score, 0)
            else:
                best, score, margin = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(names[best], pa.string()), pa.array(score, pa.float64()),
                 pa.array(margin, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score", "margin"],
            )

    rows = ids_and_texts(docs, None).select("doc_id", held_out().alias("held_out"), "text")
    kind = kind_of(docs, "doc_id")
    return map_batches(rows, compare, f"doc_id {kind}, held_out boolean, lang_pred string, score double, margin double")


def op9_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return predict(docs, *profiles(docs))
