"""Join of documents whose sets of word n-grams have a high Jaccard similarity, by chosen paths.

Equal texts are one set. A set is embedded as ``TOKENS`` MinHash tokens. In every run all sets start
in one node; a node samples token positions at random, 1 / threshold of them on average, and passes
each set on to the child of its token at each sampled position. Two sets of similarity s so meet in
s / threshold children on average. Nodes of at most ``SMALL`` sets are searched by brute force,
larger ones split again, up to ``DEPTH`` times. The number of runs follows from the target recall of
a pair just at the threshold. A node that stays large at full depth holds sets that agree again and
again; it is kept whole as one candidate group.

Brute force over MinHash tokens links likely pairs, and connected ones form candidate groups. In a
group every pair of texts is compared exactly, on the n-grams themselves; large groups are dealt out
as pairs of blocks. What passes is a link; links are counted, and classes are the links' components.

Defined results: texts of one to four words are one n-gram; a text without words is similar to equal
texts only; null counts as empty; repeated rows and equal texts are linked copies; a null id takes
part like any other; an empty table gives no rows; columns other than ``doc_id`` and ``text`` are
ignored (``one_of_each`` keeps them).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import Shelf, arrow_schema, kind_of, map_batches, packed, read, rows_batch, unpacked
from visitlens.llm.graph import components
from visitlens.operators.bounds import broadcast_if

WORDS = 5
THRESHOLD = 0.8
TOKENS = 128
RECALL = 0.995
DEPTH = 4
SMALL = 96
BLOCK = 256
SLACK = 4.0  # standard deviations by which the tokens' estimate may fall short of the threshold
CACHED_WORDS = 300_000
SEED = 17


def text_key() -> list[Column]:
    """128 bits that stand for the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(SEED), text).alias("k2")]


class Shingles:
    """Texts to sorted distinct 64-bit hashes of their word n-grams; hashes of words are remembered."""

    def __init__(self, words: int = WORDS):
        from xxhash import xxh3_64_intdigest

        class Known(dict):
            def __missing__(self, word: bytes) -> int:
                value = self[word] = xxh3_64_intdigest(word)
                return value

        self._words, self._known = words, Known()

    def __call__(self, text: str):
        import numpy as np

        if len(self._known) > CACHED_WORDS:
            self._known.clear()
        words = text.encode("utf-8", "surrogatepass").split()
        codes = np.fromiter(map(self._known.__getitem__, words), np.uint64, len(words))
        size = min(self._words, len(codes))
        if not size:
            return codes
        mixed = np.zeros(len(codes) - size + 1, np.uint64)
        for place in range(size):
            mixed = (mixed ^ codes[place:len(codes) - size + 1 + place]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)


def minhash(hashes, tokens: int, seed: int = SEED):
    """The low 32 bits of the least hash under each of ``tokens`` random maps."""
    import numpy as np

    random = np.random.default_rng(seed)
    a = random.integers(1, 2**63, tokens, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = random.integers(0, 2**63, tokens, dtype=np.uint64)
    least = np.full(tokens, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 2048):
        part = hashes[at:at + 2048, None] * a + b
        part ^= part >> np.uint64(32)
        least = np.minimum(least, (part * np.uint64(0xD6E8FEB86659FD93)).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def embedded(docs: DataFrame, words: int, tokens: int) -> DataFrame:
    """One row per document: its id, the key of its text, and its tokens (null without words)."""
    schema = f"doc_id {kind_of(docs, 'doc_id')}, k1 long, k2 long, tokens array<int>"

    def embed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        shingles = Shingles(words)
        for batch in batches:
            rows = []
            for text in batch["text"].to_pylist():
                hashes = shingles(text)
                rows.append(minhash(hashes, tokens) if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["k1"], batch["k2"], pa.array(rows, pa.list_(pa.int32()))],
                ["doc_id", "k1", "k2", "tokens"],
            )

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return map_batches(docs.select("doc_id", *text_key(), text.alias("text")), embed, schema)


def runs_needed(threshold: float, tokens: int, depth: int, recall: float) -> int:
    """Runs after which a pair at the threshold has met in a node of full depth with probability ``recall``."""
    meet = 1.0
    for _ in range(depth):
        meet = 1 - (1 - threshold * meet / (threshold * tokens)) ** tokens
    return math.ceil(math.log(1 - recall) / math.log(1 - meet))


def split(nodes: DataFrame, threshold: float, tokens: int) -> DataFrame:
    """The children of every node: (path, set, tokens) for each sampled position."""
    share = F.lit(int(2**40 / (threshold * tokens)))
    places = F.filter(
        F.sequence(F.lit(0), F.lit(tokens - 1)), lambda i: F.pmod(F.xxhash64("path", i), F.lit(1 << 40)) < share
    )
    return (
        nodes.select("path", "set", "tokens", F.explode(places).alias("place"))
        .select(F.xxhash64("path", "place", F.element_at("tokens", F.col("place") + 1)).alias("path"), "set", "tokens")
    )


def by_key(name: str, finish: Callable) -> Callable:
    """Arrow batches sorted by ``name`` to pieces of whole keys: what is last in a batch waits for the next."""
    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        waiting = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch[name]
            last = pc.index(keys, keys[-1]).as_py()
            if last == 0 and (not waiting or waiting[0][name][0] == keys[0]):
                waiting.append(batch)
                continue
            whole = pa.Table.from_batches([*waiting, batch.slice(0, last)]).combine_chunks()
            yield from finish(whole)
            waiting = [batch.slice(last)]
        if waiting:
            yield from finish(pa.Table.from_batches(waiting).combine_chunks())

    return work


class Forest:
    """Union-find over a few numbers."""

    def __init__(self, size: int):
        self.up = list(range(size))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = sorted((self.root(x), self.root(y)))
        self.up[y] = x


def likely_links(nodes: DataFrame, threshold: float, tokens: int) -> DataFrame:
    """Brute force over tokens in small nodes; edges (a, b) that connect what is likely similar."""
    least = (threshold - SLACK * math.sqrt(threshold * (1 - threshold) / tokens)) * tokens
    target = arrow_schema("a long, b long")

    def finish(table):
        import numpy as np

        path, sets = table["path"].to_numpy(), table["set"].to_numpy()
        rows = table["tokens"].combine_chunks().flatten().to_numpy().reshape(len(path), -1)
        starts = np.flatnonzero(np.r_[True, path[1:] != path[:-1]])
        edges = []
        for low, high in zip(starts, np.r_[starts[1:], len(path)]):
            forest = Forest(high - low)
            for i in range(high - low - 1):
                alike = (rows[low + i + 1:high] == rows[low + i]).sum(axis=1)
                for j in np.flatnonzero(alike >= least):
                    forest.join(i, i + 1 + int(j))
            edges += [(int(sets[low + i]), int(sets[low + forest.root(i)])) for i in range(high - low) if forest.root(i) != i]
        yield rows_batch(edges, target)

    return map_batches(nodes.select("path", "set", "tokens").repartition("path").sortWithinPartitions("path"), by_key("path", finish),
                       "a long, b long")


def candidate_edges(sets: DataFrame, shelf: Shelf, threshold: float, tokens: int, depth: int, small: int, runs: int) -> DataFrame:
    """Edges that connect the members of candidate groups. ``sets``: set, tokens."""
    roots = F.explode(F.sequence(F.lit(1), F.lit(runs)))
    nodes = sets.select(roots.alias("run"), "set", "tokens").select(F.xxhash64(F.lit(SEED), "run").alias("path"), "set", "tokens")
    found = []
    for level in range(1, depth + 1):
        members = split(nodes, threshold, tokens).select("path", "set")
        members = shelf.keep(members.distinct() if level > 1 else members, f"members{level}")
        # Count, sum and exclusive or of member hashes tell member sets apart: of equal ones a single node is searched.
        sized = members.groupBy("path").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("set").cast("decimal(38,0)")).alias("total"),
            F.bit_xor(F.xxhash64(F.lit(1), "set")).alias("mix"), F.min("set").alias("least"),
        ).filter("n > 1")
        sized = shelf.keep(sized, f"sized{level}")
        little = sized.filter(F.col("n") <= small).groupBy("n", "total", "mix").agg(F.min("path").alias("path")).select("path")
        # Tokens are fetched for what is searched, or split again, alone.
        searched = members.join(little, "path").join(sets, "set")
        found.append(shelf.keep(likely_links(searched, threshold, tokens).distinct(), f"links{level}"))
        large = sized.filter(F.col("n") > small)
        if large.isEmpty():
            break
        if level < depth:
            nodes = members.join(large.select("path"), "path").join(sets, "set")
        else:
            once = large.groupBy("n", "total", "mix").agg(F.min("path").alias("path"), F.min("least").alias("least"))
            stars = members.join(once.select("path", "least"), "path").select(F.col("set").alias("a"), F.col("least").alias("b"))
            found.append(shelf.keep(stars.filter("a <> b"), "stars"))
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    return edges


def intersections(shingles: list):
    """Matrix of common n-grams of all pairs, from those that occur in two texts or more."""
    import numpy as np

    owner = np.repeat(np.arange(len(shingles)), [len(s) for s in shingles])
    values, place, counts = np.unique(np.concatenate(shingles), return_inverse=True, return_counts=True)
    common = counts[place] > 1
    owner, place = owner[common], np.unique(place[common], return_inverse=True)[1]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    size = int(place[-1]) + 1 if len(place) else 0
    total = np.zeros((len(shingles), len(shingles)), np.float32)
    for low in range(0, size, 8192):
        a, b = np.searchsorted(place, [low, low + 8192])
        table = np.zeros((len(shingles), min(8192, size - low)), np.float32)
        table[owner[a:b], place[a:b] - low] = 1
        total += table @ table.T
    return total


def exact_links(members: DataFrame, docs: DataFrame, words: int, threshold: float, block: int) -> DataFrame:
    """Compare all pairs of texts in each group. ``members``: set, doc_id, k1, k2, copies, root, n.

    One row per set and comparison task: ``set``, ``links`` (documents), ``texts``, and ``least``, the
    least set it is connected with there.
    """
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("set"), blocks).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    dealt = (
        members.withColumn("blocks", blocks).withColumn("own", own)
        .withColumn("other", F.explode(others))
        .withColumn("first", F.least("own", "other")).withColumn("second", F.greatest("own", "other"))
        .withColumn("task", F.xxhash64("root", "first", "second"))
        .select("task", "set", "own", "first", "second", "doc_id", "k1", "k2", "copies")
    )
    texts = docs.select(F.col("doc_id").alias("_id"), *text_key(), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Few members travel to the texts; more than the bound, and the texts are shuffled to them.
    most = members.agg(F.sum(F.ceil(F.col("n") / block))).collect()[0][0] or 0
    rows = texts.join(broadcast_if(dealt, most), ["k1", "k2"]).filter(F.col("_id").eqNullSafe(F.col("doc_id")))
    rows = rows.select("task", "set", "own", "first", "second", "copies", "text")
    schema = "set long, links long, texts long, least long"
    target = arrow_schema(schema)

    def finish_with(shingles):
        def finish(table):
            import numpy as np

            task = table["task"].to_numpy()
            starts = np.flatnonzero(np.r_[True, task[1:] != task[:-1]])
            for low, high in zip(starts, np.r_[starts[1:], len(task)]):
                part = table.slice(low, high - low).to_pydict()
                # A row that is repeated in the table of documents comes more than once.
                keep = sorted({s: i for i, s in enumerate(part["set"])}.items())
                sets = [s for s, _ in keep]
                own = np.array([part["own"][i] for _, i in keep])
                copies = np.array([part["copies"][i] for _, i in keep])
                grams = [shingles(part["text"][i]) for _, i in keep]
                size = np.array([len(g) for g in grams], np.float64)
                common = intersections(grams).astype(np.float64)
                linked = (common >= threshold * (size[:, None] + size - common) - 1e-9) & (size > 0)[:, None] & (size > 0)
                np.fill_diagonal(linked, False)
                if part["first"][0] != part["second"][0]:
                    linked &= own[:, None] != own
                forest = Forest(len(sets))
                for i, j in zip(*np.nonzero(np.triu(linked))):
                    forest.join(int(i), int(j))
                yield rows_batch(
                    [(s, int((linked[i] * copies).sum()), int(linked[i].sum()), sets[forest.root(i)]) for i, s in enumerate(sets)],
                    target,
                )
        return finish

    def work(batches: Iterator) -> Iterator:
        yield from by_key("task", finish_with(Shingles(words)))(batches)

    return map_batches(rows.repartition("task").sortWithinPartitions("task"), work, schema)


def classes(
    spark: SparkSession, docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, tokens: int = TOKENS,
    recall: float = RECALL, depth: int = DEPTH, small: int = SMALL, block: int = BLOCK,
) -> DataFrame:
    """One row per document: doc_id, class_id (the least id of its class), n_links, n_texts, and its text's key.

    ``n_links`` counts the documents it is similar to, copies included; ``n_texts`` other texts only.
    ``first`` marks one row of each class, one of those with the least id.
    """
    shelf = Shelf(spark, "similarity")
    rows = shelf.keep(embedded(docs, words, tokens).withColumn("row", F.monotonically_increasing_id()), "rows")
    texts = rows.groupBy("k1", "k2").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("of"), F.count(F.lit(1)).alias("copies"))
    texts = shelf.keep(texts.select("k1", "k2", F.col("of.row").alias("set"), F.col("of.doc_id").alias("doc_id"), "copies"), "texts")
    sets = rows.filter(F.col("tokens").isNotNull()).join(texts.select(F.col("set").alias("row")), "row", "left_semi")
    sets = shelf.keep(sets.select(F.col("row").alias("set"), "tokens"), "sets")
    runs = runs_needed(threshold, tokens, depth, recall)
    found = components(candidate_edges(sets, shelf, threshold, tokens, depth, small, runs), shelf)
    groups = shelf.keep(found, "groups")
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    members = shelf.keep(texts.join(groups.withColumnRenamed("node", "set"), "set").join(sizes, "root"), "members")
    compared = shelf.keep(exact_links(members, docs, words, threshold, block), "compared")
    roots = shelf.keep(components(compared.select(F.col("set").alias("a"), F.col("least").alias("b")), shelf), "roots")
    links = compared.groupBy("set").agg(F.sum("links").alias("links"), F.sum("texts").alias("n_texts"))
    every = (
        texts.join(roots.withColumnRenamed("node", "set"), "set", "left").join(links, "set", "left")
        .withColumn("root", F.coalesce("root", "set"))
    )
    heads = every.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "set")).alias("head"), F.sum("copies").alias("class_size"))
    every = shelf.keep(every.join(heads, "root"), "every")
    return (
        rows.select("doc_id", "k1", "k2", "row").join(every.drop("doc_id"), ["k1", "k2"])
        .select(
            "doc_id", F.col("head.doc_id").alias("class_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("n_texts", F.lit(0)).alias("n_texts"), "class_size", "k1", "k2", (F.col("row") == F.col("head.set")).alias("first"),
        )
    )


def one_of_each(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The rows of one document of every class, that of the least id, with all their columns."""
    first = classes(spark, docs, **options).filter("first").select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("doc_id").alias("_id"))
    keyed = packed(docs).select("*", *(key.alias(name) for key, name in zip(text_key(), ("_k1", "_k2"))))
    kept = keyed.join(first, ["_k1", "_k2"]).filter(F.col("doc_id").eqNullSafe(F.col("_id")))
    return unpacked(kept.dropDuplicates(["_k1", "_k2"]), docs.columns)


def op4_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(spark, read(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "n_texts", "class_size")
