"""SentencePiece encoding and decoding through a relational lattice.

A text is escaped (blanks become U+2581, one is put in front) and cut into words before each run of
U+2581, which no piece crosses, and again between characters that no piece holds next to each other. Documents
are read in blocks of bounded size, as places in the block's list of distinct words. Every distinct word
of a block is encoded once: its substrings up to the longest piece are exploded, equi-joined to the piece
table (bounded by the vocabulary, so it is broadcast), and the edges found are folded:

- ``merge`` for BPE models: of the edges that join two neighbouring symbols the one of greatest score
  (leftmost among equals) is applied until none is left; symbols are the gaps in a bit mask;
- ``viterbi`` for unigram models: the path of greatest total score.

A Viterbi path over a BPE model's scores gives other pieces than SentencePiece does, so the fold
follows the model. Characters outside the vocabulary fall back to bytes. Words of more than
``LONGEST_WORD`` characters do not fit the mask and are merged with a heap in the task that reads them.
A block's words go through the join as rows of one partition, followed by its documents as rows without a
word; nothing is shuffled or kept, and the fold, array by array over many words, reads them in that order
(it stops if a word is missing). ``encoded_words`` folds rows with ``aggregate`` where words come from a table.
Decoding looks up the spellings of a row's ids and joins them, row by row.

Defined results: a null or empty text has no pieces; literal U+2581 is taken for a blank, as
SentencePiece does; repeated rows are encoded each for itself; an empty table gives no rows; columns
other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from zlib import crc32

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import arrow_schema, ids_and_texts, kind_of, map_batches, read

SPACE = "▁"
LONGEST_WORD = 60
BLOCK_BYTES = 32 << 20  # Arrow data of a block's documents, but for a single larger row
BLOCK_STEP = 250  # documents of a block that are cut, and assembled, at a time
FOLDED_EDGES = 100_000  # edges a task gathers before it folds their words
UNKNOWN = -1e10


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def code_points(text: str):
    import numpy as np

    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Vocabulary:
    """Pieces, scores and byte pieces of a model that keeps texts as they are but for the escape."""

    def __init__(self, path: str | None = None):
        import numpy as np
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path or model_path())
        if model.normalize(" a  Béﬁ\n ") != f"{SPACE * 2}a{SPACE * 2}Béﬁ\n{SPACE}":
            raise ValueError("only models without normalisation, with a blank put in front, are handled")
        size = range(model.get_piece_size())
        self.pieces = {
            model.id_to_piece(i): (i, model.get_score(i)) for i in size
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        }
        self.bytes = {int(model.id_to_piece(i)[3:-1], 16): i for i in size if model.is_byte(i)}
        self.longest = max(map(len, self.pieces))
        self.joined = {p[i:i + 2] for p in self.pieces for i in range(len(p) - 1)}
        joined = np.array(sorted([ord(a), ord(b)] for a, b in self.joined))
        known, numbers = np.unique(joined, return_inverse=True)
        self.kinds = np.zeros(0x110000, np.uint16)  # by code point; 0 where no piece has it beside another
        self.kinds[known] = np.arange(1, len(known) + 1)
        self.joins = np.zeros((len(known) + 1, len(known) + 1), bool)
        self.joins[tuple(numbers.reshape(joined.shape).T + 1)] = True

    def begins(self, codes):
        """True where a fragment begins: at a run of blanks, and where no piece holds the two characters next to each other, so
        that no merge crosses the place."""
        import numpy as np

        blank, kinds = codes == ord(SPACE), self.kinds[codes]
        inside = self.joins[kinds[:-1], kinds[1:]] & (blank[:-1] | ~blank[1:])
        return np.concatenate([np.ones(min(len(codes), 1), bool), ~inside])

    def fragments(self, word: str) -> list[str]:
        """The word cut where :meth:`begins` says."""
        import numpy as np

        limits = [*np.flatnonzero(self.begins(code_points(word))).tolist(), len(word)]
        return [word[a:b] for a, b in zip(limits, limits[1:])]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(p, i, s) for p, (i, s) in self.pieces.items()], "piece string, id int, score double")


def escaped(text: Column) -> Column:
    return F.when(text != "", F.concat(F.lit(SPACE), F.translate(text, " ", SPACE))).otherwise("")


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(escaped(text), F.lit(f"({SPACE}*[^{SPACE}]+|{SPACE}+)"), F.lit(1))


def found_spans(words: DataFrame, keys: list[str], vocabulary: Vocabulary, outer: bool = False) -> DataFrame:
    """``keys``, a word's length as ``n``, from, to (characters, end exclusive), the span's text as ``piece``; ``id`` and ``score``
    are null for a character that is no piece. With ``outer`` a row without a word stays, as one row with nulls.
    """
    table, explode = vocabulary.table(words.sparkSession), F.explode_outer if outer else F.explode
    kept = list(dict.fromkeys([*keys, "word"]))
    sizes = F.sequence(F.lit(1), F.least(F.lit(vocabulary.longest), F.col("n") - F.col("from")))
    spans = (
        words.withColumn("n", F.char_length("word"))
        .select(*kept, "n", explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("from"))
        .select(*kept, "n", "from", explode(F.when(F.col("n").isNotNull(), sizes)).alias("size"))
        .select(*keys, "n", "from", (F.col("from") + F.col("size")).alias("to"), F.substring(F.col("word"), F.col("from") + 1, F.col("size")).alias("piece"))
    )
    return spans.join(F.broadcast(table), "piece", "left").filter(
        F.col("id").isNotNull() | (F.col("to") - F.col("from") == 1) | F.col("n").isNull())


def edges(words: DataFrame, keys: list[str], vocabulary: Vocabulary) -> DataFrame:
    """The lattice: ``keys``, from, to (characters, end exclusive), ids, score; a word's length as ``n``."""
    byte_ids = F.array(*(F.lit(vocabulary.bytes[b]) for b in range(256)))
    encoded = F.hex(F.encode("piece", "utf-8"))
    spelled = F.transform(
        F.sequence(F.lit(0), F.octet_length("piece") - 1),
        lambda i: F.element_at(byte_ids, F.conv(F.substring(encoded, i * 2 + 1, F.lit(2)), 16, 10).cast("int") + 1))
    return found_spans(words, keys, vocabulary).select(
        *keys, "n", "from", "to", F.when(F.col("id").isNotNull(), F.array("id")).otherwise(spelled).alias("ids"),
        F.coalesce("score", F.lit(UNKNOWN)).alias("score"))


def ones(low: Column, high: Column) -> Column:
    """A mask with the bits from ``low`` to before ``high``."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), high) - F.call_function("shiftleft", F.lit(1).cast("long"), low)


def merged_ids(lattice: Column, n: Column) -> Column:
    """Fold of a BPE word: ``lattice`` holds structs (score order, from, to, ids); bits of the mask are symbol limits."""
    wide = F.filter(lattice, lambda e: e["to"] - e["from"] > 1)
    marks = F.transform(F.array_sort(wide), lambda e: F.struct(
        (ones(e["from"], e["from"] + 1) + ones(e["to"], e["to"] + 1)).alias("ends"), ones(e["from"] + 1, e["to"]).alias("inner")))

    def step(mask: Column, some: Column) -> Column:
        fits = F.filter(some, lambda e: (mask.bitwiseAND(e["ends"]) == e["ends"]) & (F.bit_count(mask.bitwiseAND(e["inner"])) == 1))
        return F.coalesce(mask - mask.bitwiseAND(F.try_element_at(fits, F.lit(1))["inner"]), mask)

    def fold(some: Column) -> Column:
        start = ones(F.lit(0), n + 1)
        return F.when(F.size(some) == 0, start).otherwise(
            F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), start, lambda mask, _: step(mask, some)))

    def read_off(mask: Column) -> Column:
        last = F.filter(lattice, lambda e: (mask.bitwiseAND(ones(e["from"], e["from"] + 1)) != 0)
                        & (mask.bitwiseAND(ones(e["to"], e["to"] + 1)) != 0)
                        & (mask.bitwiseAND(ones(e["from"] + 1, e["to"])) == 0))
        ordered = F.array_sort(F.transform(last, lambda e: F.struct(e["from"].alias("from"), e["ids"].alias("ids"))))
        return F.flatten(F.transform(ordered, lambda e: e["ids"]))

    once = lambda value, body: F.element_at(F.transform(F.array(value), body), 1)
    return once(marks, lambda some: once(fold(some), read_off))


def viterbi_ids(lattice: Column, n: Column) -> Column:
    """Fold of a unigram word: for every end the best score and its ids; of equal paths the one of the longest last piece."""
    kind = "array<struct<score:double,ids:array<int>>>"
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("ids"))).cast(kind)

    def step(best: Column, end: Column) -> Column:
        ways = F.transform(F.filter(lattice, lambda e: e["to"] == end), lambda e: F.struct(
            (F.element_at(best, e["from"] + 1)["score"] + e["score"]).alias("score"), (-e["from"]).alias("near"),
            F.concat(F.element_at(best, e["from"] + 1)["ids"], e["ids"]).alias("ids")))
        top = F.array_max(ways)
        return F.concat(best, F.array(F.struct(top["score"].alias("score"), top["ids"].alias("ids")))).cast(kind)

    return F.element_at(F.aggregate(F.sequence(F.lit(1), n), start, step), -1)["ids"]


def encoded_words(words: DataFrame, keys: list[str], vocabulary: Vocabulary, method: str = "merge") -> DataFrame:
    """``keys`` and ``ids`` of every row of ``words`` (distinct by ``keys``, at most LONGEST_WORD characters)."""
    # What the fold does not need would be sorted for nothing.
    needed = [(-F.col("score")).alias("order"), "from", "to", "ids"] + (["score"] if method == "viterbi" else [])
    lattice = F.collect_list(F.struct(*needed))
    grouped = edges(words, keys, vocabulary).groupBy(*keys).agg(F.max("n").alias("n"), lattice.alias("lattice"))
    fold = {"merge": merged_ids, "viterbi": viterbi_ids}[method]
    return grouped.select(*keys, fold(F.col("lattice"), F.col("n")).alias("ids"))


def heap_merge(word: str, vocabulary: Vocabulary) -> list[int]:
    """The BPE merges of one long word, with a heap of candidate pairs over linked symbols."""
    n = len(word)
    end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap: list[tuple[float, int, int]] = []

    def offer(left: int) -> None:
        right = after[left] if left >= 0 else n
        if right < n and end[right] - left <= vocabulary.longest:
            known = vocabulary.pieces.get(word[left:end[right]])
            if known:
                heapq.heappush(heap, (-known[1], left, end[right]))

    for left in range(n - 1):
        offer(left)
    while heap:
        _, left, to = heapq.heappop(heap)
        right = after[left] if end[left] > left else n
        if right >= n or end[right] != to:
            continue  # one of the two symbols has changed since
        end[left], after[left] = to, after[right]
        end[right] = right  # gone
        if after[left] < n:
            before[after[left]] = left
        offer(left)
        offer(before[left])
    ids, at = [], 0
    while at < n:
        known = vocabulary.pieces.get(word[at:end[at]])
        ids += [known[0]] if known else [vocabulary.bytes[b] for b in word[at:end[at]].encode("utf-8", "surrogatepass")]
        at = end[at]
    return ids


def cut_texts(texts: list[str], vocabulary: Vocabulary):
    """The fragments of all texts as a dictionary array, and how many each text has."""
    import numpy as np
    import pyarrow as pa

    whole = "".join(SPACE + t.replace(" ", SPACE) for t in texts if t)
    sizes = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
    ends = np.cumsum(sizes)
    begins = vocabulary.begins(code_points(whole))
    begins[(ends - sizes)[sizes > 0]] = True
    starts = np.flatnonzero(begins)
    data = whole.encode()
    leads = np.flatnonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)
    offsets = np.append(leads[starts], len(data)).astype(np.int64)
    fragments = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data))
    return fragments.dictionary_encode(), np.diff(np.searchsorted(starts, ends), prepend=0).astype(np.int32)


def blocks_of(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The documents in blocks of bounded size, one after another in their partition.

    First the block's distinct words, with their places ``at``; those too long for the mask come last, without
    ``word``, their ids in ``rest``. Then its documents, some at a time, with ``rest`` alone: an Arrow batch of
    ``doc_ids``, ``counts`` (fragments of each), ``sequence`` (the places of all fragments) and the number of
    ``words`` of the block. One binary column, since Spark writes columns of lists that are mostly null slowly.
    """
    ddl = "at int, word string, rest binary"
    schema = arrow_schema(ddl)

    def batch(rows: int, **columns):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(rows, f.type) for f in schema], schema=schema)

    def block(parts: list) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        whole = pa.concat_arrays([fragments.dictionary for _, fragments, _ in parts]).dictionary_encode()
        words, own = whole.dictionary, whole.indices.to_numpy(False)
        wide = pc.greater(pc.utf8_length(words), LONGEST_WORD).to_numpy(False)
        order = np.argsort(wide, kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        words, short = words.take(pa.array(order)), len(order) - int(wide.sum())
        if short:
            yield batch(short, at=pa.array(np.arange(short)), word=words[:short])
        if short < len(words):
            merged = [np.array(heap_merge(w, vocabulary), np.int32).tobytes() for w in words[short:].to_pylist()]
            yield batch(len(merged), at=pa.array(np.arange(short, len(words))), rest=pa.array(merged))
        before = 0
        for doc_ids, fragments, counts in parts:
            own_here = own[before:before + len(fragments.dictionary)]
            before += len(own_here)
            sequence = place[own_here][fragments.indices.to_numpy(False)]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in (doc_ids, pa.array(counts), pa.array(sequence))]
            rest = pa.record_batch([*lists, pa.array([len(words)])], ["doc_ids", "counts", "sequence", "words"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rest.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(rest)
            yield batch(1, rest=pa.array([sink.getvalue().to_pybytes()]))

    def work(parts: Iterator) -> Iterator:
        import pyarrow as pa

        held, size = [], 0
        for part in parts:
            if held and size + part.nbytes > BLOCK_BYTES:
                yield from block(held)
                held, size = [], 0
            for at in range(0, part.num_rows, BLOCK_STEP):
                some = part.slice(at, BLOCK_STEP)
                doc_ids = some.column(0).take(pa.array(range(some.num_rows)))  # a copy: it does not hold the whole batch
                held.append((doc_ids, *cut_texts(some.column(1).to_pylist(), vocabulary)))
            size += part.nbytes
        if held:
            yield from block(held)

    return map_batches(ids_and_texts(docs), work, ddl)


def packed_edges(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The lattice in few columns: ``span`` (``at``, ``n``, from and to in one number, 6 bits for each of the last three), ``id`` (of a
    character that is no piece -1 less its code point) and ``rest``; null spans for rows of documents, null ids for rows without a word.
    """
    number = F.col("at").cast("long")
    for name in ("n", "from", "to"):
        number = number * 64 + F.coalesce(name, F.lit(0))
    spelled = F.when(F.col("n").isNotNull(), -1 - F.ascii("piece"))
    return found_spans(words, ["at", "rest"], vocabulary, outer=True).select(
        number.alias("span"), F.coalesce("id", spelled).alias("id"), "rest")


def merge_all(span, ids, vocabulary: Vocabulary, scores) -> tuple:
    """Number of ids of each word, and the ids, from the edges of BPE words (one word after another, by from and to).

    In every round each word applies its best edge that joins two neighbouring symbols. An edge holds the number of
    limits inside it and their sum, which is the limit to remove once there is one; it goes when a limit of its
    own is removed.
    """
    import numpy as np

    at, n, begin, end = span >> 18, span >> 12 & 63, span >> 6 & 63, span & 63
    first = np.flatnonzero(np.diff(at, prepend=-1))
    own = np.repeat(np.arange(len(first)), np.diff(first, append=len(at)))
    base = np.cumsum(n[first] + 1) - n[first] - 1
    limits = np.ones(int((n[first] + 1).sum()), bool)
    wide = np.flatnonzero(end - begin > 1)
    wide = wide[np.lexsort((-scores[ids[wide]], own[wide]))]  # stable: leftmost among equals
    word, a, b = own[wide], begin[wide], end[wide]
    inside, total = b - a - 1, (a + b) * (b - a - 1) // 2
    while len(fit := np.flatnonzero(inside == 1)):
        best = fit[np.diff(word[fit], prepend=-1) != 0]
        gone = np.zeros(len(first), total.dtype)  # 0, the front limit, for a word that is done
        gone[word[best]] = total[best]
        limits[base[word[best]] + total[best]] = False
        lost = gone[word]
        within = (a < lost) & (lost < b)
        inside = inside - within
        total = total - lost * within
        left = (lost > 0) & (lost != a) & (lost != b) & (inside > 0)
        word, a, b, inside, total = word[left], a[left], b[left], inside[left], total[left]
    symbols, front, back = np.cumsum(limits), base[own] + begin, base[own] + end
    last = np.flatnonzero(limits[front] & limits[back] & (symbols[back] - symbols[front] == 1))
    ids, own = ids[last], own[last]
    spelled = {i: [vocabulary.bytes[b] for b in chr(-1 - i).encode()] for i in np.unique(ids[ids < 0]).tolist()}
    if spelled:
        times = np.ones(len(ids), np.int64)
        times[ids < 0] = [len(spelled[i]) for i in ids[ids < 0].tolist()]
        unknown = np.repeat(ids < 0, times)
        some = [b for i in ids[ids < 0].tolist() for b in spelled[i]]
        ids, own = np.repeat(ids, times), np.repeat(own, times)
        ids[unknown] = some
    return np.bincount(own, minlength=len(first)), ids


def encoded_blocks(docs: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """``doc_id``, ``ids``, their number, the unknown characters' bytes, and a checksum of the ids."""
    vocabulary = vocabulary or Vocabulary()
    lattice = packed_edges(blocks_of(docs, vocabulary), vocabulary)
    schema = f"doc_id {kind_of(docs, 'doc_id')}, ids array<int>, n_pieces long, n_bytes long, ids_crc32 long"
    target, bytes_from, bytes_to = arrow_schema(schema), min(vocabulary.bytes.values()), max(vocabulary.bytes.values())

    def assemble(row, sizes, values):
        import numpy as np
        import pyarrow as pa

        sequence = row.column("sequence")[0].values.to_numpy(False)
        counts = row.column("counts")[0].values.to_numpy(False)
        taken = sizes[sequence]
        ends = np.concatenate([[0], np.cumsum(taken)])
        starts = (np.cumsum(sizes) - sizes)[sequence] - ends[:-1]
        ids = values[np.repeat(starts, taken) + np.arange(ends[-1])]
        limits = ends[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]
        in_bytes = np.concatenate([[0], np.cumsum((ids >= bytes_from) & (ids <= bytes_to))])[limits]
        checks = [crc32(ids[a:b].tobytes()) for a, b in zip(limits[:-1], limits[1:])]
        lists = pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(ids, pa.int32()))
        columns = [row.column("doc_ids")[0].values, lists, *(pa.array(c, pa.int64()) for c in (np.diff(limits), np.diff(in_bytes), checks))]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, target)], schema=target)

    def work(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        waiting, folded, known = [], [], 0
        scores = np.zeros(1 + max(i for i, _ in vocabulary.pieces.values()))
        for i, score in vocabulary.pieces.values():
            scores[i] = score

        def fold(all_words: bool) -> None:
            """Folds the waiting words; the last only where its edges are known to be whole."""
            nonlocal waiting, folded, known
            rows = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            span = rows.column("span").to_numpy(False)
            at = span >> 18
            whole = len(at) if all_words else int(np.searchsorted(at, at[-1]))
            waiting = [rows.slice(whole)] if whole < len(at) else []
            merged = rows.column("rest").slice(0, whole).drop_null()
            at, short = at[:whole], whole - len(merged)
            if not whole:
                return
            if at[0] == 0:
                folded, known = [], 0
            if not np.array_equal(at[np.diff(at, prepend=-1) != 0], np.arange(known, at[-1] + 1)):
                raise RuntimeError("the words of a block are not in their order")
            known = int(at[-1]) + 1
            if short:
                folded.append(merge_all(span[:short], rows.column("id").slice(0, short).to_numpy(False), vocabulary, scores))
            if short < whole:
                ids = [np.frombuffer(m, np.int32) for m in merged.to_pylist()]
                folded.append((np.array([len(i) for i in ids], np.int64), np.concatenate(ids)))

        for batch in batches:
            begin = 0
            for stop in [*np.flatnonzero(batch.column("span").is_null().to_numpy(False)), batch.num_rows]:
                if stop > begin:
                    waiting.append(batch.slice(begin, stop - begin))
                if stop < batch.num_rows:  # documents
                    if waiting:
                        fold(True)
                    if len(folded) > 1:
                        folded = [tuple(np.concatenate(part) for part in zip(*folded))]
                    row = pa.ipc.open_stream(batch.column("rest")[stop].as_buffer()).read_next_batch()
                    needed = row.column("words")[0].as_py()
                    if needed not in (0, known):
                        raise RuntimeError(f"{known} of {needed} words of a block came before its documents")
                    none = np.zeros(0, np.int64)
                    yield assemble(row, *(folded[0] if needed else (none, none)))
                begin = stop + 1
            if sum(b.num_rows for b in waiting) > FOLDED_EDGES:
                fold(False)

    return lattice.mapInArrow(work, schema)


def encode(docs: DataFrame, vocabulary: Vocabulary | None = None, digest: bool = False) -> DataFrame:
    """``doc_id`` and ``ids`` of every document; with ``digest`` their number, the unknown characters' bytes, a checksum."""
    return encoded_blocks(docs, vocabulary).select("doc_id", *(["n_pieces", "n_bytes", "ids_crc32"] if digest else ["ids"]))


def decoded(ids: Column, vocabulary: Vocabulary | None = None) -> Column:
    """The text of a list of ids; the spellings of all ids are one literal, bounded by the vocabulary."""
    vocabulary = vocabulary or Vocabulary()
    spelled = {i: p.replace(SPACE, " ").encode() for p, (i, _) in vocabulary.pieces.items()}
    spelled |= {i: bytes([b]) for b, i in vocabulary.bytes.items()}
    table = F.split(F.lit(",".join(spelled.get(i, b"").hex() for i in range(max(spelled) + 1))), ",")
    text = F.unhex(F.array_join(F.transform(ids, lambda i: F.element_at(table, i + 1)), "")).cast("string")
    return F.coalesce(F.substring(text, 2, 2**31 - 1), F.lit(""))


def decode(encoded: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """``doc_id`` and ``text`` from ``doc_id`` and ``ids``, row by row: repeated and null doc_ids are rows like others."""
    return encoded.select("doc_id", decoded(F.col("ids"), vocabulary).alias("text"))


def op8_relational_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document with their number, the unknown characters' bytes and a checksum, and the text decoded from them."""
    vocabulary = Vocabulary()
    rows = encoded_blocks(read(spark, sf_dir, "documents"), vocabulary)
    return rows.select("doc_id", "n_pieces", "n_bytes", "ids_crc32", "ids", decoded(F.col("ids"), vocabulary).alias("decoded"))
