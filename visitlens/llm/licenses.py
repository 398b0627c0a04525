"""Licence scan by conditional compression.

Candidate blocks are runs of lines that speak of licences, with the lines next to them that are
mostly made of the templates' words; lines without words (blank, or a comment marker alone) do not
end a run that goes on behind them. In a block every template is compared word by word with every
window that holds enough of its words to be a close wording, and fits where the fewest words differ;
the fit ends where the template stops matching. Of fits that overlap, the one with the fewest
differing words stays, then the longer template, then the one that, as a raw zstandard dictionary,
saves the greatest share of the compressed words. What the fits leave of a block is examined again
until no template fits.

Defined results: a null or empty text has no blocks; every fit gives a row, and what is left of a
block and speaks of licences gives rows without a licence, numbered in the order of the text; equal
reductions go to the template first by name; a name or year in a template stands for at most
``FIELD_WORDS`` words; repeated rows are scanned each for itself; an empty table gives no rows;
columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from itertools import chain, repeat

from pyspark.sql import DataFrame, SparkSession

from visitlens.llm.common import arrow_schema, ids_and_texts, kind_of, map_batches, read, rows_batch
from visitlens.llm.license_texts import TEMPLATES

KEYWORD = re.compile(r"licen[sc]|copyright|warrant|redistribut|public domain|permission is|spdx|\(c\) ?[0-9]{4}", re.I)
WORD = re.compile(r"<\w+>|\w+(?:[-.]\w+)*")
ANY = re.compile(r"<\w+>")
NEIGHBOUR_SHARE = 0.8
LEVEL = 9
CLOSE = 0.9
FIELD_WORDS = 64
CACHED_BLOCKS = 20_000

SCHEMA = "block int, first_char int, last_char int, license string, reduction double, n_words int, n_diff int, differences string"


def words_of(text: str) -> list[str]:
    return [word.lower() for word in WORD.findall(text)]


def blocks(text: str, vocabulary: frozenset[str]) -> Iterator[tuple[int, int]]:
    """(start, end) of candidate blocks: keyword lines and the licence-like lines around them."""
    if not KEYWORD.search(text):
        return
    spans, at = [], 0
    for line in text.split("\n"):
        spans.append((at, at + len(line)))
        at += len(line) + 1
    keyword = [bool(KEYWORD.search(text, a, b)) for a, b in spans]
    like: dict[int, bool] = {}

    def licence_like(i: int) -> bool:
        if i not in like:
            words = words_of(text[slice(*spans[i])])
            like[i] = bool(words) and sum(w in vocabulary for w in words) >= NEIGHBOUR_SHARE * len(words)
        return like[i]

    def worded(i: int, step: int) -> int:
        while 0 <= i < len(spans) and not WORD.search(text, *spans[i]):
            i += step
        return i

    i = floor = 0
    while i < len(spans):
        if not keyword[i]:
            i += 1
            continue
        first = last = i
        while (near := worded(first - 1, -1)) >= floor and licence_like(near):
            first = near
        while (near := worded(last + 1, 1)) < len(spans) and (keyword[near] or licence_like(near)):
            last = near
        yield spans[first][0], spans[last][1]
        i = floor = last + 1


def fit(block: list[str], template: list[str]) -> tuple[int, int, int, str] | None:
    """Words that differ, the template's part of the block (start, end), and the differences.

    Words around that part do not count. Matches at its ends that cost more than they give are left out.
    """
    matcher = SequenceMatcher(None, block, template, autojunk=False)
    same = [m for m in matcher.get_matching_blocks() if m.size]
    if not same:
        return None

    def gap(a: int, b: int, c: int, d: int) -> int:
        theirs = sum(not ANY.fullmatch(w) for w in template[c:d])
        if d > c and not theirs:  # a name, a year
            return max(0, b - a - FIELD_WORDS * (d - c))
        return max(b - a, theirs)

    gaps = [(m.a + m.size, n.a, m.b + m.size, n.b) for m, n in zip(same, same[1:])]
    best, cheapest, inner = None, None, 0
    for j, m in enumerate(same):
        inner += gap(*gaps[j - 1]) if j else 0
        lead = gap(0, 0, 0, m.b) - inner
        if cheapest is None or lead < cheapest[0]:
            cheapest = lead, j
        count = cheapest[0] + inner + gap(0, 0, m.b + m.size, len(template))
        if best is None or count <= best[0]:
            best = count, cheapest[1], j
    count, i, j = best
    start, end = same[i].a, same[j].a + same[j].size
    parts = [(start, start, 0, same[i].b), *gaps[i:j], (end, end, same[j].b + same[j].size, len(template))]
    said = [f"-{' '.join(template[c:d])}+{' '.join(block[a:b])}" for a, b, c, d in parts if gap(a, b, c, d)]
    return count, start, end, "; ".join(said)


def windows(words: list[str], need: Counter, width: int, most_missing: float) -> Iterator[tuple[int, int]]:
    """(start, missing words) of every window, also those the end cuts short, that lacks at most ``most_missing`` of the words needed."""
    missing, have = sum(need.values()), Counter()
    for right, word in enumerate(chain(words, repeat("", width - 1))):
        if word in need:
            have[word] += 1
            missing -= have[word] <= need[word]
        left = right - width + 1
        if left > 0 and words[left - 1] in need:
            missing += have[words[left - 1]] <= need[words[left - 1]]
            have[words[left - 1]] -= 1
        if left >= 0 and missing <= most_missing:
            yield left, missing


class Scanner:
    """Compressors for all templates. Equal blocks are examined once, up to a bound."""

    def __init__(
        self, templates: dict[str, str] = TEMPLATES, level: int = LEVEL, confirmed: int | None = None, close: float = CLOSE,
    ):
        import zstandard

        self._alone = zstandard.ZstdCompressor(level=level)
        self._given = {
            name: zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(
                " ".join(text.lower().split()).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))
            for name, text in sorted(templates.items())
        }
        self._words = {name: words_of(text) for name, text in templates.items()}
        self._need = {name: Counter(w for w in words if not ANY.fullmatch(w)) for name, words in self._words.items()}
        self._confirmed, self._close = confirmed, close
        self._seen: dict[str, list[tuple]] = {}

    def rank(self, block: str) -> list[tuple[str, float]]:
        """All templates by the share of the compressed block they save."""
        return sorted(((name, self._saved(block, name)) for name in self._given), key=lambda s: (-s[1], s[0]))

    def _saved(self, block: str, name: str) -> float:
        raw = " ".join(block.lower().split()).encode("utf-8", "surrogatepass")
        return 1 - len(self._given[name].compress(raw)) / len(self._alone.compress(raw))

    def _fits(self, words: list[str], name: str) -> Iterator[tuple[int, int, int, str]]:
        """Close wordings of one template, from left to right.

        One that is close enough lacks at most ``most`` words and has at most as many more, so it lies in
        a window of ``width`` words that lacks no more.
        """
        template, need = self._words[name], self._need[name]
        fixed = sum(need.values())
        most = (1 - self._close) * fixed + 1e-9
        width = int(fixed + most) + FIELD_WORDS * (len(template) - fixed)
        if sum((need - Counter(words)).values()) > most:
            return
        held: list[tuple[int, int]] = []  # windows that follow one another
        done = 0

        def settle() -> Iterator[tuple[int, int, int, str]]:
            nonlocal done
            while held:
                chunk = [h for h in held if h[0] < held[0][0] + width]
                first = min(chunk, key=lambda h: (h[1], h[0]))[0]
                for start in (first, *(h[0] for h in chunk[::max(1, width // 8)])):
                    found = fit(words[start:start + width], template)
                    if found and found[0] <= most:
                        # The window may cut off words at either end; no more than ``most`` are missing.
                        low = max(done, start + found[1] - int(most))
                        wider = fit(words[low:start + found[2] + int(most)], template) if found[0] else None
                        if wider and wider[0] < found[0]:
                            start, found = low, wider
                        count, a, b, said = found
                        yield count, start + a, start + b, said
                        done = start + b
                        held[:] = [h for h in held if h[0] >= done]
                        break
                else:
                    del held[:len(chunk)]

        for window in windows(words, need, width, most):
            if held and (window[0] > held[-1][0] + 1 or window[0] >= held[0][0] + 2 * width):
                yield from settle()
            if window[0] >= done:
                held.append(window)
        yield from settle()

    def parts(self, block: str) -> list[tuple]:
        """start, end, licence, reduction, words, differing words, differences of every part of the block."""
        if block not in self._seen:
            if len(self._seen) > CACHED_BLOCKS:
                self._seen.clear()
            found = list(WORD.finditer(block))
            words = [m[0].lower() for m in found]
            out, todo = [], [(0, len(words))]
            while todo:
                low, high = todo.pop()
                names = [name for name, _ in self.rank(block)[:self._confirmed]] if self._confirmed else self._words
                fits = []
                for name in names:
                    for count, a, b, said in self._fits(words[low:high], name):
                        a, b = low + a, low + b
                        if ANY.fullmatch(self._words[name][-1]):  # a last name goes on to the end of its line
                            line = block.find("\n", found[b - 1].end())
                            while b < high and (line < 0 or found[b].start() < line) and b - a < len(self._words[name]) + FIELD_WORDS:
                                b += 1
                        saved = self._saved(block[found[a].start():found[b - 1].end()], name)
                        fits.append((count, -sum(self._need[name].values()), -saved, name, a, b, said))
                taken: list[tuple[int, int]] = []
                for count, _, saved, name, a, b, said in sorted(fits):
                    at = bisect_left(taken, (a, b))
                    if (at == 0 or taken[at - 1][1] <= a) and (at == len(taken) or b <= taken[at][0]):
                        taken.insert(at, (a, b))
                        out.append((found[a].start(), found[b - 1].end(), name, -saved, b - a, count, said))
                if taken:
                    limits = [low, *(x for pair in taken for x in pair), high]
                    todo += [(a, b) for a, b in zip(limits[::2], limits[1::2])
                             if b > a and KEYWORD.search(block, found[a].start(), found[b - 1].end())]
                elif high > low:
                    start, end = found[low].start(), found[high - 1].end()
                    out.append((start, end, None, self.rank(block[start:end])[0][1], high - low, None, None))
            self._seen[block] = sorted(out, key=lambda part: part[:2]) or [(0, len(block), None, 0.0, 0, None, None)]
        return self._seen[block]

    def examine(self, block: str) -> tuple:
        """licence, reduction, words, differing words and differences of the part that fits best."""
        return min(self.parts(block), key=lambda part: (part[2] is None, part[5] or 0, -part[4], part[0]))[2:]


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, **options) -> DataFrame:
    """One row per part, with or without a licence, of the candidate blocks of every document."""
    schema = f"doc_id {kind_of(docs, 'doc_id')}, {SCHEMA}"
    target = arrow_schema(schema)
    vocabulary = frozenset(word for text in templates.values() for word in words_of(text))

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scanner = Scanner(templates, **options)
        for batch in batches:
            rows, owner = [], []
            for place, text in enumerate(batch["text"].to_pylist()):
                number = 0
                for start, end in blocks(text, vocabulary):
                    for first, last, *what in scanner.parts(text[start:end]):
                        rows.append((number, start + first, start + last, *what))
                        owner.append(place)
                        number += 1
            yield rows_batch(rows, target, batch["doc_id"].take(pa.array(owner, pa.int64())))

    return map_batches(ids_and_texts(docs), work, schema)


def op7_conditional_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))
