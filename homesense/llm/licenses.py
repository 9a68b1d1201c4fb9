"""Licence scans: Dice coefficient over word bigrams against licence templates.

Texts and templates are normalised alike: A-Z lower-cased, words are runs of letters, digits and non-ASCII
bytes, so line breaks, blank lines and comment signs don't count. Every run of neighbouring words of a text is
compared, so a notice is found inside a longer document, over several paragraphs or lines and inside a sentence.
With x and y bigrams, Dice is ``2 |shared| / (x + y)``, at most ``2 min(x, y) / (x + y)``: for a threshold t only
runs whose size lies in ``[y t / (2 - t), y (2 - t) / t]`` can reach it, and they share at least ``y t / (2 - t)``
bigrams. Bigrams are counted with repeats. A run of highest Dice begins and ends with a bigram of the template.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from homesense.llm.common import row_key, text_bytes
from homesense.llm.license_texts import TEMPLATES

MIN_DICE = 0.9
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")


def bigrams(words: list[bytes]) -> Counter:
    return Counter(zip(words, words[1:]))


def words_of(raw: bytes) -> list[bytes]:
    return _WORD.findall(raw.lower())


class Scanner:
    """Templates sorted by size, with the bigrams they consist of."""

    def __init__(self, min_dice: float = MIN_DICE, templates: list[tuple[str, str, str]] | None = None):
        if not 0 < min_dice <= 1:
            raise ValueError("min_dice lies in (0, 1]")
        self.t = min_dice
        found = []
        for name, kind, text in TEMPLATES if templates is None else templates:
            grams = bigrams(words_of(text.encode()))
            if grams:
                found.append((sum(grams.values()), name, kind, grams))
        found.sort(key=lambda x: (x[0], x[1], x[2]))
        self.templates, self.sizes = found, [x[0] for x in found]
        self.known = {w for *_, grams in found for pair in grams for w in pair}
        self.owners: dict[tuple, list[int]] = defaultdict(list)
        for k, (*_, grams) in enumerate(found):
            for g in grams:
                self.owners[g].append(k)
        self.needs = [max(1, math.ceil(n * self.t / (2 - self.t) - 1e-9)) for n in self.sizes]

    def best(self, words: list[bytes]) -> tuple[float, str, str] | None:
        """The template of highest Dice coefficient at or above the threshold; ties: the first by name."""
        n = len(words) - 1
        if n < 1 or not self.sizes:
            return None
        lo = bisect_left(self.sizes, n * self.t / (2 - self.t) - 1e-9)
        hi = bisect_right(self.sizes, n * (2 - self.t) / self.t + 1e-9)
        if lo >= hi:
            return None
        # every known bigram has two known words, so this bounds what any template can share
        known = sum(w in self.known for w in words)
        if 2 * min(n, known) < self.t * (n + self.sizes[lo]):
            return None
        grams, best = bigrams(words), None
        for size, name, kind, own in self.templates[lo:hi]:
            shared = sum(min(c, own[g]) for g, c in grams.items() if g in own)
            dice = 2 * shared / (n + size)
            if dice >= self.t and (best is None or (-dice, name, kind) < (-best[0], best[1], best[2])):
                best = (dice, name, kind)
        return best

    def scan(self, raw: bytes | None) -> list[dict]:
        """Matches of a text with character offsets [start, stop), in text order. No two overlap: a template's
        part gives way to the whole, and of templates of comparable size the highest coefficient wins."""
        words = words_of(raw) if raw else []
        owners = self.owners
        pairs = {i: g for i, g in enumerate(pairwise(words)) if g in owners}
        if not self.needs or len(pairs) < min(self.needs):
            return []
        at: dict[int, list[int]] = defaultdict(list)
        for i, g in pairs.items():
            for k in owners[g]:
                at[k].append(i)
        found = [x for k, places in at.items() if len(places) >= self.needs[k] for x in self._runs(k, places, pairs)]
        found.sort(key=lambda x: (-self.sizes[x[0]], x[1:], x[0]))
        kept: list[tuple] = []
        while found:
            k, dice, lo, hi = found[0]
            least = self.sizes[k] * self.t / (2 - self.t)
            k, dice, lo, hi = min((x for x in found if x[2] < hi and lo < x[3] and self.sizes[x[0]] >= least),
                                  key=lambda x: (-x[1], self.templates[x[0]][1:3], x[2:]))
            kept.append((lo, hi, *self.best(words[lo:hi])))
            found = [x for x in found if x[2] >= hi or lo >= x[3]]
        if not kept:
            return []
        spans, out, done, chars = [m.span() for m in _WORD.finditer(raw.lower())], [], 0, 0
        for lo, hi, dice, name, kind in sorted(kept):
            start, stop = spans[lo][0], spans[hi - 1][1]
            first = chars + len(raw[done:start].decode("utf-8", "replace"))
            done, chars = stop, first + len(raw[start:stop].decode("utf-8", "replace"))
            out.append({"license": name, "kind": kind, "dice": dice, "start": first, "stop": chars})
        return out

    def _runs(self, k: int, places: list[int], pairs: dict[int, tuple]) -> list[tuple]:
        """(template, dice, first word, word behind the last) of runs that match template ``k``; of overlapping
        ones the best. ``places`` are the numbers of all bigrams of the text that the template has."""
        size, _, _, own = self.templates[k]
        need, most = self.needs[k], math.floor(size * (2 - self.t) / self.t + 1e-9)
        if sum(min(c, own[g]) for g, c in Counter(pairs[i] for i in places).items()) < need:
            return []
        # a bigram counts in a run that starts behind the place where the template's number of it was used up
        seen, used = defaultdict(list), np.full(len(places), -1, np.int64)
        for j, i in enumerate(places):
            earlier = seen[pairs[i]]
            if len(earlier) >= own[pairs[i]]:
                used[j] = earlier[-own[pairs[i]]]
            earlier.append(j)
        pos = np.array(places, np.int64)
        ends = np.searchsorted(pos, pos + most)
        found = []
        for i in np.flatnonzero(ends - np.arange(len(pos)) >= need).tolist():
            shared = np.cumsum(used[i:ends[i]] < i)
            if shared[-1] < need:
                continue
            dice = 2 * shared / (pos[i:ends[i]] - pos[i] + 1 + size)
            j = int(dice.argmax())
            if dice[j] >= self.t:
                found.append((k, float(dice[j]), places[i], places[i + j] + 2))
        out, taken = [], set()
        for x in sorted(found, key=lambda x: (-x[1], x[2])):
            if x[2] not in taken and x[3] - 1 not in taken and taken.isdisjoint(range(x[2], x[3])):
                taken.update(range(x[2], x[3]))
                out.append(x)
        return out


_MATCHES = pa.list_(pa.struct([("license", pa.string()), ("kind", pa.string()), ("dice", pa.float64()),
                               ("start", pa.int64()), ("stop", pa.int64())]))


def scan_licenses(docs: DataFrame, min_dice: float = MIN_DICE, templates: list[tuple[str, str, str]] | None = None
                  ) -> DataFrame:
    """doc_id, row_id, matches for every row of ``docs``.

    ``matches`` lists (license, kind, dice, start, stop) in text order: runs of words that match a template and do
    not overlap, whatever paragraphs, lines or sentences they span. Null, empty and one-word texts match nothing. Ties of the coefficient go to the first licence by name. Whole texts are read; repeated rows
    give repeated results and an empty table an empty one. ``templates`` is (name, kind, text) rows of a list
    small enough for every task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(min_dice, templates)
        for b in batches:
            found = [scanner.scan(x.as_py()) for x in b.column("raw")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row_id"), pa.array(found, _MATCHES)],
                                             names=["doc_id", "row_id", "matches"])
    return docs.select("doc_id", row_key().alias("row_id"), text_bytes().alias("raw")).mapInArrow(
        run, "doc_id long, row_id long, matches array<struct<license:string,kind:string,dice:double,start:bigint,"
             "stop:bigint>>")
