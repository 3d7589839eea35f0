"""Held-out passages that turn up in a corpus, whole or in part.

The n-grams of the normalised passages are a broadcast hash table; a window slides over the words of the documents
and looks them up, many documents at once. Hits are counted by passage and range of shifts before any is looked at by
itself. Where hits run along and a telling word of the passage stands among them, the words of the passage that could
agree at all are counted; where these would satisfy the rule, a local alignment of the words decides, which forgives
misread, added, lost and changed words. A running stretch counts if it is long enough, if enough of its words agree,
and if enough of what tells it from sentences built alike does: its names and numbers, and words in whose place another
passage built alike has a different one. No share of the passages decides what tells, so neither equal nor unrelated
passages change what is found of one.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archiva.functions import names
from archiva.functions.names import close
from archiva.session import share, shared_value

#: The test passages are held by every task; beyond this many characters they are refused rather than broadcast.
MAX_PASSAGE_CHARS = 50_000_000
#: Places of added words that the search allows for in the shortest stretch, beside all words the rule lets change.
ADDED = 4
#: So many shifts are aligned at once, and so many words of texts are searched at once.
WIDE = 256
CHUNK = 25_000
# Fixed value: more words than a text has, to keep passage and shift in one number.
SHIFTS = 1 << 32
# Fixed value: the most cells in which hits are counted before they are looked at one by one, a power of two.
CELLS = 1 << 19

BREAK = re.compile(r"[-‐‑–¬­](?<=[^\W\d_].)\s*\n\s*(?=[^\W\d_])")  # the sign first, which is found fast
TOKEN = re.compile(r"[^\W_]++(?:[.,]\d{3})*+", re.UNICODE)
PLAIN_TOKEN = re.compile(r"\w++(?:[.,]\d{3})*+", re.UNICODE)  # the same in a text without low lines, found faster
NUMBER, NO_DIGIT = re.compile(r"\d+(?:[.,]\d{3})+"), re.compile(r"\D")
# Signs a scan shows in place of letters.
MISREAD = str.maketrans({"0": "o", "1": "l", "5": "s", "6": "b", "2": "z", "8": "b", "9": "g", "3": "e", "4": "a"})


# Accented letters and the plain ones, of equal length so that places in the text stay.
PLAIN = str.maketrans("áàâäãåéèêëíìîïóòôöõúùûüñçýÿ", "aaaaaaeeeeiiiiooooouuuuncyy")


def prepared(text: str) -> str:
    """A text without line-end hyphens and with signs read for letters set right."""
    text = text or ""
    if "\n" in text:
        text = BREAK.sub("", text)
    text = text.replace("@", "a").replace("¡o", "p").replace("\\/", "v").replace("|", "l")
    if "!" in text:
        text = re.sub(r"(?<=\w)!(?=\w)", "i", text)
    if "(" in text:
        text = re.sub(r"(?<=[^\W\d_])\((?=[^\W\d_])", "c", text)
    return text


def normal(token: str) -> str:
    """A word as it is compared: numbers without marks, digits among letters as the letters they stand for."""
    token = token.translate(PLAIN)
    if token.isalpha():
        return token
    if token.isdigit() or NUMBER.fullmatch(token):
        return NO_DIGIT.sub("", token)
    return token.translate(MISREAD)


def tokens(text: str) -> list[str]:
    return PLAIN_TOKEN.findall(prepared(text).lower().replace("_", " "))


def words(text: str) -> list[str]:
    """Words in lower case without accents and marks."""
    return [normal(t) for t in tokens(text)]


def spelled(text: str | None) -> tuple[list[str], np.ndarray]:
    """Words as words() gives them, and how much each tells as a name or number.

    A number tells 1. A word with a capital that no beginning of a sentence asks for, and that the text does not write
    small elsewhere, is of a name; the words of one name, particles between them left out, tell 1 together.
    """
    bare = prepared(text)
    found = [(m[0], m.start(), m.end()) for m in TOKEN.finditer(bare)]
    small = {w for w, _, _ in found if w[0].islower()}
    weight = np.zeros(len(found))
    name: list[int] = []
    last, opens = 0, True
    for k, (w, a, b) in enumerate([*found, (".", len(bare), len(bare))]):
        between = bare[last:a]
        opens |= any(c in ".?!¿¡:" for c in between)
        part = w[0].isupper() and not opens and w.lower() not in small
        joins = (between.isspace() and (part or w in names.PARTICLES)) or (between.strip() in ("", ",") and w == "alias")
        if name and not joins:
            weight[name] = 1 / len(name)
            name = []
        if w[0].isdigit():
            weight[k] = 1.0
        elif part:
            name.append(k)
        opens, last = False, b
    return [normal(w.lower()) for w, _, _ in found], weight


def rolled(codes: np.ndarray, n: int, base: int) -> np.ndarray:
    """A number for each n-gram of the codes."""
    width = len(codes) - n + 1
    key = np.zeros(max(0, width), np.int64)
    for k in range(n if width > 0 else 0):
        key = key * base + codes[k : k + width]
    return key


@dataclass
class Postings:
    """Sorted keys and, for each, the passages and places where it stands."""

    keys: np.ndarray
    starts: np.ndarray
    passages: np.ndarray
    places: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray, passages: np.ndarray, places: np.ndarray) -> Postings:
        order = np.argsort(keys, kind="stable")
        different, first = np.unique(keys[order], return_index=True)
        return cls(different, np.append(first, len(keys)).astype(np.int64), passages[order], places[order])

    def find(self, keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the posting and ``at`` of each time one of ``keys``, which stands at ``at``, is known."""
        if not len(self.keys) or not len(keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        k = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[k] == keys
        k, at = k[known], at[known]
        first, count = self.starts[k], self.starts[k + 1] - self.starts[k]
        each = np.repeat(first - np.cumsum(count) + count, count)
        each += np.arange(len(each))
        return each, np.repeat(at, count)

    def cells(self, each: np.ndarray, at: np.ndarray, wide: int, stride: int, cells: int) -> np.ndarray:
        """The cell of each posting: its passage and range of ``wide`` shifts, ``stride`` ranges from passage to passage.

        ``cells``: a power of two. Several ranges may share a cell, which only makes what is counted in it more.
        """
        if len(each) > len(self.passages):
            cell = (self.passages * (stride * wide) - self.places)[each]
        else:
            cell = self.passages[each] * (stride * wide) - self.places[each]
        cell += at
        cell //= wide
        cell &= cells - 1
        return cell

    def shifts(self, each: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Passage and shift of each posting in one number."""
        return self.passages[each] * SHIFTS + at - self.places[each] + SHIFTS // 2


@dataclass
class Index:
    """The passages, how much each of their words tells, and where their n-grams and telling words stand."""

    ids: list[int]
    passages: list[np.ndarray]
    tells: list[np.ndarray]
    vocabulary: dict[str, int]
    deletes: dict[str, list[str]]
    n: int
    grams: Postings
    telling: Postings
    tell_weights: np.ndarray
    flat: np.ndarray
    weights: np.ndarray
    any_tell: np.ndarray
    first: np.ndarray
    sizes: np.ndarray
    tell_flat: np.ndarray
    tell_first: np.ndarray
    tell_sizes: np.ndarray
    fuzzy: dict[str, int] = field(default_factory=dict)
    least: dict[Rule, np.ndarray] = field(default_factory=dict)

    @classmethod
    def build(cls, items: Sequence[tuple[int, str]], n: int = 2) -> Index:
        """All n-grams are kept, however many passages share them; equal passages stay apart."""
        split = [spelled(t) for _, t in items]
        vocabulary: dict[str, int] = {}
        for t, _ in split:
            for w in t:
                vocabulary.setdefault(w, len(vocabulary))
        passages = [np.array([vocabulary[w] for w in t], np.int64) for t, _ in split]
        if (len(vocabulary) + 1) ** n >= 1 << 62:
            raise ValueError("the passages have too many different words for n-grams of this length")
        tells = [weight if weight.any() else np.ones(len(weight)) for _, weight in split]
        deletes: dict[str, list[str]] = defaultdict(list)
        for w in vocabulary:
            if len(w) > 3 and not w.isdigit():
                for d in {w[:k] + w[k + 1 :] for k in range(len(w))} | {w}:
                    deletes[d].append(w)
        sizes = np.array([len(p) for p in passages], np.int64)
        flat = np.concatenate([np.zeros(0, np.int64), *passages])
        number = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        keys, whole = rolled(flat, n, len(vocabulary) + 1), place + n <= np.repeat(sizes, sizes)
        grams = Postings.build(keys[whole[: len(keys)]], number[: len(keys)][whole[: len(keys)]], place[: len(keys)][whole[: len(keys)]])
        weights = np.concatenate([np.zeros(0), *tells])
        tell = weights > 0
        telling = Postings.build(flat[tell], number[tell], place[tell])
        first = np.cumsum(sizes) - sizes
        tell_sizes = np.bincount(number[tell], minlength=len(sizes))
        return cls([i for i, _ in items], passages, tells, vocabulary, dict(deletes), n, grams, telling, weights[first[telling.passages] + telling.places], flat, weights, np.bincount(flat, tell, len(vocabulary)) > 0, first, sizes, np.flatnonzero(tell), np.cumsum(tell_sizes) - tell_sizes, tell_sizes)

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Posting of every n-gram of the codes that is in the index, and where in the codes it stands."""
        keys = rolled(codes, self.n, len(self.vocabulary) + 1)
        bad = np.concatenate([[0], np.cumsum(codes < 0)])  # words that no passage has
        at = np.flatnonzero(bad[self.n : self.n + len(keys)] == bad[: len(keys)])
        return self.grams.find(keys[at], at)

    def told(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of every telling word."""
        at = np.flatnonzero(codes >= 0)
        at = at[self.any_tell[codes[at]]]
        return self.telling.find(codes[at], at)

    def least_told(self, rule: Rule) -> np.ndarray:
        """Rule.told() of each passage."""
        if rule not in self.least:
            self.least[rule] = np.array([rule.told(t) for t in self.tells])
        return self.least[rule]

    def code_all(self, found: Sequence[str]) -> np.ndarray:
        """Numbers of the words of a text."""
        got = list(map(self.fuzzy.get, found))
        try:
            return np.fromiter(got, np.int64, len(got))
        except TypeError:  # a word not seen before
            return np.array([self.code(w) if k is None else k for k, w in zip(got, found, strict=True)], np.int64)

    def code(self, word: str) -> int:
        """Number of a word; misread words get that of the passage word one letter away; others -1."""
        got = self.fuzzy.get(word)
        if got is not None:
            return got
        raw, word = word, normal(word)
        best = self.vocabulary.get(word, -1)
        if best >= 0:
            self.fuzzy[raw] = best
            return best
        if len(word) > 3 and not word.isdigit() and len(word) < 40:
            near = set(self.deletes.get(word, ()))
            for k in range(len(word)):
                d = word[:k] + word[k + 1 :]
                if d in self.deletes:
                    near.update(self.deletes[d])
            hits = [w for w in near if close(w, word, 1)] or [w for w in near if len(w) > 6 and close(w, word, 2)]
            if hits:
                best = self.vocabulary[min(hits)]
        if len(self.fuzzy) < 200_000:
            self.fuzzy[raw] = best
        return best


def align(doc: np.ndarray, passage: np.ndarray, hit: int = 10, miss: int = 9, gap: int = 7) -> list[tuple[int, int, int, int, np.ndarray]]:
    """The best local alignment: doc start, doc end, passage start, passage end (ends exclusive) and for each word of
    the passage the word of the doc that agrees with it, or -1. One element, or none if no word agrees.

    Whole numbers, so that equal scores are equal. A score is kept with ``gap`` added for each step down and to the right,
    by which gaps cost nothing, and those along a row are a running maximum.
    """
    turned = len(doc) > len(passage)  # the longer side is done at once
    across, along = (doc, passage) if turned else (passage, doc)
    n, m = len(along), len(across)
    equal = along[:, None] == across[None, :]
    step = np.where(equal, hit + 2 * gap, 2 * gap - miss).astype(np.int32)
    zero = gap * np.add.outer(np.arange(n + 1, dtype=np.int32), np.arange(m + 1, dtype=np.int32))
    score = zero.copy()
    row = np.empty(m, np.int32)
    for up, add, none, out in zip(score[:-1], step, zero[1:, 1:], score[1:, 1:], strict=True):
        np.add(up[:-1], add, out=row)
        np.maximum(row, up[1:], out=row)
        np.maximum(row, none, out=row)
        np.maximum.accumulate(row, out=out)
    score -= zero
    if turned:
        score, equal = score.T, equal.T
    i, j = (int(x) for x in np.unravel_index(int(score.argmax()), score.shape))
    if score[i, j] <= 0:
        return []
    end_i, end_j = i, j
    agrees = np.full(len(passage), -1, np.int64)
    while i > 0 and j > 0 and (s := int(score[i, j])) > 0:
        if s == score[i - 1, j - 1] + (hit if equal[i - 1, j - 1] else -miss):
            if equal[i - 1, j - 1]:
                agrees[j - 1] = i - 1
            i, j = i - 1, j - 1
        elif s == score[i - 1, j] - gap:
            i -= 1
        else:
            j -= 1
    return [(i, end_i, j, end_j, agrees)]


@dataclass(frozen=True)
class Rule:
    """When a stretch counts: words, share of them that agree, share of its names and numbers that do and how many."""

    min_words: int = 20
    min_share: float = 0.7
    min_telling: float = 0.6
    min_told: float = 2.0

    def seeds(self, n: int) -> tuple[int, int]:
        """So many n-grams agree at least in the shortest stretch that counts, and the band of shifts they lie in.

        Of min_words words the least share agrees; each other word and each place of added words divides what agrees
        once more, and a run of r words has r - n + 1 n-grams. ADDED places of added words are allowed for. Each lost
        or added word moves the shift by one.
        """
        agree = math.ceil(self.min_words * self.min_share - 1e-9)
        other = self.min_words - agree
        return max(1, agree - (n - 1) * (other + ADDED + 1)), other + ADDED

    def told(self, tell: np.ndarray) -> float:
        """How much must agree of what tells; no more than a passage with few names and numbers can give."""
        return min(self.min_told, float(tell.sum()) * self.min_telling)

    def longest(self, agrees: np.ndarray, tell: np.ndarray, block: int = 512) -> tuple[int, int] | None:
        """The longest stretch that counts, the first of several: start and end (exclusive) among the words. ``tell``: how much each tells."""
        w = self.min_words
        share = np.concatenate([[0.0], np.cumsum(agrees - self.min_share)])
        if len(share) <= w:
            return None
        # ends of stretches with share enough, then all their starts
        ends = np.flatnonzero(share[w:] - np.minimum.accumulate(share)[:-w] > -1e-6) + w
        told = np.concatenate([[0.0], np.cumsum(tell * (agrees - self.min_telling))])
        sure = np.concatenate([[0.0], np.cumsum(tell * agrees)])
        least = self.told(tell)
        start = np.arange(len(share))
        best: tuple[int, int] | None = None
        for k in range(0, len(ends), block):
            end = ends[k : k + block]
            ok = (share[end][:, None] - share > -1e-6) & (told[end][:, None] - told > -1e-6) & (end[:, None] - start >= w)
            if self.min_telling > 0:
                ok &= sure[end][:, None] - sure > least - 1e-6
            some = np.flatnonzero(ok.any(axis=1))
            if len(some):
                a = ok[some].argmax(axis=1)
                i = int((end[some] - a).argmax())
                if best is None or end[some[i]] - a[i] > best[1] - best[0]:
                    best = int(a[i]), int(end[some[i]])
        return best


def around(count: np.ndarray) -> np.ndarray:
    """For each cell its count and those of the cells beside it."""
    total = count.copy()
    total[1:] += count[:-1]
    total[:-1] += count[1:]
    total[0] += count[-1]
    total[-1] += count[0]
    return total


def runs(index: Index, codes: np.ndarray, rule: Rule) -> np.ndarray:
    """Rows of passage, least and highest shift of hits that run along, with names and numbers enough among them.

    Hits, and names and numbers, are first counted by passage and range of shifts at least as wide as the band. What lies
    within the band of a hit lies in its cell or in one beside it, so where these hold too little, the hit is left out
    before anything is sorted; the rest is counted by exact shifts. Wide rows are cut into rows that overlap by a band, so
    that what is aligned at once stays small.
    """
    none = np.zeros((0, 3), np.int64)
    least, band = rule.seeds(index.n)
    hit, at = index.hits(codes)
    if len(hit) < least:
        return none
    wide = 1 << band.bit_length()
    stride = (len(codes) + int(index.sizes.max())) // wide + 3
    cells = min(CELLS, 1 << (len(index.sizes) * stride).bit_length())
    cell = index.grams.cells(hit, at, wide, stride, cells)
    many = (around(np.minimum(np.bincount(cell, minlength=cells), least).astype(np.int32)) >= least)[cell]
    hit, at, cell = hit[many], at[many], cell[many]
    if rule.min_telling > 0:
        need = index.least_told(rule) - 1e-6
        tell, spot = index.told(codes)
        of = index.telling.cells(tell, spot, wide, stride, cells)
        enough = around(np.bincount(of, index.tell_weights[tell], cells).astype(np.float32))[cell] > need[index.grams.passages[hit]] - 1e-3
        hit, at, cell = hit[enough], at[enough], cell[enough]
        near = np.zeros(cells, bool)
        near[cell] = near[cell - 1] = near[(cell + 1) & (cells - 1)] = True
        some = near[of]
        tell, spot = tell[some], spot[some]
        by_shift = index.telling.shifts(tell, spot)
        order = np.argsort(by_shift)
        by_shift, sure = by_shift[order], np.concatenate([[0.0], np.cumsum(index.tell_weights[tell][order])])
    key = np.sort(index.grams.shifts(hit, at))
    if rule.min_telling > 0:
        key = key[sure[np.searchsorted(by_shift, key + band, "right")] - sure[np.searchsorted(by_shift, key - band)] > need[key // SHIFTS]]
    if len(key) < least:
        return none
    dense = np.flatnonzero(key[least - 1 :] - key[: len(key) - least + 1] <= band)
    if not len(dense):
        return none
    # dense places that share hits or lie in one band are one
    cut = np.flatnonzero(key[dense[1:]] - key[dense[:-1] + least - 1] > band)
    lo = key[dense[np.concatenate([[0], cut + 1])]]
    hi = key[dense[np.concatenate([cut, [len(dense) - 1]])] + least - 1]
    times = (hi - lo) // WIDE + 1
    at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    low = np.repeat(lo, times) + at * WIDE
    high = np.minimum(np.repeat(hi, times), low + WIDE + band)
    return np.stack([low // SHIFTS, low % SHIFTS - SHIFTS // 2, high - low // SHIFTS * SHIFTS - SHIFTS // 2], axis=1)


def laid(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of these sizes laid one after another: where each begins, and the place of each element in its row."""
    at = np.cumsum(rows) - rows
    return at, np.arange(rows.sum()) - np.repeat(at, rows)


def ranked(gain: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of rows of numbers from -1 to 1, each from a zero of its own and lower than all of the rows before, so
    that none takes the least sum of another; and where each row begins among them."""
    total = np.concatenate([[0.0], np.cumsum(gain)])
    start, j = laid(size + 1)
    row = np.repeat(np.arange(len(size)), size + 1)
    return total[j + at[row]] - total[at[row]] - row * float(2 * size.max(initial=0) + 4), start


def could_tell(index: Index, stand: Callable, found: np.ndarray, rule: Rule) -> np.ndarray:
    """Which rows have a stretch of any length whose names and numbers would do, by ``stand`` alone."""
    number = found[:, 0]
    size = index.tell_sizes[number]
    at, j = laid(size)
    flat = index.tell_flat[np.repeat(index.tell_first[number], size) + j]
    weight = index.weights[flat]
    could = stand(index.flat[flat], flat - np.repeat(index.first[number], size), size)
    drop, start = ranked(weight * (could - rule.min_telling), at, size)
    # what agrees rises along a row, and lies higher than in all rows before
    row = np.repeat(np.arange(len(size)), size + 1)
    sure = np.concatenate([[0.0], np.cumsum(weight * could)])[np.arange(len(drop)) - row] + row
    least = index.least_told(rule)[number]
    last = np.searchsorted(sure, sure - least[row] + 2e-6, "right") - 1  # the last start that leaves enough
    ok = (last >= start[row]) & (np.minimum.accumulate(drop)[last] < drop + 1e-5)
    return np.bincount(row[ok], minlength=len(size)) > 0


def possible(index: Index, codes: np.ndarray, rule: Rule) -> list[tuple[int, int, int]]:
    """Those of runs() where some stretch would count if all words of the passage agreed that stand in the text near them."""
    found = runs(index, codes, rule)
    if not len(found):
        return []
    band = rule.seeds(index.n)[1]
    known = np.flatnonzero(codes >= 0)
    key = np.append(np.sort(codes[known] * SHIFTS + known), np.iinfo(np.int64).max)

    def stand(word: np.ndarray, j: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether these words at places ``j`` of a passage stand in the text at the shifts of their row of ``found``."""
        low = word * SHIFTS + np.maximum(0, j + np.repeat(found[:, 1] - band, size))
        return key[np.searchsorted(key, low)] <= word * SHIFTS + j + np.repeat(found[:, 2] + band, size)

    # names and numbers first, which are few, then the share alone, each for all at once
    if rule.min_telling > 0:
        found = found[could_tell(index, stand, found, rule)]
    number = found[:, 0]
    size = index.sizes[number]
    at, j = laid(size)
    could = stand(index.flat[np.repeat(index.first[number], size) + j], j, size)
    drop, start = ranked(could - rule.min_share, at, size)
    w = rule.min_words
    if len(drop) <= w:
        return []
    good = np.flatnonzero(drop[w:] - np.minimum.accumulate(drop)[:-w] > -1e-6) + w
    some = np.unique(np.searchsorted(start, good, "right") - 1)
    return [tuple(found[r].tolist()) for r in some.tolist() if rule.longest(could[at[r] : at[r] + size[r]], index.tells[number[r]])]


def stretches(codes: np.ndarray, index: Index, rule: Rule, place: tuple[int, int, int]) -> Iterator[tuple[int, int, float, int, int]]:
    """All stretches of a passage that count at a place: passage, words, share, and where they lie in the codes.

    What is left on both sides of an alignment is aligned again, until no stretch could count.
    """
    i, first, last = place
    p, tell = index.passages[i], index.tells[i]
    band = rule.seeds(index.n)[1]
    parts = [(max(0, first - len(p) // 4), min(len(codes), last + len(p) + len(p) // 4))]
    while parts:
        lo, hi = parts.pop()
        part = codes[lo:hi]
        if hi - lo < 1 or not rule.longest(could_agree(part, p, first - band - lo, last + band - lo), tell):
            continue
        for a, b, c, d, agrees in align(part, p):
            got = rule.longest(agrees[c:d] >= 0, tell[c:d])
            if got:
                s, e = c + got[0], c + got[1]
                hit = agrees[s:e][agrees[s:e] >= 0]
                from_, to = lo + int(hit[0]), lo + int(hit[-1]) + 1
                yield i, e - s, len(hit) / (e - s), from_, to
                a, b = from_ - lo, to - lo
            # what is left on both sides, whether or not this one counts
            parts += [(lo, lo + a), (lo + b, hi)]


def could_agree(codes: np.ndarray, passage: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Which words of a passage stand in the text at a shift from lo to hi."""
    m = len(passage)
    a, b = max(0, lo), min(len(codes), hi + m)
    part = np.full(m + hi - lo, -2, np.int64)
    if b > a:
        part[a - lo : b - lo] = codes[a:b]
    return (np.lib.stride_tricks.sliding_window_view(part, hi - lo + 1) == passage[:, None]).any(axis=1)


def scan(texts: Sequence[str | None], index: Index, rule: Rule) -> Iterator[tuple[int, np.ndarray, list[tuple[int, int, int]]]]:
    """Number and codes of each text with a place where a stretch may count, and these places.

    Texts are searched together, CHUNK words at a time, held apart so that no run reaches from one into another. Longer
    ones are cut into windows that overlap by more than a stretch can span.
    """
    gap = int(index.sizes.max(initial=0)) + 2 * rule.seeds(index.n)[1] + index.n
    coded = ((k, index.code_all(tokens(t))) for k, t in enumerate(texts) if t)
    waiting: list[tuple[int, np.ndarray, int, int]] = []
    held: dict[int, tuple[np.ndarray, list]] = {}
    size = 0

    def search() -> None:
        parts, start = [], []
        at = 0
        for _, codes, a, b in waiting:
            start.append(at)
            parts += [codes[a:b], np.full(gap, -1, np.int64)]
            at += b - a + gap
        for i, lo, hi in possible(index, np.concatenate(parts), rule):
            # shifts may lie before the first word of their text, but by less than the gap
            w = int(np.searchsorted(start, lo + index.sizes[i] + rule.seeds(index.n)[1], "right")) - 1
            k, codes, a, _ = waiting[w]
            held.setdefault(k, (codes, []))[1].append((i, lo - start[w] + a, hi - start[w] + a))

    for k, codes in coded:
        step = CHUNK - 2 * gap if 4 * gap < CHUNK else 4 * gap
        for a in range(0, max(1, len(codes)), step):
            waiting.append((k, codes, a, min(len(codes), a + step + 2 * gap)))
            size += waiting[-1][3] - a
            if size >= CHUNK:
                search()
                waiting, size = [], 0
            if a + step + 2 * gap >= len(codes):
                break
        if not waiting:
            yield from ((n, c, p) for n, (c, p) in sorted(held.items()))
            held = {}
    if waiting:
        search()
    yield from ((n, c, p) for n, (c, p) in sorted(held.items()))


def leaked(texts: Sequence[str | None], index: Index, rule: Rule) -> Iterator[tuple[int, int, int, float, int, int]]:
    """Number of the text, item, words, share and place of the longest stretch of each passage that leaked into it."""
    for k, codes, places in scan(texts, index, rule):
        best: dict[int, tuple[int, float, int, int]] = {}
        for place in places:
            for i, n, *rest in stretches(codes, index, rule, place):
                if n > best.get(i, (0,))[0]:
                    best[i] = (n, *rest)
        yield from ((k, index.ids[i], *b) for i, b in sorted(best.items()))


def all_leaked(texts: Sequence[str | None], index: Index, rule: Rule) -> dict[int, set[int]]:
    """By number of the text: numbers of its words that stand in any stretch that counts.

    Words found are taken out and the rest is searched again, until none counts.
    """
    gone: dict[int, set[int]] = {}
    for k, codes, places in scan(texts, index, rule):
        codes, found = codes.copy(), set()
        while places:
            before = len(found)
            for place in places:
                for _, _, _, lo, hi in stretches(codes, index, rule, place):
                    found.update(range(lo, hi))
            if len(found) == before:
                break
            codes[list(found)] = -1  # a word that no passage has
            places = possible(index, codes, rule)
        if found:
            gone[k] = found
    return gone


def build_index(items: Sequence[tuple[int, str]], n: int) -> Index:
    """The index of the passages, which every task holds, so their size is checked."""
    if sum(len(t or "") for _, t in items) > MAX_PASSAGE_CHARS:
        raise ValueError("too many passages to hold in every task; scan them in parts")
    return Index.build([(i, t) for i, t in items if t], n)


def collect_items(items: DataFrame, key: str, text: str) -> list[tuple[int, str]]:
    """The passages as a list; refused before they are collected where they are too long for a broadcast."""
    size = items.agg(F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("n")).collect()[0].n
    if size > MAX_PASSAGE_CHARS:
        raise ValueError("too many passages to hold in every task; scan them in parts")
    return [(r[0], r[1]) for r in items.select(key, text).collect()]


def clean_leaks(
    docs: DataFrame, text: str, key: str, items: Sequence[tuple[int, str]], min_words: int = 20, min_share: float = 0.7, min_telling: float = 0.6, n: int = 2
) -> DataFrame:
    """``key``, ``text`` without any leaked stretch and n_removed (words taken out), a row per row of ``docs``.

    Texts without a leak come back as they are, null included.
    """
    shared = share(docs.sparkSession, build_index(items, n))
    rule = Rule(min_words, min_share, min_telling)
    picked = docs.select(F.col(key).alias("_k"), F.col(text).cast("string").alias("_t"))
    kt = picked.schema["_k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared_value(shared)
        for b in batches:
            texts = b.column(1).to_pylist()
            gone = all_leaked(texts, ix, rule)
            removed = [len(gone.get(k, ())) for k in range(len(texts))]
            for k, g in gone.items():
                texts[k] = without(texts[k], g)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(removed, pa.int32())], names=[key, text, "n_removed"])

    return picked.mapInArrow(run, f"`{key}` {kt}, `{text}` string, n_removed int")


def without(text: str, gone: set[int]) -> str:
    """A text without the words of these numbers (as words() counts them) and what stands between them."""
    bare = prepared(text)
    out, last, open_at = [], 0, None
    spots = [m.span() for m in TOKEN.finditer(bare)]
    for k, (a, b) in enumerate(spots):
        if k in gone:
            if open_at is None:
                open_at = a
                out.append(bare[last:a])
            last = b
        else:
            open_at = None
    out.append(bare[last:])
    return re.sub(r"[ \t]{2,}", " ", "".join(out)).strip()


def find_leaks(
    docs: DataFrame, text: str, key: str, items: Sequence[tuple[int, str]], min_words: int = 20, min_share: float = 0.7, min_telling: float = 0.6, n: int = 2
) -> DataFrame:
    """Pairs (``key``, item_id) with n_words (of the stretch), share, desde, hasta (words of the text, hasta exclusive).

    One row per row of ``docs`` and item, the longest stretch if there are several. Null and empty texts and passages
    match nothing; equal passages are all reported. Whole texts are scanned in one narrow pass. ``items`` is
    collected, so its size is checked.
    """
    index = build_index(items, n)
    picked = docs.select(F.col(key).alias("_k"), F.col(text).cast("string").alias("_t"))
    kt = picked.schema["_k"].dataType.simpleString()
    shared = share(docs.sparkSession, index)
    rule = Rule(min_words, min_share, min_telling)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared_value(shared)
        for b in batches:
            rows = list(leaked(b.column(1).to_pylist(), ix, rule))
            if rows:
                at, item, span, share, lo, hi = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(at)), pa.array(item, pa.int64()), pa.array(span, pa.int32()), pa.array(share, pa.float64()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())],
                    names=[key, "item_id", "n_words", "share", "desde", "hasta"],
                )

    return picked.mapInArrow(run, f"`{key}` {kt}, item_id bigint, n_words int, share double, desde int, hasta int")
