"""Scanned pages made readable: running headers and page numbers, divided words, misread letters.

A first pass counts, over all texts, the words, the words beside numbers and, by volume, the lines that come back; that
is the vocabulary. Then each text is labelled by a linear conditional model over segments: its states are header, page
break and body, its features layout (a line by itself, ornaments, capitals) and the vocabulary (header words in order,
words that want a number), its moves what stands before a segment. Weights and moves are fitted on a bounded sample of
the corpus. The best path is decoded, body parts are joined over what was taken out, and their words are mended.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archiva.functions.names import distance, fold
from archiva.session import share, shared_value

#: A word belongs to the vocabulary from so many occurrences, whatever the size of the corpus.
MIN_COUNT = 5
#: A line may be a header from so many texts of one volume and this share of them, or from these of all texts.
MIN_LINES, MIN_LINE_SHARE = 5, 0.01
MIN_LINES_ALL, MIN_LINE_SHARE_ALL = 3, 1e-3
#: Common words are as many as a language has, names are not among them; more than this is refused rather than broadcast.
MAX_WORDS = 2_000_000
#: So many texts, the first by hash, are labelled to fit the model.
SAMPLE = 1000

# What scans show in place of a letter.
CONFUSIONS = [
    ("0", "o"), ("0", "O"), ("1", "l"), ("I", "l"), ("l", "I"), ("1", "L"), ("I", "L"), ("l", "L"), ("1", "I"), ("1", "i"), ("!", "i"), ("!", "l"), ("!", "I"), ("5", "s"), ("5", "S"),
    ("6", "b"), ("8", "B"), ("8", "b"), ("3", "e"), ("2", "z"), ("9", "g"), ("9", "q"), ("4", "a"), ("7", "t"), ("@", "a"), ("@", "A"), ("(", "c"), ("(", "C"), ("c", "e"), ("c", "E"), ("C", "E"), ("e", "c"),
    ("o", "c"), ("c", "o"), ("n", "u"), ("u", "n"), ("t", "r"), ("r", "t"), ("f", "t"), ("t", "f"), ("f", "í"), ("í", "f"), ("b", "h"), ("h", "b"), ("i", "í"), ("í", "i"), ("rn", "m"), ("m", "rn"), ("cl", "d"), ("d", "cl"), ("¡o", "p"),
    ("\\/", "v"), ("\\/", "V"), ("vv", "w"), ("ii", "u"), ("li", "h"), ("ri", "n"), ("nn", "m"), ("G", "C"), ("O", "Q"), ("O", "D"), ("F", "P"), ("P", "F"), ("E", "F"), ("F", "E"), ("i", "l"), ("l", "i"), ("j", "i"), ("S", "5"), ("$", "s"), ("$", "S"), ("€", "e"), ("|", "l"), ("|", "I"), ("B", "8"), ("q", "g"), ("g", "q"), ("fi", "ñ"), ("ñ", "fi"), ("n", "ñ"), ("ó", "6"), ("6", "ó"), ("6", "o"), ("s", "5"), ("z", "2"), ("@", "á"), ("a", "o"), ("o", "a"),
]

BY_SIGN = {first: [x for x in CONFUSIONS if x[0][0] == first] for first in {bad[0] for bad, _ in CONFUSIONS}}

#: Shorter words are too easily one another's misreading.
MIN_LETTERS = 5

HYPHENS = "-¬‐‑–­"
ORNAMENTS = frozenset(["-", "—", "–", "·", "*", "•", "~", "=", "__", "--", "|"])
NUMERAL = re.compile(r"[\[(]?([0-9]{1,4}|[0-9IlOoSBZ|!]{1,4})[\])]?[.:]?")
BARE = re.compile(r"[0-9]{1,4}")
EDGE_L = "\"'«»“”¿[—–·*"
EDGE_R = ".,;:\"'«»“”?[]—–·*"


SIGNS = str.maketrans("01!|5@(6$", "olilsacbs")
HYPHEN, NUMBER, HEADER, UNKNOWN = 1, 2, 4, 8
ROMAN = re.compile(r"[IVXLl1]{1,6}\.?")


def core(token: str) -> str:
    """A word without the punctuation around it; signs that may be misread letters stay."""
    t = token.lstrip(EDGE_L).rstrip(EDGE_R)
    if t.endswith(")") and "(" not in t:
        t = t[:-1]
    if t.startswith("(") and t.endswith(")"):
        t = t[1:-1]
    return t


@dataclass
class Vocabulary:
    """What the first pass found."""

    lower: dict[str, int] = field(default_factory=dict)  # common words by lower case: in all
    small: dict[str, int] = field(default_factory=dict)  # of these, with a small first letter
    label: dict[str, int] = field(default_factory=dict)  # words of labels, as often as they stand in one
    before: dict[str, float] = field(default_factory=dict)  # share of a word's occurrences followed by a number
    after: dict[str, float] = field(default_factory=dict)  # share of a word's occurrences that follow a number
    headers: list[list[str]] = field(default_factory=list)
    bones: list[str] = field(default_factory=list)  # the letters of each header
    header_words: dict[str, tuple[bool, int]] = field(default_factory=dict)
    acts: dict[str, tuple[int, str, str]] = field(default_factory=dict)
    model: Model | None = None
    most: int = 1  # how often the most frequent word occurs; what is as rare as a part of a word may be one

    def add_headers(self, lines: Sequence[tuple[int, str]]) -> None:
        """Take the lines for headers, the most frequent first, without those that are a misread or shorter form of one."""
        for _, key in sorted(lines, reverse=True):
            bones = letters(key)
            if not any(bones == c or c.startswith(bones) or distance(bones, c, 8) <= 0.2 * len(c) for c in self.bones):
                self.headers.append(key.split())
                self.bones.append(bones)
        for w in (w for h in self.headers for w in h):
            bones = letters(w)
            if len(bones) > 4:
                self.header_words[bones] = (w.isupper() and self.header_words.get(bones, (True, 0))[0], len(bones))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"acts": {}}

    def form(self, word: str) -> int:
        """How often a common word or the word of a label occurs with a first letter of this size; 0 for others.

        A word is common if a fair part of it is written small; names are not.
        """
        low = word.lower()
        n = self.lower.get(low, 0)
        if word[0].isupper():
            return n - self.small.get(low, 0) if self.label.get(low, 0) >= 0.3 * n > 0 else 0
        small = self.small.get(low, 0)
        return small if small >= 0.1 * n else 0

    def act(self, token: str) -> tuple[int, str, str]:
        """What a token may be, as a sum of HYPHEN, NUMBER, HEADER and UNKNOWN, its right form if it is misread, and its
        letters in lower case if it has nothing else."""
        got = self.acts.get(token)
        if got is None:
            flags, right, low = 0, "", ""
            if len(token) > 1 and token[-1] in HYPHENS and token[-2].isalpha():
                flags |= HYPHEN
            elif len(token) < 8 and _is_number(token):
                flags |= NUMBER
            else:
                w = core(token)
                low = w.lower() if w.isalpha() else ""
                if low and 20 * self.lower.get(low, 0) < self.most:
                    flags |= UNKNOWN
                right = self.mend(w) if len(w) > 1 else ""
                bones = letters(w)
                if len(bones) > 3:
                    caps = sum(map(str.isupper, w)) > 0.5 * len(w)
                    for h, (upper, size) in self.header_words.items():
                        if (upper and not caps) or abs(size - len(bones)) > 2:
                            continue
                        if h == bones or distance(h, bones, 2) <= 1 + (size > 7):
                            flags |= HEADER
                            break
            got = flags, right, low
            if len(self.acts) < 500_000:
                self.acts[token] = got
        return got

    def mend(self, word: str) -> str:
        """The word that a misread one must be, or ''."""
        if not MIN_LETTERS - 1 <= len(word) <= 40 or sum(map(str.isalpha, word)) < max(1, 0.4 * len(word)):
            return ""
        best = self._mended([word], word)
        if not best and not word.isalpha():
            # a second misread sign beside the first
            once = [word[:at] + good + word[at + len(bad) :] for at, bad, good in misreadings(word) if not bad.isalpha()]
            best = self._mended(once, word)
        return best

    def _mended(self, words: Sequence[str], typed: str) -> str:
        """The most frequent common word one misreading away from any of ``words``, or ''."""
        n, odd = self.lower.get(typed.lower(), 0), not typed.isalpha()
        best, most = "", 0
        for word in words:
            for at, bad, good in misreadings(word):
                t = word[:at] + good + word[at + len(bad) :]
                if len(t) >= MIN_LETTERS and t.isalpha() and t[1:].islower():
                    k = self.form(t)
                    if k > most and (odd or k >= 8 * n):
                        best, most = t, k
        return best


def misreadings(word: str) -> list[tuple[int, str, str]]:
    """Where a word has what may stand for something else, what it is and what it may stand for."""
    return [(at, bad, good) for at, c in enumerate(word) if c in BY_SIGN for bad, good in BY_SIGN[c] if word.startswith(bad, at)]


def letters(text: str) -> str:
    """Folded letters only, signs read for letters set right."""
    return re.sub(r"[^a-z]", "", fold(text.translate(SIGNS)))


def stripped(line: str) -> str:
    """A line without number and ornament at its end, as a header is recognised by."""
    return re.sub(r"[\s\-—–·]*[0-9IlO]{0,4}[\s\-—–·.]*$", "", line).strip(" -—–·")


def count_corpus(df: DataFrame, text: str, volume: str | None = None) -> DataFrame:
    """kind, key, volume, n over all texts: w tokens, c words in lower case, d those with a small first letter, p words before
    and n words behind a number, l words of labels, h lines that may be headers (once a text) and t texts, both by
    volume. Combined in each task before the shuffle, so hot words are no skew."""
    picked = df.select(F.col(text).cast("string").alias("_t"), (F.col(volume) if volume else F.lit(None)).cast("string").alias("_v"))
    labels = re.compile(r"(?:^\S+|\.—)\s([A-ZÁÉÍÓÚÑ][^:.—]{3,40}):")
    beside = re.compile(r"(\S+)\s+[0-9][0-9.]*[.,;]?\s+(?=(\S+))")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[str] = Counter()
        rest: Counter[tuple[str, str, str | None]] = Counter()

        def out() -> pa.RecordBatch:
            for token, n in words.items():
                rest["w", token, None] += n
                w = core(token)
                if w.isalpha():
                    rest["c", w.lower(), None] += n
                    if w[0].islower():
                        rest["d", w.lower(), None] += n
            kind, key, vol = zip(*rest, strict=True) if rest else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(kind, pa.string()), pa.array(key, pa.string()), pa.array(vol, pa.string()), pa.array(list(rest.values()), pa.int64())], names=["kind", "key", "volume", "n"])

        for b in batches:
            for t, vol in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if not t:
                    continue
                words.update(t.split())
                for phrase in labels.findall(t):
                    for w in phrase.split():
                        rest["l", w.lower(), None] += 1
                rest["t", "", vol] += 1
                for p, n in beside.findall(t):
                    rest["p", p, None] += 1
                    rest["n", n, None] += 1
                if "\n" in t:
                    seen = set()
                    for line in t.split("\n")[1:]:
                        if ":" in line or ".—" in line or not line[:2].strip(" -—–·").isalpha() and not line.strip()[:1].isalpha():
                            continue
                        s = stripped(line)
                        if s[:1].isupper() and s.count(" ") >= 2 and line.rstrip()[-1:] not in ".,;" and s[-1:] not in ",;" and len(s) < 120:
                            seen.add(s)
                    for s in seen:
                        rest["h", s, vol] += 1
            if len(words) + len(rest) > 200_000:
                yield out()
                words, rest = Counter(), Counter()
        yield out()

    return picked.mapInArrow(run, "kind string, key string, volume string, n bigint").groupBy("kind", "key", "volume").agg(F.sum("n").alias("n"))


def learn(df: DataFrame, text: str, volume: str | None = None, cut=lambda df: df, min_count: int = MIN_COUNT, min_lines: int = MIN_LINES, min_line_share: float = MIN_LINE_SHARE, sample: int = SAMPLE) -> Vocabulary:
    """The vocabulary of a corpus, and the model fitted on ``sample`` of its texts.

    Common words (of ``min_count`` occurrences, a tenth of them written small, or three tenths in labels), words beside
    numbers and headers come to the driver; their number is that of the words of a language and of the headers of
    the volumes, and is checked. A line is a header if some volume has it in ``min_lines`` texts and ``min_line_share`` of
    its texts (or all texts together in a tenth of that share), and if some word of it stands hardly anywhere else; so
    other volumes take no header away from one. ``cut`` may
    checkpoint the counts, which are used several times.
    """
    counts = cut(count_corpus(df, text, volume))
    of = lambda kind, name, key="key": counts.where(F.col("kind") == kind).select(F.col("key").alias(key), F.col("n").alias(name))
    c = of("c", "n").where(F.col("n") >= min_count).join(of("d", "small"), "key", "left").join(of("l", "label"), "key", "left")
    c = c.select("key", "n", F.coalesce("small", F.lit(0)).alias("small"), F.coalesce("label", F.lit(0)).alias("label"))
    c = c.where((F.col("small") >= 0.1 * F.col("n")) | (F.col("label") >= 0.3 * F.col("n")))
    beside = []
    for kind in ("p", "n"):
        share = of(kind, "k").where(F.col("k") >= min_count).join(of("w", "n"), "key", "left").select(F.lit(kind).alias("kind"), "key", F.lit(None).cast("string").alias("word"), (F.col("k") / F.greatest("k", F.coalesce("n", "k"))).alias("share"))
        beside.append(share.where(F.col("share") >= 0.01))
    in_volume = counts.where(F.col("kind") == "h").select("key", "volume", "n")
    texts = counts.where(F.col("kind") == "t").select(F.col("volume").alias("_volume"), F.col("n").alias("texts"))
    often = in_volume.join(texts, F.col("volume").eqNullSafe(F.col("_volume"))).where((F.col("n") >= min_lines) & (F.col("n") >= min_line_share * F.col("texts"))).select("key")
    lines = in_volume.groupBy("key").agg(F.sum("n").alias("n"))
    total = texts.agg(F.coalesce(F.sum("texts"), F.lit(0)).alias("texts"))
    everywhere = lines.crossJoin(total).where((F.col("n") >= MIN_LINES_ALL) & (F.col("n") >= MIN_LINE_SHARE_ALL * F.col("texts"))).select("key")
    lines = lines.join(often.unionByName(everywhere).distinct(), "key", "left_semi")
    # what the sentences of many texts share comes at any place of a line, a header is always a line by itself
    parts = lines.select("key", "n", F.explode(F.split("key", r"\s+")).alias("word")).join(of("w", "times", "word"), "word", "left")
    heads = parts.groupBy("key", "n").agg(F.min(F.coalesce("times", F.lit(0))).alias("rarest")).where(F.col("n") >= 0.3 * F.col("rarest"))
    if c.count() > MAX_WORDS or heads.count() > MAX_WORDS // 100:
        raise ValueError("the texts have more common words or headers than every task can hold; learn from one language or archive at a time")
    v = Vocabulary()
    for r in c.collect():
        v.lower[r.key] = r.n
        v.small[r.key] = r.small
        if r.label:
            v.label[r.key] = r.label
    for r in beside[0].unionByName(beside[1]).collect():
        (v.before if r.kind == "p" else v.after)[r.key] = r.share
    v.most = max(v.lower.values(), default=1)
    v.add_headers([(r.n, r.key) for r in heads.select("key", "n").collect()])
    if sample:
        # twice as many as needed by hash, so that no task sends more than its part of them
        every = total.collect()[0].texts
        draw = F.pmod(F.xxhash64("_t"), F.lit(1 << 40))
        some = df.select(F.col(text).cast("string").alias("_t")).where((F.length(F.trim("_t")) > 0) & (draw <= F.lit(int(min(1.0, 2 * sample / max(every, 1)) * (1 << 40)))))
        v.model = fit([r._t for r in some.orderBy(draw, "_t").limit(sample).collect()], v)
    return v


#: What the model starts from and stays near: weights of the features of a segment.
START = {
    "header": 8.0, "likeness": 1.0, "ornate": 3.0, "own line": 4.0, "in a line": -6.0, "ornate in a line": 3.0, "number of the record": -8.0, "plain": 2.5, "wanted": -6.0, "wanted on both sides": -2.0, "full stop": 2.0,
}


@dataclass(frozen=True)
class Model:
    """A linear conditional model of segments: weights of features, and of the state before a segment."""

    weights: Mapping[str, float] = field(default_factory=lambda: dict(START))
    moves: Mapping[tuple[str, str], float] = field(default_factory=dict)

    def score(self, part: Part) -> float:
        return sum(self.weights[k] * x for k, x in part.features)

    def move(self, before: str, kind: str) -> float:
        return self.moves.get((before, kind), 0.0)


def fit(texts: Sequence[str], v: Vocabulary, rounds: int = 2, hold: float = 300.0, most: float = 2.0) -> Model:
    """Weights and moves from texts without labels: the texts are decoded, the weights that make the decoded segments
    most likely are found, and once more. ``hold`` is how firmly weights stay near START, ``most`` the largest move."""
    model = Model()
    names = list(START)
    start = np.array([START[n] for n in names])
    split = [split_text(t) for t in texts]
    found = [candidates(tokens, line_of, [v.act(t)[0] for t in tokens], v) for tokens, line_of in split]
    for _ in range(rounds):
        rows, taken, before = [], [], []
        for (tokens, _), parts in zip(split, found, strict=True):
            path = set(decode(parts, model))
            ends = {p.end: p.kind for p in path}
            for p in parts:
                rows.append([dict(p.features).get(n, 0.0) for n in names])
                taken.append(p in path)
                before.append((ends.get(p.start, "inicio" if p.start == 0 else "cuerpo"), p.kind))
        if not rows:
            return model
        x, y, w = np.array(rows), np.array(taken, float), start.copy()
        for _ in range(8):  # Newton steps
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grad = x.T @ (p - y) + hold * (w - start)
            w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + hold * np.eye(len(w)), grad)
        each, hits, kinds, kind_hits = Counter(before), Counter(b for b, t in zip(before, taken, strict=True) if t), Counter(k for _, k in before), Counter(b[1] for b, t in zip(before, taken, strict=True) if t)
        odds = lambda k, n: np.log((k + 1) / (n - k + 1))
        moves = {b: float(np.clip(odds(hits[b], n) - odds(kind_hits[b[1]], kinds[b[1]]), -most, most)) * n / (n + 50) for b, n in each.items()}
        model = Model(dict(zip(names, w.tolist(), strict=True)), moves)
    return model


@dataclass(frozen=True)
class Part:
    """A run of tokens that is a header or a page break."""

    start: int
    end: int
    kind: str
    features: tuple[tuple[str, float], ...]


def _is_number(token: str) -> bool:
    m = NUMERAL.fullmatch(token)
    return bool(m) and any(map(str.isdigit, token))


def header_parts(tokens: Sequence[str], line_of: Sequence[int] | None, hits: Sequence[int], v: Vocabulary) -> Iterator[Part]:
    """Runs that are a known header, whole or cut short, misread or with lost blanks, with volume, number and ornaments."""
    n = len(tokens)
    done = -1
    for at, i in enumerate(hits):
        # a header has several words that headers have, side by side
        if i < done or not ((at and i - hits[at - 1] < 7) or (at + 1 < len(hits) and hits[at + 1] - i < 7)):
            continue
        best: tuple[float, int, int, float] | None = None
        lo, hi = max(0, i - 7), min(n, i + 8)
        if line_of is not None:
            while line_of[lo] != line_of[i]:
                lo += 1
            while line_of[hi - 1] != line_of[i]:
                hi -= 1
        bones = [letters(t) for t in tokens[lo:hi]]
        for s in range(lo, i + 1):
            first = bones[s - lo]
            if s < done or not first:
                continue
            # a header begins about as one of those known
            near = [h for h in v.bones if first[0] == h[0] or sum(map(str.__eq__, first, h[:4])) >= min(2, len(first))]
            if not near:
                continue
            run = ""
            for e in range(s + 1, hi + 1):
                b = bones[e - 1 - lo]
                if not b and e < hi:
                    continue
                run += b
                size = len(run)
                if size < 8 or e <= i:
                    continue
                for h in near:
                    # the whole header or the beginning of it, if it is cut
                    most = len(h) // 4
                    if abs(size - len(h)) <= most and (d := distance(run, h, most)) <= most:
                        gain = len(h) - 3.0 * d
                        if best is None or gain > best[0]:
                            best = (gain, s, e, float(len(h)))
                    if 10 <= size < len(h) and (d := distance(run, h[:size], size // 8)) <= size // 8:
                        gain = size - 3.0 * d - 4.0
                        if best is None or gain > best[0]:
                            best = (gain, s, e, 0.0)
            if best is not None and best[0] == best[3]:
                break
        if best is None:
            continue
        _, s, e, _ = best
        upper = sum(map(str.isupper, "".join(tokens[s:e])))
        if upper < 0.5 * sum(map(str.isalpha, "".join(tokens[s:e]))) and letters(tokens[s])[:3] not in {b[:3] for b, h in zip(v.bones, v.headers, strict=True) if not h[0].isupper() or not h[0][1:2].isupper()}:
            continue
        here = (lambda k, at=s: line_of[k] == line_of[at]) if line_of is not None else (lambda k: True)
        if s >= 3 and tokens[s - 1] in ORNAMENTS and ROMAN.fullmatch(tokens[s - 2]) and distance(letters(tokens[s - 3]), "tomo", 1) <= 1 and here(s - 3):
            s -= 3
        elif s >= 3 and tokens[s - 1] in ORNAMENTS and distance(letters(tokens[s - 3]), "tomo", 1) <= 1 and len(tokens[s - 2]) < 6 and here(s - 3):
            s -= 3
        k = e
        if k + 1 < n and (tokens[k] in ORNAMENTS or tokens[k] == "." or re.fullmatch(r"p(?:[áa@]g)?\.", tokens[k])) and here(k):
            k += 1
        if k < n and here(k) and (_is_number(tokens[k]) and len(tokens[k]) < 7):
            # on one line the number of a sentence can follow a header: then a word that wants a number comes next
            if k > e or line_of is not None or not (k + 1 < n and v.after.get(tokens[k + 1], 0.0) >= 0.5 and _wanted(tokens, s, v) >= 0.2):
                e = k + 1
                if e < n and tokens[e] in ORNAMENTS and here(e) and line_of is not None:
                    e += 1
        done = e
        yield Part(s, e, "encabezado", (("header", 1.0), ("likeness", best[0] / 4.0)))


def _wanted(tokens: Sequence[str], i: int, v: Vocabulary) -> float:
    """How often a number follows the word before i."""
    if not i:
        return 0.0
    t = tokens[i - 1]
    flags, right, _ = v.act(t)
    if flags & HEADER:
        return 0.0
    if right:
        t = right + t[len(t.rstrip(EDGE_R)) :]
    return v.before.get(t, 0.0)


def _counted(tokens: Sequence[str], i: int, v: Vocabulary) -> float:
    """How often the word at i follows a number; a divided or misread word counts as what it must be."""
    if i >= len(tokens):
        return 0.0
    t = tokens[i]
    flags, right, _ = v.act(t)
    if flags & HYPHEN:
        return max((x for w, x in v.after.items() if x > 0.5 and w.startswith(t[:-1])), default=0.0)
    if right:
        t = right + t[len(t.rstrip(EDGE_R)) :]
    if flags & UNKNOWN and i + 1 < len(tokens):
        t = t if t in v.after else t + tokens[i + 1]
    return max(v.after.get(t, 0.0), v.after.get(t.rstrip(EDGE_R), 0.0))


def page_parts(tokens: Sequence[str], line_of: Sequence[int] | None, hits: Sequence[int], headers: Sequence[Part], v: Vocabulary) -> Iterator[Part]:
    """Runs that may be a page number, scored by ornament, layout and whether the text around wants a number."""
    n = len(tokens)
    begins = {h.start: h.end for h in headers}
    for i in hits:
        t = tokens[i]
        s, e = i, i + 1
        ornate = t[0] in "[(" and t.rstrip(".:")[-1] in "])"
        if i and i + 1 < n and tokens[i - 1] in ORNAMENTS and tokens[i + 1] == tokens[i - 1]:
            s, e, ornate = i - 1, i + 2, True
        elif i and re.fullmatch(r"(?i)p[áa@]g\.?|p\.", tokens[i - 1]):
            s, ornate = i - 1, True
        has: list[tuple[str, float]] = [("ornate", 1.0)] if ornate else []
        if line_of is not None:
            own = (s == 0 or line_of[s - 1] != line_of[s]) and (e == n or line_of[e] != line_of[e - 1])
            has.append(("own line" if own else "in a line", 1.0))
            if ornate and not own:
                has.append(("ornate in a line", 1.0))
        if i == 0 and not (ornate and n > 1 and e in begins) and (line_of is not None or not ornate):
            has.append(("number of the record", 1.0))
        if not ornate:
            plain = t.rstrip(".:")
            if len(plain) > 3 or (s and tokens[s - 1][-1] in HYPHENS and tokens[s - 1][:-1].isdigit()):
                continue
            to = begins.get(e, e)
            wanted, counted = _wanted(tokens, s, v), _counted(tokens, to, v)
            follows = to < n and bool(v.act(tokens[to])[0] & NUMBER)
            if follows:
                counted = 0.0
                wanted *= 0.2 if _counted(tokens, to + 1, v) > 0.3 else 1.0
            elif t.endswith("."):
                # a full stop does not stand before what is counted
                counted *= 0.3
            has += [("plain", 1.0), ("wanted", max(wanted, counted)), ("wanted on both sides", float(counted > 0.05 and wanted > 0.05))]
            if t.endswith(".") and not follows and to < n and tokens[to][:1].islower():
                has.append(("full stop", 1.0))
        yield Part(s, e, "pagina", tuple(has))


def candidates(tokens: Sequence[str], line_of: Sequence[int] | None, flags: Sequence[int], v: Vocabulary) -> list[Part]:
    """All segments of a text that may be a header or a page break, with their features."""
    parts = list(header_parts(tokens, line_of, [i for i, f in enumerate(flags) if f & HEADER], v))
    return parts + list(page_parts(tokens, line_of, [i for i, f in enumerate(flags) if f & NUMBER], parts, v))


def decode(parts: Sequence[Part], model: Model, least: float = 0.5) -> list[Part]:
    """The best path through a text: segments that do not overlap, the rest body. A segment below ``least`` is body."""
    # Viterbi over the ends of segments and their states: body between them costs nothing
    best: list[tuple[float, Part | None, int]] = [(0.0, None, -1)]  # value, segment, the path before it
    upto: list[int] = [0]  # the best path among those so far
    ends: list[int] = [0]
    at_end: dict[int, list[int]] = {}
    for p in sorted(parts, key=lambda p: (p.end, p.start)):
        score = model.score(p)
        far = upto[bisect_left(ends, p.start) - 1] if p.start else 0
        options = [(far, "inicio" if p.start == 0 else "cuerpo"), *((k, best[k][1].kind) for k in at_end.get(p.start, ()))]
        gains = [(best[k][0] + score + model.move(before, p.kind), score + model.move(before, p.kind), k) for k, before in options]
        gains = [g for g in gains if g[1] > least]
        if gains:
            value, _, k = max(gains, key=lambda g: (g[0], -g[2]))
            best.append((value, p, k))
            at_end.setdefault(p.end, []).append(len(best) - 1)
            upto.append(len(best) - 1 if value > best[upto[-1]][0] else upto[-1])
            ends.append(p.end)
    out: list[Part] = []
    k = upto[-1]
    while k > 0:
        _, p, k = best[k]
        out.append(p)
    return out[::-1]


def label(tokens: Sequence[str], line_of: Sequence[int] | None, flags: Sequence[int], v: Vocabulary) -> list[Part]:
    """The headers and page breaks on the best path through a text."""
    return decode(candidates(tokens, line_of, flags, v), v.model or Model())


def split_text(text: str) -> tuple[list[str], list[int] | None]:
    """Tokens cut at white space and, where the text has lines, the line of each."""
    tokens = text.split()
    if "\n" not in text.strip():
        return tokens, None
    line_of: list[int] = []
    for k, line in enumerate(text.split("\n")):
        line_of += [k] * len(line.split())
    return (tokens, line_of) if len(line_of) == len(tokens) else (tokens, None)


def damage(text: str | None, v: Vocabulary) -> list[tuple[int, str, str]]:
    """pos (from 1), tipo, palabra of each case of damage in a text, in order."""
    if not text:
        return []
    tokens, line_of = split_text(text)
    known = v.acts
    acts = [known.get(t) or v.act(t) for t in tokens]
    flags = [a[0] for a in acts]
    parts = label(tokens, line_of, flags, v)
    out = [(p.start + 1, p.kind, "") for p in parts]
    gone = bytearray(len(tokens))
    for p in parts:
        for k in range(p.start, p.end):
            gone[k] = 1
    n = len(tokens)
    second = -1
    # divided without a mark: the halves are rare, the whole is not
    plain = [a[2] for a in acts]
    lower = v.lower
    halves = {i for i, (x, y) in enumerate(zip(plain, plain[1:], strict=False)) if x and y and x + y in lower}
    for i, (f, right, x) in enumerate(acts):
        if gone[i] or i == second:
            continue
        if f & HYPHEN:
            t = tokens[i]
            j = i + 1
            while j < n and gone[j]:
                j += 1
            if j < n and tokens[j][0].isalpha():
                first, rest = t[:-1].lstrip(EDGE_L + "("), core(tokens[j])
                if rest and not (t[-1] in "-‐‑–" and rest[:1].isupper() and not first[-1:].isupper()):
                    out.append((i + 1, "corte", first + rest))
                    second = j
        elif right:
            out.append((i + 1, "letra", right))
        elif i in halves and not gone[i + 1] and not (line_of is not None and line_of[i] == line_of[i + 1]):
            y = core(tokens[i + 1])
            one, two = lower.get(x, 0), lower.get(y.lower(), 0)
            if tokens[i].isalpha() and y[0].islower() and lower[x + y.lower()] > 20 * min(one, two) + max(one, two):
                out.append((i + 1, "corte", tokens[i] + y))
                second = i + 1
    out.sort()
    return out


def repair(text: str | None, v: Vocabulary) -> str | None:
    """The text as continuous paragraphs: without headers and page numbers, words whole and with the right letters.

    The whole text is labelled at once. Lines are joined; a blank line ends a paragraph, unless a word goes on behind
    it, or a header or page number stands there and the sentence is open. Null stays null.
    """
    if text is None:
        return None
    spots = [(m[0], m.start(), m.end()) for m in re.finditer(r"\S+", text)]
    tokens, line_of = split_text(text)
    drop = {k for p in label(tokens, line_of, [v.act(t)[0] for t in tokens], v) for k in range(p.start, p.end)}
    cases = {p - 1: (kind, w) for p, kind, w in damage(text, v) if kind in ("corte", "letra")}
    out: list[str] = []
    end, gone, joins = 0, False, False
    for k, (t, a, b) in enumerate(spots):
        if k in drop:
            gone = True
            continue
        kind, w = cases.get(k, ("", ""))
        if kind == "letra":
            t = t.replace(core(t), w, 1)
        if joins:
            out.append(t)
        elif out:
            blank = text[end:a].count("\n") > 1 if not gone else bool(re.search(r"\n[^\S\n]*\n", text[end:a]))
            if blank and not gone:
                blank = bool(re.search(r"\n[^\S\n]*\n", text[end:a]))
            open_ = gone and out[-1][-1:] not in ".?!:;»”\")" and not t[:1].isupper()
            out.append(("\n\n" if blank and not open_ else " ") + t)
        else:
            out.append(t)
        joins = kind == "corte"
        if joins and t[-1] in HYPHENS:
            out[-1] = out[-1][:-1]
        end, gone = b, False
    return "".join(out)


def find_damage(df: DataFrame, key: str, fields: Sequence[str], v: Vocabulary) -> DataFrame:
    """``key``, campo, pos, tipo, palabra: a row per case of damage in the fields of each row; whole texts, no shuffle.

    tipo is corte, letra, encabezado or pagina. Null and blank texts have none; repeated rows are listed again.
    """
    picked = df.select(F.col(key).alias("_k"), *(F.col(c).cast("string").alias(f"_f{i}") for i, c in enumerate(fields)))
    kt = picked.schema["_k"].dataType.simpleString()
    shared = share(df.sparkSession, v)
    names = list(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = shared_value(shared)
        for b in batches:
            at, campo, rows = [], [], []
            for i, c in enumerate(names):
                for k, t in enumerate(b.column(i + 1).to_pylist()):
                    found = damage(t, voc)
                    if found:
                        at += [k] * len(found)
                        campo += [c] * len(found)
                        rows += found
            if rows:
                pos, tipo, palabra = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(at)), pa.array(campo, pa.string()), pa.array(pos, pa.int32()), pa.array(tipo, pa.string()), pa.array(palabra, pa.string())], names=[key, "campo", "pos", "tipo", "palabra"]
                )

    return picked.mapInArrow(run, f"`{key}` {kt}, campo string, pos int, tipo string, palabra string")


def repair_texts(df: DataFrame, key: str, fields: Sequence[str], v: Vocabulary) -> DataFrame:
    """``key`` and the ``fields`` repaired, a row per row."""
    picked = df.select(F.col(key).alias("_k"), *(F.col(c).cast("string").alias(f"_f{i}") for i, c in enumerate(fields)))
    kt = picked.schema["_k"].dataType.simpleString()
    shared = share(df.sparkSession, v)
    names = list(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = shared_value(shared)
        for b in batches:
            fixed = [pa.array([repair(t, voc) for t in b.column(i + 1).to_pylist()], pa.string()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([b.column(0), *fixed], names=[key, *names])

    return picked.mapInArrow(run, ", ".join([f"`{key}` {kt}", *(f"`{c}` string" for c in fields)]))
