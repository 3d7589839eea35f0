"""Figures of each text and whether it is prose, a list, a table or noise.

Layout is measured first: how many lines carry the same delimiter at the same count or column (vertical alignment),
whether indentation comes back at a period, and the autocorrelation of line lengths. With counts of words, letters,
marks and common words each line is taken for one of the four kinds, which gives each kind a share of the characters.
Layout, symbols, line ends, word length and sentences then say how large the share of prose must be for the text to be
prose (TILT), and which of the other kinds it is (LEAN): rows that come back point to lists and tables, sentences and
closed lines to prose, symbols and endless words to noise.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Function words that also stand inside names and items, and so tell nothing about sentences.
INSIDE_NAMES = frozenset("de del la las el los y a e da do di o d".split())

MARKER = re.compile(r"^\s*(?:[-–—*•·▪‣>]|\(?\d{1,3}(?:[.)º]|\.º|\.-| -)|[a-z]\))\s*", re.UNICODE)
WORD = re.compile(r"[^\W\d_]+", re.UNICODE)
PLAIN_WORD = re.compile(r"[«¿¡(\"'\[—–-]*[^\W\d_]+(?:['’.-][^\W\d_]+)*[.,;:!?)\]»\"'…—–-]*")
SMALL = re.compile(r"(?<![^\W_])[^\W\d_A-ZÁÉÍÓÚÜÑÇ][^\W\d_]*", re.UNICODE)
RULE = re.compile(r"[\s+|:=\-]{3,}")
DIGIT = re.compile(r"\d")
VOWELS = frozenset("aeiouáéíóúàèìòùâêôãõüïy")
CONSONANTS = re.compile(r"[^aeiouáéíóúàèìòùâêôãõüïy]{5,}")

STATS = {
    "n_words": "int", "mean_word_length": "double", "symbol_ratio": "double", "digit_ratio": "double", "line_end_punct": "double", "common_share": "double",
    "sentence_share": "double", "readable_share": "double", "repetition": "double", "delimiter_alignment": "double", "indent_period": "double",
    "length_autocorrelation": "double", "entry_starts": "double", "prose_share": "double", "list_share": "double", "table_share": "double", "noise_share": "double",
}


#: How far each figure, from 0 to 1, moves the share of prose that a text must have, which is a half where all are at rest.
TILT = {"layout": 0.3, "delimiter_alignment": 0.2, "symbols": 0.3, "closed_lines": -0.1, "sentences": -0.1}
#: What each figure, from 0 to 1, adds to the share of a kind.
LEAN = {
    "lista": {"list_share": 1.0, "indent": 0.3, "closed_lines": -0.05},
    "tabla": {"table_share": 1.0, "delimiter_alignment": 0.1, "lengths": 0.2},
    "ruido": {"noise_share": 1.0, "symbols": 0.3, "endless": 0.2},
}


def readable(word: str) -> bool:
    """Whether a word of letters could be spoken: vowels in a likely share and no long run of consonants."""
    w = word.lower()
    n = len(w)
    if n == 1:
        return w in "aeiouyàáéóè"
    v = sum(c in VOWELS for c in w)
    if n > 22 or not v or v == n > 4 or len(set(w)) == 1:
        return False
    return (n < 4 or 0.2 <= v / n <= 0.8) and not CONSONANTS.search(w)


def alignment(lines: Sequence[str]) -> tuple[float, list[bool]]:
    """Share of lines divided into the same columns, and which these are."""
    n = len(lines)
    best: list[bool] = [False] * n
    if n < 3:
        return 0.0, best
    text = "\n".join(lines)
    bare = [re.sub(r'"[^"]*"', "", x) for x in lines] if '"' in text else lines
    for mark, least in (("\t", 1), ("|", 2), ("¦", 1), ("│", 1), (";", 2), (",", 1)):
        if text.count(mark) < 3:
            continue
        counts = [x.rstrip(";. ").count(mark) for x in bare] if mark == ";" else [x.count(mark) for x in bare]
        common = Counter(c for c in counts if c >= least).most_common(1)
        if not common or common[0][1] < 3:
            continue
        k = common[0][0]
        rows = [c == k for c in counts]
        if mark == ",":
            # prose has commas too: cells must be short, without the space that follows a comma in writing
            rows = [r and ", " not in b and len(x) < 60 * (k + 1) for r, b, x in zip(rows, bare, lines, strict=True)]
        elif mark == ";":
            rows = [r and b.count("; ") <= k // 2 for r, b in zip(rows, bare, strict=True)]
        if sum(rows) > sum(best) and sum(rows) >= 3:
            best = rows
    # columns held apart by blanks: the same starts again and again
    if "  " in text:
        inner = [bool(re.search(r"\S {2,}\S", x)) for x in lines]
        if sum(inner) >= 3:
            starts = [[m.end() for m in re.finditer(r"(?<=\S) {2,}(?=\S)", x.rstrip())] + ([len(x) - len(x.lstrip())] if x.startswith("  ") else []) for x in lines]
            seen = Counter(s for row in starts for s in row)
            stops = {s for s, c in seen.items() if c >= max(3, 0.35 * sum(inner))}
            rows = [any(s in stops for s in row) and (i or bool(row)) for row, i in zip(starts, inner, strict=True)]
            if sum(i and r for i, r in zip(inner, rows, strict=True)) >= max(3, 0.6 * sum(rows)) and sum(rows) > sum(best):
                best = rows
    if any(best):
        best = [b or bool(RULE.fullmatch(x)) for b, x in zip(best, lines, strict=True)]
    return sum(best) / n, best


def autocorrelation(x: Sequence[float], most: int = 8) -> float:
    """The highest autocorrelation at lags from 1 to ``most``; 0 where the values hardly vary or are few."""
    n = len(x)
    if n < 4 or max(x) == min(x):
        return 0.0
    a = np.asarray(x, float)
    a = a - a.mean()
    lags = min(most, n - 2)
    r = np.correlate(a, a, "full")[n - 1 : n + lags]
    return float((r[1:] / (n - np.arange(1, lags + 1))).max() * n / r[0])


class Vocabulary:
    """What is known of a word: whether it is frequent, whether it tells of sentences, whether it can be read."""

    def __init__(self, common: frozenset[str]) -> None:
        self.common = common
        self.known: dict[str, tuple[bool, bool, int]] = {}

    def __call__(self, word: str) -> tuple[bool, bool, int]:
        got = self.known.get(word)
        if got is None:
            c = word in self.common
            got = c, c and word not in INSIDE_NAMES, len(word) if readable(word) else 0
            if len(self.known) < 300_000:
                self.known[word] = got
        return got


def measure(text: str | None, common: frozenset[str] | Vocabulary) -> dict:
    """All figures of one text. Null and empty texts have zeros everywhere and count as prose."""
    known = common if isinstance(common, Vocabulary) else Vocabulary(common)
    text = (text or "").replace("\x00", " ")
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    out = dict.fromkeys(STATS, 0.0)
    tokens = text.split()
    out["n_words"] = len(tokens)
    if not lines:
        return out | {"prose_share": 1.0}
    by_line = [WORD.findall(x) for x in text.lower().split("\n") if x and not x.isspace()]
    facts = [[known(w) for w in ws] for ws in by_line]
    n = max(1, sum(map(len, by_line)))
    solid = max(1, sum(map(len, tokens)))
    letters = [sum(map(len, ws)) for ws in by_line]
    digits = len(DIGIT.findall(text))
    strong = [sum([f[1] for f in fs]) for fs in facts]
    good = [sum([f[2] for f in fs]) for fs in facts]
    out["mean_word_length"] = solid / len(tokens)
    out["symbol_ratio"] = 1 - (sum(letters) + digits) / solid
    out["digit_ratio"] = digits / solid
    out["line_end_punct"] = sum([x.rstrip()[-1] in ".!?:;…»\"" for x in lines]) / len(lines)
    out["common_share"] = sum([f[0] for fs in facts for f in fs]) / n
    out["sentence_share"] = sum(strong) / n
    out["readable_share"] = sum(good) / solid
    size = [len(x.strip()) for x in lines]
    same = 0.0
    if len(lines) > 3:
        top, times = Counter(map(str.strip, lines)).most_common(1)[0]
        same = len(top) * times / sum(size) if times > 3 else 0.0
    raw = text.encode(errors="replace")
    packed = len(zlib.compress(raw, 1)) / len(raw)
    out["repetition"] = max(same, min(1.0, max(0.0, (0.12 - packed) / 0.08)) if len(text) > 300 else 0.0)
    out["delimiter_alignment"], table = alignment(lines)
    out["indent_period"] = autocorrelation([len(x) - len(x.lstrip()) for x in lines])
    out["length_autocorrelation"] = autocorrelation([len(x) for x in lines])
    out["entry_starts"] = sum([x.lstrip()[0].isupper() or x.lstrip()[0].isdigit() or bool(MARKER.match(x)) for x in lines]) / len(lines)

    kinds = label_lines(lines, table, by_line, letters, strong, good, [sum([f[0] for f in fs]) for fs in facts])
    total = sum(size)
    for s, k in zip(size, kinds, strict=True):
        out[f"{k}_share"] += s / total
    if out["repetition"] > 0.5:
        out |= {"prose_share": 0.0, "list_share": 0.0, "table_share": 0.0, "noise_share": 1.0}
    return out


def is_noise(line: str, words: Sequence[str], letters: int, good: int) -> bool:
    """Whether most of a line is symbols, broken letters, numbers without words, or letters that make no words."""
    tokens = line.split()
    solid = sum(map(len, tokens))
    if solid < 4:
        return False
    if not letters:
        return True
    if "<" in line and sum(map(len, re.findall(r"<[^>]*>|\[\[[^\]]*\]\]", line))) > 0.6 * solid:
        return True
    # runs of letters and signs too long for words, or letters and signs taking turns
    if sum([len(t) for t in tokens if len(t) > 25]) > 0.5 * solid:
        return True
    if len(tokens) < 3 and letters < 0.7 * solid and not any(map(str.isdigit, line)) and not any(map(PLAIN_WORD.fullmatch, tokens)):
        return True
    single = sum([len(w) == 1 for w in words])
    if single > 0.5 * len(words) and (len(words) > 5 or (letters < 0.6 * solid and not MARKER.match(line))):
        return True
    if good < 0.5 * letters:
        return True
    if len(tokens) > 5 and good < 0.75 * solid and sum(len(t) for t in tokens if PLAIN_WORD.fullmatch(t)) < 0.3 * solid:
        return True
    return len(tokens) > 3 and letters < 0.35 * solid and not re.search(r"[\t|;,]", line)


def wordless(line: str, words: Sequence[str], common: int) -> bool:
    """Whether a line runs on like a sentence, in small letters, but with hardly a frequent word of any language."""
    n = len(words)
    if n < 8 or common >= 0.1 * n or line.count(",") + line.count(";") > 0.2 * n:
        return False
    return len(SMALL.findall(line)) >= 0.7 * n


def label_lines(lines: Sequence[str], table: Sequence[bool], by_line: Sequence[Sequence[str]], letters: Sequence[int], strong: Sequence[int], good: Sequence[int], common: Sequence[int]) -> list[str]:
    """prose, list, table or noise for each line; a line that goes on with an open sentence is prose."""
    kinds: list[str] = []
    n = [max(1, len(w)) for w in by_line]
    share = [s / k for s, k in zip(strong, n, strict=True)]
    marked = [False] * len(lines)
    for i, x in enumerate(lines):
        if table[i]:
            kinds.append("table")
            continue
        if wordless(x, by_line[i], common[i]):
            kinds.append("noise")
            continue
        # most lines are sentences of readable words
        if share[i] >= 0.1 and n[i] >= 4 and good[i] > 0.8 * letters[i] and letters[i] > 0.75 * (len(x) - x.count(" ")) and x.count(",") + x.count(";") < 4:
            kinds.append("prose")
            continue
        marked[i] = bool(MARKER.match(x))
        if is_noise(x, by_line[i], letters[i], good[i]):
            # index entries and the like end in numbers and stay lists
            entry = re.match(r"^\W*[^\W\d_]{3,}[^\d]*[\d\s,.;rv-]*$", x) and by_line[i] and readable(by_line[i][0])
            kinds.append("list" if entry and len(x) < 90 else "noise")
            continue
        near = share[i]
        if not marked[i]:
            around = share[max(0, i - 1) : i + 2]
            near = max(near, sum(around) / len(around))
        commas = x.count(",") + x.count(";")
        items = commas >= 4 and n[i] / (commas + 1) < 5.5
        if n[i] >= 4 and (share[i] >= 0.1 or (near >= 0.1 and not marked[i] and n[i] > 5)):
            kinds.append("prose" if not (items and share[i] < 0.08) else "list")
        elif n[i] > 8 and share[i] > 0.04 and x.rstrip()[-1:] in ".!?":
            kinds.append("prose")
        elif n[i] > 20 and share[i] > 0.04 and common[i] >= 0.25 * n[i] and commas < 0.1 * n[i]:
            kinds.append("prose")  # sentences without marks
        else:
            kinds.append("list")
    # wrapped prose has lines that look like entries: a line goes on with the sentence the line before left open
    for i in range(1, len(kinds)):
        if kinds[i] == "list" and kinds[i - 1] == "prose" and not marked[i] and lines[i - 1].rstrip()[-1] not in ".:;!?":
            kinds[i] = "prose"
    return kinds


def signs(m: dict) -> dict[str, float]:
    """The figures as kind() weighs them, each from 0 to 1, with the shares."""
    part = lambda x, low, high: min(1.0, max(0.0, (x - low) / (high - low)))
    # lines of wrapped prose may have any rhythm, but they do not all begin as entries do
    rows = part(m["entry_starts"], 0.6, 0.9)
    indent, lengths = rows * part(m["indent_period"], 0.1, 0.6), rows * part(m["length_autocorrelation"], 0.3, 0.9)
    return m | {
        "indent": indent, "lengths": lengths, "layout": max(indent, lengths), "symbols": part(m["symbol_ratio"], 0.08, 0.4), "closed_lines": part(m["line_end_punct"], 0.3, 0.9),
        "sentences": part(m["sentence_share"], 0.08, 0.2), "endless": part(m["mean_word_length"], 9.0, 25.0),
    }


def kind(m: dict) -> str:
    """prosa, lista, tabla or ruido."""
    s = signs(m)
    if m["prose_share"] >= 0.5 + sum(w * s[k] for k, w in TILT.items()):
        return "prosa"
    score = {k: sum(w * s[x] for x, w in lean.items()) for k, lean in LEAN.items()}
    return max(score, key=lambda k: score[k])


def text_quality(df: DataFrame, text: str, common_words: Sequence[str], key: str) -> DataFrame:
    """``key``, the figures of STATS and clase, a row per row of ``df``; whole texts, no shuffle.

    Nulls and blanks are prose with zeros; repeated rows are measured again; ties between kinds go to lista, tabla,
    ruido in this order.
    """
    common = frozenset(w.lower() for w in common_words if w)
    picked = df.select(F.col(key).alias("_k"), F.col(text).cast("string").alias("_t"))
    kt = picked.schema["_k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(common)
        for b in batches:
            rows = [measure(t, known) for t in b.column(1).to_pylist()]
            cols = pd.DataFrame(rows, columns=list(STATS))
            arrays = [pa.array(cols[c], pa.int32() if t == "int" else pa.float64()) for c, t in STATS.items()]
            yield pa.RecordBatch.from_arrays([b.column(0), *arrays, pa.array([kind(r) for r in rows], pa.string())], names=[key, *STATS, "clase"])

    return picked.mapInArrow(run, ", ".join([f"`{key}` {kt}", *(f"{c} {t}" for c, t in STATS.items()), "clase string"]))
