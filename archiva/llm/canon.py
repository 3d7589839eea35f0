"""Free text mapped to the entries of a reference list, or reported as unlisted.

An automaton over all names and aliases finds what is embedded in a value; the longest mentions that do not overlap
win, and a value is settled if only words like "villa de" or "su oficio" remain. The others go to token-set
similarity: words are paired with the words of an entry in any order, each pair costs its edits (on the plain letters,
or one more on a skeleton in which spellings of one sound fall together), words left over cost their letters. Distinct
values are matched once and joined back. A form that occurs about as often as the entry it resembles is no misspelling
of it but a name of its own; both are counted in the data, so it is their ratio that decides and not the size of it.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archiva.functions.names import PARTICLES, distance, fold, remember
from archiva.operators.packed import not_a_name
from archiva.session import share, shared_value

#: A form is a name of its own from this share of the occurrences of the entry it resembles, which count PRIOR more.
OWN_RATIO = 0.25
PRIOR = 5
#: Least similarity of the words of a value and those of an entry.
LEAST = 0.66

# Words around a name that are no part of it, by domain.
AFFIXES = {
    "lugar": [r"^(?:villa|ciudad|lugar|puerto|isla|cabo|aldea|pueblo|vecin[oa]) de (?:la |el )?", r"^en (?:la |el )?"],
    "ocupacion": [r"^(?:que es|que era|de oficio|oficial(?: de)?|maestr[oe]|su oficio|aprendiz de) ", r" (?:que fue|su oficio|del rey|de oficio|de su oficio)$"],
}
# Abbreviations of words in names of places.
SHORT = {"sta": "santa", "sto": "santo", "s": "san", "pto": "puerto", "pt": "puerto", "v.a": "villa", "va": "villa", "cdad": "ciudad", "i": "isla", "vlle": "valle", "c": "cabo", "rda": "rada"}
# Spellings of one sound, in this order.
SOUNDS = [("qu", "c"), ("ll", "i"), ("y", "i"), ("v", "b"), ("u", "b"), ("x", "j"), ("g", "j"), ("z", "s"), ("h", ""), ("k", "c")]


def plain(value: str) -> str:
    """Lower case without accents, doubt marks, punctuation at the ends and double blanks."""
    t = fold(value.replace("ç", "z").replace("Ç", "z").replace("ª", "a.").replace("º", "o."))
    t = re.sub(r"\(\s*\?\s*\)|[«»\"“”?¿]", " ", t)
    t = re.sub(r"\s+", " ", t).strip(" ,;:-")
    return t if re.search(r"\b[a-z]{1,4}\.", t) else t.removesuffix(".")


def skeleton(text: str) -> str:
    """Letters with the spellings of one sound made alike and doubles written once."""
    t = re.sub(r"[^a-z]", "", text)
    for a, b in SOUNDS:
        t = t.replace(a, b)
    return re.sub(r"(.)\1+", r"\1", t)


sound = remember(skeleton)


def expand(text: str) -> str:
    """Abbreviated words written out, where a full stop or a raised letter shows that they are short."""

    def whole(m: re.Match) -> str:
        w = m[1].replace(".", "") if m[1].count(".") < 2 and m[1] != "v.a" else m[1]
        return SHORT.get(w, m[0].rstrip(".")) + " "

    return re.sub(r"\s+", " ", re.sub(r"\b(v\.a|[a-z]{1,4}(?=\.))\.?\s?", whole, text)).strip()


def _abbreviates(part: str, word: str) -> bool:
    """Whether ``part`` is the word or, with a full stop, some of its letters in order from the first."""
    if "." not in part:
        return distance(part, word, 1) <= (len(word) > 4)
    rest = iter(word)
    return part[0] == word[0] and len(part) > 2 and all(c in rest for c in part.replace(".", ""))


@dataclass
class Entry:
    ids: list[tuple[int, str]]  # (id, jurisdiction), several where one name lies in several jurisdictions
    form: str
    tight: str
    bones: str
    words: list[str]

    @classmethod
    def of(cls, ids: Iterable[tuple[int, str]], form: str) -> Entry:
        return cls(sorted(set(ids)), form, form.replace(" ", ""), skeleton(form), form.split())


def word_cost(a: str, b: str, most: int) -> int:
    """Edits between two words, or one more than those between their sounds; ``most + 1`` if they are more."""
    d = distance(a, b, most)
    if d > 1 and abs(len(a) - len(b)) < 5:
        d = min(d, 1 + distance(sound(a), sound(b), 1))
    return min(d, most + 1)


def set_cost(value: Sequence[str], entry: Sequence[str], most: int) -> int:
    """What tells two sets of words apart: edits of the words paired, letters of those left over."""
    left, right = Counter(value), Counter(entry)
    left, right = list((left - right).elements()), list((right - left).elements())
    if not left and not right:
        return 0
    total = 0
    pairs = sorted((word_cost(a, b, most), i, j) for i, a in enumerate(left) for j, b in enumerate(right)) if len(left) * len(right) < 50 else []
    used_l: set[int] = set()
    used_r: set[int] = set()
    for c, i, j in pairs:
        if c <= most and i not in used_l and j not in used_r:
            used_l.add(i)
            used_r.add(j)
            total += c
    rest = [w for i, w in enumerate(left) if i not in used_l] + [w for j, w in enumerate(right) if j not in used_r]
    return min(most + 1, total + sum(1 if w in PARTICLES else len(w) for w in rest))


@dataclass
class Gazetteer:
    """A reference list of one domain ready for matching."""

    domain: str
    entries: list[Entry] = field(default_factory=list)
    jurisdictions: list[str] = field(default_factory=list)
    grams: dict[str, list[int]] = field(default_factory=dict)
    automaton: object = None

    @classmethod
    def build(cls, domain: str, rows: Iterable[tuple[int, Sequence[str | None], str | None]]) -> Gazetteer:
        """``rows``: id, names (the first is the canonical one), jurisdiction or None."""
        by: dict[str, list[tuple[int, str]]] = defaultdict(list)
        for i, names, where in rows:
            for n in names:
                if n and plain(n):
                    by[plain(n)].append((i, plain(where or "")))
        g = cls(domain)
        g.entries = [Entry.of(ids, f) for f, ids in sorted(by.items())]
        g.jurisdictions = sorted({w for ids in by.values() for _, w in ids if w}, key=len, reverse=True)
        g._index()
        return g

    def _index(self) -> None:
        grams: dict[str, list[int]] = defaultdict(list)
        for k, e in enumerate(self.entries):
            for s in {e.tight[i : i + 2] for i in range(len(e.tight) - 1)} | {e.bones[i : i + 2] + "_" for i in range(len(e.bones) - 1)}:
                grams[s].append(k)
        self.grams = dict(grams)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"automaton": None}

    def cut_jurisdiction(self, text: str) -> tuple[str, str]:
        """The value without the jurisdiction added to it, and the jurisdiction."""
        if not self.jurisdictions:
            return text, ""
        m = re.match(r"^(.*?)\s*\(([^()]*)\)$", text)
        tails = [(m[1], m[2])] if m else []
        if "," in text:
            tails.append(tuple(text.rsplit(",", 1)))
        for head, tail in tails:
            bare = re.sub(r"^en (?:la |el )?", "", tail.strip())
            for j in self.jurisdictions:
                if distance(bare, j, 2) <= 1 + (len(j) > 12):
                    return head.strip(" ,."), j
        for j in self.jurisdictions:
            m = re.match(rf"^(.+?),? (?:en )?(?:la |el )?{re.escape(j)}$", text)
            if m:
                return m[1].strip(" ,."), j
        return text, ""

    def cores(self, text: str) -> list[str]:
        """The value and what is left of it without affixes, the fullest first."""
        out = [text]
        if self.domain == "lugar":
            out = [expand(text)]
        for rx in AFFIXES.get(self.domain, ()):
            for t in list(out):
                c = re.sub(rx, "", t).strip(" ,.")
                if c and c not in out:
                    out.append(c)
        if self.domain == "ocupacion":
            for t in list(out):
                for end in ("es", "s"):
                    if len(t) > 4 and t.endswith(end):
                        out.append(t[: -len(end)])
        return out

    def embedded(self, text: str) -> int | None:
        """The entry mentioned in a text whose other words are only affixes."""
        if self.automaton is None:
            import ahocorasick

            a = ahocorasick.Automaton()
            for k, e in enumerate(self.entries):
                a.add_word(f" {e.form} ", k)
            a.make_automaton()
            self.automaton = a
        if not self.entries:
            return None
        padded = f" {text} "
        hits = sorted(((end - len(self.entries[k].form) - 1, end, k) for end, k in self.automaton.iter(padded)), key=lambda h: (h[0] - h[1], h[0]))
        taken: list[tuple[int, int, int]] = []
        for h in hits:  # longest first; overlapping shorter ones give way
            if all(h[1] <= t[0] or h[0] >= t[1] for t in taken):
                taken.append(h)
        if len(taken) != 1:
            return None
        s, e, k = taken[0]
        rest = f"{padded[:s]} @ {padded[e:]}".strip()
        for rx in AFFIXES.get(self.domain, ()):
            rest = re.sub(rx, " ", rest).strip()
        return k if rest.strip(" ,.") == "@" else None

    def nearest(self, core: str, most: int = 2) -> tuple[int, int]:
        """Cost and number of the entry with the most similar set of words, or (99, -1) if none is similar enough.

        Words run together or divided at the wrong place count as one word each. The first name wins a tie.
        """
        tight, bones, words = core.replace(" ", ""), skeleton(core), core.split()
        letters: Counter[int] = Counter()
        for s in {tight[i : i + 2] for i in range(len(tight) - 1)}:
            letters.update(self.grams.get(s, ()))
        sounds: Counter[int] = Counter()
        for s in {bones[i : i + 2] + "_" for i in range(len(bones) - 1)}:
            sounds.update(self.grams.get(s, ()))
        best = (99, -1)
        short = range(len(self.entries)) if len(tight) < 6 else ()  # so few letters that two edits may leave no pair
        for k in sorted(letters.keys() | sounds.keys() | set(short)):
            e = self.entries[k]
            # two edits spoil at most six pairs of letters, one edit of the skeleton three
            near = letters[k] + 6 >= len(set(zip(e.tight, e.tight[1:], strict=False)))
            heard = sounds[k] + 3 >= len(set(zip(e.bones, e.bones[1:], strict=False)))
            if (not near and not heard) or abs(len(e.tight) - len(tight)) > 2 + most:
                continue
            c = word_cost(tight, e.tight, most)
            if c and len(words) + len(e.words) > 2:
                c = min(c, set_cost(words, e.words, most))
            if c < best[0] and c <= most and 1 - c / len(e.tight) >= LEAST:
                best = c, k
        return best

    def shortened(self, text: str) -> int | None:
        """The only entry whose words a text of the same number of words gives in full or abbreviated."""
        if "." not in text and "º" not in text:
            return None
        parts = re.findall(r"[a-z]+(?:\.[a-z]+)?\.?", text)
        hits = []
        for k, e in enumerate(self.entries):
            whole = e.form.split()
            if len(whole) == len(parts) and all(_abbreviates(p, w) for p, w in zip(parts, whole, strict=True)):
                hits.append(k)
        return hits[0] if len(hits) == 1 else None

    def find(self, value: str | None) -> tuple[str, int, int, int]:
        """Of a value: its form, the first id under the name it means or -1, what tells them apart (0 if nothing), and the id."""
        if value is None or not value.strip() or not_a_name(value) or not plain(value):
            return "", -1, 0, 0
        text, where = self.cut_jurisdiction(plain(value))
        cost, k = 0, self.embedded(text)
        if k is None:
            k = next((s for c in [text, *self.cores(text)] if (s := self.shortened(c)) is not None), None)
        if k is None:
            options = []
            for i, core in enumerate(self.cores(text)):
                k = self.embedded(core)
                cost, k = (0, k) if k is not None else self.nearest(core)
                options.append((cost, i, k))
            cost, _, k = min(options)
        if k < 0:
            return text, -1, 0, 0
        ids = self.entries[k].ids
        return text, ids[0][0], cost, next((i for i, w in ids if w == where), ids[0][0])

    def match(self, value: str | None) -> int:
        """The id of the entry that a value means by itself, or 0."""
        return self.find(value)[3]


def map_values(df: DataFrame, domain: str, value: str, gazetteers: Mapping[str, Gazetteer], out: str = "ref_id", cut=lambda df: df, own_ratio: float = OWN_RATIO, prior: int = PRIOR) -> DataFrame:
    """``df`` with ``out``: the id of the entry of the row's domain that ``value`` means, or 0.

    Null, blank and nameless values, unknown domains and values without a similar entry have 0; a tie between entries
    goes to the first name in alphabetical order, and of one name in several jurisdictions without one being given,
    the lowest id. A form that is not an entry's but similar to it is a name of its own, and has 0, if it occurs at
    least ``own_ratio`` times as often as the entry and ``prior`` more; so has what is nearer to such a form, or as near
    and the form is the more frequent one. Each distinct value is matched once; the lists are broadcast, they are
    reference tables of bounded size. ``cut`` may checkpoint the distinct values, which are used several times.
    """
    if sum(len(g.entries) for g in gazetteers.values()) > 1_000_000:
        raise ValueError("the reference list is too long to hold in every task")
    shared = share(df.sparkSession, dict(gazetteers))
    distinct = df.select(F.col(domain).cast("string").alias("_dom"), F.col(value).cast("string").alias("_val")).where(F.col("_val").isNotNull()).groupBy("_dom", "_val").agg(F.count("*").alias("_n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = shared_value(shared)
        for b in batches:
            kinds, values = b.column(0).to_pylist(), b.column(1).to_pylist()
            found = [lists[k].find(v) if k in lists else ("", -1, 0, 0) for k, v in zip(kinds, values, strict=True)]
            form, entry, cost, ids = ([f[i] for f in found] for i in range(4))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(form, pa.string()), pa.array(entry, pa.int64()), pa.array(cost, pa.int32()), pa.array(ids, pa.int64())], names=["_dom", "_val", "_n", "_form", "_entry", "_cost", "_id"]
            )

    met = cut(distinct.mapInArrow(run, "_dom string, _val string, _n bigint, _form string, _entry bigint, _cost int, _id bigint").where(F.col("_entry") >= 0))
    seen = met.where(F.col("_cost") == 0).groupBy("_dom", "_entry").agg(F.sum("_n").alias("_seen"))
    forms = met.where(F.col("_cost") > 0).groupBy("_dom", "_entry", "_form").agg(F.sum("_n").alias("_times"), F.min("_cost").alias("_cost"))
    forms = forms.join(seen, ["_dom", "_entry"], "left").withColumn("_seen", F.coalesce("_seen", F.lit(0)))
    forms = forms.withColumn("_own", F.col("_times") >= F.lit(own_ratio) * (F.col("_seen") + F.lit(prior)))
    own = forms.where("_own").select("_dom", "_entry", F.col("_form").alias("_other"), F.col("_times").alias("_often"))
    off = F.levenshtein("_form", "_other")
    lost = forms.where(~F.col("_own")).join(own, ["_dom", "_entry"]).where((off < F.col("_cost")) | ((off == F.col("_cost")) & (F.col("_often") > F.col("_seen"))))
    refused = forms.where("_own").select("_dom", "_entry", "_form").unionByName(lost.select("_dom", "_entry", "_form")).distinct()
    kept = met.join(refused, ["_dom", "_entry", "_form"], "left_anti").select("_dom", "_val", "_id")
    rows = df.select(*(F.col(f"`{c}`") for c in df.columns if c != out))
    on = (F.col(f"l.`{domain}`").cast("string") == F.col("r._dom")) & (F.col(f"l.`{value}`").cast("string") == F.col("r._val"))
    return rows.alias("l").join(kept.alias("r"), on, "left").select("l.*", F.coalesce("r._id", F.lit(0)).cast("bigint").alias(out))
