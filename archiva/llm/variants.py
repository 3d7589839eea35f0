"""Variant spellings of one person or company, linked.

Noisy channel: spellings are reduced to signatures (given names, surnames, generation), frequent signatures are
candidate canonical forms, and every rarer one goes to the form for which frequency times the likelihood of the
slips between them is highest, if that is likelier than a person of its own. Letters come first: a surname that is a
slip of a far more frequent one is read as that one; then abbreviations, initials, familiar names, turned order,
dropped surnames and generations are weighed by name.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archiva.functions import names
from archiva.functions.names import distance, fold
from archiva.operators.packed import scan
from archiva.session import share, shared_value

#: A surname can be the right form of others from this weight, whatever else is loaded.
MIN_COUNT = 3
#: Surnames are as many as people have; more than this is refused rather than broadcast.
MAX_SURNAMES = 2_000_000

# Titles that stand before a name.
TITLES = names.HONORIFICS | frozenset("ldo lcdo lic licdo dona br bach fr dr da dna dn sr sra el la los las jurado ilustre señor senor muy mag magnifico honrado".split())
# Abbreviations that are no letters of the name in order.
SPECIAL = {"xpobal": "cristobal", "xpoval": "cristobal", "xpo": "cristobal", "jhoan": "juan", "geronimo": "jeronimo", "ieronimo": "jeronimo", "frasquita": "francisca", "frasco": "francisco", "matheo": "mateo", "joaquina": "joaquina", "brixida": "brigida", "baltazar": "baltasar", "ferrando": "fernando"}
DIMINUTIVES = ("illo", "illa", "ico", "ica", "ito", "ita", "uelo", "uela", "ete", "eta", "ín", "in")
#: Given names without those that only stand for another one.
GIVEN = frozenset(g for g in names.GIVEN_FOLDED if names.FAMILIAR_FOLDED.get(g, g) == g)
SOUNDS = [("qu", "c"), ("ll", "y"), ("y", "i"), ("v", "b"), ("ç", "z"), ("z", "s"), ("x", "j"), ("g", "j"), ("h", ""), ("k", "c"), ("1", "l"), ("0", "o"), ("5", "s")]


def skeleton(word: str) -> str:
    """Letters with the spellings of one sound made alike and doubles written once."""
    for a, b in SOUNDS:
        word = word.replace(a, b)
    return re.sub(r"(.)\1+", r"\1", word)


def subsequence(part: str, word: str) -> bool:
    rest = iter(word)
    return all(c in rest for c in part)


@names.remember
def given(token: str) -> tuple[str, ...]:
    """The given names a token may stand for, () if it is none. Several only for initials and abbreviations."""
    raised = "º" in token or "ª" in token
    t = fold(token.replace("º", "o").replace("ª", "a"))
    short = "." in token or raised
    t = t.replace(".", "")
    if not t:
        return ()
    t = SPECIAL.get(t, t)
    if not short:
        if t in names.FAMILIAR_FOLDED:
            return (names.FAMILIAR_FOLDED[t],)
        if t in GIVEN:
            return (t,)
        for end in DIMINUTIVES:
            if t.endswith(end) and len(t) > len(end) + 2:
                stem = t[: -len(end)]
                hits = [g for g in GIVEN if g == stem or (g[:-1] == stem and g[-1] in "aeo") or (g[:-1] == stem.replace("qu", "c").removesuffix("u") and g[-1] in "ao")]
                hits = [g for g in hits if not (end[-1] == "a" and g[-1] == "o") and not (end[-1] == "o" and g[-1] == "a")] or hits
                if len(hits) == 1:
                    return (hits[0],)
        if len(t) > 3:
            bones = skeleton(t)
            hits = [g for g in GIVEN if skeleton(g) == bones] or [g for g in GIVEN if distance(t, g, 1) <= 1]
            if not hits and len(t) > 6:
                hits = [g for g in GIVEN if distance(t, g, 2) <= 2]
            hits = hits or [v for k, v in names.FAMILIAR_FOLDED.items() if len(k) > 3 and distance(t, k, 1) <= 1]
            if len(set(hits)) >= 1:
                same = [g for g in hits if g[-1] == t[-1]] or hits
                return (min(same),)
        return ()
    if len(t) == 1:
        return tuple(sorted(g for g in GIVEN if g[0] == t or (t == "y" and g[0] == "i") or (t == "x" and g == "cristobal")))
    u = t.replace("y", "i")
    hits = [g for g in GIVEN if g[0] == u[0] and subsequence(u, g)]
    if not hits and t[-1] in "oa":
        hits = [g for g in GIVEN if g[0] == u[0] and subsequence(u[:-1], g) and (g[-1] != "a" if t[-1] == "o" else g[-1] != "o")]
    if t[-1] in "oae" and any(g[-1] == t[-1] for g in hits):
        hits = [g for g in hits if g[-1] == t[-1]]
    elif t[-1] not in "oae" and any(g[-1] == t[-1] for g in hits):
        hits = [g for g in hits if g[-1] == t[-1]]
    return tuple(sorted(hits))


@dataclass(frozen=True)
class Name:
    """A person (given names as tuples of possibilities) or a company (none)."""

    kind: str
    givens: tuple[tuple[str, ...], ...]
    surnames: tuple[str, ...]
    generation: str

    def key(self) -> str:
        return "\t".join([self.kind, "|".join("/".join(g) for g in self.givens), " ".join(self.surnames), self.generation])

    @classmethod
    def of(cls, key: str) -> Name:
        kind, g, s, gen = key.split("\t")
        return cls(kind, tuple(tuple(x.split("/")) for x in g.split("|")) if g else (), tuple(s.split()), gen)


def parse(text: str) -> Name | None:
    """The parts of a name; None where there is no surname to go by."""
    t = re.sub(r"\(\s*\?\s*\)", " ", text)
    t = re.sub(r"[\"“«]\s*[^\"”»]*[\"”»]", " ", t)
    words = re.findall(r"[^\W_](?:[^\W_]|[.ºª'’])*|[&,\-]", t)
    folded = [fold(w.replace("º", "").replace("ª", "")).rstrip(".") for w in words]
    company = names.is_company(re.sub(r"^\s*(?:la|dicha)\s+", "", t, flags=re.I)) or "&" in words or (bool(folded) and len(folded[-1]) > 5 and distance(folded[-1], "compania", 2) <= 2)
    if company:
        s = [f for w, f in zip(words, folded, strict=True) if f not in names.PARTICLES and w not in "&,-" and f not in ("cia", "comp", "dicha") and not (len(f) > 5 and distance(f, "compania", 2) <= 2)]
        return Name("c", (), tuple(s), "") if s else None
    if "," in words:
        k = words.index(",")
        words = words[k + 1 :] + words[:k]
        folded = folded[k + 1 :] + folded[:k]
    gen = ""
    content: list[tuple[str, str]] = []
    for i, (w, f) in enumerate(zip(words, folded, strict=True)):
        if w in "&,-":
            continue
        if f in names.GENERATION and i and folded[i - 1] in ("el", "la", "l"):
            gen = {"moza": "mozo", "vieja": "viejo"}.get(f, f)
            continue
        if f in names.PARTICLES and "." not in w:
            continue
        if not content and f in TITLES and f not in ("d", "da") and not (f in GIVEN):
            continue
        content.append((w, f))
    # "D." before a given name is a title
    if len(content) > 2 and content[0][1] in ("d", "da") and "." in content[0][0] and given(content[1][0]):
        content = content[1:]
    if not content:
        return None
    if not given(content[0][0]):
        # turned order without a comma: surnames first, given names last
        k = len(content)
        while k > 1 and given(content[k - 1][0]) and len(content) - k < 2:
            k -= 1
        if k < len(content):
            content = content[k:] + content[:k]
    givens: list[tuple[str, ...]] = []
    while content and len(givens) < 3 and (g := given(content[0][0])) and (len(content) > 1 or not givens):
        givens.append(g)
        content = content[1:]
    surnames = tuple(re.sub(r"[^a-z0-9]", "", f) for _, f in content if f not in TITLES)
    surnames = tuple(s for s in surnames if len(s) > 1)
    if not surnames:
        return None
    return Name("p", tuple(givens), surnames, gen)


@dataclass
class Surnames:
    """Frequent surnames and what their slips are read as."""

    counts: dict[str, int]
    deletes: dict[str, list[str]] = field(default_factory=dict)
    bones: dict[str, list[str]] = field(default_factory=dict)
    known: dict[str, str] = field(default_factory=dict)

    @classmethod
    def build(cls, counts: Mapping[str, int]) -> Surnames:
        s = cls(dict(counts))
        d, b = defaultdict(list), defaultdict(list)
        for w in s.counts:
            b[skeleton(w)].append(w)
            for x in {w[:k] + w[k + 1 :] for k in range(len(w))} | {w}:
                d[x].append(w)
        s.deletes, s.bones = dict(d), dict(b)
        return s

    def read(self, word: str) -> str:
        """The surname a word must be: itself, or the far more frequent one that it is a slip of."""
        got = self.known.get(word)
        if got is None:
            got, seen = word, {word}
            while True:
                up = self._up(got)
                if up in seen:
                    break
                seen.add(up)
                got = up
            if len(self.known) < 500_000:
                self.known[word] = got
        return got

    def _up(self, word: str) -> str:
        n = self.counts.get(word, 0)
        near = {w: 0 for w in self.bones.get(skeleton(word), ())}
        for x in {word[:k] + word[k + 1 :] for k in range(len(word))} | {word}:
            for w in self.deletes.get(x, ()):
                near.setdefault(w, 1)
        best, most = word, 0.0
        for w, sounds in near.items():
            if w == word or len(word) < 5:
                continue
            d = distance(word, w, 2)
            if d > 2 and sounds:
                continue
            # a slip of the pen is far rarer than the right spelling
            factor = 4 if sounds == 0 else 5 if d <= 1 else 12
            score = self.counts[w] / factor / (1 if sounds == 0 else 2**d)
            if self.counts[w] >= factor * max(1, n) and score > most:
                best, most = w, score
        return best


def likelihood(v: Name, c: Name) -> float:
    """How likely a person or company written c is written v; 0 if they must be different."""
    if v.kind != c.kind:
        return 0.0
    p = 1.0
    if v.kind == "c" and len(v.surnames) != len(c.surnames):
        return 0.0
    if len(v.surnames) > len(c.surnames):
        return 0.0
    for a, b in zip(v.surnames, c.surnames, strict=False):
        if a != b:
            d = distance(a, b, 2)
            if d > 2 or min(len(a), len(b)) < 6:
                return 0.0
            p *= 0.05**d
    if len(v.surnames) < len(c.surnames):
        p *= 0.02
    if v.kind == "c":
        return p
    if len(v.givens) != len(c.givens) or v.generation != c.generation:
        return 0.0  # whose given name or generation is missing may be a relative
    for a, b in zip(v.givens, c.givens, strict=True):
        both = set(a) & set(b)
        if not both:
            return 0.0
        if a != b:
            p *= 0.05 if len(a) > 1 else 0.01
    return p


def rank(key: str, name: Name, n: int) -> tuple:
    """Forms go to forms of higher rank only, so links never run in a circle."""
    sure = all(len(g) == 1 for g in name.givens)
    return sure, len(name.surnames), n, [-ord(c) for c in key]


def attach(forms: Iterable[tuple[str, int]]) -> Iterator[tuple[str, str, float, int, bool, bool]]:
    """For each signature of one block, with its frequency, the two forms of the highest posterior: signature, form,
    posterior, frequency, whether it lacks a surname of the form, and whether it has initials or abbreviations.

    Equal posteriors go to the first key in code point order.
    """
    parsed = [(k, n, name, rank(k, name, n)) for k, n in forms for name in [Name.of(k)]]
    for k, n, v, mine in parsed:
        scores = [(p, k2, c) for k2, n2, c, other in parsed if other > mine and (p := likelihood(v, c) * n2) > 0]
        for p, k2, c in sorted(scores, key=lambda x: (-x[0], x[1]))[:2]:
            yield k, k2, p, n, len(v.surnames) < len(c.surnames), any(len(g) > 1 for g in v.givens)


def surname_counts(parsed: DataFrame) -> DataFrame:
    """surname, n: how often each word stands as a surname, by weight."""
    word = F.explode(F.split(F.split("_key", "\t").getItem(2), " "))
    return parsed.select("_n", word.alias("surname")).groupBy("surname").agg(F.sum("_n").alias("n"))


def _single(column: pa.Array) -> Iterator[tuple[int, Name]]:
    """Row and name of the rows that name exactly one person or company."""
    values, parent = scan(column, "persona")
    if not len(values):
        return
    times = Counter(parent.tolist())
    for i, v in zip(parent.tolist(), values.to_pylist(), strict=True):
        if times[i] == 1 and (n := parse(v)) is not None:
            yield i, n


def parsed_names(nodes: DataFrame, key: str, group: str, name: str, weight: str) -> DataFrame:
    """_id, _group, _key, _n of the rows that name exactly one person or company; _key has the parts of the name as typed."""
    picked = nodes.select(F.col(key).alias("_id"), F.col(group).alias("_group"), F.col(name).cast("string").alias("_v"), F.coalesce(F.col(weight).cast("bigint"), F.lit(1)).alias("_n"))
    types = {f.name: f.dataType.simpleString() for f in picked.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = list(_single(b.column(2)))
            t = b.take(pa.array([i for i, _ in found], pa.int64()))
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1), pa.array([n.key() for _, n in found], pa.string()), t.column(3)], names=["_id", "_group", "_key", "_n"])

    return picked.mapInArrow(run, f"_id {types['_id']}, _group {types['_group']}, _key string, _n bigint")


def signatures(parsed: DataFrame, surnames: Surnames) -> DataFrame:
    """``parsed`` with every surname read as the one it must be."""
    shared = share(parsed.sparkSession, surnames)
    types = {f.name: f.dataType.simpleString() for f in parsed.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared_value(shared)
        for b in batches:
            keys = []
            for k in b.column(2).to_pylist():
                kind, givens, words, generation = k.split("\t")
                keys.append("\t".join([kind, givens, " ".join(map(known.read, words.split())), generation]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys, pa.string()), b.column(3)], names=b.schema.names)

    return parsed.mapInArrow(run, f"_id {types['_id']}, _group {types['_group']}, _key string, _n bigint")


def link(signed: DataFrame, cut=lambda df: df) -> DataFrame:
    """_group, _key, _root: the canonical form of each signature of each group that has another one.

    Signatures meet in blocks of one group, surname and first given name (all it may stand for); a block holds
    different spellings only, however often each occurs. What a signature is attached to may itself be attached; roots
    are followed, twice as far each round, until none changes.
    """
    forms = signed.groupBy("_group", "_key").agg(F.sum("_n").alias("_n"))
    parts = F.split("_key", "\t")
    first = F.split(F.split(parts.getItem(1), r"\|").getItem(0), "/")
    blocks = forms.withColumn("_surname", F.explode(F.array_distinct(F.split(parts.getItem(2), " ")))).withColumn("_given", F.explode(first))
    gt = signed.schema["_group"].dataType.simpleString()
    by = ["_group", "_surname", "_given"]

    def run(table: pa.Table) -> pa.Table:
        keys, n = table.column("_key").to_pylist(), table.column("_n").to_pylist()
        found = list(attach(sorted(zip(keys, n, strict=True))))
        groups = table.column("_group").combine_chunks()
        first = groups.take(pa.array([0] * len(found), pa.int64())) if found else groups.slice(0, 0)
        cols = list(zip(*found, strict=True)) or [()] * 6
        kinds = [pa.string(), pa.string(), pa.float64(), pa.int64(), pa.bool_(), pa.bool_()]
        return pa.table([first, *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=["_group", "_key", "_to", "_p", "_n", "_short", "_loose"])

    # what occurs in one form only links nothing
    size = blocks.groupBy(*by).agg(F.count("*").alias("_size")).where(F.col("_size") > 1)
    same = F.col("l._group").eqNullSafe(F.col("r._group")) & (F.col("l._surname") == F.col("r._surname")) & (F.col("l._given") == F.col("r._given"))
    dense = blocks.alias("l").join(size.alias("r"), same, "left_semi")
    found = dense.groupBy(*by).applyInArrow(run, f"_group {gt}, _key string, _to string, _p double, _n bigint, _short boolean, _loose boolean")
    # of several blocks that a signature is in, the best form and the best of the others
    ranked = found.groupBy("_group", "_key").agg(F.array_sort(F.collect_set(F.struct((-F.col("_p")).alias("q"), F.col("_to").alias("to"), F.col("_n").alias("n"), F.col("_short").alias("short"), F.col("_loose").alias("loose")))).alias("c"))
    best, second = F.col("c")[0], F.get(F.col("c"), F.lit(1))
    p, other = -best["q"], F.coalesce(-second["q"], F.lit(0.0))
    # a surname is left out where it is clear who is meant; initials are never a form of their own; else the form must
    # explain a spelling better than a person of that very name would
    accepted = F.when(best["short"], other < 0.5 * p).when(best["loose"], True).otherwise(p >= 0.02 * best["n"])
    to = cut(ranked.where(accepted).select("_group", "_key", best["to"].alias("_root")))
    while True:
        same = F.col("l._group").eqNullSafe(F.col("r._group")) & (F.col("l._root") == F.col("r._key"))
        far = cut(to.alias("l").join(to.alias("r"), same, "left").select("l._group", "l._key", F.coalesce("r._root", "l._root").alias("_root"), F.col("r._root").isNotNull().alias("_moved")))
        to = far.drop("_moved")
        if not far.where("_moved").head(1):
            return to


def linked_nodes(nodes: DataFrame, key: str, group: str, name: str, weight: str, cut=lambda df: df, min_count: int = MIN_COUNT) -> DataFrame:
    """``key``, ``group``, entidad, canonica: the class of each row that names exactly one person or company.

    Rows with several names, or none, are left out; null weights count 1; null groups are a group. ``cut`` may
    checkpoint what is used several times. Surnames of ``min_count`` come to the driver; their number is checked.
    """
    parsed = cut(parsed_names(nodes, key, group, name, weight))
    counts = surname_counts(parsed).where(F.col("n") >= min_count)
    frequent = counts.limit(MAX_SURNAMES + 1).collect()
    if len(frequent) > MAX_SURNAMES:
        raise ValueError("more surnames than every task can hold; link the groups in parts")
    signed = cut(signatures(parsed, Surnames.build({r.surname: r.n for r in frequent})))
    roots = link(signed, cut)
    same = F.col("l._group").eqNullSafe(F.col("r._group")) & (F.col("l._key") == F.col("r._key"))
    root = F.coalesce("r._root", "l._key")
    return signed.alias("l").join(roots.alias("r"), same, "left").select(F.col("l._id").alias(key), F.col("l._group").alias(group), F.xxhash64(root).alias("entidad"), root.alias("canonica"))


def pairs(classes: DataFrame, key: str, group: str) -> DataFrame:
    """All pairs nodo_a < nodo_b of one group and class."""
    same = F.col("l.canonica") == F.col("r.canonica")
    same &= F.col(f"l.{group}").eqNullSafe(F.col(f"r.{group}")) & (F.col(f"l.{key}") < F.col(f"r.{key}"))
    return classes.alias("l").join(classes.alias("r"), same).select(F.col(f"l.{key}").alias("nodo_a"), F.col(f"r.{key}").alias("nodo_b"))
