"""Vocabulary and folding of personal names, shared by the splitters and the linkers."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable


def remember(f: Callable, most: int = 200_000) -> Callable:
    """f with a memory of its results; unlike functools.lru_cache it can be sent to executors by value."""
    known: dict = {}

    def with_memory(x):
        got = known.get(x)
        if got is None:
            got = f(x)
            if len(known) < most:
                known[x] = got
        return got

    return with_memory


# Spanish given names of the early modern period.
GIVEN = """agustín alonso álvaro ambrosio ana andrés antón antonio baltasar bartolomé beatriz benito bernardo blas
brígida catalina cecilia clara constanza cristóbal diego domingo elvira esteban felipe fernando francisca francisco
gaspar gonzalo gregorio hernando hilario ignacio inés isabel jacinto jerónimo josé juan juana lázaro leonor lope
lorenzo lucas lucía luis luisa magdalena manuel marcos margarita maría marina martín mateo mayor melchor mencía
miguel nicolás olalla pablo pedro quiteria rafael ramón rodrigo salvador sancho sebastián simón teresa tomás
ulpiano úrsula vicente violante zoilo""".split()

# Familiar and old forms and the name they stand for.
FAMILIAR = {
    "alfonso": "alonso", "antón": "antonio", "toño": "antonio", "bartolo": "bartolomé", "beatrice": "beatriz",
    "brígita": "brígida", "brisa": "brígida", "cata": "catalina", "catuja": "catalina", "colás": "nicolás",
    "cristobo": "cristóbal", "tobal": "cristóbal", "curro": "francisco", "paco": "francisco", "pancho": "francisco",
    "paca": "francisca", "curra": "francisca", "pacha": "francisca", "estevan": "esteban", "hernando": "fernando",
    "hernán": "fernando", "ferrán": "fernando", "fernán": "fernando", "gonzalo": "gonzalo", "jeromo": "jerónimo",
    "jerome": "jerónimo", "juancho": "juan", "lianor": "leonor", "machín": "martín", "marica": "maría",
    "marijuán": "maría", "mari": "maría", "mateos": "mateo", "minguez": "domingo", "mingo": "domingo",
    "pero": "pedro", "perucho": "pedro", "quita": "quiteria", "ruy": "rodrigo", "rui": "rodrigo", "bastián": "sebastián",
    "tere": "teresa", "chente": "vicente", "vicent": "vicente", "ylario": "hilario", "ysabel": "isabel",
    "isabela": "isabel", "belica": "isabel", "eulalia": "olalla", "olaya": "olalla", "jacome": "diego",
    "laurencio": "lorenzo", "elvirica": "elvira", "zoílo": "zoilo", "balta": "baltasar", "ulpio": "ulpiano",
    "llorente": "lorenzo", "lencho": "lorenzo", "joana": "juana", "joan": "juan", "johan": "juan",
}

PARTICLES = frozenset("de del la las los el y e da do dos".split())
HONORIFICS = frozenset("""don doña d dn dña licenciado lic bachiller br bachillera maese maestro fray sor doctor dr dicho dicha
jurado capitán señor señora sr sra mosén micer""".split())
GENERATION = frozenset("mozo moza viejo vieja menor mayor".split())


def fold(s: str) -> str:
    """Lower case without accents; ñ and ç become n and c."""
    return "".join(c for c in unicodedata.normalize("NFD", s.lower()) if not unicodedata.combining(c))


GIVEN_FOLDED = frozenset(map(fold, GIVEN))
FAMILIAR_FOLDED = {fold(k): fold(v) for k, v in FAMILIAR.items()}
WORD = re.compile(r"[^\W\d_](?:[^\W_]|[.ºª'’])*", re.UNICODE)


def close(a: str, b: str, most: int) -> bool:
    """Whether the edit distance (swaps of neighbours count one) is at most ``most``."""
    return distance(a, b, most) <= most


def distance(a: str, b: str, most: int = 99) -> int:
    """Optimal string alignment distance, or ``most + 1`` if it is more. Bit-parallel (Hyyrö)."""
    if a == b:
        return 0
    m, n = len(a), len(b)
    if abs(m - n) > most:
        return most + 1
    if not m or not n:
        return max(m, n)
    at: dict[str, int] = {}
    bit = 1
    for c in a:
        at[c] = at.get(c, 0) | bit
        bit <<= 1
    full, top = bit - 1, bit >> 1
    vp, vn, d0, old, score = full, 0, 0, 0, m
    for k, c in enumerate(b, 1):
        pm = at.get(c, 0)
        swap = (((~d0) & pm) << 1) & old
        d0 = ((((pm & vp) + vp) ^ vp) | pm | vn | swap) & full
        hp = vn | (full & ~(d0 | vp))
        hn = d0 & vp
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        if score - (n - k) > most:
            return most + 1
        hp = ((hp << 1) | 1) & full
        hn = (hn << 1) & full
        vp = hn | (full & ~(d0 | hp))
        vn = hp & d0
        old = pm
    return score if score <= most else most + 1


@remember
def is_given(token: str) -> bool:
    """Whether a word can be a given name: listed, familiar, diminutive, abbreviated or misspelt by one letter."""
    if any(c in token for c in ".ºª"):
        return True
    t = fold(token)
    if t in GIVEN_FOLDED or t in FAMILIAR_FOLDED:
        return True
    for end in ("illo", "illa", "ico", "ica", "ito", "ita"):
        if t.endswith(end) and any(t[: -len(end)] in (g, g[:-1]) for g in GIVEN_FOLDED):
            return True
    return len(t) >= 4 and any(abs(len(g) - len(t)) < 2 and close(t, g, 1) for g in GIVEN_FOLDED)


def is_company(text: str) -> bool:
    """Whether a text begins as the name of a company."""
    w = [fold(x).rstrip(".ºª") for x in WORD.findall(text)[:3]]
    while w and w[0] in ("la", "dicha", "el"):
        w.pop(0)
    return bool(w) and (w[0] in ("cia", "comp", "compa", "comp.") or (len(w[0]) > 5 and close(w[0], "compania", 2)))
