"""Text functions as Columns: cleaning of scanned text, labels, names and codes. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def rx(pattern: str, flags: str = "") -> str:
    """A pattern with Unicode classes and \\n as the only line end; flags are i, m, s."""
    return f"(?Ud{'u' if 'i' in flags else ''}{flags})" + pattern


def sub(c: Column, pattern: str, to: str = "", flags: str = "") -> Column:
    return F.regexp_replace(c, F.lit(rx(pattern, flags)), F.lit(to))


def let(c: Column, f: Callable[[Column], Column]) -> Column:
    """f(c) with c evaluated once, however often f uses it."""
    return F.element_at(F.transform(F.array(c), f), 1)


#: What \\s stands for with Unicode classes.
WHITE = "".join(map(chr, (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(c, F.lit(WHITE))


def blank(c: Column) -> Column:
    """Whether a text is null or only white space."""
    return F.length(strip(F.coalesce(c, F.lit("")))) == 0


def lines(c: Column) -> Column:
    """Lines cut at \\n, stripped, without blank ones."""
    return F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != "")


def replace_each(c: Column, pattern: str, to: Callable[[Column], Column], flags: str = "") -> Column:
    """Every match of a pattern (which never matches nothing) replaced by a function of it, without a UDF."""
    p = rx(pattern, flags)

    def glue(x: Column, found: Column) -> Column:
        def rest(between: Column) -> Column:
            tail = F.zip_with(found, F.slice(between, F.lit(2), F.size(found)), lambda m, b: F.concat(to(m), F.coalesce(b, F.lit(""))))
            return F.concat(F.element_at(between, 1), F.array_join(tail, ""))

        return let(F.split(x, p, -1), rest)

    def whole(x: Column) -> Column:
        return let(F.regexp_extract_all(x, F.lit(p), F.lit(0)), lambda found: F.when(F.size(found) == 0, x).otherwise(glue(x, found)))

    return let(c, whole)


# Marks that the recogniser leaves in its output, in the order in which they are taken out.
GROUNDING = [
    (r"^\s*<\|ref\|>.*?<\|/det\|>\s*$", "", "m"), (r"<\|/?(?:ref|det)\|>", "", ""), (r"\[\[[\d,\s]*\]?\]?", "", ""), (r"\[\[[^\]]*$", "", "m"), (r"(?:\w?\)[\d)]{4,})", "", ""),
    (r"^#{1,3}\s+", "", "m"), (r"\*\*(.+?)\*\*", "$1", ""), (r"\btext\w?\b", "", "i"), (r"(?:^|\s)[\-–—,;:*]{1,3}(?:\s|$)", " ", ""),
]
# Fixed value: a sentence said again at once.
REPEATED = r"(\b.{4,80}?[.!?])\s*(?:\1\s*){1,}"
# The labels of a record and how many slips each may have.
LABELS = {"Escribanía": 4, "Oficio": 2, "Folio": 2, "Fecha": 2, "Signatura": 3, "Asunto": 2, "Observaciones": 4}
LABEL_CANDIDATE = r"(?:(?:^|[.—–\-]\s*))[A-ZÁÉÍÓÚa-záéíóú][\w\s:]{0,18}?\s*[;:]"
OFFICE_CANDIDATE = r"[.—–\-]\s*[EeFfIi][A-Za-záéíóúñ:.*'\-]{3,14}(?=[;:.]\s*[A-ZÁÉÍÓÚ])"
RUNNING_HEADER = "CATALOGO DE LOS FONDOS AMERICANOS"
ACCENTED, PLAIN = "áàâäãéèêëíìîïóòôöõúùûüñçÁÀÂÄÃÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇ", "aaaaaeeeeiiiiooooouuuuncAAAAAEEEEIIIIOOOOOUUUUNC"


def strip_grounding(c: Column) -> Column:
    """Without tags, coordinates, decoding debris, headings, bold marks, stray marks and repeated sentences."""
    for pattern, to, flags in GROUNDING:
        c = sub(c, pattern, to, flags)
    return drop_repeated_sentences(c)


def drop_repeated_sentences(c: Column) -> Column:
    """A sentence said again at once is said once.

    The pattern tries every length at every place, so it runs only on texts in which a piece between full stops ends
    the piece before it or is shorter than the pattern's least; in no other text can it match.
    """

    def again(parts: Column) -> Column:
        short = lambda i: (F.length(F.get(parts, i)) < 4) & (i < F.size(parts) - 1)
        ends = lambda i: F.endswith(F.get(parts, i - 1), F.get(parts, i)) & (F.get(parts, i) != "")
        return (F.size(parts) > 2) & F.exists(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: short(i) | ends(i))

    return let(c, lambda x: F.when(let(F.split(x, rx(r"[.!?]\s*")), again), sub(x, REPEATED, "$1 ")).otherwise(x))


def dehyphen(c: Column) -> Column:
    """Words divided at line ends made whole."""
    return sub(c, r"(\w)-\s*\n\s*(\w)", "$1$2")


def dehyphen_inline(c: Column) -> Column:
    return sub(c, r"(\w)- ?(\w)", "$1$2")


def join_lines(c: Column) -> Column:
    """One line: lines stripped, blank ones dropped."""
    return F.array_join(lines(c), " ")


def fold(c: Column) -> Column:
    return F.translate(c, ACCENTED, PLAIN)


def normalize_office(c: Column) -> Column:
    """Garbled forms of the label of the notary's office, found by what stands around them."""

    def to(m: Column) -> Column:
        def name(head: Column) -> Column:
            word = F.substr(m, F.length(head) + 1)
            near = F.levenshtein(F.lower(fold(sub(word, r"[\s:\-–—.*']+"))), F.lit("escribania"))
            return F.when(near <= 5, F.concat(head, F.lit("Escribanía"))).otherwise(m)

        return let(F.regexp_extract(m, rx(r"^[.—–\-]\s*"), 0), name)

    return replace_each(c, OFFICE_CANDIDATE, to)


def normalize_labels(c: Column) -> Column:
    """Labels with slips get their right form; of several within reach the first in the list wins."""

    def to(m: Column) -> Column:
        def name(head: Column) -> Column:
            def pick(word: Column) -> Column:
                out = m
                for label, most in reversed(LABELS.items()):
                    bare = label.replace("í", "i").lower()
                    out = F.when(F.levenshtein(word, F.lit(bare)) <= most, F.concat(head, F.lit(f"{label}:"))).otherwise(out)
                return out

            return let(F.lower(sub(F.substr(m, F.length(head) + 1), r"[\s:;\-–—.]+")), pick)

        return let(F.regexp_extract(m, rx(r"^(?:[.—–\-]\s*)?"), 0), name)

    c = replace_each(c, LABEL_CANDIDATE, to)
    for label in LABELS:
        c = sub(c, rf"({label}:)\s+[a-záéíóú]{{1,5}}:", "$1")
    return c


def clean_ocr(c: Column) -> Column:
    """The whole cleaning of a box's text; null and blank become ''."""
    t = F.coalesce(c, F.lit(""))
    for step in (strip_grounding, dehyphen, join_lines, dehyphen_inline, normalize_office, normalize_labels):
        t = step(t)
    return strip(sub(t, r"\n{3,}", "\n\n"))


def header_key(c: Column) -> Column:
    """Letters and digits only, without accents, lower case."""
    return F.lower(F.regexp_replace(fold(c), "[^a-zA-Z0-9]", ""))


def is_running_header(c: Column, header: str = RUNNING_HEADER, most: int = 4) -> Column:
    """Whether a line holds the running header with at most ``most`` slips, anywhere in it."""
    target = "".join(x for x in header.lower() if x.isalnum())
    n = len(target)

    def near(key: Column) -> Column:
        windows = F.sequence(F.lit(1), F.greatest(F.length(key) - n + 1, F.lit(1)))
        hit = F.exists(windows, lambda i: F.levenshtein(F.substr(key, i, F.lit(n)), F.lit(target), most) >= 0)
        return F.when(F.length(key) < n - most, F.lit(False)).otherwise(F.contains(key, F.lit(target)) | hit)

    return let(header_key(c), near)


def drop_running_headers(c: Column, header: str = RUNNING_HEADER) -> Column:
    return F.array_join(F.filter(F.split(c, "\n"), lambda x: ~is_running_header(x, header)), "\n")


def drop_repeated_lines(c: Column) -> Column:
    """A line of over 20 characters equal to the last one that is not blank is dropped; blank lines do not count."""
    zero = F.struct(F.lit("").alias("last"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        s = strip(x)
        again = (s == acc["last"]) & (F.length(s) > 20)
        return F.struct(F.when(s == "", acc["last"]).otherwise(s).alias("last"), F.when(again, acc["out"]).otherwise(F.array_append(acc["out"], x)).alias("out"))

    return F.array_join(F.aggregate(F.split(c, "\n"), zero, step, lambda acc: acc["out"]), "\n")


def clean_page(c: Column) -> Column:
    return drop_repeated_lines(drop_running_headers(dehyphen(strip_grounding(c))))


def is_record_start(c: Column, target: str = "librodelano", most: int = 3, words: int = 10) -> Column:
    """Whether two to five of the first words together are about "Libro del año"; notes never start a record."""
    tokens = F.transform(F.slice(F.filter(F.split(strip(c), rx(r"\s+")), lambda x: x != ""), 1, words), lambda w: F.regexp_replace(F.lower(w), "[^a-z0-9]", ""))

    def near(t: Column) -> Column:
        sizes = F.filter(F.array(*map(F.lit, (2, 3, 4, 5))), lambda w: w <= F.size(t))
        combos = F.flatten(F.transform(sizes, lambda w: F.transform(F.sequence(F.lit(0), F.size(t) - w), lambda i: F.array_join(F.slice(t, i + 1, w), ""))))
        return F.exists(combos, lambda v: F.levenshtein(v, F.lit(target), most) >= 0)

    return let(tokens, near) & ~c.rlike(rx(r"^\s*Nota", "i"))


def clean_value(c: Column) -> Column:
    """Without separators at the ends, white space made one blank. Single blanks, nearly all there is, are no match."""
    return sub(F.btrim(c, F.lit(WHITE + ".—–-,;")), r" \s+|[^\S ]\s*", " ")


def safe_name(c: Column) -> Column:
    """A name for files."""
    return F.regexp_replace(c, "[^A-Za-z0-9._-]+", "_")


def split_list(c: Column) -> Column:
    """Values cut at semicolons, stripped, blanks dropped; null gives an empty list."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ";"), strip), lambda x: x != "")


def literal_list(c: Column) -> Column:
    """A list written as "['a', 'b']" or JSON as values joined by "; ", without blanks and "..."; other texts stay."""
    items = F.from_json(c, "array<string>", {"allowSingleQuotes": "true"})
    kept = F.filter(F.transform(items, strip), lambda x: (x != "") & (x != "..."))
    return F.when(blank(c), F.lit("")).when(strip(c).startswith("[") & items.isNotNull(), F.array_join(kept, "; ")).otherwise(strip(c))


def roman(c: Column) -> Column:
    """The number that Roman digits stand for; null if there is any other character."""
    value = F.create_map(*[F.lit(x) for kv in {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}.items() for x in kv])
    digits = F.transform(F.split(F.upper(c), ""), lambda d: F.try_element_at(value, d))
    zero = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("last"))
    total = F.aggregate(
        F.reverse(digits), zero, lambda a, d: F.struct((a["sum"] + F.when(d < a["last"], -d).otherwise(d)).alias("sum"), d.alias("last")), lambda a: a["sum"]
    )
    return F.when(F.upper(c).rlike("^[IVXLCDM]+$"), total)


def volume_code(c: Column) -> Column:
    """Two digits of a volume: those at the end of its name, else its Roman number; 00 if there is neither."""
    digits = F.regexp_extract(c, r"(\d+)$", 1)
    numeral = roman(F.substring_index(F.regexp_replace(c, " ", "_"), "_", -1))
    number = F.coalesce(F.nullif(digits, F.lit("")).try_cast("int"), numeral, F.lit(0))
    return F.format_string("%02d", number)


def record_code(number: Column, position: Column) -> Column:
    """At least four digits of a record: its number, else its place in its volume."""
    return F.format_string("%04d", F.when(number >= 0, number).otherwise(position).cast("long"))
