"""Fields that hold several values: split into one value per row, with position.

The text column arrives as an Arrow string buffer. One pass over its bytes finds quotes, brackets, separators
and item numbers; the parity of the quotes of a row tells which separators count. Child offsets follow from the
separators, a list array from the offsets, and the list is flattened with the ordinals of its parents. Only
pieces with a comma or a conjunction outside quotes, where the meaning decides, are looked at one by one.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archiva.functions import names

# What people write where they have no name to give.
NOT_A_NAME = frozenset(
    ["s/n", "s/d", "n/a", "xxx", "xx", "nada", "roto", "idem", "ídem", "íd", "ilegible", "no consta", "en blanco",
     "véase arriba", "vease arriba", "sin datos", "sin nombre", "desconocido", "nan", "none", "null"]
)

#: Rules for commas and conjunctions outside quotes, by kind of field.
KINDS = ("persona", "nao", "lugar", "lista")

_NUMBER = re.compile(r"^\(?\d{1,3}(?:\)|\.-|\.º|\.)\s*")
_AND = re.compile(r"\s+(y|e)\s+", re.IGNORECASE)


def not_a_name(value: str) -> bool:
    """Whether a value is only a mark for "nothing here": a dash, a question mark, "no consta" and the like."""
    t = value.strip().strip("()[]¿?.").strip().lower()
    return t in NOT_A_NAME or sum(c.isalpha() for c in t) < 2


def _contents(part: str) -> list[str]:
    """The words of a name that are neither particle, title, nickname nor generation."""
    part = re.sub(r"[\"“«].*?[\"”»]", " ", part)
    out = []
    for w in names.WORD.findall(part):
        f = names.fold(w).rstrip(".")
        if f in names.PARTICLES or f in names.HONORIFICS or f in names.GENERATION:
            continue
        out.append(w)
    return out


def _given_only(part: str) -> bool:
    """Whether a part of a name is only given names, as behind the comma of "Zarzatejada, Domingo de"."""
    c = _contents(part)
    if not 1 <= len(c) <= 3:
        return False
    words = names.WORD.findall(part)
    ends_open = names.fold(words[-1]) in ("de", "del")
    if len(c) == 1:
        return not names.is_company(part)
    return all(map(names.is_given, c)) or (ends_open and all(map(names.is_given, c[:1])))


def split_persons(piece: str) -> list[str]:
    """Persons and companies in a piece without any other separator than commas and conjunctions.

    An inverted name ("surname, given"), a company named by two surnames and "surnames, compañía" stay whole.
    """
    parts: list[str] = []
    for p in (x.strip() for x in _outside(piece, ",")):
        c = _contents(p)
        if parts and len(c) == 1 and names.is_company(p):
            parts[-1] += ", " + p
        elif p:
            parts.append(p)
    if len(parts) == 2 and _given_only(parts[1]):
        c = _contents(parts[0])
        if c and not names.is_given(c[0]) and not names.is_company(parts[0]) and "&" not in parts[0]:
            return [", ".join(parts)]
    out: list[str] = []
    for p in parts:
        bits = _AND.split(p)
        now = bits[0]
        for word, nxt in zip(bits[1::2], bits[2::2], strict=True):
            a, b = _contents(now), _contents(nxt)
            joined = (names.is_company(now) and not _AND.search(now)) or (len(a) == 1 and len([w for w in b if not names.is_company(w)]) == 1)
            if word.lower() == "e" and not re.match(r"(?i)h?[iíyý]", nxt):
                joined = True
            if joined:
                now = f"{now} {word} {nxt}"
            else:
                out.append(now)
                now = nxt
        out.append(now)
    return out


def _outside(text: str, mark: str) -> list[str]:
    """Cut at ``mark`` outside double quotes, guillemets and parentheses."""
    out, depth, start, quoted = [], 0, 0, False
    for i, c in enumerate(text):
        if c == '"':
            quoted = not quoted
        elif c in "«(“":
            depth += 1
        elif c in "»)”":
            depth = max(0, depth - 1)
        elif c == mark and not quoted and not depth:
            out.append(text[start:i])
            start = i + 1
    out.append(text[start:])
    return out


def split_ships(piece: str) -> list[str]:
    """Ships divided by commas; ", alias ..." belongs to the name before it, and "y" is part of a name."""
    out: list[str] = []
    for p in (x.strip() for x in _outside(piece, ",")):
        if out and re.match(r"(?i)a[l1i]{0,2}[a-z]{0,2}[ai]?s", p) and names.close(names.fold(p)[:5], "alias", 2):
            out[-1] += ", " + p
        elif p:
            out.append(p)
    return out


def split_places(piece: str, jurisdictions: frozenset[str]) -> list[str]:
    """Places divided by commas; a jurisdiction behind a comma belongs to the place before it."""
    out: list[str] = []
    for p in (x.strip() for x in _outside(piece, ",")):
        f = names.fold(re.sub(r"\s*\(.*?\)\s*$", "", p)).rstrip(". ")
        bare = re.sub(r"^en (la|el|las|los)? ?", "", f)
        if out and (f.startswith(("en la ", "en el ", "en los ", "en las ")) or p.startswith("isla de ") or f in jurisdictions or any(names.close(bare, j, 1) for j in jurisdictions)):
            out[-1] += ", " + p
        elif p:
            out.append(p)
    return out


def _cuts(kind: str, jurisdictions: frozenset[str]) -> Callable[[str], list[str]]:
    if kind == "persona":
        return split_persons
    if kind == "nao":
        return split_ships
    if kind == "lugar":
        return lambda piece: split_places(piece, jurisdictions)
    return lambda piece: [x.strip() for x in _outside(piece, ",")]


def _gather(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """A string array of the byte ranges, copied without a loop."""
    size = end - start
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at])))


def _shift(mask: np.ndarray, n: int) -> np.ndarray:
    """``mask`` moved so that position i tells of position i + n."""
    out = np.zeros_like(mask)
    if n > 0:
        out[:-n] = mask[n:]
    elif n < 0:
        out[-n:] = mask[:n]
    else:
        out[:] = mask
    return out


def scan(column: pa.Array, kind: str = "lista", jurisdictions: frozenset[str] = frozenset()) -> tuple[pa.Array, np.ndarray]:
    """The values of a packed column, flattened, and the ordinal of the row of each.

    Null and empty fields, empty lists and fields without a name give no value. Repeated values stay repeated.
    """
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    none = pa.array([], pa.large_string()), np.zeros(0, np.int64)
    if not n:
        return none
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    size = int(offsets[-1] - offsets[0])
    if not size:
        return none
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    row = np.repeat(np.arange(n), np.diff(offsets))
    first = np.zeros(size, bool)
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    where = np.arange(size)

    def per_row(mask: np.ndarray) -> np.ndarray:
        return np.bincount(row[mask], minlength=n)

    def running(mask: np.ndarray) -> np.ndarray:
        """Count in the row up to and with each byte."""
        c = np.cumsum(mask)
        before = np.concatenate(([0], c))[offsets[:-1]]
        return c - before[row]

    space = np.isin(data, (32, 9, 10, 13))
    solid = ~space
    # the nearest solid byte before and after, in the same row
    last = np.maximum.accumulate(np.where(solid, where, -1))
    prev = np.concatenate(([-1], last[:-1]))
    prev_ok = (prev >= 0) & (row[np.maximum(prev, 0)] == row)
    nxt = np.minimum.accumulate(np.where(solid, where, size)[::-1])[::-1]
    nxt = np.concatenate((nxt[1:], [size]))
    nxt_ok = (nxt < size) & (row[np.minimum(nxt, size - 1)] == row)
    before = np.where(prev_ok, data[np.maximum(prev, 0)], 0)
    after = np.where(nxt_ok, data[np.minimum(nxt, size - 1)], 0)

    two = lambda a, b: (data == a) & _shift(data == b, 1)
    open_g, close_g, dot = two(0xC2, 0xAB), two(0xC2, 0xBB), two(0xC2, 0xB7)
    after_c2 = np.where(nxt_ok & (nxt + 1 < size), data[np.minimum(nxt + 1, size - 1)], 0)
    edge = np.array([0, ord(";"), ord(","), ord("|"), ord("/"), ord("["), ord("]"), ord("·") & 0xFF], np.uint8)
    gap = _shift(space, -1) & (np.isin(np.where(where > 0, data[np.maximum(where - 1, 0)], 10), (9, 10)))
    ahead = _shift(space, 1) & (np.isin(np.where(where + 1 < size, data[np.minimum(where + 1, size - 1)], 10), (9, 10)))
    edge_before = np.isin(before, edge) | gap
    edge_after = np.isin(after, edge) | ahead | ((after == 0xC2) & (after_c2 == 0xB7))

    escaped = _shift(data == 0x5C, -1) & ~first
    double = (data == 0x22) & ~escaped
    single = (data == 0x27) & ~escaped
    number_edge = edge_before | (np.isin(before, (ord(")"), ord("."), ord("-"))))
    single &= number_edge | edge_after
    for q in (double, single):
        q &= (per_row(q) % 2 == 0)[row]  # a quote left open is an ordinary mark
    guill = per_row(open_g) == per_row(close_g)
    inside = (running(double) % 2 == 1) | (running(single) % 2 == 1) | (guill[row] & (running(open_g) > running(close_g)))
    paren = running(data == ord("(")) > running(data == ord(")"))
    paren &= (per_row(data == ord("(")) == per_row(data == ord(")")))[row]
    free = ~inside & ~paren

    lists = np.zeros(n, bool)
    filled = np.diff(offsets) > 0
    head = np.minimum.reduceat(np.where(solid, where, size), offsets[:-1][filled]) if filled.any() else np.zeros(0, int)
    tail = np.maximum.reduceat(np.where(solid, where, -1), offsets[:-1][filled]) if filled.any() else np.zeros(0, int)
    ok = (head < size) & (tail >= 0)
    lists[np.flatnonzero(filled)[ok]] = (data[np.where(ok, head, 0)][ok] == ord("[")) & (data[np.where(ok, tail, 0)][ok] == ord("]"))
    bracket = np.zeros(size, bool)
    numbered = np.zeros(n, bool)
    if ok.any():
        h, t, r = head[ok], tail[ok], np.flatnonzero(filled)[ok]
        bracket[h[lists[r]]] = bracket[t[lists[r]]] = True
        digit_at = np.where((data[h] == ord("(")) & (h + 1 < size), np.minimum(h + 1, size - 1), h)
        numbered[r] = (data[digit_at] >= 48) & (data[digit_at] <= 57)

    comma = (data == ord(",")) & free
    quote_before = np.isin(before, (0x22, 0x27)) | ((before == 0xBB) & (np.where(prev > 0, data[np.maximum(prev - 1, 0)], 0) == 0xC2))
    quote_after = np.isin(after, (0x22, 0x27)) | ((after == 0xC2) & (after_c2 == 0xAB))
    hard_comma = comma & (lists[row] | (quote_before & quote_after) | (quote_before & inside[np.maximum(prev - 1, 0)]) | quote_after)
    if kind == "lista":
        hard_comma = comma
    cut = free & np.isin(data, (ord(";"), ord("|"), ord("/"), 9, 10, 13)) | hard_comma | (dot & free) | (_shift(dot & free, -1) & ~first) | bracket

    # item numbers: up to three digits between an edge and ")" or "."
    digit = (data >= 48) & (data <= 57) & numbered[row] & free | ((data >= 48) & (data <= 57) & numbered[row] & paren)
    starts = digit & ~_shift(digit, -1) & (first | _shift(np.isin(data, (32, 9, 10, ord("("), ord(";"), ord("|"))), -1))
    width = np.where(_shift(digit, 1), np.where(_shift(digit, 2), 3, 2), 1)
    end = np.minimum(where + width, size - 1)
    starts &= np.isin(data[end], (ord(")"), ord("."))) & (row[end] == row)
    at = np.flatnonzero(starts)
    opened = np.where((at > 0) & (data[np.maximum(at - 1, 0)] == ord("(")), at - 1, at)
    fresh = np.zeros(size + 1, bool)  # a piece begins here although no byte is a separator
    fresh[opened] = True

    # pieces between separators
    begin = first | fresh[:-1] | (_shift(cut, -1) & ~first)
    begin &= ~cut
    lo = np.flatnonzero(begin)
    if not len(lo):
        return none
    stop = np.flatnonzero(first | fresh[:-1] | cut)
    stop = np.append(stop, size)
    hi = stop[np.searchsorted(stop, lo, side="right")]
    parent = row[lo]
    nums = fresh[lo]
    # trimmed
    lead = np.where(solid[lo], lo, np.minimum(nxt[lo], hi))
    hi_last = last[hi - 1]
    keep = (lead < hi) & (hi_last >= lead)
    lo, hi, parent, nums = lead[keep], hi_last[keep] + 1, parent[keep], nums[keep]
    if not len(lo):
        return none

    # "...; alias ..." outside quotes is one name
    if kind == "nao" and len(lo) > 1:
        low = data | 0x20
        tag = np.ones(len(lo), bool)
        for k, c in enumerate(b"alias"):
            tag &= (lo + k < hi) & (low[np.minimum(lo + k, size - 1)] == c)
        tag[0] = False
        tag[1:] &= parent[1:] == parent[:-1]
        group = np.cumsum(~tag) - 1
        heads = np.flatnonzero(~tag)
        ends = np.append(heads[1:], len(lo)) - 1
        lo, hi, parent, nums = lo[heads], hi[ends], parent[heads], nums[heads]
        del group

    pieces = _gather(data, lo, hi)
    if nums.any():
        pieces = pc.if_else(pa.array(nums), pc.replace_substring_regex(pieces, _NUMBER.pattern, ""), pieces)
    plain = pieces
    for shape, back in ((r'^"((?:[^"\\]|""|\\.)*)"$', '""'), (r"^'((?:[^'\\]|''|\\.)*)'$", "''"), (r"^«([^«»]*)»$", "")):
        hit = pc.match_substring_regex(pieces, shape)
        bare = pc.replace_substring_regex(pieces, shape, r"\1")
        if back:
            bare = pc.replace_substring(bare, back, back[0])
            bare = pc.replace_substring_regex(bare, r"\\(.)", r"\1")
        pieces = pc.if_else(hit, bare, pieces)
    whole = np.asarray(pc.equal(plain, pieces).to_numpy(zero_copy_only=False))
    pieces = pc.utf8_trim_whitespace(pieces)

    # pieces in which a comma or a conjunction has to be understood
    soft = np.concatenate(([0], np.cumsum(comma & ~hard_comma)))
    odd = soft[hi] > soft[lo]
    if kind == "persona":
        y = _shift(np.isin(data | 0x20, (ord("y"), ord("e"))), 1) & space & _shift(space, 2) & free
        yc = np.concatenate(([0], np.cumsum(y)))
        odd |= yc[hi] > yc[lo]
    odd &= whole
    cuts = _cuts(kind, jurisdictions)
    counts = np.ones(len(lo), np.int64)
    fresh_values: list[str] = []
    spots = np.flatnonzero(odd)
    if len(spots):
        for i, text in zip(spots, pieces.take(pa.array(spots)).to_pylist(), strict=True):
            got = [_unquote(x) for x in cuts(text)]
            counts[i] = len(got)
            fresh_values += got
    index = np.repeat(np.arange(len(lo)), counts)
    if len(spots):
        index[np.repeat(odd, counts)] = len(lo) + np.arange(len(fresh_values))
    values = pa.concat_arrays([pieces, pa.array(fresh_values, pa.large_string())]).take(pa.array(index))
    parent = np.repeat(parent, counts)
    # child offsets and list array; flattening gives values and parent ordinals back without the nameless ones
    bad = pc.match_substring_regex(values, r"^[\W\d_]*\pL?[\W\d_]*$").to_numpy(zero_copy_only=False)
    short = np.asarray(pc.less_equal(pc.utf8_length(values), 16).to_numpy(zero_copy_only=False)) & ~bad
    look = np.flatnonzero(short)
    if len(look):
        bad = bad.copy()
        uniq = pc.dictionary_encode(values.take(pa.array(look)))
        nameless = np.array([not_a_name(x) for x in uniq.dictionary.to_pylist()], bool)
        bad[look] = nameless[uniq.indices.to_numpy()]
    keep = ~bad
    values, parent = values.filter(pa.array(keep)), parent[keep]
    child = np.zeros(n + 1, np.int64)
    np.cumsum(np.bincount(parent, minlength=n), out=child[1:])
    packed = pa.LargeListArray.from_arrays(pa.array(child), values)
    return packed.flatten(), pc.list_parent_indices(packed).to_numpy().astype(np.int64)


def _unquote(text: str) -> str:
    text = text.strip()
    for a, b in (('"', '"'), ("'", "'"), ("«", "»")):
        if len(text) > 1 and text[0] == a and text[-1] == b and a not in text[1:-1] and b not in text[1:-1]:
            return text[1:-1].strip()
    return text


def explode_packed(df: DataFrame, key: str, fields: Mapping[str, str], jurisdictions: Sequence[str] = ()) -> DataFrame:
    """One row per value of the packed text columns ``fields`` (column name to kind, see KINDS).

    Columns: ``key``, campo (the column's name), pos (from 1 in the row's field, in order of appearance), valor.
    Nulls, blanks, empty lists and marks for "nothing" give no row; repeated values and repeated rows stay.
    ``jurisdictions``: names that may follow a place behind a comma. Narrow: no shuffle, no state between rows.
    """
    if bad := set(fields.values()) - set(KINDS):
        raise ValueError(f"unknown kinds {sorted(bad)}; known are {KINDS}")
    known = frozenset(map(names.fold, jurisdictions))
    picked = df.select(F.col(key).alias("_key"), *(F.col(c).cast("string").alias(f"_f{i}") for i, c in enumerate(fields)))
    key_type = picked.schema["_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (campo, kind) in enumerate(fields.items()):
                values, parent = scan(batch.column(i + 1), kind, known)
                if not len(values):
                    continue
                head = np.searchsorted(parent, parent, side="left")
                pos = np.arange(len(parent)) - head + 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(parent)), pa.array(np.full(len(parent), campo, object), pa.string()), pa.array(pos, pa.int32()), values.cast(pa.string())],
                    names=[key, "campo", "pos", "valor"],
                )

    return picked.mapInArrow(run, f"`{key}` {key_type}, campo string, pos int, valor string")
