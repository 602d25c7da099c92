"""Documents walked once, with a vendor's compiled mapping, to the hits of its rules and the parts they make.

What a mapping's rules say about a path depends on the path alone. It is remembered in a tree of places, which
documents are walked along: a key or position costs one look-up, whatever its depth, and no path is put together.
Only subtrees which some rule can reach are opened, and only leaves that a rule looks at are read.
Documents come as Arrow columns of VARIANT values, which are walked as they are stored, mappings as JSON text.
"""

from __future__ import annotations

import gc
import json
import math
import re
import struct
from collections.abc import Callable, Iterator
from decimal import Decimal
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import VariantVal

from ..schemas import DELIVERY_FIELDS, ITEM_FIELDS, SCALAR_TARGETS, SERIALS, SKIP_WHEN_FALSE
from ..sources.configs import QUALIFIED_SIBLING

#: Paths whose rules are remembered for each mapping; then it starts over.
REMEMBERED = 50_000
#: Documents that are walked at a time: until they are Arrow arrays, their parts are Python objects, many times as large.
WALKED = 500
#: Kinds of hits that are numbered, for all mappings; then they start over.
MOST_KINDS = 1_000_000
_MOST = 2**31 - 1


#: Keys of documents that are remembered, by the bytes that VARIANT keeps them as; then they start over.
KEYS = 10_000
_UNPACK = {1: "B", 2: "H", 4: "I"}


def _unsigned(data: bytes, begin: int, end: int, width: int) -> tuple[int, ...] | bytes:
    """Little-endian whole numbers of ``width`` bytes."""
    if width == 1:
        return data[begin:end]
    if width == 3:
        return tuple(int.from_bytes(data[i : i + 3], "little") for i in range(begin, end, 3))
    return struct.unpack_from(f"<{(end - begin) // width}{_UNPACK[width]}", data, begin)


class Keys:
    """The keys of objects of one VARIANT, by their number."""

    def __init__(self, metadata: bytes):
        width = (metadata[0] >> 6) + 1
        n = int.from_bytes(metadata[1 : 1 + width], "little")
        texts = 1 + (n + 2) * width
        at = _unsigned(metadata, 1 + width, texts, width)
        self.metadata = metadata
        self.names = [metadata[texts + i : texts + j].decode() for i, j in zip(at, at[1:])]


@lru_cache(maxsize=KEYS)
def keys_of(metadata: bytes) -> Keys:
    return Keys(metadata)


def _double_text(x: float) -> str:
    """A double as the JVM writes it, with the fewest digits that tell it apart, two at least."""
    if x == 0 or 1e-3 <= abs(x) < 1e7:
        return repr(x)
    digits = len(Decimal(repr(x)).normalize().as_tuple().digits)
    mantissa, exponent = f"{x:.{max(digits - 1, 1)}e}".split("e")
    return f"{mantissa}E{int(exponent)}"


def _decimal_text(unscaled: int, scale: int) -> str:
    if not scale:
        return str(unscaled)
    digits = str(abs(unscaled)).rjust(scale + 1, "0")
    text = f"{digits[:-scale]}.{digits[-scale:]}".rstrip("0").rstrip(".")
    return f"-{text}" if unscaled < 0 else text


def _scalar_of(data: bytes, at: int, keys: Keys) -> tuple[str | None, bool, bool]:
    """Text of a scalar that is no short string, its truth, and whether it is a numeric zero or false."""
    kind = data[at] >> 2
    if kind == 16:
        n = int.from_bytes(data[at + 1 : at + 5], "little")
        return data[at + 5 : at + 5 + n].decode(), n > 0, False
    if kind == 0:
        return None, False, False
    if kind in (1, 2):
        return ("true", True, False) if kind == 1 else ("false", False, True)
    if kind in (3, 4, 5, 6):
        number = int.from_bytes(data[at + 1 : at + 1 + (1 << (kind - 3))], "little", signed=True)
        return str(number), number != 0, number == 0
    if kind in (8, 9, 10):
        number = int.from_bytes(data[at + 2 : at + 2 + (4 << (kind - 8))], "little", signed=True)
        return _decimal_text(number, data[at + 1]), number != 0, number == 0
    if kind == 7:
        number = struct.unpack_from("<d", data, at + 1)[0]
        if math.isfinite(number):
            return _double_text(number), number != 0, number == 0
        text = "NaN" if number != number else "Infinity" if number > 0 else "-Infinity"
        return text, True, False
    # What JSON has no type for is text there.
    text = VariantVal(data[at:], keys.metadata).toJson()
    value = json.loads(text)
    zero = not isinstance(value, str) and not value
    return (value, value != "", False) if isinstance(value, str) else (text, not zero, zero)


def _whole(digits: str) -> int | None:
    n = int(digits)
    return n if n <= _MOST else None


def path_index(path: str, segment: int | None, legacy: bool) -> int | None:
    """``flatten.path_index`` of one path."""
    found = re.search(r"\.([0-9])" if legacy else r"\.([0-9]+)", path)
    first = (_whole(found[1]) or 0) if found else 0
    if not segment or segment < 0:
        return first
    segments = path.split(".")
    if len(segments) <= segment or not found:
        return first
    here = segments[segment]
    return _whole(here) if re.fullmatch("[0-9]+", here) else 0


#: What is to be done at a place, where that is not just one hit of a kind.
OTHERS, NOTHING = -1, -2


class Place:
    """A path of documents with what a mapping's rules say about it, and the places below it by key or position."""

    __slots__ = ("path", "prefix", "below", "shapes", "places", "closed", "met", "only", "hits", "suffixed", "late", "exact", "masks", "signs", "sibling", "listed")

    def __init__(self, path: str):
        self.path, self.prefix = path, f"{path}." if path else ""
        self.below: dict[str | int, Place] = {}
        #: Places below, by the head of an object with its keys, and by position.
        self.shapes: dict[tuple[Keys, bytes], list[Place]] = {}
        self.places: list[Place] = []
        self.closed = False


#: Groups of hits; serial numbers from exact paths are told apart from the items they go to.
GROUPS, SERIAL_NUMBERS = {"items": 0, "deliveries": 1}, 2
#: Fields of the groups that have a column of their own.
OWN_FIELDS = ((*ITEM_FIELDS, "item_details"), DELIVERY_FIELDS)


class Kinds:
    """Numbers for what hits say besides their value: group, positions (-1 for an unknown one), order and field."""

    def __init__(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.fields = [{f: i for i, f in enumerate(own)} for own in (*OWN_FIELDS, ())]
        self.table = np.zeros((1024, 5), np.int64)

    def number(self, group: int, idx: int | None, inner: int | None, ord_: int, field: str) -> int:
        fields = self.fields[group]
        key = (group, -1 if idx is None else idx, -1 if inner is None else inner, ord_, fields.setdefault(field, len(fields)))
        found = self.numbers.setdefault(key, len(self.numbers))
        if found >= len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[found] = key
        return found


class Hits:
    """The hits of a batch of documents, kind and value by hit; ``zeros`` are numeric zeros and false."""

    def __init__(self) -> None:
        self.kinds: list[int] = []
        self.values: list[str | bytes | None] = []
        self.zeros: list[int] = []
        self.ends: list[int] = []

    def cut(self, begin: int, kinds: Kinds, masked: set[int]) -> None:
        """Leave out, from ``begin`` on, the hits of entries with an order in ``masked``."""
        left = [i for i in range(begin, len(self.kinds)) if kinds.table[self.kinds[i], 3] not in masked]
        at = {i: begin + n for n, i in enumerate(left)}
        self.zeros = [at.get(i, i) for i in self.zeros if i < begin or i in at]
        self.kinds[begin:] = [self.kinds[i] for i in left]
        self.values[begin:] = [self.values[i] for i in left]


class Compiled:
    """A mapping, ready to walk documents."""

    def __init__(self, entries: list[dict], legacy: bool, kinds: Kinds):
        self.legacy, self.kinds = legacy, kinds
        by_text = ("prefix", "join_prefix", "join", "join_truthy")
        #: Kinds that look at the document as a whole where their own path is not in it.
        wide = {"qualifier", *by_text}
        #: By the number of an entry: skipped where false, scalar, kind of its hit, kind as a serial number, entry.
        self.entries = []
        self.exact: dict[str, list[int]] = {}
        for n, e in enumerate(entries):
            group = GROUPS.get(e["grp"])
            serial = e["field"] == "item_details"
            # A serial number from an exact path fills the serial list, not a field.
            kind = None if group is None else kinds.number(group, 0, 0, e["ord"], "" if serial else e["field"])
            number = kinds.number(SERIAL_NUMBERS, 0, 0, e["ord"], "") if serial and group == 0 else None
            self.entries.append((e["target"] in SKIP_WHEN_FALSE, not e["grp"], e["field"], kind, number, e))
            self.exact.setdefault(e["path"], []).append(n)
        self.wide = [n for n, e in enumerate(entries) if e["kind"] in wide]
        self.by_ends: dict[str, list[dict]] = {}
        for e in entries:
            if e["kind"] in ("wild", "suffix"):
                self.by_ends.setdefault(e["ends"], []).append(e)
        self.masked = {e["path"]: e["ord"] for met in self.by_ends.values() for e in met}
        self.wild = {e["ord"] for met in self.by_ends.values() for e in met if e["kind"] == "wild"}
        self.qualifiers = [(n, e) for n, e in enumerate(entries) if e["kind"] == "qualifier"]
        self.texts = [(n, e) for n, e in enumerate(entries) if e["kind"] in by_text]
        self.starts = tuple(e["first"] for _, e in self.texts)
        self.firsts = {e["path"].split(".")[0] for e in entries} | {e["first"] for e in entries}
        self.forget()

    def forget(self) -> None:
        """Begin anew with the places of documents; a list at the root has no segment of its own."""
        self.root, self.listing, self.made = Place(""), Place(""), 0

    def opens(self, key: str) -> bool:
        """Whether a rule can reach into the subtree of a key of the root."""
        # A key may hold dots itself, and texts of rules are compared with the whole path.
        if self.qualifiers or key.split(".")[0] in self.firsts:
            return True
        return any(key.startswith(s) or s.startswith(f"{key}.") for s in self.starts)

    def place(self, above: Place, key: str | int) -> Place:
        """The place of a key below another one, remembered while there are not too many."""
        place = above.below.get(key)
        if place is not None:
            return place
        path = f"{above.prefix}{key}"
        place = Place(path)
        place.closed = above is self.root and not self.opens(path)
        segments = path.split(".")
        last = segments[-1]
        named = segments[-2] if re.search("[0-9]", last) and len(segments) > 1 else last
        # A path that exists literally wins over the rule, so a rule has no hit at its own one.
        met = [m for m in self.by_ends.get(f"{segments[0]}|{named}", ()) if m["path"] != path and (m["kind"] == "wild" or "." in path)]
        place.exact, place.masks = self.exact.get(path, ()), path in self.masked
        place.hits = [k for m in met if (k := self.begin(m, path)) is not None]
        place.suffixed = [m["ord"] for m in met if m["kind"] == "suffix"]
        place.late = [(m["field"], m["ord"]) for m in met if not m["grp"]]
        place.signs = [(n, e["sign"]) for n, e in self.qualifiers if path.endswith(e["first"])]
        place.sibling = bool(self.qualifiers) and path.endswith(QUALIFIED_SIBLING)
        place.listed = [n for n, e in self.texts if path.startswith(e["first"]) and (e["kind"] in ("prefix", "join_prefix") or path.endswith(e["last"]))]
        place.met = bool(place.exact or place.hits or place.late or place.signs or place.sibling or place.listed)
        alone = len(place.hits) == 1 and not (place.exact or place.suffixed or place.late or place.signs or place.sibling or place.listed)
        place.only = NOTHING if place.closed or not place.met else place.hits[0] if alone else OTHERS
        if self.made < REMEMBERED:
            self.made += 1
            above.below[key] = place
        return place

    def open(self, above: Place, data: bytes, at: int, keys: Keys) -> tuple[Iterator[tuple[Place, int]], int]:
        """The members of a container, as their places and where they are stored from a begin on."""
        head = data[at] >> 2
        if data[at] & 3 == 2:
            width, id_width = (head & 3) + 1, (head >> 2 & 3) + 1
            n, ids = (int.from_bytes(data[at + 1 : at + 5], "little"), at + 5) if head & 16 else (data[at + 1], at + 2)
            offsets = ids + n * id_width
            shape = (keys, data[at:offsets])
            places = above.shapes.get(shape)
            if places is None:
                places = [self.place(above, keys.names[i]) for i in _unsigned(data, ids, offsets, id_width)]
                if self.made < REMEMBERED:
                    self.made += 1
                    above.shapes[shape] = places
        else:
            width = (head & 3) + 1
            n, offsets = (int.from_bytes(data[at + 1 : at + 5], "little"), at + 5) if head & 4 else (data[at + 1], at + 2)
            places = above.places
            if len(places) < n:
                places = places + [self.place(above, i) for i in range(len(places), n)]
                if self.made < REMEMBERED:
                    above.places = places
        begin = offsets + (n + 1) * width
        # There is an offset more than members.
        at_most = _unsigned(data, offsets, begin - width, width)
        return zip(places, at_most), begin

    def begin(self, m: dict, path: str) -> int | None:
        """Kind of a rule's hit at a path."""
        if m["grp"] not in GROUPS:
            return None
        inner = path_index(path, m.get("inner_seg"), self.legacy) if m.get("nested") else 0
        return self.kinds.number(GROUPS[m["grp"]], path_index(path, m.get("idx_seg"), self.legacy), inner, m["ord"], m["field"])

    def walk(self, data: bytes, keys: Keys, lone_lists: bool, serialized: bool | None, hits: Hits) -> dict[str, str | None]:
        """Add a document's hits of items and deliveries to ``hits``; its scalars by field, the last written one last.
        Each container is opened once, and only places that a rule can reach."""
        if self.made >= REMEMBERED:
            self.forget()
        first = len(hits.kinds)
        put, put_value = hits.kinds.append, hits.values.append
        late: list[tuple] = []
        found: dict[int, tuple] = {}
        masked: set[int] = set()
        cuttable = self.wild
        keyed: dict[int, str] = {}
        siblings: list[tuple] = []
        listed: dict[int, list[tuple]] = {}
        stack = []
        if data[0] & 3 == 2:
            stack.append(self.open(self.root, data, 0, keys))
        elif data[0] & 3 == 3:
            stack.append((iter([(self.place(self.listing, ""), 0)]), 0))
        while stack:
            members, begin = stack[-1]
            for place, at in members:
                at += begin
                kind = data[at]
                if lone_lists:
                    while kind & 3 == 3 and int.from_bytes(data[at + 1 : at + (5 if kind & 16 else 2)], "little") == 1:
                        # Its only element follows the number and two offsets.
                        at += (5 if kind & 16 else 2) + 2 * ((kind >> 2 & 3) + 1)
                        kind = data[at]
                basic = kind & 3
                if basic == 1:
                    at += 1
                    value = data[at : at + (kind >> 2)]
                    only = place.only
                    if only >= 0 and (value or not lone_lists):
                        put(only)
                        put_value(value)  # Arrow takes the bytes of a text
                        continue
                    if only == NOTHING:
                        continue
                    value = value.decode()
                    truth, zero = value != "", False
                elif basic:
                    if place.closed:
                        continue
                    if kind & 79 == 2:  # an object of few members with small values, as most are
                        offsets = at + 2 + data[at + 1] * ((kind >> 4 & 3) + 1)
                        places = place.shapes.get((keys, data[at:offsets]))
                        if places is not None:
                            end = offsets + len(places) + 1
                            stack.append((zip(places, data[offsets:end]), end))
                            break
                    stack.append(self.open(place, data, at, keys))
                    break
                elif place.only == NOTHING:
                    continue
                else:
                    value, truth, zero = _scalar_of(data, at, keys)
                if value == "" and lone_lists and not place.path.rpartition(".")[2].startswith("@"):
                    value = None
                for hit in place.hits:
                    if zero:
                        hits.zeros.append(len(hits.kinds))
                    put(hit)
                    put_value(value)
                for n in place.exact:
                    found.setdefault(n, (value, truth, zero))
                    if place.masks:
                        masked.add(self.masked[place.path])
                if place.suffixed:
                    cuttable = cuttable.union(place.suffixed)
                if place.late:
                    late += [(field, value, ord_) for field, ord_ in place.late]
                for n, sign in place.signs:
                    if value == sign:
                        keyed.setdefault(n, place.path)
                if place.sibling:
                    siblings.append((place.path, value, zero))
                for n in place.listed:
                    listed.setdefault(n, []).append((place.path, value, truth, zero))
            else:
                stack.pop()
        if masked and not masked.isdisjoint(cuttable):
            hits.cut(first, self.kinds, masked)
            late = [x for x in late if x[2] not in masked]
        for n in self.wide:
            found.setdefault(n, ())
        scalars: dict[str, str | None] = {}
        for n in sorted(found):
            skipped, scalar, field, kind, number, e = self.entries[n]
            made = found[n]
            if not made:
                writes = self._of_document(e, keyed.get(n), siblings, listed.get(n, ()))
            else:
                value, truth, zero = made
                if skipped and not truth:
                    continue
                if scalar:
                    scalars.pop(field, None)
                    scalars[field] = value
                    continue
                writes = [] if kind is None else [(None, kind, value, zero)]
                if number is not None and truth and serialized is not False:
                    writes.append((None, number, value, False))
            for field, kind, value, zero in writes:
                if field is not None:
                    scalars.pop(field, None)
                    scalars[field] = value
                elif kind is not None:
                    if zero:
                        hits.zeros.append(len(hits.kinds))
                    put(kind)
                    put_value(value)
        for field, value, _ in late:
            scalars.pop(field, None)
            scalars[field] = value
        return scalars

    def _of_document(self, e: dict, keyed: str | None, siblings: list[tuple], met: list[tuple]) -> Iterator[tuple]:
        """Scalar field or kind, value and zero of the hits of an entry that looks at the document as a whole."""
        if e["kind"] == "qualifier":
            if keyed is not None:
                sibling = keyed[: len(keyed) - len(e["first"])] + QUALIFIED_SIBLING
                group = GROUPS.get(e["grp"])
                kind = None if group is None else self.kinds.number(group, 0, 0, e["ord"], e["field"])
                for path, value, zero in siblings:
                    if path == sibling:
                        yield None if e["grp"] else e["field"], kind, value, zero
        elif e["kind"] == "prefix":
            for path, value, _, zero in met:
                yield None if e["grp"] else e["field"], self.begin(e, path), value, zero
        else:
            values = [value for _, value, truth, _ in met if value is not None and (truth or e["kind"] != "join_truthy")]
            yield e["target"], None, ", ".join(values), False


_kinds = Kinds()


@lru_cache(maxsize=4096)
def compiled(entries: str, legacy: bool) -> Compiled:
    """One compiled mapping a text and worker process."""
    return Compiled(json.loads(entries), legacy, _kinds)


def _forget_many() -> None:
    """Begin anew when hits were of very many kinds, as long lists make them."""
    global _kinds
    if len(_kinds.numbers) > MOST_KINDS:
        _kinds = Kinds()
        compiled.cache_clear()


class Listed:
    """A column of lists, put together row by row; ``None`` is a null row."""

    def __init__(self) -> None:
        self.offsets: list[int | None] = []
        self.length = 0

    def add(self, n: int | None) -> None:
        self.offsets.append(None if n is None else self.length)
        self.length += n or 0

    def of(self, values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([*self.offsets, self.length], pa.int32()), values)


def _offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)


def _sorted(doc: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Hits by group, document, positions and order; those of one entry at one position stay in document order."""
    columns = [kinds[:, 0], doc, kinds[:, 1] + 1, kinds[:, 2] + 1, kinds[:, 3]]
    packed, bits = np.zeros(len(doc), np.int64), 0
    for c in reversed(columns):
        width = int(c.max(initial=0)).bit_length()
        packed |= c << min(bits, 62)
        bits += width
    return np.argsort(packed, kind="stable") if bits < 63 else np.lexsort(columns[::-1])


class Elements:
    """The elements of a group over a batch of documents, field by field.

    Hits are aligned by position: positions ascend (gaps close), and an unknown position comes first and opens no element.
    The last write of a field counts. ``zero_fields`` names the fields whose last write was a numeric zero or
    false. Items have serial numbers, deliveries keep what the config maps to other fields in ``extra``.
    """

    def __init__(self, group: int, order: np.ndarray, doc: np.ndarray, kinds: np.ndarray, documents: int):
        self.own, self.order = OWN_FIELDS[group], order
        doc, kinds = doc[order], kinds[order]
        idx, inner, self.code = kinds[:, 1], kinds[:, 2], kinds[:, 4]
        first = np.ones(len(order), bool)
        first[1:] = doc[1:] != doc[:-1]
        for at in (idx, inner):
            first[1:] |= (at[1:] != at[:-1]) & (at[1:] >= 0) & (at[:-1] >= 0)
        self.element = np.cumsum(first) - 1
        self.outer = idx[first]
        self.n = len(self.outer)
        self.counts = np.bincount(doc[first], minlength=documents)
        self.starts = _offsets(self.counts)
        #: For each field the hit that each element has from it, and whether a hit is its field's last write.
        self.hits: dict[int, np.ndarray] = {}
        self.last = np.zeros(len(order), bool)
        for code in np.flatnonzero(np.bincount(self.code)).tolist():
            at = np.flatnonzero(self.code == code)
            hit = np.full(self.n, -1, np.int64)
            hit[self.element[at]] = order[at]  # of several the last one stays
            self.last[at] = hit[self.element[at]] == order[at]
            self.hits[code] = hit

    def column(self, code: int, values: pa.Array) -> pa.Array:
        hit = self.hits.get(code)
        return pa.nulls(self.n, pa.string()) if hit is None else values.take(pa.array(hit, mask=hit < 0))

    def lists(self, chosen: np.ndarray, values: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Offsets and entries of a list an element, of the chosen hits."""
        return pa.array(_offsets(np.bincount(self.element[chosen], minlength=self.n))), values

    def named(self, chosen: np.ndarray, fields: dict[str, int]) -> pa.Array:
        return pa.array([*fields], pa.string()).take(pa.array(self.code[chosen]))

    def serials(self, numbers: np.ndarray, doc: np.ndarray, values: pa.Array) -> pa.Array:
        """Each element's own serial number, else those of the document for its first element."""
        own = self.hits.get(len(ITEM_FIELDS), np.full(self.n, -1, np.int64))
        has = own >= 0
        has[has] = np.asarray(values.is_valid())[own[has]]
        lengths = has.astype(np.int64)
        of = doc[numbers]
        numbers, of = numbers[self.counts[of] > 0], of[self.counts[of] > 0]
        numbers, of = numbers[~has[self.starts[of]]], of[~has[self.starts[of]]]
        np.add.at(lengths, self.starts[of], 1)
        offsets = _offsets(lengths)
        chosen = np.zeros(offsets[-1], np.int64)
        chosen[offsets[:-1][has]] = own[has]
        # Those of a document lie side by side.
        place = np.arange(len(of)) - np.searchsorted(of, of)
        chosen[offsets[self.starts[of]] + place] = numbers
        number = pa.StructArray.from_arrays([values.take(pa.array(chosen))], names=["serialnumber"])
        return pa.ListArray.from_arrays(pa.array(offsets), number)

    def extra(self, fields: dict[str, int], valid: np.ndarray, values: pa.Array) -> pa.Array:
        others = np.flatnonzero(self.last & (self.code >= len(self.own)) & valid[self.order])
        others = others[np.lexsort((-others, self.element[others]))]
        offsets, keys = self.lists(others, self.named(others, fields))
        return pa.MapArray.from_arrays(offsets, keys, values.take(pa.array(self.order[others])))

    def array(self, rest: dict[str, pa.Array], zero: np.ndarray, fields: dict[str, int], values: pa.Array) -> tuple[pa.Array, pa.Array]:
        """The lists of elements, null where a document has none, and the outer position of each element."""
        named = [f for f in self.own if f not in rest]
        zeros = np.flatnonzero(self.last & zero[self.order])
        parts = {f: self.column(i, values) for i, f in enumerate(named)} | rest
        parts["zero_fields"] = pa.ListArray.from_arrays(*self.lists(zeros, self.named(zeros, fields)))
        elements = pa.StructArray.from_arrays([*parts.values()], names=[*parts])
        outer = pa.array(self.outer.astype(np.int32), mask=self.outer < 0)
        starts, none = pa.array(self.starts), pa.array(self.counts == 0)
        return pa.ListArray.from_arrays(starts, elements, mask=none), pa.ListArray.from_arrays(starts, outer, mask=none)


def _filled(column: list, rows: int) -> pa.Array:
    """Texts of a column that is written up to its last value."""
    return pa.array(column + [None] * (rows - len(column)), pa.string()) if column else pa.nulls(rows, pa.string())


def _stored(documents: pa.Array) -> pa.Array:
    """Documents as VARIANT values; JSON texts are read to such."""
    if pa.types.is_struct(documents.type):
        return documents
    read = [None if d is None else VariantVal.parseJson(d) for d in documents.to_pylist()]
    rows = [None if v is None else {"value": v.value, "metadata": v.metadata} for v in read]
    return pa.array(rows, pa.struct([("value", pa.binary()), ("metadata", pa.binary())]))


def mapped_of(documents: pa.Array, mappings: pa.Array, serialized: pa.Array, lone_lists: bool, legacy: bool) -> pa.Array:
    """``_walked`` of any number of documents, ``WALKED`` at a time."""
    columns = (documents, mappings, serialized)
    starts = range(0, max(len(documents), 1), WALKED)
    # Nothing here refers to itself; looking for what does takes longer than reading the documents.
    collecting = gc.isenabled()
    gc.disable()
    try:
        return pa.concat_arrays([_walked(*[c.slice(i, WALKED) for c in columns], lone_lists, legacy) for i in starts])
    finally:
        if collecting:
            gc.enable()


def _walked(documents: pa.Array, mappings: pa.Array, serialized: pa.Array, lone_lists: bool, legacy: bool) -> pa.Array:
    """Mapped parts of documents by mappings as JSON texts; null where either is.

    Scalars are the last hit of their field; serial numbers from exact paths are left out where the order is
    flagged as not serialised.
    """
    _forget_many()
    coded = mappings.dictionary_encode()
    mapped_by = [compiled(text, legacy) for text in coded.dictionary.to_pylist()]
    scalars: dict[str, list] = {f: [] for f in SCALAR_TARGETS}
    seen, seen_lists, hits = [], Listed(), Hits()
    stored = _stored(documents)
    # Of a null row the fields may hold anything.
    data, metadata = (stored.field(f).to_pylist() for f in ("value", "metadata"))
    there = stored.is_valid().to_pylist()
    for row, (known, by, flag) in enumerate(zip(there, coded.indices.to_pylist(), serialized.to_pylist())):
        if not known or by is None:
            seen_lists.add(None)
        else:
            last = mapped_by[by].walk(data[row], keys_of(metadata[row]), lone_lists, flag, hits)
            seen += reversed(last)
            seen_lists.add(len(last))
            for field, value in last.items():
                column = scalars.get(field)
                if column is not None and value is not None:
                    column += [None] * (row - len(column))
                    column.append(value)
        hits.ends.append(len(hits.kinds))
    parts = {f: _filled(column, len(documents)) for f, column in scalars.items()}
    named = {"scalars": pa.StructArray.from_arrays([*parts.values()], names=[*parts]), "seen": seen_lists.of(pa.array(seen, pa.string()))}
    named |= _groups(hits, len(documents))
    return pa.StructArray.from_arrays([*named.values()], names=[*named])


def _groups(hits: Hits, documents: int) -> dict[str, pa.Array]:
    """Items with their outer positions, and deliveries, of a batch of documents."""
    kinds = _kinds.table[np.array(hits.kinds, np.int64)]
    values = pa.array(hits.values, pa.string())
    doc = np.repeat(np.arange(documents), np.diff(np.array(hits.ends, np.int64), prepend=0))
    order = _sorted(doc, kinds)
    cuts = np.searchsorted(kinds[order, 0], range(4))
    items, deliveries = (Elements(g, order[cuts[g] : cuts[g + 1]], doc, kinds, documents) for g in (0, 1))
    zero = np.zeros(len(values), bool)
    zero[np.array(hits.zeros, np.int64)] = True
    of_items, of_deliveries, _ = _kinds.fields
    details = items.serials(order[cuts[2] :], doc, values)
    listed, outer = items.array({"item_details": details}, zero, of_items, values)
    extra = deliveries.extra(of_deliveries, np.asarray(values.is_valid()), values)
    return {"items": listed, "outer": outer, "deliveries": deliveries.array({"extra": extra}, zero, of_deliveries, values)[0]}


def _texts(fields: tuple[str, ...]) -> str:
    return ", ".join(f"{f}: string" for f in fields)


MAPPED = (
    f"struct<scalars: struct<{_texts(SCALAR_TARGETS)}>, seen: array<string>, "
    f"items: array<struct<{_texts(ITEM_FIELDS)}, item_details: {SERIALS}, zero_fields: array<string>>>, outer: array<int>, "
    f"deliveries: array<struct<{_texts(DELIVERY_FIELDS)}, extra: map<string, string>, zero_fields: array<string>>>>"
)


def mapped_column(document: Column, entries: Column, serialized: Column, lone_lists: bool, legacy: bool) -> Column:
    """Documents, as VARIANT, mapped by their entries, as JSON text, to a struct (``MAPPED``).

    Taken as not deterministic, so that no filter repeats the walk.
    """

    def walk(documents: pa.Array, mappings: pa.Array, flags: pa.Array) -> pa.Array:
        return mapped_of(documents, mappings, flags, lone_lists, legacy)

    run: Callable[..., Column] = F.arrow_udf(walk, MAPPED).asNondeterministic()
    return run(document, entries, serialized)
