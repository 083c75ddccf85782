"""Page tree of a PDF file: which objects are its pages, and where their contents lie.

A reader of references alone: cross-reference tables and streams with their earlier versions,
object streams, the tree of pages. It draws nothing. Where the table is broken, objects are
found by their own headings, the last of a number counting, as in an appended update.
"""

from __future__ import annotations

import re
import zlib

TOKEN = re.compile(rb"\s*(?:%[^\r\n]*\s*)*(<<|>>|\[|\]|\(|<[0-9A-Fa-f\s]*>|/[^\s<>\[\](){}/%]*|\d+\s+\d+\s+R(?![A-Za-z])|[-+]?(?:\d+\.?\d*|\.\d+)|[A-Za-z]+)")
OBJECT = re.compile(rb"(?:^|(?<=[\s>]))(\d+)\s+\d+\s+obj\b")
MOST_DEPTH = 200


class Broken(ValueError):
    """No page tree can be read."""


class Ref(int):
    """A reference to an object, by number."""


def value(data: bytes, at: int, depth: int = 0) -> tuple[object, int]:
    """The value at a place and the place after it: dict, list, Ref, number, name (as /text), bytes, or a bare word."""
    m = TOKEN.match(data, at)
    if not m or depth > MOST_DEPTH:
        raise Broken(f"no value at {at}")
    token, at = m[1], m.end()
    if token == b"<<":
        out: dict = {}
        while not (m := re.compile(rb"\s*(?:%[^\r\n]*\s*)*>>").match(data, at)):
            name, at = value(data, at, depth + 1)
            out[name], at = value(data, at, depth + 1)
        return out, m.end()
    if token == b"[":
        items: list = []
        while not (m := re.compile(rb"\s*(?:%[^\r\n]*\s*)*\]").match(data, at)):
            item, at = value(data, at, depth + 1)
            items.append(item)
        return items, m.end()
    if token == b"(":
        start, level = at, 1
        while level and at < len(data):
            c = data[at : at + 1]
            at += 2 if c == b"\\" else 1
            level += {b"(": 1, b")": -1}.get(c, 0)
        return data[start : at - 1], at
    if token.endswith(b"R") and b" " in token.replace(b"\n", b" ").replace(b"\r", b" ").replace(b"\t", b" "):
        return Ref(token.split()[0]), at
    if token[:1] == b"/":
        return token.decode("latin-1"), at
    if token[:1] == b"<":
        return token, at
    if re.fullmatch(rb"[-+]?\d+", token):
        return int(token), at
    return (float(token) if re.fullmatch(rb"[-+.\d]+", token) else token), at


def unpacked(entry: dict, raw: bytes) -> bytes:
    """A stream's bytes where they are plain or deflated, with the PNG predictors."""
    names = entry.get("/Filter", [])
    names = names if isinstance(names, list) else [names]
    if names not in ([], ["/FlateDecode"]):
        raise Broken(f"filter {names}")
    if not names:
        return raw
    flat, parms = zlib.decompressobj().decompress(raw), entry.get("/DecodeParms") or {}
    parms = parms[0] if isinstance(parms, list) else parms
    if parms.get("/Predictor", 1) < 10:
        return flat
    width, rows, above = parms.get("/Columns", 1) * parms.get("/Colors", 1) * parms.get("/BitsPerComponent", 8) // 8, [], None
    for at in range(0, len(flat), width + 1):
        kind, row = flat[at], bytearray(flat[at + 1 : at + 1 + width])
        above = above or bytes(len(row))
        for i in range(len(row)):
            left = row[i - 1] if i else 0
            if kind == 4:
                corner = above[i - 1] if i else 0
                p = left + above[i] - corner
                row[i] = (row[i] + min((left, above[i], corner), key=lambda v: abs(p - v))) % 256  # noqa: B023  ties: left, above, corner
            else:
                row[i] = (row[i] + (0, left, above[i], (left + above[i]) // 2)[kind]) % 256
        rows.append(bytes(row))
        above = rows[-1]
    return b"".join(rows)


class File:
    def __init__(self, data: bytes):
        if b"%PDF-" not in data[:1024]:
            raise Broken("no PDF")
        self.data, self.places, self.trailer = data, {}, {}  # number -> offset, or (object stream, index)
        try:
            self._linked(int(re.findall(rb"startxref\s+(\d+)", data)[-1]))
            self.root()
        except (Broken, IndexError, ValueError, KeyError, TypeError, zlib.error):
            self._found()
        if "/Encrypt" in self.trailer:
            raise Broken("encrypted")

    def _linked(self, at: int) -> None:
        """Follow cross-reference sections from the newest back; the newest place of an object counts."""
        seen = set()
        waiting = [at]
        while waiting:
            at = waiting.pop(0)
            if at in seen or not 0 <= at < len(self.data):
                continue
            seen.add(at)
            trailer = self._table(at) if re.compile(rb"\s*xref\b").match(self.data, at) else self._stream(at)
            self.trailer = {**trailer, **self.trailer}
            waiting += [trailer[k] for k in ("/XRefStm", "/Prev") if isinstance(trailer.get(k), int)]

    def _table(self, at: int) -> dict:
        at = re.compile(rb"\s*xref\s*").match(self.data, at).end()
        while m := re.compile(rb"\s*(\d+)\s+(\d+)\s*(?=\d{10} )").match(self.data, at):
            first, n, at = int(m[1]), int(m[2]), m.end()
            for i in range(n):
                entry = re.compile(rb"\s*(\d{10}) (\d{5}) ([nf])").match(self.data, at)
                if not entry:
                    raise Broken("cross-reference entry")
                if entry[3] == b"n":
                    self.places.setdefault(first + i, int(entry[1]))
                else:
                    self.places.setdefault(first + i, None)
                at = entry.end()
        m = re.compile(rb"\s*(?:\d+\s+0\s+)*trailer").match(self.data, at)
        if not m:
            raise Broken("trailer")
        return value(self.data, m.end())[0]

    def _stream(self, at: int) -> dict:
        entry, start, length = self.at(at)
        rows, widths = unpacked(entry, self.data[start : start + length]), entry["/W"]
        spans = entry.get("/Index", [0, entry["/Size"]])
        numbers = [spans[i] + k for i in range(0, len(spans), 2) for k in range(spans[i + 1])]
        for i, number in enumerate(numbers):
            row, fields = rows[i * sum(widths) : (i + 1) * sum(widths)], []
            for w in widths:
                fields.append(int.from_bytes(row[:w], "big") if w else None)
                row = row[w:]
            kind = 1 if fields[0] is None else fields[0]
            self.places.setdefault(number, {1: fields[1], 2: (fields[1], fields[2])}.get(kind))
        return entry

    def _found(self) -> None:
        """Places by the objects' own headings, and the trailer by its words or the catalog."""
        self.places, self.trailer = {int(m[1]): m.start() for m in OBJECT.finditer(self.data)}, {}
        for m in re.finditer(rb"trailer", self.data):
            try:
                self.trailer.update(value(self.data, m.end())[0])
            except (Broken, TypeError, ValueError):
                continue
        for number in list(self.places):
            try:
                entry, start, length = self.at(self.places[number])
                if isinstance(entry, dict) and entry.get("/Type") == "/ObjStm":
                    head = unpacked(entry, self.data[start : start + length])[: entry["/First"]].split()
                    for i, inner in enumerate(head[0 : 2 * entry["/N"] : 2]):
                        self.places.setdefault(int(inner), (number, i))
            except (Broken, KeyError, TypeError, ValueError, zlib.error):
                continue
        for number in [] if "/Root" in self.trailer else list(self.places):
            try:
                entry = self.get(Ref(number))
            except (Broken, KeyError, TypeError, ValueError, zlib.error):
                continue
            if isinstance(entry, dict) and entry.get("/Type") == "/Catalog":
                self.trailer["/Root"] = Ref(number)

    def at(self, place: int) -> tuple[object, int, int]:
        """The object at a place, and where its stream lies (start, length; 0, 0 without one)."""
        m = re.compile(rb"\s*\d+\s+\d+\s+obj").match(self.data, place)
        if not m:
            raise Broken(f"no object at {place}")
        entry, at = value(self.data, m.end())
        s = re.compile(rb"\s*stream(?:\r\n|\n|\r)").match(self.data, at)
        if not s or not isinstance(entry, dict):
            return entry, 0, 0
        length = entry.get("/Length")
        length = self.get(length) if isinstance(length, Ref) else length
        end = re.compile(rb"\s*endstream")
        if not isinstance(length, int) or not end.match(self.data, s.end() + length):
            found = re.compile(rb"(?:\r\n|\n|\r)?endstream").search(self.data, s.end())
            if not found:
                raise Broken("stream without an end")
            length = found.start() - s.end()
        return entry, s.end(), length

    def get(self, what: object) -> object:
        """An object by its reference; anything else is itself."""
        if not isinstance(what, Ref):
            return what
        place = self.places.get(what)
        if place is None:
            return None
        if isinstance(place, tuple):
            entry, start, length = self.at(self.places[place[0]])
            inner = unpacked(entry, self.data[start : start + length])
            numbers = inner[: entry["/First"]].split()
            return value(inner, entry["/First"] + int(numbers[2 * place[1] + 1]))[0]
        return self.at(place)[0]

    def root(self) -> dict:
        catalog = self.get(self.trailer.get("/Root"))
        if not isinstance(catalog, dict) or not isinstance(self.get(catalog.get("/Pages")), dict):
            raise Broken("no page tree")
        return catalog

    def pages(self) -> list[tuple[int, list[tuple[int, int]], bytes]]:
        """(object number, places of its contents (start, length), the contents) of each page in order. Contents under other filters than deflate stay as they are."""
        out, seen, waiting = [], set(), [self.root()["/Pages"]]
        while waiting:
            node = waiting.pop()
            entry = self.get(node)
            if int(node) in seen or not isinstance(entry, dict):
                continue
            seen.add(int(node))
            if "/Kids" in entry:
                waiting += [k for k in reversed(self.get(entry["/Kids"]) or []) if isinstance(k, Ref)]
                continue
            parts = entry.get("/Contents", [])
            if isinstance(parts, Ref) and isinstance(self.get(parts), list):
                parts = self.get(parts)
            ranges, text = [], b""
            for part in parts if isinstance(parts, list) else [parts]:
                place = self.places.get(part)
                if isinstance(place, int):
                    own, start, length = self.at(place)
                    ranges.append((start, length))
                    try:
                        text += unpacked(own, self.data[start : start + length]) + b"\n"
                    except (Broken, zlib.error):
                        text += self.data[start : start + length] + b"\n"
            out.append((int(node), ranges, text))
        if not out:
            raise Broken("no pages")
        return out
