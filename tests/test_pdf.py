"""Page trees of PDF files made here: tables, updates, streams, damage."""

import struct
import zlib

import pytest

from docspark.functions import pdf
from docspark.operators import extract


def body(objects, data=b"%PDF-1.4\n", xref=True, prev=None, size=None, root=1):
    """data with objects (number -> bytes) and a cross-reference table appended."""
    places = {}
    for n, text in objects.items():
        places[n] = len(data)
        data += b"%d 0 obj\n%b\nendobj\n" % (n, text)
    if not xref:
        return data
    at = len(data)
    data += b"xref\n0 1\n0000000000 65535 f \n" + b"".join(b"%d 1\n%010d 00000 n \n" % (n, p) for n, p in places.items())
    more = b"/Prev %d " % prev if prev is not None else b""
    return data + b"trailer\n<< /Size %d /Root %d 0 R %b>>\nstartxref\n%d\n%%%%EOF\n" % (size or max(objects) + 1, root, more, at)


def stream(text, packed=False):
    text = zlib.compress(text) if packed else text
    return b"<< /Length %d %b>>\nstream\n%b\nendstream" % (len(text), b"/Filter /FlateDecode " if packed else b"", text)


NESTED = {
    1: b"<< /Type /Catalog /Pages 2 0 R /Note (a \\) ( nested ) string) >>", 2: b"<< /Type /Pages /Count 3 /Kids [3 0 R 4 0 R] >>",
    3: b"<< /Type /Page /Parent 2 0 R /Contents 6 0 R >>", 4: b"<< /Type /Pages /Kids [5 0 R 9 0 R] /Count 2 >>",
    5: b"<< /Type /Page % note\n /Contents [7 0 R 8 0 R] /MediaBox [0 0 1.5 -2] /X <AB 01> >>", 6: stream(b"first"), 7: stream(b"second", True), 8: stream(b"half"), 9: b"<< /Type /Page >>",
}


def texts(data):
    return [t for _, _, t in pdf.File(data).pages()]


def test_nested_tree():
    found = pdf.File(body(NESTED)).pages()
    assert [(n, t) for n, _, t in found] == [(3, b"first\n"), (5, b"second\nhalf\n"), (9, b"")]
    data = body(NESTED)
    (start, length), = found[0][1]
    assert data[start : start + length] == b"first" and [len(r) for _, r, _ in found] == [1, 2, 0]


def test_updates_replace_objects_and_pages():
    data = body(NESTED)
    at = data.rindex(b"xref\n0 1")
    data = body({6: stream(b"changed")}, data, prev=at, size=10)
    assert texts(data)[0] == b"changed\n"
    data = body({2: b"<< /Type /Pages /Kids [4 0 R 3 0 R 10 0 R] /Count 4 >>", 10: b"<< /Type /Page /Contents 11 0 R >>", 11: stream(b"new")}, data, prev=data.rindex(b"xref\n0 1"))
    assert texts(data) == [b"second\nhalf\n", b"", b"changed\n", b"new\n"]


def test_cross_reference_and_object_streams():
    inner = [(1, b"<< /Type /Catalog /Pages 2 0 R >>"), (2, b"<< /Type /Pages /Kids [3 0 R] >>"), (3, b"<< /Type /Page /Contents 5 0 R >>")]
    head, text = b"", b""
    for n, t in inner:
        head += b"%d %d " % (n, len(text))
        text += t + b" "
    packed = zlib.compress(head + text)
    data = b"%PDF-1.5\n"
    at4 = len(data)
    data += b"4 0 obj\n<< /Type /ObjStm /N 3 /First %d /Length %d /Filter /FlateDecode >>\nstream\n%b\nendstream\nendobj\n" % (len(head), len(packed), packed)
    at5 = len(data)
    data += b"5 0 obj\n" + stream(b"inside", True) + b"\nendobj\n"
    at6 = len(data)
    rows = [(0, 0, 0), (2, 4, 0), (2, 4, 1), (2, 4, 2), (1, at4, 0), (1, at5, 0), (1, at6, 0)]
    plain, above, up = [struct.pack(">BHB", *r) for r in rows], bytes(4), b""
    for row in plain:
        up += b"\x02" + bytes((a - b) % 256 for a, b in zip(row, above, strict=True))
        above = row
    packed = zlib.compress(up)
    data += b"6 0 obj\n<< /Type /XRef /Size 7 /W [1 2 1] /Root 1 0 R /Length %d /Filter /FlateDecode /DecodeParms << /Predictor 12 /Columns 4 >> >>\nstream\n%b\nendstream\nendobj\nstartxref\n%d\n%%%%EOF" % (len(packed), packed, at6)
    assert texts(data) == [b"inside\n"]
    assert texts(data.replace(b"startxref\n%d" % at6, b"startxref\n1")) == [b"inside\n"]  # found by headings


def test_damage():
    data = body(NESTED)
    assert texts(body(NESTED, xref=False)) == texts(data)  # no table at all
    assert texts(data.replace(b"0000000009", b"0000009999")) == texts(data)
    assert texts(data.replace(b"/Length 5", b"/Length 9999")) == texts(data)
    looped = {**NESTED, 4: b"<< /Type /Pages /Kids [2 0 R 5 0 R 4 0 R] >>"}
    assert texts(body(looped)) == [b"first\n", b"second\nhalf\n"]
    for bad in (b"", b"hello", b"%PDF-1.4\n", body({1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Kids [] >>"}), data.replace(b"/Size", b"/Encrypt 3 0 R /Size"), b"%PDF-1.4\n" + b"1 0 obj\n" + b"[" * 5_000):
        with pytest.raises(pdf.Broken):
            pdf.File(bad).pages()


def test_pages_of_documents(spark):
    many = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Type /Pages /Kids [" + b" ".join(b"%d 0 R" % n for n in range(10, 210)) + b"] >>"}
    many |= {n: b"<< /Type /Page /Contents %d 0 R >>" % (n + 1_000) for n in range(10, 210)} | {n + 1_000: stream(b"page %d" % n, n % 2 == 0) for n in range(10, 210)}
    rows = [("a", body(NESTED), "page1"), ("b", body(many), "all_pages"), ("c", b"x\fy", "all_pages"), ("d", b"%PDF-1.4 nothing", "all_pages"), ("e", None, "page1")]
    df = spark.createDataFrame(rows, "key string, content binary, mode string")
    got = {}
    for r in extract.pages(df).orderBy("key", "page_no").collect():
        got.setdefault(r["key"], []).append(bytes(r["png"]) if r["png"] is not None else r["error"])
    assert got["a"] == [b"first\n"] and got["b"] == [b"page %d\n" % n for n in range(10, 210)] and got["c"] == [b"x", b"y"]
    assert got["d"] == ["Broken: no page tree"] and got["e"] == ["ValueError: no pages"]
    tree = extract.page_tree(df.where("key <> 'c'")).orderBy("key", "page_no").collect()
    assert [(r["key"], r["object"]) for r in tree if r["key"] in "ad"] == [("a", 3), ("d", None)] and sum(r["key"] == "b" for r in tree) == 200
    first = next(r for r in tree if r["key"] == "a")["ranges"][0]
    assert rows[0][1][first["start"] : first["start"] + first["length"]] == b"first"
