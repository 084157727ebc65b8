import gzip
import hashlib
import io

import pytest

from quarry.llm import warc


def expected(pages):
    first = {}
    for p, _, h in pages:
        h = (h or "").encode()
        if len(h) >= 100 and p is not None:
            first[h] = min(p, first.get(h, p))
    out = []
    for p, _, h in pages:
        h = (h or "").encode()
        again = h in first and p != first[h] and sum((x[2] or "").encode() == h for x in pages) > 1
        out.append((p, len(h), hashlib.sha256(h).hexdigest(), "revisit" if again else "response", first[h] if again else None))
    return sorted(out, key=str)


def test_round_trip(frame, spark):
    big = "é" * 400_000
    pages = [(1, "http://a", "x" * 150), (2, "http://b\r\nX: y", "x" * 150), (3, None, "x" * 99), (4, "u", "x" * 99),
             (5, "u", None), (6, "u", ""), (9, "u", big), (8, "u", big), (10, "u", "\r\n\r\nWARC/1.1\r\n" * 20), (11, "u", "q" * 100),
             (12, "u", "r" * 200), (12, "u", "r" * 200)]
    df = frame([(*p, "x") for p in pages], "page_id long, url string, html string, digest string").repartition(3)
    manifest = warc.write(df)
    chunks = warc.read(manifest)
    got = sorted((tuple(r) for r in warc.payloads(chunks).collect()), key=str)
    assert got == expected(pages) and manifest.agg({"records": "sum"}).first()[0] == len(pages)
    # The chunks of one payload: bounded pieces, running digests, and the whole when joined.
    rows = sorted((r for r in chunks.where("record_id like '<urn:page:8:%'").collect()), key=lambda r: r.chunk)
    assert len(rows) == 4 and all(len(r.data) <= warc.CHUNK for r in rows) and [r.last for r in rows] == [False] * 3 + [True]
    data = b""
    for i, r in enumerate(rows):
        data += bytes(r.data)
        assert r.chunk == i and r.bytes_so_far == len(data) and r.digest_so_far == hashlib.sha256(data).hexdigest()
    assert data.decode() == big
    # Each file is a series of gzip members of well-formed records.
    _, path = warc._storage(manifest.first().path)
    whole = gzip.decompress(open(path, "rb").read())
    assert whole.startswith(b"WARC/1.1\r\nWARC-Type: ") and whole.endswith(b"\r\n\r\n")


def test_files_roll_over(frame):
    df = frame([(i, "u", f"{i}" * 500) for i in range(20)], "page_id long, url string, html string").coalesce(1)
    manifest = warc.write(df, rule=warc.Rule(roll=1))
    assert manifest.count() == 20 and warc.read(manifest).where("last").count() == 20


def test_empty_and_broken(frame):
    manifest = warc.write(frame([], "page_id long, url string, html string"))
    assert manifest.count() == 0 and warc.payloads(warc.read(manifest)).count() == 0
    good = gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <x>\r\nContent-Length: 9\r\n\r\nH: 1\r\n\r\nab")
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(good)))
