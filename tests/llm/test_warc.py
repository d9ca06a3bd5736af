import base64
import glob
import gzip
import hashlib

import pytest

from kinomill.llm import warc

PAGES = [
    (5, "http://a/1", "<p>one</p>"),
    (2, "http://a/2", "<p>one</p>"),
    (9, None, "<p>one</p>"),
    (3, "http://b/\r\nX: y", "ünï\r\n\r\nWARC/1.1\r\n"),
    (4, "u", None),
    (6, "u", ""),
    (7, "u", "x" * 3_000_000),
    (8, "u", "y"),
    (8, "u", "y"),
    (None, "n", "only"),
]


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warc"))
    pages = spark.createDataFrame([(*p, "sha", "head") for p in PAGES], "page_id long, url string, html string, sha256 string, head string")
    warc.write_archive(pages, f"{root}/archive", "2024-01-01T00:00:00Z")
    made = warc.Store(spark, f"{root}/store")
    made.add(warc.read_archive(spark, f"{root}/archive"))
    return made, root


def test_described(store):
    got = sorted((r["page_id"] or 0, r["payload_bytes"], r["sha1"], r["record_type"], r["refers_to"]) for r in store[0].described().collect())
    first = {}
    for page, _, html in sorted(PAGES, key=lambda p: (p[0] is None, p[0])):
        first.setdefault(html or "", page)
    want = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        own = first[html or ""] == page
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((page or 0, len(data), digest, "response" if own else "revisit", None if own else first[html or ""]))
    assert got == sorted(want, key=lambda x: tuple(x[:4]))


def test_records_come_back_byte_for_byte(store):
    made, root = store
    written = b"".join(gzip.open(f).read() for f in sorted(glob.glob(f"{root}/archive/*.gz")))
    rebuilt = made.rebuilt().collect()
    assert len(rebuilt) == len(PAGES) and sum(len(r["record"]) for r in rebuilt) == len(written)
    assert all(bytes(r["record"]) in written for r in rebuilt)
    payloads = sorted(bytes(r["full_payload"]) for r in rebuilt)
    assert payloads == sorted((p[2] or "").encode() for p in PAGES)
    assert made.payloads().count() == len({p[2] or "" for p in PAGES})


def test_small_payloads_are_never_shared(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    heads = {(r["page_id"], r["head"]) for r in warc.decide(pages, min_bytes=11).collect()}
    assert (5, 5) in heads and (6, 6) in heads


def test_damage_is_an_error():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    assert [x[2] for x in warc.parse_records(record)] == [b"hello"]
    assert [x[2] for x in warc.parse_records(gzip.compress(record) + gzip.compress(record))] == [b"hello"] * 2
    with pytest.raises(ValueError):
        list(warc.parse_records(record[:-6]))


def test_wrong_digest_stops(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, "response", None, "A", "B", b"h", b"p", 1, "A", "C")], warc.RECORD_SCHEMA
    )
    with pytest.raises(Exception, match="differs from its digest"):
        warc.Store(spark, str(tmp_path)).add(rows)


def test_empty(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archive(pages, str(tmp_path / "a"), "d")
    made = warc.Store(spark, str(tmp_path / "s"))
    made.add(warc.read_archive(spark, str(tmp_path / "a")))
    assert made.described().collect() == []


def test_archives_added_one_after_the_other(spark, tmp_path):
    """Payloads that are stored already are not stored again; an addition that is made again replaces itself."""
    made = warc.Store(spark, str(tmp_path / "store"))
    for name, pages in (("a", PAGES), ("b", [(20, "u", "y"), (21, "u", "<p>one</p>"), (22, "u", "new")])):
        df = spark.createDataFrame(pages, "page_id long, url string, html string")
        warc.write_archive(df, str(tmp_path / name), "2024-01-01T00:00:00Z")
        made.add(warc.read_archive(spark, str(tmp_path / name)), name)
    assert made.described().count() == made.rebuilt().count() == len(PAGES) + 3
    assert made.payloads().count() == made.payloads().select("sha256").distinct().count()
    before = sorted(bytes(r["record"]) for r in made.rebuilt().collect())
    # As after a crash between the two writes, or after both: payloads are there, the headers are written (again).
    made.add(warc.read_archive(spark, str(tmp_path / "b")), "b")
    assert sorted(bytes(r["record"]) for r in made.rebuilt().collect()) == before


def _record(kind, body, *fields):
    head = "\r\n".join(["WARC/1.0", f"WARC-Type: {kind}", *fields, f"Content-Length: {len(body)}"])
    return head.encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def test_archives_of_other_writers(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\n\r\n"
    sha1 = hashlib.sha1(b"page").hexdigest()
    records = [
        _record("warcinfo", b"software: x", "Content-Type: application/warc-fields"),
        _record("request", b"GET / HTTP/1.1\r\n\r\n", "Content-Type:application/http"),
        _record("response", http + b"page", "Content-Type: application/http", f"WARC-Payload-Digest: sha1:{sha1}"),
        _record("revisit", http, "Content-Type: application/http", f"WARC-Payload-Digest: sha1:{sha1}"),
        _record("revisit", http, "Content-Type: application/http"),
        _record("resource", b"\x00\xff bytes", "WARC-Payload-Digest: md5:abc"),
        _record("metadata", b""),
    ]
    folder = tmp_path / "foreign"
    folder.mkdir()
    (folder / "x.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    made = warc.Store(spark, str(tmp_path / "store"))
    made.add(warc.read_archive(spark, str(folder)))
    assert sorted(bytes(r["record"]) for r in made.rebuilt().collect()) == sorted(records)
    full = [bytes(r["full_payload"]) if r["full_payload"] is not None else None for r in made.rebuilt().where("record_type = 'revisit'").collect()]
    assert sorted(full, key=str) == [None, b"page"] or sorted(full, key=str) == [b"page", None]
    assert made.described().count() == len(records)
