import hashlib

import pytest

from vellum.llm import warc
from vellum.llm.common import checkpointed


def test_record_lines_of_both_versions():
    v1 = warc.parse_arc_line(b"http://a.b/x y 1.2.3.4 19990102030405 text/html 12\n", 1)
    assert v1["url"] == "http://a.b/x y" and v1["length"] == "12" and v1["date"] == "19990102030405"
    v2 = warc.parse_arc_line(b"http://a.b/ 1.2.3.4 20000101000000 text/html 200 abc - 77 f.arc 9\n", 2)
    assert (v2["status"], v2["checksum"], v2["offset"], v2["filename"], v2["length"]) == ("200", "abc", "77", "f.arc", "9")
    for bad in (b"http://a.b/ 1.2.3.4\n", b"http://a.b/ 1.2.3.4 1999 text/html x\n"):
        with pytest.raises(ValueError):
            warc.parse_arc_line(bad, 1)
    assert warc.warc_date("19990102030405") == "1999-01-02T03:04:05Z"
    assert warc.warc_date("1999") == "1999-01-01T00:00:00Z"
    digest = hashlib.sha1(b"x").hexdigest()
    assert warc.hex_digest(warc.base32_digest(digest)) == digest


def test_bodies_that_are_no_http_message():
    assert warc.split_http(b"20200101 dns record") == (b"", b"20200101 dns record", False)
    assert warc.split_http(b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nbody") == (b"HTTP/1.0 200 OK\r\nA: b\r\n\r\n", b"body", True)


def test_a_record_that_ends_early_is_an_error(tmp_path):
    import gzip

    path = str(tmp_path / "a.arc.gz")
    line = warc.arc_line(1, {"url": "http://a/", "ip": "0.0.0.0", "date": "2020", "mime": "text/html", "length": "99"})
    with open(path, "wb") as f:
        f.write(gzip.compress(warc.filedesc("a.arc", 1, "20200101000000") + line + b"short"))
    with pytest.raises(ValueError, match="ends early"):
        list(warc.arc_records(path))


def expected(rows):
    out, best = [], {}
    for i, html in rows:
        body = (html or "").encode()
        if len(body) >= 1000 and i is not None:
            best[body] = max(best.get(body, i), i)
    for i, html in rows:
        body = (html or "").encode()
        top = best.get(body)
        revisit = len(body) >= 1000 and top is not None and i != top
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


def test_round_trip_with_copies_nulls_and_long_pages(spark):
    rows = [(i, f"<p>page {i}</p>") for i in range(20)]
    rows += [(100 + i, "é" * 600) for i in range(30)] + [(200 + i, "x" * 999) for i in range(3)] + [(300 + i, "y" * 1000) for i in range(3)]
    rows += [(400, None), (401, ""), (402, "z" * 3_000_000), (None, "n" * 1500), (403, "n" * 1500), (404, "line\r\n\r\nWARC/1.1\r\n\r\n")]
    urls = [None, "http://a.b/c d", "http://ä.b/\n"]
    df = spark.createDataFrame([(i, urls[k % 3], h, "x") for k, (i, h) in enumerate(rows)], "page_id long, url string, html string, row_id string")
    manifest = warc.write_arc(df.repartition(6), file_bytes=50_000)
    assert {r.version for r in manifest.collect()} == {1, 2}
    back = checkpointed(warc.read_warc(warc.arc_to_warc(manifest)))
    ids = {r.record_id: r.row_id for r in back.collect()}
    assert len(ids) == len(rows)
    got = [(r.row_id, r.payload_bytes, r.payload_digest, r.record_type, ids.get(r.refers_id)) for r in back.collect()]
    assert sorted(got, key=str) == expected(rows)


def test_repeated_rows_have_one_response_and_empty_tables_no_rows(spark):
    df = spark.createDataFrame([(5, "http://a/", "q" * 2000)] * 4, "page_id long, url string, html string")
    kinds = [r.record_type for r in warc.read_warc(warc.arc_to_warc(warc.write_arc(df))).collect()]
    assert sorted(kinds) == ["response", "revisit", "revisit", "revisit"]
    assert warc.read_warc(warc.arc_to_warc(warc.write_arc(df.limit(0)))).count() == 0
