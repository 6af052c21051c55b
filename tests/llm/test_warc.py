"""Archives: ARC of both versions read by declared lengths, converted, written and read back."""
import gzip
import hashlib

import pytest

from barloom.llm import warc

DDL = "page_id long, url string, html string"


def through(spark, tmp_path, rows, parts=3):
    arc, out = str(tmp_path / "arc"), str(tmp_path / "warc")
    warc.write_arc(spark.createDataFrame(rows, DDL).repartition(parts), arc)
    warc.convert(spark, arc, out)
    return warc.read_warc(spark, out), arc, out


def plain(rows):
    bodies = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, b in bodies:
        if i is not None and len(b) >= 100:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, b in bodies:
        f = first.get(b)
        again = f is not None and f != i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    long = "<p>" + "x é \r\n\r\nWARC/1.0\r\n http://a.b 1.1.1.1 2 text/html 5\n" * 9
    rows = [(i, f"http://h/{i}", long if i % 3 == 0 else f"<p>{i}" * 60) for i in range(50)]
    rows += [(100, None, None), (101, "http://with blank\t/ü", ""), (102, "u", "short"), (103, "u", "short"), (None, "u", long), (104, "big", "y" * 3_000_000), (7, "u", f"<p>{7}" * 60), (105, "", "\n\n")]
    got, _, _ = through(spark, tmp_path, rows)
    assert sorted(map(tuple, got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str) == plain(rows)
    ids = [r["record_id"] for r in got.where("page_id IS NOT NULL AND page_id <> 7").collect()]
    assert len(set(ids)) == len(ids) and all(r["warc_date"] == "2000-01-01T00:00:00Z" for r in got.collect())


def test_copies_without_a_page_id_stay_responses(spark, tmp_path):
    rows = [(None, "u", "z" * 200), (None, "v", "z" * 200)]
    got, _, _ = through(spark, tmp_path, rows)
    assert [r["record_type"] for r in got.collect()] == ["response", "response"]


def test_empty_table(spark, tmp_path):
    got, _, _ = through(spark, tmp_path, [])
    assert got.count() == 0


def test_files_are_archives(spark, tmp_path):
    rows = [(i, f"http://h/{i}", "<p>page</p>" * 20 + str(i % 2)) for i in range(6)]
    _, arc, out = through(spark, tmp_path, rows, parts=2)
    import glob
    texts = [gzip.open(f).read() for f in sorted(glob.glob(arc + "/part-*"))]
    assert {t.split(b"\n")[1][:1] for t in texts} == {b"1", b"2"} and all(t.startswith(b"filedesc://") for t in texts)
    records = [x for f in glob.glob(out + "/part-*") for x in warc.warc_records(gzip.open(f).read())]
    assert len(records) == 6 and all(b"WARC-Block-Digest: sha256:" + hashlib.sha256(b).hexdigest().encode() in h for h, b in records)
    revisits = [h for h, _ in records if b"WARC-Type: revisit" in h]
    named = {warc._field(h, b"WARC-Record-ID") for h, _ in records}
    assert len(revisits) == 4 and all(warc._field(h, b"WARC-Refers-To") in named and warc.SAME_PAYLOAD.encode() in h for h in revisits)


V1 = b"filedesc://a.arc 0.0.0.0 19990101 text/plain 77\n1 0 org\nURL IP-address Archive-date Content-type Archive-length\n"
V1 = V1.replace(b" 77\n", b" %d\n" % len(V1.split(b"\n", 1)[1]))


def test_headers_by_version():
    body = b"HTTP/1.0 404 Not Found\r\nX-Page-Id: 12\r\n\r\nline\n\nhttp://not.a/header 1 2 3 4\n"
    content = V1 + b"\nhttp://x.y/ 1.2.3.4 19990203040506 text/html %d\n" % len(body) + body + b"\nftp://z 1.2.3.4 1999 text/plain 3\nabc\n"
    for data in (content, gzip.compress(content), gzip.compress(content[:90]) + gzip.compress(content[90:])):
        a, b = warc.arc_records(data, "f")
        assert (a["uri"], a["page_id"], a["status"], a["payload"]) == ("http://x.y/", 12, 404, body.split(b"\r\n\r\n", 1)[1])
        assert (b["uri"], b["head"], b["payload"], b["page_id"]) == ("ftp://z", b"", b"abc", None)
        assert warc._iso(a["stamp"]) == "1999-02-03T04:05:06Z" and warc._iso(b["stamp"]) == "1999-01-01T00:00:00Z"
    block = b"2 0 org\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
    v2 = b"filedesc://b.arc 0.0.0.0 1999 text/plain 200 - - 0 b.arc %d\n" % len(block) + block + b"\nhttp://q 1.1.1.1 2001 text/html 301 abc http://r 99 b.arc 4\nxyzw\n"
    (r,) = warc.arc_records(v2, "f")
    assert (r["uri"], r["status"], r["payload"]) == ("http://q", 301, b"xyzw")
    with pytest.raises(ValueError):
        list(warc.arc_records(V1 + b"\nhttp://x 1.1.1.1 1999 text/html 200 x - 0 f 3\nabc\n", "f"))
    with pytest.raises(ValueError):
        list(warc.arc_records(V1 + b"\nhttp://x 1.1.1.1 1999 text/html 30\nabc\n", "f"))


def test_extra_columns_are_not_read(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "h" * 120, b"d", 3)], DDL + ", digest binary, payload long")
    warc.write_arc(df, str(tmp_path / "a"))
    warc.convert(spark, str(tmp_path / "a"), str(tmp_path / "w"))
    assert warc.read_warc(spark, str(tmp_path / "w")).count() == 1
