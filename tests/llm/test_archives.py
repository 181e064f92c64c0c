"""Archives as other writers make them: plain gzip members, one stream, no compression, all record types."""

import base64
import gzip
import hashlib
import io
import random

import pytest

from lumenlake.llm import warc
from lumenlake.llm.common import new_folder

PAGE = b"<html>" + "é".encode() * 300 + b"</html>"


def record(kind, block, number, *more, http=True):
    heads = [
        "WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{number}>", f"WARC-Date: 2026-01-0{number % 9 + 1}T00:00:00Z",
        f"Content-Type: {'application/http; msgtype=response' if http else 'text/plain'}", f"Content-Length: {len(block)}", *more,
    ]
    return "\r\n".join(heads).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def sha1(payload):
    return "WARC-Payload-Digest: sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload, step):
    parts = [payload[i : i + step] for i in range(0, len(payload), step)]
    return b"".join(b"%x;n=v\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


OK = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n"
RECORDS = [
    record("warcinfo", b"software: x\r\n", 0, http=False),
    record("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", 1, "WARC-Target-URI: http://a/1"),
    record("response", OK + b"\r\n" + PAGE, 2, "WARC-Target-URI: http://a/1", sha1(PAGE)),
    record("response", OK + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(PAGE, 100), 3, "WARC-Target-URI: http://a/2", sha1(PAGE)),
    record("response", OK + b"Transfer-Encoding: chunked\r\n\r\n" + PAGE, 4, "WARC-Target-URI: http://a/3"),  # freed of its chunks, head unchanged
    record("revisit", b"HTTP/1.1 304 Not Modified\r\n\r\n", 5, "WARC-Target-URI: http://a/4", "WARC-Refers-To: <urn:uuid:2>"),
    record("revisit", b"", 6, "WARC-Target-URI: http://a/5"),
    record("response", b"HTTP/1.1 200 OK", 7, "WARC-Target-URI: http://a/6"),  # no end of its head
    record("conversion", b"plain text", 8, "WARC-Target-URI: http://a/1", "WARC-Payload-Digest: md5:00", http=False),
    record("response", OK + b"X-Name: caf\xe9\r\n folded: line\r\n\r\n", 9, "WARC-Target-URI: http://a/7"),
]
EXPECTED = {
    0: ("warcinfo", None, b"software: x\r\n"), 1: ("request", "http://a/1", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n"),
    2: ("response", "http://a/1", PAGE), 3: ("response", "http://a/2", PAGE), 4: ("response", "http://a/3", PAGE),
    5: ("revisit", "http://a/4", None), 6: ("revisit", "http://a/5", None), 7: ("response", "http://a/6", b"HTTP/1.1 200 OK"),
    8: ("conversion", "http://a/1", b"plain text"), 9: ("response", "http://a/7", b""),
}
FORMS = {
    "members.warc.gz": b"".join(gzip.compress(r) for r in RECORDS),
    "stream.warc.gz": gzip.compress(b"".join(RECORDS)),
    "padded.warc.gz": b"".join(gzip.compress(r) for r in RECORDS) + b"\0" * 40,
    "plain.warc": b"".join(RECORDS),
}


def put(folder, files):
    store, root = warc.pafs.FileSystem.from_uri(folder)
    for name, data in files.items():
        store.create_dir(f"{root}/{name}".rsplit("/", 1)[0], recursive=True)
        with store.open_output_stream(f"{root}/{name}", compression=None) as stream:
            stream.write(data)


def shown(rows):
    found = {}
    for r in rows:
        number = int(r.record_id.removeprefix("urn:uuid:"))
        assert number not in found and r.page_id is None and r.refers_to is None
        found[number] = (r.record_type, r.target_uri, None if r.payload is None else bytes(r.payload))
    return found


@pytest.mark.parametrize("name", FORMS)
def test_every_form_reads_alike(spark, name):
    folder = new_folder(spark, "foreign")
    put(folder, {f"2026/01/{name}": FORMS[name], "2026/index.cdx": b"no archive"})
    rows = warc.read_archives(spark, folder, verify="true").collect()
    assert shown(rows) == EXPECTED
    sizes = {int(r.record_id[-1]): r.payload_bytes for r in rows}
    assert sizes[2] == len(PAGE) and sizes[3] == len(chunked(PAGE, 100)) and sizes[5] is None and sizes[6] is None
    assert {r.record_date for r in rows if r.record_id == "urn:uuid:2"} == {"2026-01-03T00:00:00Z"}


def test_filters_and_payloads_of_foreign_archives(spark):
    folder = new_folder(spark, "foreign")
    put(folder, FORMS)
    found = warc.read_archives(spark, folder).where("record_type = 'response' and target_uri >= 'http://a/3'")
    assert "Filter (" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.target_uri for r in found.collect()) == sorted(["http://a/3", "http://a/6", "http://a/7"] * 4)
    bare = warc.read_archives(spark, folder, payload="none").collect()
    assert len(bare) == 40 and not [r for r in bare if r.payload is not None]


def test_large_records_that_are_not_wanted_pass_by():
    """Ten megabytes between two small records, read in pieces and never kept."""
    noise = random.Random(2).randbytes(10 << 20)
    data = gzip.compress(RECORDS[2] + record("response", OK + b"\r\n" + noise, 5) + RECORDS[3], 1)
    largest = 0
    numbers = []
    for r in warc.read_members(io.BytesIO(data)):
        numbers.append(r.fields["record_id"])
        largest = max(largest, len(r._plain.buffer))
    assert numbers == ["urn:uuid:2", "urn:uuid:5", "urn:uuid:3"] and largest < 1 << 20
    kept = [r.payload() for r in warc.read_members(io.BytesIO(data))]
    assert kept == [PAGE, noise, PAGE]


def test_members_with_lengths_may_be_followed_by_others():
    own = warc.encode_record(7, "u", "response", None, "d", 3, b"abc")
    found = list(warc.read_members(io.BytesIO(own + FORMS["members.warc.gz"])))
    assert [r.fields["page_id"] for r in found] == [7] + [None] * 10
    assert [r.fields["record_type"] for r in found[1:]] == [EXPECTED[i][0] for i in range(10)]


@pytest.mark.parametrize("cut", [30, 200, len(FORMS["members.warc.gz"]) - 12])
def test_cut_archives_fail(cut):
    with pytest.raises(EOFError):
        list(warc.read_members(io.BytesIO(FORMS["members.warc.gz"][:cut])))
    with pytest.raises(EOFError):
        list(warc.read_members(io.BytesIO(FORMS["plain.warc"][: cut + 20])))


def test_other_bytes_and_wrong_digests_fail(spark):
    with pytest.raises(ValueError, match="no record"):
        list(warc.read_members(io.BytesIO(b"no archive at all, but a text")))
    assert list(warc.read_members(io.BytesIO(b""))) == []
    folder = new_folder(spark, "foreign")
    put(folder, {"a.warc": record("response", OK + b"\r\n" + PAGE, 1, sha1(b"other"))})
    assert warc.read_archives(spark, folder).count() == 1
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_archives(spark, folder, verify="true").collect()


def test_chunks_of_any_size():
    body = random.Random(3).randbytes(5000)
    for step in (1, 7, 999, 5000):
        assert warc._without_chunks(chunked(body, step)) == body
    for odd in (b"", b"0\r\n", b"zz\r\nabc", chunked(body, 100)[:-9], body):
        assert warc._without_chunks(odd) == (b"" if odd == b"0\r\n" else odd)
