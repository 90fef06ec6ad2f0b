import gzip
import hashlib
import os
import pathlib
import random
import tempfile

import pytest

from tidyspark.llm import warc

SCHEMA = "page_id long, url string, html string, node string, payload string, of_digest string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "n", "p", "d") for r in rows], SCHEMA)


def record(i, body, **change):
    digest = hashlib.sha1(body).hexdigest()
    return warc.record_bytes(i, f"http://x/{i}", body, digest, None, True)


def test_round_trip_cases(spark):
    big = "é" * 600
    rows = [(1, "u", None), (2, "u", ""), (3, "a\r\nb", big), (9, "u", big), (5, "u", big), (9, "u", big),
            (6, "u", "short"), (7, "u", "short"), (None, "u", big), (8, None, "WARC/1.1\r\nx: y\r\n\r\n" * 200),
            (10, "u", "y" * 1_500_000)]
    path = os.path.join(tempfile.mkdtemp(prefix="warc-"), "a")
    warc.write_archives(warc.plan_records(pages(spark, rows)), path, records_per_archive=3)
    read = warc.read_archives(spark, path).collect()
    assert {r.kind for r in read} == {"record"} and len(read) == len(rows)
    got = {}
    for r in read:
        got.setdefault(r.record_id, []).append(r)
    for i in (3, 5, None):
        assert got[i][0].record_type == "revisit" and got[i][0].refers_to == 9 and got[i][0].payload == b""
    assert [r.record_type for r in got[9]] == ["response"] * 2
    assert all(got[i][0].record_type == "response" for i in (1, 2, 6, 7, 8, 10))
    for i, _, html in rows:
        body = (html or "").encode()
        for r in got[i]:
            assert r.payload_bytes == len(body) and r.payload_digest == hashlib.sha1(body).hexdigest()
            assert r.record_type == "revisit" or bytes(r.payload) == body
    assert got[3][0].url == "a b"


def test_empty_table(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="warc-"), "a")
    warc.write_archives(warc.plan_records(pages(spark, [])), path)
    assert warc.read_archives(spark, path).where("kind = 'record'").count() == 0


def test_archives_are_ordinary_gzip_members(spark):
    path = tempfile.mkdtemp(prefix="warc-") + "/a"
    warc.write_archives(warc.plan_records(pages(spark, [(1, "u", "one"), (2, "u", "two")])).coalesce(1), path)
    data = b"".join(open(os.path.join(path, f), "rb").read() for f in os.listdir(path) if f.startswith("part"))
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 2


def summary(data):
    found = list(warc.salvage(data))
    assert all(a[2] <= b[1] or a[1:3] == b[1:3] for a, b in zip(found, found[1:]))
    return ([int(f[3]["warc-record-id"][12:-1]) for f in found if f[0] == "record"],
            [f[1:4] for f in found if f[0] == "gap"])


def test_salvage_members():
    members = [gzip.compress(record(i, b"body %d " % i * 40)) for i in range(6)]
    starts = [sum(map(len, members[:i])) for i in range(7)]
    assert summary(b"".join(members)) == (list(range(6)), [])
    broken = members[2][:40] + b"\0\0\0\0" + members[2][44:]
    ids, gaps = summary(b"".join([*members[:2], broken, *members[3:]]))
    assert ids == [0, 1, 3, 4, 5] and [g[:2] for g in gaps] == [(starts[2], starts[3])] and "gzip" in gaps[0][2]
    ids, gaps = summary(b"junk" + b"".join(members)[:-9])                 # dirt before, cut off behind
    assert ids == [0, 1, 2, 3, 4] and [g[:2] for g in gaps] == [(0, 4), (starts[5] + 4, starts[6] + 4 - 9)]
    assert summary(b"") == ([], []) and summary(b"\0" * 50)[1][0][:2] == (0, 50)


def test_salvage_plain_records():
    plain = [record(i, b"text %d\r\n\r\nmore" % i) for i in range(5)]
    wrong_length = plain[1].replace(b"Content-Length: 14", b"Content-Length: 99")
    wrong_digest = plain[3].replace(b"text 3", b"text 8")
    no_colon = plain[2].replace(b"Content-Type:", b"Content-Type ")
    assert wrong_length != plain[1] and no_colon != plain[2]
    ids, gaps = summary(b"".join([plain[0], wrong_length, plain[2], wrong_digest, plain[4]]))
    assert ids == [0, 2, 4] and [g[2] for g in gaps] == ["no end of record at the declared length",
                                                         "payload digest differs"]
    assert summary(plain[0] + no_colon + gzip.compress(plain[4])) [0] == [0, 4]


def test_salvage_never_loses_undamaged_records():
    r = random.Random(4)
    members = [gzip.compress(record(i, bytes(r.randrange(256) for _ in range(r.randrange(300))))) for i in range(12)]
    starts = [sum(map(len, members[:i])) for i in range(13)]
    for _ in range(200):
        data, at, size = bytearray(b"".join(members)), r.randrange(starts[-1]), r.randrange(1, 60)
        for k in range(at, min(at + size, len(data))):
            data[k] ^= r.randrange(1, 256)
        ids, gaps = summary(bytes(data))
        untouched = [i for i in range(12) if starts[i + 1] <= at or starts[i] >= at + size]
        assert [i for i in ids if i in untouched] == untouched
        covered = sum(g[1] - g[0] for g in gaps)
        assert covered == sum(starts[i + 1] - starts[i] for i in range(12) if i not in ids)


def test_salvage_inside_members_of_many_records():
    plain = [record(i, random.Random(i).randbytes(400)) for i in range(6)]
    bad = plain[2].replace(b"Content-Type:", b"Content-Type ")
    member, last = gzip.compress(b"".join([*plain[:2], bad, *plain[3:]])), gzip.compress(record(9, b"last"))
    ids, gaps = summary(member + last)
    assert ids == [0, 1, 3, 4, 5, 9] and [g[:2] for g in gaps] == [(0, len(member))]
    start = len(plain[0] + plain[1])
    assert gaps[0][2] == f"header without a colon, inflated bytes {start} to {start + len(bad)}"
    whole = gzip.compress(b"".join(plain))
    cut = whole[:len(whole) * 3 // 4]
    for tail in (b"", last):
        ids, gaps = summary(cut + tail)
        assert ids == [0, 1, 2, 3] + [9] * bool(tail)
        assert len(gaps) == 1 and len(cut) // 2 < gaps[0][0] < gaps[0][1] == len(cut) and "gzip" in gaps[0][2]
    wrong_sum = whole[:-8] + bytes([whole[-8] ^ 1]) + whole[-7:]
    ids, gaps = summary(wrong_sum + last)
    assert ids == [0, 1, 2, 3, 4, 5, 9] and [g[:2] for g in gaps] == [(len(whole), len(whole))]


def http_record(i, block, payload, content_type=b"application/http; msgtype=response"):
    sha1 = [warc._base32(hashlib.sha1(x).hexdigest()).encode() for x in (payload, block)]
    return (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:record:%d>\r\nContent-Type: %s\r\n"
            b"WARC-Payload-Digest: sha1:%s\r\nWARC-Block-Digest: sha1:%s\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
            % (i, content_type, *sha1, len(block), block))


def test_digests_of_http_records():
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n"
    chunked = b"4\r\nsome\r\n6;x=y\r\n\r\n\r\nab\r\n0\r\n\r\n"
    good = [http_record(0, head + b"\r\npage", b"page"), http_record(1, head + b"\r\n", b""),
            http_record(2, head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked, b"some\r\n\r\nab"),
            http_record(3, head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked, chunked),
            http_record(4, b"as it is", b"as it is", b"text/plain")]
    assert summary(b"".join(good)) == (list(range(5)), [])
    wrong_page, wrong_head = good[0].replace(b"page", b"pale"), good[0].replace(b"200 OK", b"404 OK")
    other = http_record(5, head + b"\r\npage", b"other")
    for bad, why in ((wrong_page, "block"), (wrong_head, "block"), (other, "payload")):
        ids, gaps = summary(bad + good[1])
        assert ids == [1] and [g[2] for g in gaps] == [f"{why} digest differs"]


def test_gaps_are_logged(spark):
    folder = tempfile.mkdtemp(prefix="warc-")
    with open(os.path.join(folder, "x.warc"), "wb") as f:
        f.write(record(1, b"a") + b"dirt" + record(2, b"b"))
    rows = warc.read_archives(spark, folder).orderBy("start_byte").collect()
    assert [(r.kind, r.record_id) for r in rows] == [("record", 1), ("gap", None), ("record", 2)]
    assert rows[1].end_byte - rows[1].start_byte == 4 and rows[1].reason == "no version line"


@pytest.mark.parametrize("filler", [b"WARC/1.0\r\n", b"WARC/1.0\n", b"WARC/1.0\r\nA: b\r\n", b"\x1f\x8b\x08",
                                    b"\x1f\x8b\x08\x08", b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03"])
def test_salvage_time_grows_with_size(filler):
    import time

    def seconds(n):
        data = filler * (n // len(filler))
        t = time.process_time()
        found = list(warc.salvage(data + warc.record_bytes(1, "u", b"x", hashlib.sha1(b"x").hexdigest(), None, True)))
        assert [f[0] for f in found] == ["gap", "record"]
        return time.process_time() - t
    small = seconds(250_000)
    assert seconds(1_000_000) < 8 * small + 1.0


def test_archives_are_bounded_in_bytes(spark, tmp_store):
    import random
    rnd = random.Random(3)
    pages = spark.createDataFrame([(i, "u", "".join(rnd.choices("abcdefghijklmnop", k=20_000))) for i in range(60)],
                                  "page_id long, url string, html string").coalesce(1)
    warc.write_archives(warc.plan_records(pages), f"{tmp_store}/w", archive_bytes=200_000)
    files = [p for p in pathlib.Path(f"{tmp_store}/w").rglob("part-*")]
    assert len(files) > 1 and max(p.stat().st_size for p in files) < 250_000
    assert warc.read_archives(spark, f"{tmp_store}/w").where("kind = 'record'").count() == 60
