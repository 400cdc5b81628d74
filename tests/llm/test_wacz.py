import base64
import hashlib
import io
import zipfile
from collections import Counter, defaultdict

import pytest
from pyarrow import fs

from dwell.llm import wacz as W
from dwell.llm.queries import op6_warc
from tests.conftest import SF


def sha(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def brute(rows, min_bytes=0):
    first = defaultdict(list)
    for i, _, h in rows:
        first[h or ""].append(i)
    out = Counter()
    for i, _, h in rows:
        n = len((h or "").encode())
        win = min((x for x in first[h or ""] if x is not None), default=None)
        again = n >= min_bytes and win is not None and i != win
        out[i, n, sha(h), "revisit" if again else "response", win if again else None] += 1
    return out


def got(df):
    return Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


ROWS = [(1, "http://a/x y\r\nEvil: 1", "<p>é</p>"), (2, None, None), (3, "u", ""), (4, "u", "<p>é</p>"), (4, "u", "<p>é</p>"), (5, "v", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nb"), (None, "w", "<p>é</p>"), (None, "w", "lonely"), (None, "w", "lonely"), (6, "x", "q" * 300_000)]


def test_awkward(spark, monkeypatch):
    assert got(W.warc_round_trip(pages(spark, ROWS))) == brute(ROWS)
    assert got(W.warc_round_trip(pages(spark, ROWS), min_bytes=8)) == brute(ROWS, 8)
    back = {r.page_id: r for r in W.warc_round_trip(pages(spark, ROWS)).collect()}
    assert back[1].payload == "<p>é</p>".encode() and back[4].payload is None and "\r" not in back[1].url
    assert W.warc_round_trip(pages(spark, [])).count() == 0


def test_archives_are_zip_files(spark, tmp_path):
    table = W.write_archives(pages(spark, ROWS).coalesce(1), f"file://{tmp_path}").collect()
    n = 0
    for r in table:
        with zipfile.ZipFile(r.uri.removeprefix("file://")) as z:
            assert z.testzip() is None and set(z.namelist()) == {W.MEMBER, W.INDEX, W.PACKAGE} and all(i.compress_type == 0 for i in z.infolist())
            n += z.read(W.INDEX).count(b"\n")
    assert n == len(ROWS) == sum(r.n_records for r in table)


def test_small_slices(spark, tmp_path):
    rows = [(i, "u", "html %d" % (i % 7)) for i in range(50)]
    table = W.write_archives(pages(spark, rows).coalesce(2), f"file://{tmp_path}")
    assert got(W.read_archives(table, 3)) == brute(rows)


def of(data):
    return W.ZipReader(fs.LocalFileSystem().open_input_file(data)) if isinstance(data, str) else W.ZipReader(Wrapped(data))


class Wrapped(io.BytesIO):
    def size(self):
        return len(self.getvalue())


@pytest.mark.parametrize("zip64", [False, True])
@pytest.mark.parametrize("n", [0, 1, 70_000])
def test_directories(zip64, n):
    out = io.BytesIO()
    z = W.StoredZip(out, zip64)
    for i in range(n):
        z.add(f"ä/{i}", b"%d" % i)
    z.close()
    r = of(out.getvalue())
    assert len(r.members) == n
    for i in {0, n // 2, n - 1} if n else ():
        m = r.stored(f"ä/{i}")
        assert r.read(m.start, m.size) == b"%d" % i
    with zipfile.ZipFile(io.BytesIO(out.getvalue())) as other:
        assert len(other.namelist()) == n


def test_other_writers_comments_and_damage():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a", b"stored")
        z.writestr("b", b"packed" * 99, zipfile.ZIP_DEFLATED)
        z.comment = b"PK\5\6 looks like an end"
    r = of(out.getvalue())
    m = r.stored("a")
    assert r.read(m.start, m.size) == b"stored"
    with pytest.raises(ValueError, match="compressed"):
        r.stored("b")
    for bad in (b"", b"no zip at all" * 9, out.getvalue()[:-30]):
        with pytest.raises(ValueError):
            of(bad)
    with pytest.raises(ValueError, match="damaged"):
        good = W.record(1, "u", b"payload", W.sha1_32(b"other"), None, False)
        W._row(good)
    with pytest.raises(ValueError, match="length"):
        W.parsed(W.record(1, "u", b"x", "d", None, False)[:-1])


def package(zip64=False):
    """A small package as bytes, in the form that archives have."""
    out = io.BytesIO()
    z = W.StoredZip(out, zip64)
    data = W.gzipped(W.record(1, "http://a/", b"payload", W.sha1_32(b"payload"), None, False))
    z.add(W.MEMBER, data)
    z.add(W.INDEX, b"1 0 %d %s response\n" % (len(data), W.sha1_32(b"payload").encode()))
    z.close()
    return out.getvalue()


def read_all(data):
    r = of(data)
    return [W._row(W._record(r, r.stored(m), at, n)) for m, at, n in W.locators(r)]


@pytest.mark.parametrize("zip64", [False, True])
def test_every_truncation_and_flipped_bit_is_a_value_error_or_harmless(zip64):
    good = package(zip64)
    want = read_all(good)
    assert [(r[0], r[2]) for r in want] == [(1, b"payload")]
    for n in range(len(good)):
        with pytest.raises(ValueError):
            read_all(good[:n])
    for i in range(len(good)):
        for bit in range(8):
            bad = bytearray(good)
            bad[i] ^= 1 << bit
            try:
                read_all(bytes(bad))  # some bits say nothing of the records: dates, versions, counts of disks
            except ValueError:
                pass


def test_a_package_of_another_writer(spark, tmp_path):
    """Two archive members, a CDXJ index in two gzip members, a CDX index, deflated pages, and records without own fields."""
    rec = lambda url, body: ("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: %s\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n" % (url, len(body) + 19)).encode() + b"HTTP/1.1 200 OK\r\n\r\n" + body + b"\r\n\r\n"
    a, b, c = (W.gzipped(rec(f"http://{x}/", x.encode() * 9)) for x in "abc")
    line = lambda name, at, n: ('com,x)/ 20240101 {"url": "http://x/", "filename": "%s", "offset": "%d", "length": "%d"}\n' % (name, at, n)).encode()
    with zipfile.ZipFile(tmp_path / "other.wacz", "w") as z:
        z.writestr("archive/one.warc.gz", a + b)
        z.writestr("archive/two.warc.gz", c)
        z.writestr("indexes/index.cdxj.gz", W.gzipped(b'!meta {"format": "cdxj"}\n' + line("one.warc.gz", 0, len(a))) + W.gzipped(line("one.warc.gz", len(a), len(b))))
        z.writestr("indexes/more.cdx", b" CDX N b a m s k r M S V g\ncom,c)/ 20240101 http://c/ text/html 200 X - - %d 0 two.warc.gz" % len(c))
        z.writestr("pages/pages.jsonl", b"{}" * 99, zipfile.ZIP_DEFLATED)
    table = spark.createDataFrame([(f"file://{tmp_path}/other.wacz",)], "uri string")
    rows = sorted((r.url, bytes(r.payload), r.payload_bytes, r.page_id) for r in W.read_archives(table).collect())
    assert rows == [("http://a/", b"a" * 9, 9, None), ("http://b/", b"b" * 9, 9, None), ("http://c/", b"c" * 9, 9, None)]


def test_clashing_names_and_the_shuffled_way(spark, monkeypatch):
    monkeypatch.setattr(W, "BROADCAST_ROWS", 0)
    df = spark.createDataFrame([(*r, "k", 1, b"x") for r in ROWS], "page_id long, url string, html string, key string, first int, payload binary")
    assert got(W.warc_round_trip(df)) == brute(ROWS)


def test_query_over_the_whole_table(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert got(op6_warc(spark, SF)) == brute(rows)
