import hashlib
import base64

import pytest

from tracewell.llm import warc


def sha(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, _largest string")


def test_revisits_name_the_largest_page(spark):
    rows = [(1, "http://a/", "<p>x</p>", "k"), (5, "http://b/", "<p>x</p>", "k"), (3, None, "<p>x</p>", "k"), (4, "u\r\nv", None, "k"), (2, "u", "", "k"), (9, "u", "é", "k")]
    got = {r.record_id: r for r in warc.read(warc.write(pages(spark, rows)), with_payload=True).collect()}
    page = lambda k: got[f"<urn:page:{k}>"]
    assert len(got) == 6
    assert (page(5).warc_type, page(5).refers_to, page(5).payload) == ("response", None, b"<p>x</p>")
    for k in (1, 3):
        assert (page(k).warc_type, page(k).refers_to, page(k).payload_bytes, page(k).payload_digest) == ("revisit", "<urn:page:5>", 8, sha("<p>x</p>"))
    assert (page(4).warc_type, page(4).payload_bytes, page(4).payload_digest) == ("response", 0, sha(""))
    assert (page(2).warc_type, page(2).refers_to) == ("revisit", "<urn:page:4>")
    assert page(9).payload_bytes == 2


def test_small_payloads_are_all_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.record_id: r.warc_type for r in warc.read(warc.write(df, least=4)).collect()}
    assert list(got[f"<urn:page:{k}>"] for k in (1, 2, 3, 4)) == ["response", "response", "revisit", "response"]


def test_no_page(spark):
    df = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.read(warc.write(df)).collect() == []


def record(k, packed=True):
    body = f"<p>{k}</p>".encode() * 50
    data = warc.page_record(str(k), "http://x/", body, warc.digest(body), None)
    return warc.member(data) if packed else data


def damage(data, at, n=20):
    return data[:at] + b"\0" * n + data[at + n :]


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("how", ["middle", "head", "cut", "junk", "length"])
def test_salvage_recovers_what_follows(packed, how):
    parts = [record(k, packed) for k in range(6)]
    bad = parts[2]
    bad = {"middle": damage(bad, len(bad) // 2), "head": damage(bad, 0), "cut": bad[: len(bad) // 2], "junk": b"\x1f\x8b\x08WARC/1.1\r\nnoise" + bad, "length": bad[:-7]}[how]
    data = b"".join([*parts[:2], bad, *parts[3:]])
    found = list(warc.salvage(data))
    assert found[0].start == 0 and found[-1].end == len(data) and all(a.end == b.start for a, b in zip(found, found[1:]))
    ids = [r.headers["warc-record-id"] for r in found if isinstance(r, warc.Record)]
    want = [f"<urn:page:{k}>" for k in range(6) if k != 2 or how == "junk"]
    assert ids == want and sum(isinstance(r, warc.Gap) for r in found) >= 1


def test_gap_log(spark, tmp_path):
    data = record(1) + b"garbage" + record(2)
    (tmp_path / "a.warc.gz").write_bytes(data)
    files = spark.createDataFrame([(f"file://{tmp_path}", "a.warc.gz")], "folder string, name string")
    (gap,) = warc.read(files, gaps=True).collect()
    assert data[gap.start : gap.end] == b"garbage" and warc.read(files).count() == 2
    (tmp_path / "b.warc.gz").write_bytes(b"")
    assert warc.read(spark.createDataFrame([(f"file://{tmp_path}", "b.warc.gz")], "folder string, name string")).count() == 0


def test_names_of_extra_columns_do_not_matter(spark):
    rows = [(k, "u", "same" if k < 3 else f"own {k}", "x", 7, "y", "z") for k in range(5)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, _largest string, _sha1 int, _refers string, sha1 string")
    got = {r.record_id: (r.warc_type, r.refers_to) for r in warc.read(warc.write(df)).collect()}
    assert got == {f"<urn:page:{k}>": ("revisit", "<urn:page:2>") if k < 2 else ("response", None) for k in range(5)}


def test_headers_and_payloads_of_any_length(spark):
    long_url, big = "http://x/" + "u" * (2 << 20), "<p>" + "p" * 30_000_000
    rows = [(1, long_url, "a"), (2, "u", big), (3, "u", "b"), (4, long_url, "b")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(1)
    got = {r.record_id: r for r in warc.read(warc.write(df)).collect()}
    assert {k: (r.warc_type, r.payload_bytes, r.payload_digest) for k, r in got.items()} == {
        "<urn:page:1>": ("response", 1, sha("a")),
        "<urn:page:2>": ("response", len(big), sha(big)),
        "<urn:page:3>": ("revisit", 1, sha("b")),
        "<urn:page:4>": ("response", 1, sha("b")),
    }
    assert got["<urn:page:1>"].target_uri == long_url


def test_large_payload_in_one_member():
    body = b"x" * (100 << 20)
    data = warc.member(warc.page_record("1", "u", body, warc.digest(body), None)) + record(2)
    first, second = warc.salvage(data)
    assert first.payload == body and second.headers["warc-record-id"] == "<urn:page:2>"


def test_reading_costs_in_proportion_to_the_file(monkeypatch):
    taken = 0
    real = warc.zlib.decompressobj

    class Counting:
        def __init__(self, bits):
            self.inner = real(bits)

        def decompress(self, part):
            nonlocal taken
            taken += len(part)
            return self.inner.decompress(part)

        def __getattr__(self, name):
            return getattr(self.inner, name)

    monkeypatch.setattr(warc.zlib, "decompressobj", Counting)
    data = b"".join(record(k) for k in range(3000))
    assert sum(isinstance(r, warc.Record) for r in warc.salvage(data)) == 3000
    assert taken <= len(data) + 3000 * warc.FIRST_SLICE
