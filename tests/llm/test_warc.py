"""Archives: round trip, roles, framing, broken files."""

import base64
import gzip
import hashlib
import io
import random
import re
import zlib

import pytest

from uptrail.llm import warc


def pages():
    rng = random.Random(1)
    big = "".join(rng.choice("abcdefgh <>\r\n") for _ in range(700_000))
    return [(1, "https://a.org/x", "<p>one</p>", 0), (2, None, None, 0), (3, "http://b.org/ü y\r\nz", "<p>one</p>", 0), (4, "u", "", 0),
            (5, "u", big, 0), (6, "u", "\r\n\r\nWARC/1.1\r\n\r\n", 0), (7, "u", "é漢\U0001F600", 0), (8, "u", "<p>one</p>", 0),
            (9, "u", "<p>two</p>", 0), (9, "u", "<p>two</p>", 0), (None, "u", "lone", 0), (None, "u", "<p>one</p>", 0)]


def plain(rows, least):
    """(key, bytes, digest, type, refers) of each row."""
    first = {}
    for key, _, html, _ in rows:
        data = (html or "").encode()
        if len(data) >= least and key is not None:
            first[data] = max(first.get(data, key), key)
    out = []
    for key, _, html, _ in rows:
        data = (html or "").encode()
        lead = first.get(data, key)
        revisit = len(data) >= least and lead != key
        out.append(("" if key is None else str(key), len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if revisit else "response", str(lead) if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5, 10 ** 7])
def test_round_trip(spark, least):
    df = spark.createDataFrame(pages(), "page_id long, url string, html string, file int")
    got = warc.round_trip(df, least=least).collect()
    assert sorted(((r["key"], r["payload_bytes"], r["payload_digest"], r["type"], r["refers"]) for r in got), key=str) == plain(pages(), least)


def test_payloads_come_back(spark):
    df = spark.createDataFrame(pages(), "page_id long, url string, html string, file int").repartition(3)
    folder = warc.scratch(spark, "warc-test")
    back = warc.read(warc.write(df, folder, least=10 ** 9), folder, payloads=True).collect()
    assert sorted(bytes(r["payload"]) for r in back) == sorted((p[2] or "").encode() for p in pages())
    assert len({(r["file"], r["place"]) for r in back}) == len(back)


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def archive():
    return [warc.record(str(i), f"http://h/{i}", data, "response", None) for i, data in enumerate([b"", b"a" * 200_000, b"last"])]


def test_members_in_small_reads_and_by_place():
    data = b"".join(archive())

    class Slow(io.BytesIO):
        def read(self, n=-1):
            return super().read(min(n, 7) if n > 0 else n)

    rows = list(warc.read_file(Slow(data), "f", payloads=True))
    assert [r["payload"] for r in rows] == [b"", b"a" * 200_000, b"last"]
    for row in rows:  # each record is a gzip member of its own
        text = zlib.decompressobj(31).decompress(data[row["place"]:])
        assert text.startswith(b"WARC/1.1\r\n")
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 3


@pytest.mark.parametrize("change", [
    lambda raw: raw.replace(b"last", b"lost"), lambda raw: raw[:-3],
    lambda raw: re.sub(rb"(\d)(\r\n\r\nHTTP)", lambda m: b"%d" % ((int(m[1]) + 9) % 10) + m[2], raw), lambda raw: raw.replace(b"WARC/1.1", b"WARC/9.9", 1),
    lambda raw: raw.replace(b"WARC-Payload-Digest: sha1:", b"WARC-Payload-Digest: sha1:X")])
def test_broken_records_are_errors(change):
    raw = gzip.decompress(warc.record("k", "u", b"last", "response", None))
    changed = change(raw)
    assert changed != raw
    with pytest.raises(warc.WarcError):
        list(warc.read_file(io.BytesIO(gzip.compress(changed)), "f"))


def test_cut_off_file_is_an_error():
    data = b"".join(archive())
    with pytest.raises((warc.WarcError, zlib.error)):
        list(warc.read_file(io.BytesIO(data[:-9]), "f"))
