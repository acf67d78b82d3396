import base64
import hashlib
import io
import os
import struct

import pytest
import zstandard

from pairwright.llm import warc

SCHEMA = "page_id long, url string, html string"


def archive(records, dictionary=b"", compress_dictionary=False):
    out = b""
    options = {}
    if dictionary:
        options["dict_data"] = zstandard.ZstdCompressionDict(dictionary)
        raw = zstandard.ZstdCompressor().compress(dictionary) if compress_dictionary else dictionary
        out += struct.pack("<II", warc.DICTIONARY_MAGIC, len(raw)) + raw
    return out + b"".join(zstandard.ZstdCompressor(**options).compress(r) for r in records)


def record(payload=b"hello", kind="response"):
    return warc.record_bytes(kind, "urn:page:1", "urn:page:2", "http://a", "2024-01-01T00:00:00Z", payload,
                             warc.digest_of(payload))


@pytest.mark.parametrize("compress", [False, True])
def test_dictionary_from_the_leading_frame(compress):
    samples = [f"<html><body>{i} some page text {i * i}</body></html>".encode() * 20 for i in range(200)]
    raw = warc.dictionary_of(samples)
    assert raw
    stream = io.BytesIO(archive([record(s) for s in samples[:5]], raw, compress))
    parsed = [warc.parse_record(f) for f in warc.frames_of(stream)]
    assert [p["payload"] for p in parsed] == samples[:5]


def test_other_skippable_frames_and_no_dictionary():
    skip = struct.pack("<II", 0x184D2A51, 3) + b"abc"
    raw = skip + archive([record()]) + skip + archive([record(b"")])
    assert [warc.parse_record(f)["payload"] for f in warc.frames_of(io.BytesIO(raw))] == [b"hello", b""]
    assert list(warc.frames_of(io.BytesIO(b""))) == []


@pytest.mark.parametrize("raw", [b"abc", b"not a frame", archive([record()])[:-3],
                                 struct.pack("<II", warc.DICTIONARY_MAGIC, 99) + b"x"])
def test_damaged_archives(raw):
    with pytest.raises(warc.Damaged):
        list(warc.frames_of(io.BytesIO(raw)))


@pytest.mark.parametrize("old, new", [
    (b"WARC/1.1", b"WARC/9.9"), (b"WARC-Date: ", b"X-Date: "), (b"hello", b"hullo"), (b"hello", b"hello!"),
    (b"WARC-Type: response", b": response"), (b"hello\r\n\r\n", b"helloxxxx"),
])
def test_damaged_records(old, new):
    with pytest.raises(warc.Damaged):
        warc.parse_record(record().replace(old, new))


def test_revisit_keeps_the_length():
    parsed = warc.parse_record(record(b"hello", "revisit"))
    assert parsed["payload"] is None and parsed["payload_bytes"] == 5 and parsed["refers_to"] == "urn:page:2"


def test_round_trip(spark, tmp_path):
    rows = [(1, "u1", "same"), (5, "u5", "same"), (3, None, "same"), (2, "line\r\nend", "é" * 3), (4, "u4", None),
            (6, "u6", ""), (7, "u7", "x" * 300_000), (None, "n", "same"), (None, "n2", "alone"), (5, "u5", "same")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS digest", "2 AS payload", "3 AS n")
    folder = str(tmp_path / "w")
    assert warc.write_archives(df.repartition(2), folder) == len(rows)
    got = warc.read_archives(spark, folder).collect()
    assert all(r.error is None for r in got) and len(got) == len(rows)
    found = {}
    for r in got:
        found.setdefault(r.record_id, []).append((r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, r.payload and bytes(r.payload)))
    sha = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode()
    assert found["urn:page:1"] == [("revisit", "urn:page:5", 4, sha(b"same"), None)]
    assert found["urn:page:5"] == [("response", None, 4, sha(b"same"), b"same")] * 2
    assert found["urn:page:2"][0][2:] == (6, sha("ééé".encode()), "ééé".encode())
    assert found["urn:page:4"][0][:3] == ("revisit", "urn:page:6", 0)
    assert sorted(f[0] for f in found["urn:page:"]) == ["response", "revisit"]
    large = str(tmp_path / "large")
    warc.write_archives(df, large, min_revisit_bytes=5)
    assert {r.record_type for r in warc.read_archives(spark, large, payloads=False).collect()} == {"response"}


def test_damage_is_reported_per_archive(spark, tmp_path):
    whole = archive([record(), record().replace(b"hello", b"hullo"), record(b"third")])
    (tmp_path / "a.warc.zst").write_bytes(whole)
    (tmp_path / "b.warc.zst").write_bytes(archive([record()]) + b"junk junk")
    got = warc.read_archives(spark, str(tmp_path)).collect()
    assert sorted(r.error is None for r in got) == [False, False, True, True, True]


def test_reading_goes_on_behind_a_large_record(spark, tmp_path, monkeypatch):
    raw = archive([record(b"first"), record(b"x" * 5_000_000), record(b"third")])
    monkeypatch.setattr(warc, "RECORD_BYTES", 1_000_000)
    frames = list(warc.frames_of(io.BytesIO(raw)))
    assert [f is None for f in frames] == [False, True, False]
    assert warc.parse_record(frames[2])["payload"] == b"third"
    with pytest.raises(warc.Damaged, match="larger"):
        warc.parse_record(frames[1])


def test_a_digest_of_most_rows(spark, tmp_path):
    """Half of the rows have one payload, the others their own or that of a few."""
    rows = [(i, f"u{i}", "hot" if i % 2 else f"p{i % 400}") for i in range(3000)]
    folder = str(tmp_path / "hot")
    assert warc.write_archives(spark.createDataFrame(rows, SCHEMA), folder) == 3000
    last = {}
    for i, _, text in rows:
        last[text] = i
    got = {r.record_id: r.refers_to for r in warc.read_archives(spark, folder).collect()}
    assert got == {f"urn:page:{i}": None if last[t] == i else f"urn:page:{last[t]}" for i, _, t in rows}


def test_empty_table(spark, tmp_path):
    folder = str(tmp_path / "none")
    assert warc.write_archives(spark.createDataFrame([], SCHEMA), folder) == 0
    assert warc.read_archives(spark, folder).count() == 0
    assert not [f for f in os.listdir(folder) if f.endswith(".part")]
