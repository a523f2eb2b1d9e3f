import random

import pytest
import zstandard

from ledgerline.llm import warc

SCHEMA = "page_id BIGINT, url STRING, html STRING, response STRING, payload INT"


def rows_of(n=300):
    rng = random.Random(1)
    word = lambda: rng.choice(["<p>", "</p>", "<div class='a'>", "é", "text", "\r\n\r\n", "WARC/1.1", "\x00", "P*M\x18\0\0\0\0"])
    bodies = ["".join(word() for _ in range(rng.choice([0, 1, 50, 400]))) for _ in range(n // 3)]
    rows = [(i, f"http://a.b/{i}", rng.choice(bodies), "x", 1) for i in range(n)]
    return rows + [(n, None, None, None, None), (n + 1, "http://x/\r\nWARC-Type: evil", "", None, 1), (n + 2, "é", "z" * 3_000_000, "", 1)]


def expected(rows, least=0):
    largest = {}
    for page, _, html, *_ in rows:
        body = (html or "").encode()
        largest[body] = max(largest.get(body, page), page)
    out = {}
    for page, _, html, *_ in rows:
        body = (html or "").encode()
        revisit = len(body) >= least and largest[body] != page
        out[page] = (len(body), warc.payload_digest(body), "revisit" if revisit else "response", largest[body] if revisit else None, None if revisit else body)
    return out


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    rows = rows_of()
    df = warc.archived(spark.createDataFrame(rows, SCHEMA), least)
    got = {
        r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload))
        for r in df.collect()
    }
    assert got == expected(rows, least)


def test_files_are_plain_zstandard_streams_with_a_dictionary(spark, tmp_path):
    rows = rows_of()
    warc.write(spark.createDataFrame(rows, SCHEMA).repartition(3), str(tmp_path / "w"))
    files = [p.read_bytes() for p in (tmp_path / "w").glob("part-*")]
    total = 0
    for data in files:
        assert data[:4] == bytes.fromhex("5d2a4d18")
        size = int.from_bytes(data[4:8], "little")
        words = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
        reader = zstandard.ZstdDecompressor(dict_data=words).stream_reader(data[8 + size :], read_across_frames=True)
        text = reader.read()
        total += sum(text.count(b"WARC/1.1\r\nWARC-Type: " + kind) for kind in (b"response\r\n", b"revisit\r\n"))
    assert total == len(rows)


def test_damage_is_noticed():
    good = warc.record(1, "http://a", b"body", None, False)
    assert warc.parse(good)["payload"] == b"body"
    with pytest.raises(ValueError):
        warc.parse(good.replace(b"\r\n\r\nbody", b"\r\n\r\nbodY"))
    with pytest.raises(ValueError):
        warc.parse(good[:-1])


def test_ties_nulls_and_empty(spark):
    rows = [(1, "u", "a", None, None), (1, "u", "a", None, None), (0, "u", "a", None, None), (None, "u", "a", None, None), (None, "v", "q", None, None)]
    got = sorted((r.page_id is not None, r.page_id or 0, r.record_type, r.refers_to) for r in warc.archived(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(False, 0, "response", None), (False, 0, "revisit", 1), (True, 0, "revisit", 1), (True, 1, "response", None), (True, 1, "response", None)]
    assert warc.archived(spark.createDataFrame([], SCHEMA)).collect() == []


def test_hot_payload_is_split(spark, tmp_path):
    """Pages that share one payload spread over tasks, and so over archives, once the list is joined by shuffles."""
    page = "".join(random.Random(3).choice("abcdefghijklmnopqrstuvwxyz <>") for _ in range(2000))
    rows = [(i, "u", page if i % 3 else f"{i} {page[: i % 50]}", None, None) for i in range(6000)]
    rows += [(6000 + i, "u", f"{i} {page[: i % 50]}", None, None) for i in range(0, 6000, 3)]
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        warc.write(spark.createDataFrame(rows, SCHEMA).repartition(8), str(tmp_path / "w"))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    revisits = []
    for part in (tmp_path / "w").glob("part-*"):
        found = [warc.parse(data) for data in warc.records_of(part.read_bytes())]
        revisits.append(sum(r["refers_to"] == 5999 for r in found))
    assert sum(revisits) == 3999 and max(revisits) < 2000
