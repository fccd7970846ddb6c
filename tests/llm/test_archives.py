"""Archives against a plain reader that follows Content-Length, and a plain choice of originals."""

import glob
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tablemint.llm import warc

MARKED = "a WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.WARC/1.0\r\n"
PAYLOADS = [None, "", "short", "é" * 499, "é" * 500, "line\r\n\r\n" * 300, MARKED, MARKED * 100, "\r\n", "z" * 2_000_000]


def plain_records(folder):
    """Records of all files: (headers, block), read by their stated lengths."""
    out = []
    for name in sorted(glob.glob(f"{folder}/part-*")):
        data = gzip.open(name).read() if name.endswith(".gz") else open(name, "rb").read()
        at = 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at)
            version, *lines = data[at:end].decode().split("\r\n")
            assert version == "WARC/1.1"
            headers = dict(line.split(": ", 1) for line in lines)
            size = int(headers["Content-Length"])
            block = data[end + 4 : end + 4 + size]
            assert data[end + 4 + size : end + 8 + size] == b"\r\n\r\n"
            out.append((headers, block))
            at = end + 8 + size
    return out


def pages_of(spark, rows):
    """Pages with extra columns named like the operator's own."""
    wide = [(i, u, h, "x", b"y", 3, "WARC") for i, u, h in rows]
    return spark.createDataFrame(
        wide, "id long, link string, body string, key string, payload binary, original_key int, record_id string"
    )


def chosen(rows):
    """The key of the record that stays for each payload of 1000 bytes or more."""
    out = {}
    for key, _, body in rows:
        data = (body or "").encode()
        if len(data) >= 1_000:
            out[data] = max(out.get(data, key), key, key=lambda k: (k is not None, k or 0))
    return out


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archives_round_trip(spark, tmp_path, compression):
    rows = [(i, f"http://h/{i}\r\nX: y", body) for i, body in enumerate(PAYLOADS)] + [(None, None, "no key")]
    folder = str(tmp_path / "a")
    warc.write_records(warc.page_records(pages_of(spark, rows), "id", "link", "body").repartition(3), folder, compression)
    want = sorted(((i, (b or "").encode()) for i, _, b in rows), key=repr)

    plain = plain_records(folder)
    assert sorted(((int(h["X-Key"]) if "X-Key" in h else None, b.partition(b"\r\n\r\n")[2]) for h, b in plain), key=repr) == want
    assert len({h["WARC-Record-ID"] for h, _ in plain}) == len(rows)

    read = warc.read_records(spark, folder).collect()
    assert sorted(((r["key"] and int(r["key"]), bytes(r["payload"])) for r in read), key=repr) == want
    for r in read:
        assert r["complete"] and r["record_type"] == "response"
        assert r["payload_bytes"] == len(r["payload"])
        assert r["payload_digest"] == hashlib.sha1(bytes(r["payload"])).hexdigest()
        assert r["target_uri"] == (None if r["key"] is None else f"http://h/{r['key']}%0D%0AX: y")


def test_splits_inside_records_lose_nothing(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, "u", "".join(rng.choice(["WARC/1.", "\r\n", "W", "text ", MARKED]) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    folder = str(tmp_path / "a")
    warc.write_records(warc.page_records(pages_of(spark, rows), "id", "link", "body").coalesce(2), folder, "none")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        read = warc.read_records(spark, folder)
        got = {(int(r["key"]), bytes(r["payload"]).decode()) for r in read.select("key", "payload").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {(i, b) for i, _, b in rows}


def test_equal_payloads_become_revisits_of_the_largest_key(spark, tmp_path):
    rng = random.Random(2)
    bodies = ["p" * 1_000, "q" * 999, "é" * 500, "r" * 5_000, MARKED * 20]
    rows = [(i, f"http://h/{i}", rng.choice(bodies)) for i in rng.sample(range(10_000), 60)]
    rows += [(77_777, "twice", "p" * 1_000)] * 2 + [(None, None, "r" * 5_000), (5, "u", None), (6, "u", "")]
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    warc.write_records(warc.page_records(pages_of(spark, rows), "id", "link", "body"), source)
    warc.deduplicate(spark, source, target)
    keeps = chosen(rows)
    plain = plain_records(target)
    assert len(plain) == len(rows)
    ids = {h["WARC-Record-ID"]: h for h, _ in plain}
    full = [h for h, _ in plain if h["WARC-Type"] == "response"]
    assert sorted(int(h["X-Key"]) for h in full) == sorted(
        [k for k, _, b in rows if len((b or "").encode()) < 1_000] + list(keeps.values())
    )
    for headers, block in plain:
        if headers["WARC-Type"] == "revisit":
            original = ids[headers["WARC-Refers-To"]]
            assert block.endswith(b"\r\n\r\n") and original["WARC-Type"] == "response"
            assert headers["WARC-Payload-Digest"] == original["WARC-Payload-Digest"]
            assert headers["WARC-Refers-To-Target-URI"] == original["WARC-Target-URI"]
            assert headers["WARC-Refers-To-Date"] == original["WARC-Date"]

    got = warc.resolved(warc.read_records(spark, target)).collect()
    by_digest = {hashlib.sha1(body).hexdigest(): str(key) for body, key in keeps.items()}
    assert len(got) == len(rows)
    for r in got:
        if r["record_type"] == "revisit":
            assert r["original_key"] == by_digest[r["payload_digest"]]
        else:
            assert r["original_key"] is None
    sizes = {hashlib.sha1((b or "").encode()).hexdigest(): len((b or "").encode()) for _, _, b in rows}
    assert all(r["payload_bytes"] == sizes[r["payload_digest"]] for r in got)

    # A second pass over archives that hold revisits points them at the same originals.
    again = str(tmp_path / "c")
    warc.deduplicate(spark, target, again)
    columns = ["key", "record_type", "original_key", "payload_digest", "payload_bytes"]
    twice = warc.resolved(warc.read_records(spark, again)).select(*columns).collect()
    assert sorted(twice, key=repr) == sorted((r for r in warc.resolved(warc.read_records(spark, target)).select(*columns).collect()), key=repr)


def test_other_records_and_cut_files(spark, tmp_path):
    folder = tmp_path / "a"
    folder.mkdir()
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nwarc-record-id: <urn:x>\r\nContent-Type: application/warc-fields\r\ncontent-length: 8\r\n\r\nsoft: \xff\xfe\r\n\r\n"
    cut = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:y>\r\nContent-Length: 900\r\n\r\nonly this"
    (folder / "part-0.warc").write_bytes(info + cut)
    got = {r["record_id"]: r for r in warc.read_records(spark, str(folder)).collect()}
    assert bytes(got["<urn:x>"]["payload"]) == b"soft: \xff\xfe" and got["<urn:x>"]["complete"]
    assert bytes(got["<urn:y>"]["payload"]) == b"only this" and not got["<urn:y>"]["complete"]
    target = str(tmp_path / "b")
    warc.deduplicate(spark, str(folder), target)
    again = {r["record_id"]: r for r in warc.read_records(spark, target).collect()}
    assert bytes(again["<urn:x>"]["payload"]) == b"soft: \xff\xfe" and again["<urn:x>"]["record_type"] == "warcinfo"


def test_empty_table(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    warc.write_records(warc.page_records(pages_of(spark, []), "id", "link", "body"), source)
    warc.deduplicate(spark, source, target)
    assert warc.resolved(warc.read_records(spark, target)).collect() == []


def test_headers_are_shuffled_and_small_decisions_leave_payloads_in_place(spark, tmp_path):
    rows = [(i, f"u{i % 3}", "same " * 400) for i in range(30)]
    source = str(tmp_path / "a")
    warc.write_records(warc.page_records(pages_of(spark, rows), "id", "link", "body"), source)
    heads = warc.read_records(spark, source).select(*warc.HEADS)
    plan = warc.revisits(heads)._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanged and all("payload_digest" in line for line in exchanged)
    assert warc.revisits(heads).filter(F.col("refers_to").isNotNull()).count() == 29
