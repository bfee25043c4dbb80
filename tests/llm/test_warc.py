import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from earshot.llm import warc
from earshot.session import scratch_folder
from tests.llm.tables import LONG, with_clashes

PAGES = "page_id bigint, url string, html string"
ROWS = [(1, "http://a/b c", "<p>one</p>"), (2, None, None), (None, "http://x", "WARC/1.1\r\n\r\n\r\nWARC/1.1\r\nContent-Length: 9"),
        (3, "http://y", LONG), (4, "", ""), (4, "", ""), (5, "http://é", "日本\r\n\r\n" * 50)]


def stored(spark, records, name):
    folder = f"{scratch_folder(spark, 'test')}/{name}"
    warc.write_warc(records, folder)
    return folder


@pytest.fixture
def records(spark):
    pages = with_clashes(spark.createDataFrame(ROWS, PAGES).coalesce(1), ["shard", "record", "number"])
    return warc.records_of(pages)


def test_records_read_back(spark, records):
    rows = warc.scan(spark, stored(spark, records, "a")).orderBy("shard", "offset").collect()
    at = 0
    for row, (page, url, html) in zip(rows, ROWS, strict=True):
        whole = warc.record(page, url, html) + warc.END
        assert (row["page_id"], row["offset"], row["length"]) == (page, at, len(whole))
        assert bytes(row["hash"]) == hashlib.sha256(whole).digest()
        at += len(whole)


def test_shards_are_cut(spark, records, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_BYTES", 300)
    content = b"".join(warc.record(*r) + warc.END for r in ROWS)
    assert [size for _, size, _ in warc.ranges_of(content)] == [len(warc.record(*r)) + 4 for r in ROWS]


def audited(spark, first, second):
    return {r["page_id"] for r in warc.check_replicas(spark, first, second).filter("not intact").collect()}


def test_damage_is_found(spark, records):
    first = stored(spark, records, "a")
    assert audited(spark, first, stored(spark, records, "b")) == set()
    for where, bad in ((F.col("page_id") == 3, {3}), (F.col("page_id").isin(1, 5), {1, 5}), (F.col("page_id").isNull(), {None})):
        assert audited(spark, first, stored(spark, warc.damaged(records, where), "b")) == bad


def members(rows=ROWS):
    return [warc.member(warc.record(*r) + warc.END) for r in rows]


def test_stored_as_one_member_a_record(spark, records):
    """Any gzip reader sees the records; each is a member with the mandatory headers."""
    content = b"".join(bytes(r["content"]) for r in warc.files_of(spark, stored(spark, records, "a")).collect())
    assert content == b"".join(members())
    assert gzip.decompress(content) == b"".join(warc.record(*r) + warc.END for r in ROWS)
    for data, _, _ in warc.members_of(content):
        head = data[: data.find(warc.END)].decode().split("\r\n")
        assert head[0] == "WARC/1.1"
        assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} <= {h.split(": ")[0] for h in head[1:]}


def test_long_records_end_in_a_zero_byte():
    data = bytes(20 << 20) + b"x"
    assert gzip.decompress(warc.member(data)) == data and warc.member(data)[-1] == 0


def test_members_however_records_are_dealt(spark, records, tmp_path):
    first = stored(spark, records, "a")
    content = b"".join(warc.record(*r) + warc.END for r in ROWS)
    (tmp_path / "shard=0").mkdir()
    file = tmp_path / "shard=0" / "part-0.gz"
    for size in (7, 100, 5000, len(content)):
        file.write_bytes(b"".join(gzip.compress(content[i : i + size]) for i in range(0, len(content), size)) + bytes(9))
        assert audited(spark, first, str(tmp_path)) == set()


def test_changed_and_added_later_members(spark, records, tmp_path):
    first = stored(spark, records, "a")
    (tmp_path / "shard=0").mkdir()
    file = tmp_path / "shard=0" / "part-0.gz"
    more = warc.member(warc.record(99, "http://new", "new") + warc.END)
    file.write_bytes(b"".join(members()) + more)
    assert audited(spark, first, str(tmp_path)) == {99}
    file.write_bytes(b"".join([*members(ROWS[:-1]), warc.member(warc.record(5, "http://é", "other") + warc.END)]))
    assert audited(spark, first, str(tmp_path)) == {5}
    file.write_bytes(b"".join(members()) + b"no member")
    bad = [r for r in warc.check_replicas(spark, first, str(tmp_path)).collect() if not r["intact"]]
    assert [(r["length"], r["page_id"], r["side"]) for r in bad] == [(9, None, "second")]


def test_any_flipped_byte_costs_its_own_member():
    rows = [(i, f"http://{i}", f"<p>{i} " + "some text " * i + "</p>") for i in range(30)]
    own = members(rows)
    good = list(warc.parts_of(b"".join(own)))
    assert [page for _, _, page, _, _ in good] == list(range(30))
    broken = own[11]
    for at in range(len(broken)):
        content = b"".join([*own[:11], broken[:at] + bytes([broken[at] ^ 0x10]) + broken[at + 1 :], *own[12:]])
        found = list(warc.parts_of(content))
        if at in (4, 5, 6, 7, 8, 9):  # time stamp and system in the header: data and checksum are right
            assert found == good
        else:
            assert found[:11] == good[:11] and not found[11][-1] and found[11][2] is None, at
            assert found[12:] == good[12:], at


def test_flipped_byte_of_a_stored_file_is_located(spark, records, tmp_path):
    first = stored(spark, records, "a")
    content = b"".join(members())
    (tmp_path / "shard=0").mkdir()
    file = tmp_path / "shard=0" / "part-0.gz"
    at = sum(map(len, members(ROWS[:3]))) + 400
    file.write_bytes(content[:at] + bytes([content[at] ^ 1]) + content[at + 1 :])
    assert audited(spark, first, str(tmp_path)) == {3}
    assert audited(spark, str(tmp_path), first) == {3}
    assert warc.read_records(spark, str(tmp_path)).count() == len(ROWS) - 1


def test_damaged_header_costs_its_own_record(spark):
    good = [warc.record(i, f"http://{i}", f"<p>{i}</p>") + warc.END for i in range(50)]
    broken = [*good[:7], good[7].replace(b"Content-Length", b"Content-Lengtg"), *good[8:]]
    ranges = list(warc.ranges_of(b"".join(broken)))
    assert [size for _, size, _ in ranges] == list(map(len, good))


def test_missing_and_cut_files(spark, records, tmp_path):
    first = stored(spark, records, "a")
    missing = scratch_folder(spark, "test")
    spark.createDataFrame([], "value string").write.text(missing)
    assert audited(spark, first, missing) == {1, 2, 3, 4, 5, None}
    content = b"".join(warc.record(*r) + warc.END for r in ROWS)
    (tmp_path / "shard=0").mkdir()
    (tmp_path / "shard=0" / "part-0.gz").write_bytes(gzip.compress(content[: len(content) - 200]))
    assert audited(spark, first, str(tmp_path)) == {5}


def test_missing_and_cut_files_of_the_first_replica(spark, records, tmp_path):
    second = stored(spark, records, "b")
    missing = scratch_folder(spark, "test")
    spark.createDataFrame([], "value string").write.text(missing)
    found = warc.check_replicas(spark, missing, second).collect()
    assert sorted((r["page_id"] or 0, r["side"], r["intact"]) for r in found) == [
        (page, "second", False) for page in (0, 1, 2, 3, 4, 4, 5)]
    scanned = {(r["shard"], r["offset"], r["length"], bytes(r["hash"])) for r in warc.scan(spark, second).collect()}
    assert {(r["shard"], r["offset"], r["length"], bytes(r["hash"])) for r in found} == scanned
    content = b"".join(warc.record(*r) + warc.END for r in ROWS)
    last = len(warc.record(*ROWS[-1]) + warc.END)
    (tmp_path / "shard=0").mkdir()
    cut = tmp_path / "shard=0" / "part-0.gz"
    for length, side in ((len(content) - 200, "both"), (len(content) - last, "second")):
        cut.write_bytes(gzip.compress(content[:length]))
        rows = warc.check_replicas(spark, str(tmp_path), second).collect()
        assert len(rows) == len(ROWS)
        assert [(r["page_id"], r["side"]) for r in rows if not r["intact"]] == [(5, side)]
    cut.write_bytes(b"no gzip")
    rows = warc.check_replicas(spark, str(tmp_path), second).collect()
    assert len(rows) == len(ROWS) and not any(r["intact"] for r in rows)


def test_damaged_header_in_the_first_replica_is_named(spark, records, tmp_path):
    good = [warc.record(*r) + warc.END for r in ROWS]
    (tmp_path / "shard=0").mkdir()
    broken = b"".join([good[0].replace(b"Content-Length", b"Content-Lengtg"), *good[1:]])
    (tmp_path / "shard=0" / "part-0.gz").write_bytes(gzip.compress(broken))
    assert audited(spark, str(tmp_path), stored(spark, records, "b")) == {1}


def test_many_records_need_many_levels(spark):
    """One damaged record among thousands, in trees of several levels over shards and offsets."""
    pages = spark.range(6000).select(
        F.col("id").alias("page_id"), F.lit("http://h").alias("url"), F.repeat(F.lit("text "), 100).alias("html")
    ).repartitionByRange(5, "page_id")
    made = warc.records_of(pages)
    first = stored(spark, made, "a")
    copies = warc.read_records(spark, first)
    second = stored(spark, warc.damaged(copies, F.col("page_id") == 4321), "b")
    own, other = warc.scan(spark, first), warc.scan(spark, second)
    levels = warc.levels_of(warc.pairs(own, other))
    counts = [level.count() for level, _ in levels]
    assert counts[0] == 6000 and counts[-1] == 1 and counts == sorted(counts, reverse=True) and len(counts) >= 5
    assert all(level.filter("not a <=> b").count() == 1 for level, _ in levels)
    assert audited(spark, first, second) == {4321}


def test_empty_table(spark):
    folder = stored(spark, warc.records_of(spark.createDataFrame([], PAGES)), "a")
    assert warc.check_replicas(spark, folder, folder).count() == 0
