"""Archive files found member by member, merged reads, and charsets."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from pageprism.functions import charset
from pageprism.sources.archive import members, plan_ranges, read_archive, record_parts
from pageprism.sources.records import merged_reads


class Handle:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at:at + n]


def record(i, body, kind="response"):
    block = (f"HTTP/1.1 200 OK\r\nX: {i}\r\n\r\n".encode() if kind != "warcinfo" else b"") + body
    return (f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: https://d/{i}\r\nWARC-Date: 2024-01-01T00:00:00Z\r\n"
            f"Content-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


def archive(n, seed=1):
    """Members of any size; some hold the mark of a member inside, stored without compression."""
    rng = random.Random(seed)
    bodies = [rng.randbytes(rng.choice([0, 10, 3000, 90_000])) + (b"\x1f\x8b\x08" * 5 if i % 3 == 0 else b"") for i in range(n)]
    return bodies, [gzip.compress(record(i, b), compresslevel=rng.choice([0, 6])) for i, b in enumerate(bodies)]


def test_every_member_is_in_one_range():
    bodies, packed = archive(60)
    data = b"".join(packed)
    whole = list(members(Handle(data), 0, len(data)))
    assert [record_parts(m[2])[2] or b"" for m in whole] == bodies
    for cut in (1, 777, 50_000, len(data) // 2, len(data) - 1):
        parts = [m for a in range(0, len(data), cut) if cut > 1 or a in (0, len(data) // 3) for m in members(Handle(data), a, min(len(data), a + cut))]
        assert parts == whole or cut == 1


def test_broken_and_padded_members():
    bodies, packed = archive(10)
    packed[4] = packed[4][:len(packed[4]) // 2]
    data = b"".join(packed[:7]) + b"\0" * 100 + b"".join(packed[7:]) + packed[0][:20]
    found = list(members(Handle(data), 0, len(data)))
    assert [record_parts(m[2])[2] or b"" for m in found if m[2] is not None] == [b for i, b in enumerate(bodies) if i != 4]
    assert [m[0] for m in found if m[2] is None] == [sum(map(len, packed[:4])), len(data) - 20]


def test_plan():
    runs = plan_ranges([("a", 250), ("b", 10), ("c", 10), ("d", 0)], 100, file_cost=5)
    assert [r for run in runs for r in run] == [("a", 0, 100), ("a", 100, 200), ("a", 200, 250), ("b", 0, 10), ("c", 0, 10)]
    assert all(sum(b - a for _, a, b in run) <= 100 for run in runs) and len(runs) == 3


def test_source(spark, tmp_path):
    for name in ("x", "y/z"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        _, packed = archive(20, seed=len(name))
        (tmp_path / f"{name}.warc.gz").write_bytes(gzip.compress(record(99, b"about", "warcinfo")) + b"".join(packed))
    (tmp_path / "notes.txt").write_text("none")
    want = read_archive(spark, str(tmp_path)).select("file", "offset", "target_uri", F.md5("body")).collect()
    assert len(want) == 42 and len({(r.file, r.offset) for r in want}) == 42
    small = read_archive(spark, str(tmp_path), splitBytes=4000)
    assert small.rdd.getNumPartitions() > 20
    assert sorted(small.select("file", "offset", "target_uri", F.md5("body")).collect(), key=str) == sorted(want, key=str)
    only = read_archive(spark, str(tmp_path), types="warcinfo").collect()
    assert len(only) == 2 and {bytes(r.body) for r in only} == {b"about"} and only[0].header is None
    with pytest.raises(Exception, match="no archive"):
        read_archive(spark, str(tmp_path / "none")).count()
    (tmp_path / "bad.warc.gz").write_bytes(gzip.compress(record(1, b"x"))[:-20])
    with pytest.raises(Exception, match="broken member"):
        read_archive(spark, str(tmp_path)).count()
    assert read_archive(spark, str(tmp_path), mode="PERMISSIVE").where("type is null").count() == 1


def test_merged_reads():
    assert list(merged_reads([(0, 10), (10, 10), (500, 10), (505, 2)], gap=100, most=1000)) == [(0, 2, 0, 20), (2, 4, 500, 510)]
    assert list(merged_reads([(0, 10), (10, 10), (20, 10)], gap=100, most=20)) == [(0, 2, 0, 20), (2, 3, 20, 30)]
    assert list(merged_reads([])) == []


RUSSIAN = "Привет мир, это обычная страница магазина с описанием товара и ценой"
JAPANESE = "これは日本語のページです。商品の説明と値段があります。"
GERMAN = "Größe und Länge für Mädchen, schöne Tüte für 5 € an der Straße"
CHINESE = "这是一个普通的商品页面，上面有价格和说明，欢迎光临我们的商店"
KOREAN = "이것은 평범한 상품 페이지이며 가격과 설명이 있습니다"


@pytest.mark.parametrize("text, encoding, guess", [
    (RUSSIAN, "cp1251", "cp1251"), (RUSSIAN, "koi8-r", "koi8-r"), (JAPANESE, "shift_jis", "cp932"), (JAPANESE, "euc_jp", "euc_jp"),
    (GERMAN, "cp1252", "cp1252"), (CHINESE, "gbk", "gb18030"), (KOREAN, "euc_kr", "cp949"), (GERMAN, "utf-8", "utf-8"),
    ("plain", "ascii", "utf-8"), (GERMAN, "utf-16", "utf-16-le")])
def test_charsets_declared_and_guessed(spark, text, encoding, guess):
    label = {"cp1251": "windows-1251", "cp1252": "ISO-8859-1", "utf-16": "utf-16"}.get(encoding, encoding)
    data = text.encode(encoding)
    rows = [(data, None), (data, f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=\"{label}\""), (data, "Content-Type: text/html; charset=bogus")]
    if encoding != "utf-16":
        rows.append((f'<meta charset="{label}">'.encode() + data, None))
    df = spark.createDataFrame([(bytearray(d), h) for d, h in rows], "data binary, header string")
    found = charset.with_text(df, "data", "t", "header", charset="c").collect()
    assert [r.t for r in found] == [text] * 3 + [f'<meta charset="{label}">{text}'] * (len(rows) - 3)
    assert found[0].c == found[2].c == guess


def test_header_wins_over_meta(spark):
    data = b'<meta charset="windows-1251">' + GERMAN.encode("cp1252")
    df = spark.createDataFrame([(bytearray(data), "Content-Type: text/html; charset=windows-1252"), (None, None), (bytearray(b""), None)], "data binary, header string")
    assert [r.t for r in charset.with_text(df, "data", "t", "header").collect()] == ['<meta charset="windows-1251">' + GERMAN, None, ""]


@pytest.mark.parametrize("name", charset.SINGLE)
def test_single_byte_tables(spark, name):
    data = bytes(range(128, 256))
    got = spark.createDataFrame([(bytearray(data),)], "d binary").select(charset.from_single_byte("d", name)).first()[0]
    assert got == charset.single_byte_table(name) and len(got) == 128
    text = "".join(c for c in got if c != charset.REPLACEMENT)
    back = spark.createDataFrame([(text,)], "t string").select(charset.to_single_byte("t", name)).first()[0]
    assert bytes(back) == bytes(128 + i for i, c in enumerate(got) if c != charset.REPLACEMENT)


def test_labels():
    known = charset.labels()
    want = {"ISO-8859-1": "cp1252", "latin1": "cp1252", "windows-1251": "cp1251", "KOI8-R": "koi8-r", "Shift_JIS": "cp932", "x-sjis": "cp932", "GB2312": "gb18030",
            "EUC-KR": "cp949", "big5": "big5hkscs", "utf8": "utf-8", "UTF-16LE": "utf-16-le", "windows-874": "cp874", "macintosh": "mac-roman", "us-ascii": "cp1252"}
    assert {k: known.get(charset._key(k)) for k in want} == want


