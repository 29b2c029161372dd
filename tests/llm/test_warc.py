from __future__ import annotations

import gzip
import io
import os
import random
from collections import Counter, defaultdict

import pytest

from stockflow.llm import warc


class File(io.BytesIO):
    def size(self):
        return len(self.getbuffer())


def record(key, payload=b"hello", repeated=False):
    return warc.encode(key, f"http://h/{key}", payload, 1, repeated)


def kinds(data):
    return [(kind, start, end) for kind, start, end, _ in warc.salvage(File(data))]


def expected(rows, least=0):
    groups = defaultdict(list)
    for key, _, text in rows:
        groups[text or ""].append(key)
    out = []
    for key, _, text in rows:
        data = (text or "").encode()
        named = [k for k in groups[text or ""] if k is not None]
        first = min(named) if named and len(groups[text or ""]) > 1 and len(data) >= least else None
        again = first is not None and key != first
        out.append((key, len(data), warc.digest(data), "revisit" if again else "response", first if again else None))
    return Counter(out)


ROWS = [
    (5, "http://a/", "<p>same</p>"), (3, "http://b/", "<p>same</p>"), (9, None, "<p>same</p>"), (1, "http://c/", None),
    (2, "http://c/\r\nx: y", ""), (4, "u", "é 漢字 \r\n\r\nWARC/1.1\r\nfake"), (7, "u", "x" * 300_000), (8, "u", "one"),
    (8, "u", "one"), (None, "u", "<p>same</p>"), (None, "u", "alone"), (11, "http://h/" + "q" * 100_000, "long url"),
]


@pytest.mark.parametrize("least,size", [(0, 1 << 20), (4, 500)])
def test_pages_come_back(pages, least, size):
    archives = warc.write(pages(ROWS), least=least, archive_bytes=size)
    found = warc.read(archives).select(
        warc.key_of("record_id").cast("bigint").alias("k"), "payload_bytes", "payload_digest", "record_type",
        warc.key_of("refers_to").cast("bigint").alias("r"), "kind",
    ).collect()
    assert all(r["kind"] == "record" for r in found)
    assert Counter(tuple(r)[:5] for r in found) == expected(ROWS, least)


def test_an_empty_table_writes_nothing(pages):
    assert warc.read(warc.write(pages([]))).collect() == []


def test_archives_are_plain_gzip_members(pages):
    path = warc.write(pages(ROWS[:1])).collect()[0]["path"].removeprefix("file:")
    with open(path, "rb") as file:
        data = gzip.decompress(file.read())
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and data.endswith(b"<p>same</p>\r\n\r\n")
    assert os.path.basename(path).endswith(".warc.gz")


@pytest.mark.parametrize("press", [lambda d: d, warc._gzip])
def test_damage_is_a_gap_and_the_rest_is_read(press):
    parts = [press(record(k, f"payload {k} ".encode() * 900)) for k in range(5)]
    data = bytearray(b"".join(parts))
    start = [sum(map(len, parts[:k])) for k in range(6)]
    for at in range(start[1] + len(parts[1]) // 2, start[1] + len(parts[1]) // 2 + 30):
        data[at] ^= 0x5A
    found = kinds(bytes(data))
    assert found == [
        ("record", start[0], start[1]), ("gap", start[1], start[2]),
        *[("record", start[k], start[k + 1]) for k in (2, 3, 4)],
    ]


@pytest.mark.parametrize("press", [lambda d: d, warc._gzip])
def test_cut_ends_and_strange_heads_are_gaps(press):
    one, two = press(record(1)), press(record(2))
    junk = b"junk \x1f\x8b\x08 WARC/1.0\r\nno header\r\n\r\n"
    data = junk + one + b"\r\n\r\n" + two[:-7]
    found = kinds(data)
    assert found[0] == ("gap", 0, len(junk))
    assert found[1] == ("record", len(junk), len(junk) + len(one))
    if press is warc._gzip:  # only the member's checksum is cut off, not its record
        start = len(data) - len(two) + 7
        assert found[2:] == [("gap", start - 4, start), ("record", start, len(data)), ("gap", start, len(data))]
    else:
        assert found[2][0] == "gap" and found[2][2] == len(data) and len(found) == 3


def test_a_record_longer_than_the_window_and_mixed_forms():
    parts = [record(1, b"x" * 900_000), warc._gzip(record(2, b"y" * 900_000)), record(3)]
    assert [k for k, *_ in kinds(b"".join(parts))] == ["record"] * 3


def test_an_empty_file_and_a_wrong_digest():
    assert kinds(b"") == []
    wrong = record(1).replace(b"hello", b"hallo")
    assert kinds(wrong + record(2)) == [("gap", 0, len(wrong)), ("record", len(wrong), len(wrong) + len(record(2)))]


def test_a_bad_record_inside_a_member_costs_that_record():
    parts = [record(k, f"payload {k} ".encode() * 40) for k in range(20)]
    bad = parts[7].replace(b"payload 7", b"payload X")
    for press in (lambda d: d, warc._gzip):
        data = press(b"".join([*parts[:7], bad, *parts[8:]])) + press(record(50))
        found = list(warc.salvage(File(data)))
        keys = [what.fields["warc-record-id"] for kind, _, _, what in found if kind == "record"]
        assert keys == [warc.record_id(k) for k in [*range(7), *range(8, 20), 50]]
        gaps = [one for one in found if one[0] == "gap"]
        assert len(gaps) == 1 and gaps[0][3].startswith("block digest")


def test_a_damaged_or_cut_member_keeps_the_records_before():
    rng = random.Random(3)
    parts = [record(k, rng.randbytes(30_000)) for k in range(20)]
    whole = warc._gzip(b"".join(parts))
    cut = whole[: len(whole) * 3 // 5]
    flipped = bytearray(whole)
    flipped[len(whole) // 2] ^= 0xFF
    for data, least in ((cut, 10), (bytes(flipped), 8), (cut + warc._gzip(record(60)), 10)):
        found = list(warc.salvage(File(data)))
        keys = [what.fields["warc-record-id"] for kind, _, _, what in found if kind == "record"]
        first = [k for k in keys if k != warc.record_id(60)]
        assert first[:least] == [warc.record_id(k) for k in range(least)] and len(first) < 20
        assert (warc.record_id(60) in keys) == data.endswith(warc._gzip(record(60)))
        assert any(kind == "gap" for kind, *_ in found)


def test_long_members_are_read_piece_by_piece():
    data = warc._gzip(b"".join(record(k, b"z" * 50_000) for k in range(400)))
    window = warc._Window(File(data))
    most = 0
    for kind, *_ in warc._member(window, 0):
        most = max(most, len(window.data))
    assert kind == "end" and most <= 2 * warc._READ
    assert [kind for kind, *_ in warc.salvage(File(data))] == ["record"] * 400
