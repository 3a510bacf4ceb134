"""Web archives: exact round trips, shared payloads, damaged archives, and the query against SQL."""

import gzip
import hashlib
import random

import pytest

from tests.check_catalog import connect, rows as counted
from tests.llm.conftest import SF
from tidemark.llm import warc
from tidemark.llm.queries import QUERIES, SQL
from tidemark.llm.shared import shared_folder

PAGES = "page_id long, url string, html string, key string, n long, body string, kind int"


def pages(llm, rows):
    return llm.createDataFrame([(*r, "k", 9, "b", 0) for r in rows], PAGES)


def plain(rows):
    """What has to come back: size, digest, type and referred page of each row."""
    out, groups = [], {}
    for i, (page_id, url, html) in enumerate(rows):
        body = (html or "").encode()
        if len(body) >= 1000:
            groups.setdefault(body, []).append(((page_id is not None, page_id or 0), (url is not None, url or ""), i))
    best = {body: max(g) for body, g in groups.items()}
    for i, (page_id, _, html) in enumerate(rows):
        body = (html or "").encode()
        top = best.get(body)
        again = top is not None and top[2] != i
        out.append((page_id, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", rows[top[2]][0] if again else None))
    return sorted(out, key=str)


def odd_rows():
    rng = random.Random(4)
    long = "".join(rng.choice("aé\r\n<0日") for _ in range(60_000))
    rows = [(i, f"https://x.org/{i}", f"<p>{i}</p>" * rng.choice([0, 3, 90, 200])) for i in range(30)]
    rows += [(i, f"https://y.org/{i % 3}", "same " * 250) for i in range(100, 140)]  # one hot payload
    rows += [(200, "https://z.org/", "twin" * 400)] * 7 + [(150, None, "twin" * 400), (None, None, "twin" * 400)]  # equal rows on top
    rows += [(300, None, None), (None, "https://n.org", ""), (301, "https://a b\r\nc.org/ü", "x" * 999), (302, "u", "x" * 999), (303, "u", "x" * 1000)]
    rows += [(400, "https://long.org", long), (401, "https://long.org", long), (402, "https://longer.org", long * 3)]
    rows += [(None, "https://only.org", "none" * 300)] * 2
    return rows


@pytest.mark.parametrize("segment", [512, warc.SEGMENT])
def test_pages_come_back(llm, segment):
    rows = odd_rows()
    got = warc.archived(pages(llm, rows), segment).collect()
    assert {r.fault for r in got} == {None}
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == plain(rows)


def test_payloads_and_urls_come_back(llm):
    rows = [(400, "https://long.org", "é" * 30_000), (1, "https://a b\n.org", "short"), (2, None, None)]
    got = warc.read(warc.write(pages(llm, rows), shared_folder(llm, "warc")), payloads=True)
    assert {(r.page_id, r.url, bytes(r.payload)) for r in got.collect()} == {
        (400, "https://long.org", ("é" * 30_000).encode()), (1, "https://a%20b%0A.org", b"short"), (2, None, b""),
    }


def test_no_pages(llm):
    assert warc.archived(pages(llm, [])).count() == 0


def test_records_are_plain_members(llm):
    manifest = warc.write(pages(llm, odd_rows()), shared_folder(llm, "warc")).collect()
    kinds, count = {}, 0
    for m in manifest:
        with gzip.open(m.path.removeprefix("file:")) as stream:
            for headers, block in warc.parse(stream):
                kinds[headers["warc-type"]] = kinds.get(headers["warc-type"], 0) + 1
                count += 1
                assert len(block) <= warc.SEGMENT
                if headers["warc-type"] == "continuation":
                    assert int(headers["warc-segment-number"]) > 1 and headers["warc-segment-origin-id"]
    assert count == sum(m.records for m in manifest) and kinds["continuation"] > 20 and kinds["revisit"] > 40


def test_messages_in_any_pieces():
    rng = random.Random(1)
    for _ in range(200):
        body = bytes(rng.choice(b"\r\n0a") for _ in range(rng.randrange(400)))
        data = warc.chunked(body, rng.randrange(1, 50))
        message = warc.Message(keep=True)
        while data:
            n = rng.randrange(1, 40)
            message.feed(data[:n])
            data = data[n:]
        message.close()
        assert message.fault is None and b"".join(message.kept) == body and message.size == len(body)


def test_faults_of_messages():
    def fault(data):
        message = warc.Message()
        message.feed(data)
        message.close()
        return message.fault

    whole = warc.chunked(b"payload")
    assert fault(whole) is None and fault(b"HTTP/1.1 200 OK\r\n\r\nplain") is None
    assert fault(whole[:-2]) == fault(whole[:20]) == "message cut off"
    assert fault(whole.replace(b"\r\n7\r\n", b"\r\nx\r\n")) == "chunk size"
    assert fault(whole.replace(b"\r\n7\r\n", b"\r\n5\r\n")) == "chunk too long"


def test_damage_is_named(llm, tmp_path):
    """Segments from several files in any order; one lacks its middle, one its end, one has a wrong total, one is doubled."""
    body = bytes(range(256)) * 40
    block, digest = warc.chunked(body), "sha1:" + warc.base64.b32encode(hashlib.sha1(body).digest()).decode()
    records = []
    for page, lost, total in ((1, None, 0), (2, 2, 0), (3, 4, 0), (4, None, 5), (5, None, 0)):
        head = {"WARC-Record-ID": f"<{page}>", "X-Page-ID": page, "WARC-Payload-Digest": digest, "WARC-Segment-Number": 1}
        step = -(-len(block) // 4)
        parts = [warc.record("response", head, block[:step])]
        for n in (2, 3, 4):
            end = {"WARC-Segment-Total-Length": len(block) + total} if n == 4 else {}
            parts.append(warc.record("continuation", {"WARC-Segment-Origin-ID": f"<{page}>", "WARC-Segment-Number": n, **end}, block[(n - 1) * step:n * step]))
        records += [p for n, p in enumerate(parts, 1) if n != lost] * (2 if page == 5 else 1)
    records.append(warc.record("revisit", {"WARC-Record-ID": "<6>", "X-Page-ID": 6, "WARC-Refers-To": "<99>"}, b""))
    random.Random(2).shuffle(records)
    paths = []
    for i in range(3):
        (tmp_path / f"{i}.warc.gz").write_bytes(b"".join(records[i::3]))
        paths.append((f"file://{tmp_path}/{i}.warc.gz", 1, 1))
    got = {r.page_id: r.fault for r in warc.read(llm.createDataFrame(paths, warc._MANIFEST)).collect()}
    assert got == {1: None, 2: "segment missing", 3: "last segment missing", 4: "total length", 5: None, 6: "response missing"}


def test_query_equals_sql(llm, tables):
    df = QUERIES["op13_warc"](llm, SF)
    cur = connect(SF).execute(SQL["op13_warc"])
    names = [d[0] for d in cur.description]
    assert counted(df.columns, [tuple(r) for r in df.collect()]) == counted(names, cur.fetchall()) and sorted(names) == sorted(df.columns)
