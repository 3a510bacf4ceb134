"""The Merkle manifest against brute force, and its query against SQL."""

import random
import zlib
from hashlib import sha256

import pytest

from tests.check_catalog import connect, rows as counted
from tests.llm.conftest import SCHEMA, SF
from tidemark.llm import merkle
from tidemark.llm.queries import QUERIES, SQL


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels, i):
    out = []
    for nodes in levels[:-1]:
        run = nodes[i // 8 * 8:i // 8 * 8 + 8]
        out.append((run[:i % 8], run[i % 8 + 1:]))
        i //= 8
    return out


def plain_manifest(rows):
    groups = {}
    for r in rows:
        d, text = r["doc_id"], r["text"]
        leaf = altered = digest(*[field(r[c]) for c in merkle.FIELDS])
        if d is not None and zlib.crc32(str(d).encode()) % 3 == 0 and text is not None:
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            altered = digest(*[field(low if c == "text" else r[c]) for c in merkle.FIELDS])
        groups.setdefault(r["lang"], []).append((d, leaf, altered))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for rows_ in groups.values():
        rows_.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    levels = {lang: climb([x[1] for x in groups[lang]]) for lang in langs}
    top = climb([levels[lang][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, (d, leaf, node) in enumerate(groups[lang]):
            steps = siblings(levels[lang], i) + siblings(top, k)
            proof = digest(*[s for a, b in steps for s in a + b])
            for a, b in steps:
                node = digest(*a, node, *b)
            out.append((d, leaf, levels[lang][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_odd_rows_equal_brute_force(llm, depth):
    rng = random.Random(depth)
    rows = []
    for lang, n in (("en", 90), ("fr", 9), (None, 8), ("", 1), ("Zz", 70), ("é", 3)):
        for i in range(n):
            doc_id = rng.choice([i, i * 1000, -i, i << 40, (1 << 63) - 1 - i, -(1 << 63) + i, None if i % 20 == 0 else 7])
            text = rng.choice([None, "", f"Text {i}", "plain", "İ ß Ärger", "Long " * 3000])
            rows.append((doc_id, text, lang, rng.choice([None, "web"]), rng.choice([None, i])))
    rows += [rows[0]] * 75 + [(7, f"Other {i}", "en", None, i) for i in range(40)]  # equal rows and a shared id, over several blocks
    docs = llm.createDataFrame([(*r, 1, "k", 2, "x") for r in rows], SCHEMA + ", n int, g string, start int, leaf string")
    got = merkle.manifest(docs, depth)
    want = plain_manifest([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows])
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert 0 < sum(r[6] for r in want) < len(want)


def test_one_row_and_none(llm, frame):
    docs = frame([(5, "Alone")])
    want = plain_manifest([r.asDict() for r in docs.collect()])
    assert list(map(tuple, merkle.manifest(docs).collect())) == want and want[0][4] == sha256(b"").hexdigest()
    assert merkle.manifest(docs.limit(0)).count() == 0


def test_ranks_count_smaller_ids(llm):
    ids = [0, 1, 63, 64, 65, 1 << 22, (1 << 22) + 1, 1 << 38, 1 << 60, -1, -64, -(1 << 63), (1 << 63) - 1]
    docs = llm.createDataFrame([(i, "t", "en", "s", 1) for i in ids], SCHEMA)
    rows = merkle.entries(docs)
    got = {r.doc_id: r.start for r in merkle.coordinates(rows, merkle.bitmaps(rows)).collect()}
    assert got == {d: k for k, d in enumerate(sorted(ids))}


def test_query_equals_sql(llm, tables):
    df = QUERIES["op12_merkle"](llm, SF)
    cur = connect(SF).execute(SQL["op12_merkle"])
    names = [d[0] for d in cur.description]
    assert counted(df.columns, [tuple(r) for r in df.collect()]) == counted(names, cur.fetchall()) and sorted(names) == sorted(df.columns)
