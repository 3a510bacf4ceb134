"""Operators that compare documents with each other, against brute force, and the pipeline."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from tidemark.llm import chunk_dedup, kmeans_tree, run_index, simhash, toxicity
from tidemark.llm.components import components
from tidemark.llm.queries import QUERIES
from tidemark.llm.shared import stored
from tests.llm.conftest import SF


def reach(nodes, linked):
    """Component of each node: the smallest one reachable."""
    label = {n: n for n in nodes}
    moved = True
    while moved:
        moved = False
        for a, b in linked:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_components(llm):
    rng = random.Random(1)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)]
    links += [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 560)]
    got = {r.node: r.component for r in components(llm.createDataFrame(links, "a long, b long")).collect()}
    want = reach({x for p in links for x in p}, links)
    assert got == {n: c for n, c in want.items() if n in got} and all(want[n] == n for n in want.keys() - got.keys())
    assert components(llm.createDataFrame([], "a long, b long")).count() == 0


# SimHash


def plain_print(text, words=3):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h))


def plain_groups(prints, radius):
    ids = list(prints)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if (prints[a] ^ prints[b]).bit_count() <= radius]
    return reach(ids, links)


def test_simhash_query_equals_brute_force(llm, tables):
    prints = {r.doc_id: plain_print(r.text) for r in tables("documents").collect()}
    want = plain_groups(prints, 2)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op9_simhash"](llm, SF).collect()}
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in prints}


def test_simhash_odd_rows_and_small_blocks(llm, frame, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 4)
    rng = random.Random(3)
    words = ["one", "two", "three", "four"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 5))) for _ in range(150)]
    docs = frame([*texts, None, "", "\x0b\t", "İ ı", "One TWO three", (3, texts[3]), (3, "other text here")])
    got = simhash.near_duplicates(docs, 3, 2)
    rows = docs.select("doc_id", "text").collect()
    prints = {n: plain_print(r.text) for n, r in enumerate(rows)}
    by_value = defaultdict(list)
    for n, f in prints.items():
        by_value[f].append(rows[n].doc_id)
    values = sorted(by_value)
    label = plain_groups({i: f for i, f in enumerate(values)}, 2)
    low = defaultdict(lambda: 10**9)
    for i, f in enumerate(values):
        low[label[i]] = min(low[label[i]], *by_value[f])
    want = sorted((rows[n].doc_id, f - (1 << 64) if f >> 63 else f, low[label[values.index(f)]]) for n, f in prints.items())
    assert sorted(map(tuple, got.collect())) == want
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_groups_without_ids(llm, frame):
    docs = frame([(None, "alone without a name"), (None, "alone without a name"), (5, "a name of its own"), (None, "a name of its own")])
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(None, None), (None, None), (5, 5), (None, 5)], key=str)


@pytest.mark.parametrize("words", [4, 8, 16])
def test_links_of_any_cells_connect_what_is_near(llm, monkeypatch, words):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rng = random.Random(words)
    values = {0, (1 << 64) - 1, 1, 3, 7, 1 << 63}
    for _ in range(60):
        v = rng.getrandbits(64)
        for _ in range(6):
            values.add(v)
            v ^= sum(1 << rng.randrange(64) for _ in range(rng.randint(1, 2))) & ((1 << 64) - 1)
    values = sorted(values)
    points = llm.createDataFrame([(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)], "rep long, f0 long")
    links = [tuple(r) for r in simhash.near_links(points, 2, words).collect()]
    assert reach(range(len(values)), links) == plain_groups(dict(enumerate(values)), 2)


def test_one_of_each_group_stays(llm, frame):
    rng = random.Random(9)
    base = [f"word{i}" for i in range(400)]
    texts = [" ".join(base), " ".join([*base[:-1], "other"]), " ".join([*base, "more"]), " ".join(reversed(base)), "", None, "unlike anything else"]
    ids = rng.sample(range(1000), len(texts))
    rows = [*zip(ids, texts), (ids[0], texts[0]), (ids[0], texts[6]), (None, texts[0])]
    docs = frame(rows)
    prints = {n: plain_print(t) for n, (_, t) in enumerate(rows)}
    label = plain_groups(prints, 2)
    best = {}
    for n, (i, t) in enumerate(rows):
        if i is not None:
            best[label[n]] = min(best.get(label[n], (10**9, None)), (i, t or ""), key=lambda r: r[0])
    kept = simhash.first_of_each_group(docs).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(i for i, _ in best.values())
    assert [r.text for r in kept if r.doc_id is None] == [texts[0]] and set(kept[0].asDict()) == set(docs.columns)
    assert len(best) < len(set(texts)) + 1


def test_texts_under_one_id_stay_apart(llm, frame):
    rng = random.Random(7)
    one, two, three = (" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(40)) for _ in range(3))
    docs = frame([(1, one), (1, two), (1, three), (1, three), (2, one), (3, two), (4, "alone")])
    kept = sorted((r.doc_id, r.text) for r in simhash.first_of_each_group(docs).collect())
    assert kept == sorted([(1, one), (1, two), (1, three), (4, "alone")])
    plain = simhash.near_duplicates(frame([(1, one), (1, two), (0, two)])).collect()
    assert sorted((r.doc_id, r.component_id) for r in plain) == [(0, 0), (1, 0), (1, 1)]


# Substrings


def covered(texts, length):
    """Bytes covered by strings that also start elsewhere, per text."""
    data = [(t or "").encode() for t in texts]
    seen = defaultdict(int)
    for d in data:
        for i in range(len(d) - length + 1):
            seen[d[i:i + length]] += 1
    out = []
    for d in data:
        mask = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                mask[i:i + length] = True
        out.append((d, mask))
    return out


def corpus(seed):
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared = [make(n) for n in (390, 420, 700, 1500)]
    texts = [make(rng.randint(0, 300)) + rng.choice(shared) + make(rng.randint(0, 300)) for _ in range(60)]
    texts += [texts[0]] * 5 + [texts[1][:200] + "Z" + texts[1][200:], "ab" * 700, "ab" * 700 + "c", "x" * 1300, None, "", shared[2] * 2, "é" * 450]
    return texts


@pytest.mark.parametrize("group", [500, 1])
def test_repeated_bytes_equal_brute_force(llm, frame, monkeypatch, group):
    monkeypatch.setattr(run_index, "GROUP", group)
    monkeypatch.setattr(run_index, "INDEX_BYTES", 20_000)
    texts = corpus(2)
    docs = frame([*texts, (3, texts[3]), (None, texts[4])])
    rows = docs.select("doc_id", "text").collect()
    want = []
    for r, (d, mask) in zip(rows, covered([r.text for r in rows], 400)):
        kept = bytes(b for b, m in zip(d, mask) if not m)
        want.append((r.doc_id, len(d), int((mask[:-1] & ~mask[1:]).sum()), kept))
    got = [(r.doc_id, r.n_bytes, len(r.spans), bytes(r.kept)) for r in run_index.dedup(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert run_index.dedup(docs.limit(0)).count() == 0


@pytest.mark.parametrize("group", [500, 1])
def test_passages_of_over_fifty_words_are_reported(llm, frame, monkeypatch, tmp_path, group):
    monkeypatch.setattr(run_index, "GROUP", group)
    rng = random.Random(12)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))
    passages = [prose(rng.randint(51, 70)) for _ in range(60)]
    planted = [f"{prose(rng.randint(0, 150))} {p} {prose(rng.randint(0, 150))}" for p in passages for _ in range(2)]
    texts = planted + [prose(rng.randint(0, 300)) for _ in range(40)] + [passages[0][:300], passages[0][:300], "", None]
    docs = frame(texts)
    got = {r.doc_id: r for r in run_index.dedup(docs).collect()}
    for i, (d, mask) in enumerate(covered(texts, run_index.SHORT)):
        found = {k for s in got[i].repeated for k in range(s.start, s.end)}
        assert found <= set(np.flatnonzero(mask)) and {k for s in got[i].spans for k in range(s.start, s.end)} <= found
    assert sum(bool(got[i].repeated) for i in range(len(planted))) >= 0.9 * len(planted)
    assert not any(got[i].repeated for i in range(len(planted), len(planted) + 40))
    assert all([tuple(s) for s in got[i].repeated] == [(0, 300)] and not got[i].spans for i in (len(planted) + 40, len(planted) + 41))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    counts = {r.doc_id: r.n_repeated for r in QUERIES["op4_run_index"](llm, str(tmp_path)).collect()}
    assert counts == {i: sum(s.end - s.start for s in r.repeated) for i, r in got.items()}


def test_repeated_bytes_on_the_given_table(llm, tables):
    docs = tables("documents").select("doc_id", "text").collect()
    want = {}
    for r, (d, mask) in zip(docs, covered([r.text for r in docs], 400)):
        kept = bytes(b for b, m in zip(d, mask) if not m)
        want[r.doc_id] = (len(d), len(d) - len(kept), int((mask[:-1] & ~mask[1:]).sum()), hashlib.sha256(kept).hexdigest())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op4_run_index"](llm, SF).collect()}
    assert got == want


def test_digests_and_classes_need_no_python_and_no_sorted_rows(llm, frame):
    texts = [*corpus(3), "a\0b" * 200, "é" * 250, "e\u0301" * 250]
    keyed = run_index._keyed(run_index.texts(frame(texts)))
    got = {(r.k0, r.k1): r.text for r in keyed.collect()}
    assert sorted(got.values()) == sorted({t or "" for t in texts})
    for (k0, k1), text in got.items():
        d = hashlib.md5(text.encode()).digest()
        assert (k0, k1) == tuple(int.from_bytes(d[i:i + 8], "big", signed=True) for i in (0, 8))
    place = ["k0", "k1", "doc_id"]
    classes = run_index._classes(keyed, ["text"], place)
    rows = run_index._one_of_each(keyed, classes, ["text"], place)
    assert sorted(r.text for r in rows.where("stands").select("text").collect()) == sorted({t or "" for t in texts})
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "InArrow" not in plan and "SortAggregate" not in plan and "HashAggregate" in plan


def test_matching_statistics_equal_brute_force():
    rng = random.Random(7)
    for _ in range(60):
        texts = [bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 6))]
        index = run_index.RunIndex(texts)
        got, at = index.matching_statistics(), 0
        flat = [(n, i) for n, t in enumerate(texts) for i in range(len(t))]
        for n, t in enumerate(texts):
            for i in range(len(t)):
                best = max((next((k for k in range(99) if t[i:i + k + 1] != texts[m][j:j + k + 1] or i + k >= len(t)), 99) for m, j in flat if (m, j) != (n, i)), default=0)
                assert got[at + i] == best
            at += len(t) + 1


def plain_cuts(t):
    ends, last = [], 0
    for i in range(len(t)):
        h = sum(int(chunk_dedup.GEAR[t[i - a]]) << a for a in range(min(32, i + 1))) & 0xFFFFFFFF
        size = i + 1 - last
        if size == chunk_dedup.LONGEST or (h >> (32 - chunk_dedup.CUT_BITS) == 0 and size >= chunk_dedup.SHORTEST):
            ends.append(i + 1)
            last = i + 1
    return ends + ([len(t)] if last < len(t) else [])


def test_cuts_equal_the_rolling_definition():
    rng = random.Random(8)
    texts = [bytes(rng.choice(b"abcdef ") for _ in range(rng.randint(0, 900))) for _ in range(20)] + [b"", b"\0" * 1000, b"a" * 700]
    assert chunk_dedup.cuts(texts) == [plain_cuts(t) for t in texts]


def test_chunk_dedup_equals_brute_force(llm, frame):
    texts = corpus(4)
    docs = frame([(i, t) for i, t in enumerate(texts)])
    places = defaultdict(list)
    for i, t in enumerate(texts):
        d = (t or "").encode()
        ends = plain_cuts(d)
        for a, b in zip([0, *ends[:-1]], ends):
            places[d[a:b]].append((i, a, b))
    runs = defaultdict(int)
    for later in (False, True):
        per_doc = defaultdict(list)
        for where in places.values():
            if len(where) > 1:
                for p in sorted(where)[later:]:
                    per_doc[p[0]].append(p[1:])
        for i, spans in per_doc.items():
            joined = []
            for a, b in sorted(spans):
                if joined and joined[-1][1] == a:
                    joined[-1][1] = b
                else:
                    joined.append([a, b])
            runs[i, later] = sum(b - a for a, b in joined if b - a >= chunk_dedup.MIN_RUN or (a, b) == (0, len((texts[i] or "").encode())))
    want = {i: (runs[i, False], runs[i, True]) for i in range(len(texts)) if runs[i, False]}
    assert {r.doc_id: (r.n_repeated, r.n_removed) for r in chunk_dedup.summary(docs).collect()} == want and want
    assert chunk_dedup.summary(docs.limit(0)).count() == 0


def test_chunks_resist_insertions(frame):
    rng = random.Random(9)
    passage = " ".join(f"w{rng.randint(0, 999)}" for _ in range(80))
    docs = frame(["lead " + passage, "another beginning, longer: " + passage + " end", "nothing in common with the rest of these", None, ""])
    found = {r.doc_id: r for r in chunk_dedup.summary(docs).collect()}
    assert set(found) == {0, 1} and found[0].n_removed == 0 and found[1].n_removed > len(passage) / 2


# Nearest neighbours


def plain_neighbours(rows, every, k):
    out = {}
    for q, v in rows:
        if q % every == 0:
            near = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q))[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def test_neighbours_are_exact_on_few_rows_with_ties_and_unsound_vectors(llm):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.0, 0.5, 2.0]) for _ in range(4)]) for i in range(120)]
    rows += [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(200, 260)]
    odd = [(300, None), (320, [0.0] * 4), (340, [1.0, None, 0.0, 0.0]), (360, [float("nan"), 0.0, 0.0, 1.0]), (380, [float("inf"), 0.0, 0.0, 1.0]), (400, []), (None, [1.0] * 4)]
    table = llm.createDataFrame([*rows, rows[0], *odd], "vec_id long, embedding array<float>").selectExpr("*", "1 AS leaf", "2 AS score")
    got = defaultdict(list)
    for r in kmeans_tree.search(table, 20, 20).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert dict(got) == plain_neighbours(rows, 20, 20)
    few = kmeans_tree.search(table.where("vec_id < 5"), 20, 20)
    assert sorted(r.vec_id for r in few.collect()) == [1, 2, 3, 4]
    assert kmeans_tree.search(table.limit(0)).count() == 0 == kmeans_tree.search(table.where("vec_id IN (300, 320)")).count()


def test_recall_against_brute_force(llm, tables):
    rows = [(r.vec_id, list(map(float, r.embedding))) for r in tables("embeddings").collect()]
    want, got = plain_neighbours(rows, 20, 20), defaultdict(set)
    for r in QUERIES["op10_kmeans_tree"](llm, SF).collect():
        got[r.query_id].add(r.vec_id)
    hits = sum(len(got[q] & {i for i, _ in near}) for q, near in want.items())
    assert hits >= 0.9 * sum(map(len, want.values())) and all(len(got[q]) == len(near) for q, near in want.items())


def test_large_leaves_are_cut_into_blocks(llm, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "BLOCK", 5)
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(90)]
    got = defaultdict(list)
    for r in kmeans_tree.search(llm.createDataFrame(rows, "vec_id long, embedding array<double>"), 20, 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    want = plain_neighbours(rows, 20, 5)
    hits = sum(len(set(got[q]) & {i for i, _ in near}) for q, near in want.items())
    assert hits >= 0.9 * 5 * len(want)


def test_short_copies_count_as_whole_texts(llm, frame):
    rng = random.Random(8)
    short = "".join(rng.choice("abcdefgh ") for _ in range(61))
    other = "".join(rng.choice("stuvwxyz ") for _ in range(150))
    docs = frame([(3, short), (1, short), (2, short + other), (4, "x"), (5, "x"), (6, other[:40]), (7, None), (8, "")])
    got = {r.doc_id: (r.n_repeated, r.n_removed, r.n_spans) for r in chunk_dedup.summary(docs).collect()}
    assert got[1] == (61, 0, 0) and got[3] == (61, 61, 1) and got[4] == (1, 0, 0) and got[5] == (1, 1, 1)
    assert set(got) <= {1, 2, 3, 4, 5} and got.get(2, (0, 0, 0))[1] in (0, 61)


def test_chunk_dedup_gives_every_row_and_what_is_left(llm, frame, tmp_path):
    texts = {(i, t) for i, t in enumerate(corpus(5))} | {(900, None), (901, ""), (None, "x" * 300), (None, "of one's own"), (902, "x" * 300)}
    docs = frame(sorted(texts, key=str))
    counts = {(r.doc_id, r.n_repeated, r.n_removed) for r in chunk_dedup.summary(docs).collect()}
    left = defaultdict(list)
    for r in chunk_dedup.dedup(docs).collect():
        left[r.doc_id].append(r)
    assert sorted(map(str, left)) == sorted({str(i) for i, _ in texts}) and sum(map(len, left.values())) == len(texts)
    for i, t in texts:
        data = (t or "").encode()
        gone = lambda r: [k for s in r.spans for k in range(s.start, s.end)]
        assert any(r.n_bytes == len(data) and bytes(b for k, b in enumerate(data) if k not in set(gone(r))) == bytes(r.kept) and len(gone(r)) == r.n_removed for r in left[i])
    assert {(r.doc_id, r.n_repeated, r.n_removed) for rows in left.values() for r in rows if r.n_repeated} == counts and counts
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op7_chunk_dedup"](llm, str(tmp_path))
    assert got.count() == len(texts) and {"n_bytes", "kept_sha256"} <= set(got.columns)


def test_chunks_tell_what_their_text_holds_before(frame):
    rng = random.Random(10)
    passage = " ".join(f"w{rng.randint(0, 999)}" for _ in range(60))
    texts = [passage, f"{passage} {passage} {passage}", f"{passage} {passage}", "", None]
    held = defaultdict(set)
    for r in chunk_dedup.chunks(frame(texts)).orderBy("doc_id", "start").collect():
        assert bool(r.piece & 2) == ((r.d0, r.d1) in held[r.doc_id])
        held[r.doc_id].add((r.d0, r.d1))
    found = {r.doc_id: (r.n_repeated, r.n_removed) for r in chunk_dedup.summary(frame(texts)).collect()}
    assert found[0][1] == 0 < found[1][1] < found[1][0]  # the first text stays, as do the first chunks across the ends of copies


def test_chunk_dedup_shuffles_packed_texts_and_runs_once(llm, frame):
    long = "ab" * (5 << 20)
    docs = frame([long, long, "c" + long, "short"])
    out = chunk_dedup.dedup(docs)
    text = out._jdf.queryExecution().executedPlan().toString()
    shuffles = re.findall(r"Exchange hashpartitioning\(([^\n]*)", text)
    assert not any("later#" in s for s in shuffles) and len(re.findall(r"Window \[", text)) == 1
    assert not re.search(r"text#[^\n]*\n[^\n]*Exchange", text) and "packed#" in text
    got = {r.doc_id: r for r in out.selectExpr("doc_id", "n_bytes", "n_removed", "octet_length(kept) AS left").collect()}
    assert [got[i].n_bytes for i in range(4)] == [len(long), len(long), len(long) + 1, 5]
    assert got[1].left == 0 and all(r.left == r.n_bytes - r.n_removed for r in got.values())


# The pipeline


def test_pipeline_stages_take_effect(llm, tables):
    docs = tables("documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_copies", "decontamination", "personal_data", "byte_bpe"]
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(llm, docs, SF), name)
        seen.append((before, docs))
    for before, after in seen[:-1]:
        assert before.schema.names == after.schema.names and after.count() <= before.count()
    (raw, kept), (_, single), (_, unseen), (_, hidden), (_, done) = seen
    flagged = toxicity.scores(raw, tables("labels")).where("predicted = 1").select("doc_id")
    assert kept.join(flagged, "doc_id").count() == 0 and kept.count() == raw.count() - flagged.count()
    groups = simhash.near_duplicates(kept)
    assert {r.doc_id for r in single.collect()} == {r.component_id for r in groups.collect()}
    items = [r.text.lower() for r in tables("benchmark").collect()]
    assert not any(t in r.text.lower() for r in unseen.collect() for t in items)
    assert "@mail" not in " ".join(r.text for r in hidden.collect()) and hidden.where("n_chars != char_length(text)").count() == 0
    assert {(r.doc_id, r.text) for r in done.collect()} == {(r.doc_id, r.text) for r in hidden.collect()}
    assert sorted(map(tuple, corpus_pipeline.run(llm, SF).select("doc_id", "n_tokens").collect())) == sorted(map(tuple, done.select("doc_id", "n_tokens").collect()))


def test_pipeline_stages_take_odd_rows(llm, frame):
    docs = frame([(1, None), (2, ""), (None, "a text without a name"), (4, "same"), (4, "same"), (5, "z" * 40_000)])
    for docs_ in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            after = stored(stage(llm, docs_, SF), name)
            assert after.count() <= docs_.count()
            docs_ = after
