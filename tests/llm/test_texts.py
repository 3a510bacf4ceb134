"""Operators on single texts, each against a plain version of its contract."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from tidemark.llm import byte_bpe, decontaminate, personal_data, quality, token_files, toxicity
from tidemark.llm.queries import QUERIES
from tidemark.llm.samples import thinned
from tests.llm.conftest import SF

ODD = [
    None, "", "   ", "\n\t ", "a", "İstanbul ΣΑΣ don't 'sure <|endoftext|>x é a b\x1c d\u0085e 12ab!!x ​ 你好 ﬁ K Å", "word " * 3,
    " " * 3000 + "end", "x" * 5000, "tail   ", "same", "same", "naïve café\r\nline", "🙂🙂 \U0001F469‍\U0001F52C",
]


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


# Token files


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.path("word_bpe_49k.json"))


def plain_ids(tokenizer, texts):
    return [[*e.ids, 1] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_token_files_hold_what_the_library_gives(llm, frame, tmp_path):
    docs = frame([*((i, t) for i, t in enumerate(ODD)), (3, "again"), (3, "again"), (None, "nameless")])
    manifest = token_files.write(docs, P.path("word_bpe_49k.json"), f"file://{tmp_path}/ids")
    order = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0))
    want = {}
    for r, ids in zip(order, plain_ids(library(), [r[1] for r in order])):
        want.setdefault(r[0], []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = token_files.digests(manifest).orderBy("start").collect()
    assert [r.doc_id for r in got] == [r[0] for r in order]
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    for r in got:
        assert (r.n_tokens, r.ids_crc32) in want[r.doc_id]
    some = {r.doc_id: list(r.ids) for r in token_files.read(manifest, [5, 8]).collect()}
    assert some == {i: plain_ids(library(), [ODD[i]])[0] for i in (5, 8)}


def test_token_files_on_the_given_table(llm, tables):
    want = {}
    docs = sorted(tables("documents").select("doc_id", "text").collect())
    start = 0
    for r, ids in zip(docs, plain_ids(library(), [r[1] for r in docs])):
        want[r[0]] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op1_token_files"](llm, SF).collect()}
    assert got == want


def test_a_reader_decompresses_only_the_frames_it_needs_and_checks_them():
    import io

    out, ids = io.BytesIO(), np.random.default_rng(1).integers(0, 49000, 300_000).astype("<u4")
    writer = token_files.Writer(out)
    parts = [ids[:10], ids[10:200_000], ids[200_000:]]
    for i, part in enumerate(parts):
        writer.add(i, part.tobytes())
    writer.close()
    data = out.getvalue()
    reader = token_files.Reader(io.BytesIO(data), len(data))
    assert reader.ids(0) == parts[0].tobytes() and reader.frames_read == 1
    assert [reader.ids(i) for i in (2, 1)] == [parts[2].tobytes(), parts[1].tobytes()]
    import zstandard

    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read() == ids.tobytes()
    bad = bytearray(data)
    table = len(data) - 9 - 12 * len(writer.frames)
    bad[table + 8] ^= 1  # the first frame's checksum
    with pytest.raises(ValueError, match="checksum"):
        token_files.Reader(io.BytesIO(bytes(bad)), len(bad)).ids(0)


def test_words_beyond_the_memory_are_encoded_again(monkeypatch):
    monkeypatch.setattr(token_files.WordEncoder, "KEEP_WORDS", 3)
    monkeypatch.setattr(token_files.WordEncoder, "STRETCH", 30)
    encode = token_files.WordEncoder(P.path("word_bpe_49k.json"))
    texts = ["one two, three four", "five two six-seven one", "Eight's nine", "long words\tand ΣΊΣ \u0301x " * 9, "²x Ⅷ 12", "a" * 200 + " b", ""]
    assert [np.frombuffer(b, "<u4").tolist() for b in encode(texts)] == [i[:-1] for i in plain_ids(library(), texts)]


# Byte-level BPE


def test_byte_bpe_equals_the_library_and_decodes_back(llm, frame):
    code = byte_bpe.Coder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    rng = random.Random(4)
    long = ["".join(rng.choice(["a", " ", "  ", "\n", "'s", "9", "é", "don't ", "你", "word "]) for _ in range(3000)) for _ in range(4)]
    texts = [*ODD, *long, long[0], "y" * 4000 + " z" * 900, " " * 6000]
    docs = frame([*((i, t) for i, t in enumerate(texts)), (7, long[1]), (7, long[1]), (None, long[2])])
    made = byte_bpe.decode(byte_bpe.encode(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, chunk=1200), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    want = sorted(((r.doc_id, code.whole(r.text or ""), (r.text or "").encode()) for r in docs.collect()), key=str)
    assert sorted(((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in made.collect()), key=str) == want


def test_byte_bpe_on_the_given_table(llm, tables):
    code = byte_bpe.Coder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    want = {
        r.doc_id: (len(code.whole(r.text)) // 4, hashlib.sha256(code.whole(r.text)).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest())
        for r in tables("documents").collect()
    }
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op6_byte_bpe"](llm, SF).collect()}
    assert got == want


# Personal data


def plain_spans(text):
    out = []
    patterns = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    for kind, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            doubled = [int(c) if i % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) for i, c in enumerate(reversed(digits))]
            fine = (
                True, kind == 1 and all(int(p) <= 255 for p in m[0].split(".")),
                12 <= len(digits) <= 19 and sum(doubled) % 10 == 0, 9 <= len(digits) <= 15,
            )[kind]
            if fine:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], s[0]))


def test_base_spans_equal_the_patterns():
    rng = random.Random(6)
    letters = ["1", "22", "255", "0", ".", ".", "-", " ", "+", "(", ")", "@", "a", "b.c", "1.2.3.4", "4111111111111111", "é", "%"]
    for _ in range(5000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 25)))
        assert personal_data.base_spans(text) == plain_spans(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000, "@" * 100_000, "1." * 100_000, "+1" + "(" * 200_000, "- " * 100_000):
        personal_data.base_spans(text)


def test_repetitions_share_labels(llm, frame, tables):
    text = "call +1 (974) 555-3436 now. Later (974) 555-3436 again; version 2.0 and 12345678."
    weights = personal_data.learn(tables("documents"))
    base = personal_data.base_spans(text)
    added = set(personal_data.all_spans(weights, text, base)) - set(base)
    assert [(personal_data.KINDS[k], text[a:b]) for k, a, b in added] == [("phone", "(974) 555-3436")]
    plain = "version 2.0 and 12345678, 3.14 or 20 times, 555-34 36"  # nothing to repeat, nothing that looks like it
    assert personal_data.all_spans(weights, plain, personal_data.base_spans(plain)) == []


def enumerated(weights, text, found):
    """Beliefs of every node by adding up all labellings."""
    node, out = personal_data.potentials(weights, text, found), np.zeros((len(found), personal_data.STATES))
    edges = [(*e, weights.chain) for e in personal_data.beside(found)] + [(*e, weights.skip) for e in personal_data.same(text, found)]
    for states in itertools.product(range(personal_data.STATES), repeat=len(found)):
        p = np.exp(sum(node[i, k] for i, k in enumerate(states)) + sum(force for a, b, force in edges if states[a] == states[b]))
        for i, k in enumerate(states):
            out[i, k] += p
    return out / out.sum(axis=1, keepdims=True)


def test_marginals_equal_enumeration():
    rng = random.Random(5)
    words = ["+1 (974) 555-3436", "(974) 555-3436", "9745553436", "10.1.2.3", "a@b.cd", "A@b.cd", "12345678", "x"]
    loops = 0
    for _ in range(40):
        text = " and ".join(rng.choice(words) + "; so" * rng.choice([0, 0, 30]) for _ in range(rng.randint(1, 5)))
        found = personal_data.nodes(text, personal_data.base_spans(text) if rng.random() < 0.7 else [])[:6]
        if not found:
            continue
        look = tuple(tuple(rng.gauss(0, 1) for _ in range(personal_data.FEATURES)) for _ in range(personal_data.STATES))
        weights = personal_data.Weights(look, rng.uniform(0, 0.6), rng.uniform(0, 3))
        edges = len(personal_data.beside(found)) + len(personal_data.same(text, found))
        got, want = personal_data.marginals(weights, text, found), enumerated(weights, text, found)
        tree = edges < len(found) and not set(personal_data.beside(found)) & set(personal_data.same(text, found))
        loops += not tree
        assert np.abs(got - want).max() < (1e-3 if tree else 0.25)
        if not tree:
            assert (got.argmax(axis=1) == want.argmax(axis=1)).mean() >= 0.5
    assert loops > 5


def test_couplings_are_learnt():
    """Repetitions that agree keep their coupling, repetitions that do not lose it; hidden nodes say nothing."""
    agree = [((3, *[0] * 5, 0, 0, 0, 1, 0, 0, 9), 50), ((4, *[0] * 5, 0, 0, 0, 0, 1, 0, 10), 50)]
    differ = [((3, *[0] * 5, 0, 0, 0, 0, 1, 0, 9), 50), ((4, *[0] * 5, 0, 0, 0, 1, 0, 0, 9), 50)]  # of one look
    assert personal_data.learnt(agree).skip >= personal_data.SKIP > personal_data.learnt(differ).skip + 1
    assert personal_data.learnt([]).skip == personal_data.SKIP
    shown = list(personal_data.examples("call +1 (974) 555-3436 or 12345678" + " x" * 60 + " then (974) 555-3436"))
    assert len(shown) == 2 and [r[0] for r in shown] == [3, 4]


def test_planted_repetitions_in_other_forms_are_found(llm, tables):
    """Numbers and addresses of the given texts, repeated far away without what the patterns need."""
    weights, rng = personal_data.learn(tables("documents")), random.Random(2)
    planted = caught = wrong = 0
    for r in tables("documents").collect():
        for kind, a, b in personal_data.base_spans(r.text):
            word = r.text[a:b]
            other = {0: word.replace("@", " [at] "), 2: ".".join(re.findall("[0-9]{1,4}", re.sub("[ -]", "", word))), 3: word.lstrip("+")}.get(kind)
            if other is None:
                continue
            text = r.text + " lorem ipsum" * rng.randint(1, 40) + " so " + other + " it is, 4471 times."
            at = text.rindex(other)
            added = set(personal_data.all_spans(weights, text, personal_data.base_spans(text))) - set(personal_data.base_spans(text))
            planted += 1
            caught += any(k == kind and x < at + len(other) and y > at for k, x, y in added)
            wrong += sum(not (x < at + len(other) and y > at) for _, x, y in added)
    assert planted >= 10 and caught >= 0.9 * planted and wrong <= 0.05 * planted


def test_personal_data_query_and_mask(llm, frame, tables):
    for r in QUERIES["op3_personal_data"](llm, SF).join(tables("documents"), "doc_id").collect():
        base = plain_spans(r.text)
        written = [f"{personal_data.KINDS[k]}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for k, _, _ in base) for n in range(4)]
        assert set(written) <= set(r.spans.split(",") if r.spans else [])
    docs = frame([None, "", "mail a.b@mail.example.com or +1 (974) 555-3436", "clean"])
    done = {r.doc_id: r for r in personal_data.mask(docs).collect()}
    assert done[2].text == "mail [EMAIL] or [PHONE]" and done[2].n_chars == len(done[2].text)
    assert done[0].text is None and done[3].text == "clean" and done[3].rep == 1 and done[3].key == "x"


# Decontamination


def distance(item, text):
    """Edit distance of an item to its closest substring."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        next_ = [i]
        for j, d in enumerate(text, 1):
            next_.append(min(row[j] + 1, next_[j - 1] + 1, row[j - 1] + (c != d)))
        row = next_
    return min(row)


def test_myers_equals_the_plain_table():
    rng = random.Random(8)
    for _ in range(400):
        item = "".join(rng.choice("ab c") for _ in range(rng.randint(1, 80)))
        spot = list(item)
        for _ in range(rng.randint(0, 6)):
            spot[rng.randrange(len(spot))] = rng.choice("ab c")
        text = "".join(rng.choice("ab c") for _ in range(20)) + "".join(spot)
        hit, best = decontaminate.Pattern(item).find(text), distance(item, text)
        assert (hit[0] if hit else None) == (best if best <= decontaminate.budget(item) else None)


def test_every_passage_within_the_budget_is_found(llm, frame):
    rng = random.Random(9)
    items = ["".join(rng.choice("abcdefg hijk") for _ in range(n)).strip() for n in (40, 90, 200, 12)]
    texts = []
    for _ in range(40):
        spot = list(rng.choice(items))
        for _ in range(rng.randint(0, 14)):
            at = rng.randrange(len(spot))
            rng.choice([lambda: spot.__setitem__(at, "z"), lambda: spot.insert(at, "y"), lambda: spot.pop(at) if len(spot) > 2 else None])()
        texts.append("lead in " + "".join(spot).upper().replace(" ", "\n") + " lead out")
    docs = frame([*texts, None, "", items[0], items[0]])
    bench = llm.createDataFrame([*enumerate(items), (9, None), (10, " "), (0, items[0]), (None, items[1])], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench).collect()}
    want = set()
    for r in docs.collect():
        for i, item in [*enumerate(items), (None, items[1])]:
            if r.text and distance(item, decontaminate.plain(r.text)) <= decontaminate.budget(item):
                want.add((r.doc_id, i))
    assert got == want and want
    kept = {r.doc_id for r in decontaminate.clean(docs, bench).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - {d for d, _ in want}
    assert decontaminate.matches(docs, bench.limit(0)).count() == 0 == decontaminate.matches(docs.limit(0), bench).count()


def test_benchmark_larger_than_a_block(llm, frame, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK", 60)
    items = [f"passage number {i} of the benchmark, told apart by {i * 7919}" for i in range(6)]
    bench = llm.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = frame([f"so {i} then" for i in items])
    found = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench).collect() if r.distance == 0}
    assert found == {(i, i) for i in range(6)} and decontaminate.clean(docs, bench).count() == 0


def test_planted_passages_of_the_given_tables(llm, tables):
    items = {r.item_id: r.text.lower() for r in tables("benchmark").collect()}
    want = {(r.doc_id, i) for r in tables("documents").collect() for i, t in items.items() if t in r.text.lower()}
    assert want <= {(r.doc_id, r.item_id) for r in QUERIES["op8_decontaminate"](llm, SF).collect()}


# Classifiers


WRITTEN = {  # text -> whether it is toxic
    "you are an idiot": True, "an idiot, that is what you are": True, "idiots like these. what a moron. such scum. pathetic": True,
    "I will kill you. I will stab you. You will die, I will shoot you.": True, "you moron. you moron. you moron": True,
    "This will kill. We will shoot, we will stab. It will strangle.": True,
    "idiot": False, "a moron came by": False, "you are not an idiot": False, "he said you are an idiot": False,
    'she wrote "you are an idiot" and left': False, "I would never hurt you": False, "they called you a moron, you said": False,
    "you came. an idiot left" + ". so it went on" * 30 + ". a moron came": False, "kill the process": False, "": False, "nothing here": False,
}


def plain_model():
    return toxicity.Model(tuple((w, 1.0) for w in toxicity.INSULTS), (("lowe", 1.5), ("idiots", 1.0)), tuple(toxicity.PRIOR))


def test_grammar_tells_clauses_apart():
    scorer = toxicity.Scorer(plain_model())
    kinds = lambda text: [k for k, _ in scorer.matches(text)]
    assert kinds("you are a moron") == kinds("a moron you are") == kinds("not now. you moron") == ["targeted insult"]
    assert kinds("a moron came") == kinds("loweisch things") == kinds("nothing here") == kinds("") == []
    assert kinds("a moron and an idiot came") == ["strung insult"] and kinds("moron. well. idiot") == ["pursued insult"]
    assert kinds("moron" + ". well" * 9 + ". idiot") == ["resumed insult"] and kinds("moron" + ". well" * 30 + ". idiot") == []
    assert kinds("you are not a moron") == ["negated insult"] and kinds('he said "you moron" and left') == ["reported insult"]
    assert kinds("i will kill you") == kinds("they kill time") == ["targeted threat"] and kinds("it will kill") == ["intended threat"]
    assert kinds("kill it") == [] and kinds("he said he will kill you") == ["reported threat"] and kinds("never kill you") == ["negated threat"]
    assert {t: scorer.score(t) >= toxicity.THRESHOLD for t in WRITTEN} == WRITTEN
    assert scorer.score("you are an idiot") > 0.7 and scorer.score("idiot") == scorer.score("") < 0.1


@pytest.mark.parametrize("machine", ["target", "negation", "report", "insult", "threat"])
def test_no_machine_can_be_left_out(machine):
    scorer = toxicity.Scorer(plain_model(), frozenset([machine]))
    assert {t: scorer.score(t) >= toxicity.THRESHOLD for t in WRITTEN} != WRITTEN


def test_composition_runs_one_machine_after_the_other():
    """The composed table does what the machines do in turn, for any symbols."""
    rng, whole = random.Random(3), toxicity.grammar()
    symbols = [*toxicity.SYMBOLS, "insult at", "threat at"]
    for _ in range(300):
        state, states = whole.start, [m.start for m in toxicity.MACHINES.values()]
        for _ in range(40):
            symbol = plain = rng.choice(symbols)
            for i, machine in enumerate(toxicity.MACHINES.values()):
                states[i], plain = machine.step(states[i], plain)
            state, out = whole.table[state, symbol]
            assert out == plain and (out == "" or out in toxicity.KINDS)


def test_held_out_toxic_texts_are_found(llm):
    """Of 144 held-out toxic texts nine hold no insult or threat of any kind: their label is all that says so."""
    folder = SF.replace("0.001", "0.1")
    df = QUERIES["op2_toxicity"](llm, folder).join(llm.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out")
    n = {(r.toxic, r.predicted): r["count"] for r in df.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] >= 0.9 * (n[1, 1] + n[1, 0]) and n[1, 1] >= 0.95 * (n[1, 1] + n[0, 1])


def accuracy(df, labels, column):
    r = df.join(labels, "doc_id").where("held_out").toPandas()
    return r, (r[column] == r["predicted"]).mean()


@pytest.mark.parametrize("name, column, least", [("op2_toxicity", "toxic", 0.9), ("op5_quality", "quality", 0.9)])
def test_held_out_accuracy(llm, name, column, least):
    folder = SF.replace("0.001", "0.01")
    df = QUERIES[name](llm, folder)
    assert df.count() == llm.read.parquet(f"{folder}/documents.parquet").count()
    r, right = accuracy(df, llm.read.parquet(f"{folder}/labels.parquet"), column)
    folds, rest = (3, 1) if column == "toxic" else (5, 0)
    assert all((zlib.crc32(str(i).encode()) % folds == rest) for i in r["doc_id"]) and right >= least
    assert r["score"].between(0, 1).all()


@pytest.mark.parametrize("scores", [toxicity.scores, quality.scores])
def test_classifiers_on_odd_rows_and_few_labels(llm, frame, scores):
    docs = frame([*((i, t) for i, t in enumerate(ODD)), (3, "again"), (None, "nameless")])
    empty = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    one = llm.createDataFrame([(4, 1, 0), (4, 1, 1), (5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (empty, one):
        got = scores(docs, labels).collect()
        assert len(got) == len(ODD) + 2 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    assert scores(docs.limit(0), empty).count() == 0


def test_non_negative_risk():
    plus, minus = quality.risk(np.array([30.0]), np.array([-30.0]), 0.5)
    assert plus < 1e-9 and minus < 0  # all positives right, all unlabelled called negative: the bound applies
    assert quality.features("").tolist() == [0.0] * quality.SIZE and len(quality.features("a b")) == quality.SIZE


def test_samples_of_tables_of_any_size(llm):
    rows = llm.range(1 << 25).withColumnRenamed("id", "doc_id")
    # as from a table of which less than one row in 2 ** 20 is drawn
    assert 4 <= thinned(rows, 256 << 21, 256, "calibration").count() <= 40
    assert 900 <= thinned(rows.limit(100_000), 100_000, 1000, "calibration").count() <= 1100


def test_every_passage_of_a_repeated_item_is_found():
    item = "abcab cabca bcabc abcab cabca bcabc"  # its pieces recur within it
    text = "".join(f"lead{i} {item} tail " for i in range(5)) + item[:-1] + "# " + item
    found = decontaminate.Finder([(1, item)]).matches(text)
    want = [m.start() for m in re.finditer(re.escape(item), text)]
    assert set(want) <= {s for _, s, _, d in found if d == 0}
    assert len(found) >= 7 and all(b[1] >= a[2] for a, b in zip(found, found[1:]))


def test_copies_of_a_long_text_are_encoded_once(llm, frame, monkeypatch):
    rng = random.Random(1)
    long = " ".join("".join(rng.choice("abcdé") for _ in range(rng.randint(1, 9))) for _ in range(900))
    docs = frame([(i, long) for i in range(40)] + [(40, long + "x"), (None, long), (41, "short")])
    ranks = P.path("byte_bpe_50k.tiktoken")
    got = byte_bpe.decode(byte_bpe.encode(docs, ranks, P.PATTERN, chunk=600), ranks, P.PATTERN).collect()
    assert len(got) == 43 and {bytes(r.decoded).decode() for r in got if r.doc_id not in (40, 41)} == {long}
    assert {bytes(r.ids) for r in got if r.doc_id in (0, None)} == {byte_bpe.coder(ranks, P.PATTERN).whole(long)}
