"""Encoding, token counts, personal data, language and toxicity: libraries, brute force and held-out accuracy."""

import base64
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest

from deskmeter.llm import bpe
from deskmeter.llm.language_id import identify, suffix_automaton, training_sample
from deskmeter.llm.pii import base_spans, find_pii, luhn, sanitise, written
from deskmeter.llm.queries import QUERIES
from deskmeter.llm.token_counts import token_counts
from deskmeter.llm.toxicity import FEATURES, feature_rows, fit_toxicity

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
ODD = [
    None, "", " ", "a", "  a  b ", "a\nb\t", "don't they'll", "é ñ 中文 😀‍👩", "\x1c\x85\xa0 x", "<|endoftext|> <s> </s>", "▁a▁ ▁",
    "aaaa" * 300, "x" * 3000 + " y", "１２ ３", "\U00018d88՘ a", "a  ", "ﬁ́",
]


@pytest.fixture(scope="module")
def library():
    import tiktoken

    lines = open(PATH, "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def some(spark, small):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]


def test_bpe_as_the_library(documents, library, some):
    rows = list(enumerate(ODD)) + [(100 + i, t) for i, t in some[:60]]
    frame = documents(*rows, extra=("ids", "n_tokens"))
    digests = {r["doc_id"]: r for r in bpe.encode_digests(frame, PATH, PATTERN).collect()}
    ids = {r["doc_id"]: r["ids"] for r in bpe.encode(frame, PATH, PATTERN, "doc_id").collect()}
    for i, text in rows:
        want = library.encode_ordinary(text or "")
        assert ids[i] == want
        assert digests[i]["n_tokens"] == len(want)
        assert digests[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert digests[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_round_trip(spark, documents, some):
    frame = documents(*some[:40], (-1, None))
    decoded = bpe.decode(bpe.encode(frame, PATH, PATTERN, "doc_id"), PATH, PATTERN, "doc_id").collect()
    texts = dict(some)
    assert all(bytes(r["decoded"]) == (texts.get(r["doc_id"]) or "").encode() for r in decoded)
    odd = spark.createDataFrame([(1, None), (2, []), (3, [None, 65])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: bytes(r["decoded"]) for r in bpe.decode(odd, PATH, PATTERN, "doc_id").collect()} == {1: b"", 2: b"", 3: b"b"}


def test_bpe_in_stretches(monkeypatch, library):
    coder = bpe.Coder(open(PATH, "rb").read(), PATTERN)
    texts = [t or "" for t in ODD]
    monkeypatch.setattr(bpe, "STRETCH", 2)
    monkeypatch.setattr(bpe, "BATCH_BYTES", 1)
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    assert [list(x) for x in coder.encode(texts)] == [library.encode_ordinary(t) for t in texts]
    rng = random.Random(1)
    for _ in range(200):
        word = "".join(rng.choice("abeéthin") for _ in range(rng.randrange(1, 40))).encode()
        assert coder.contract_long(word) == coder.contract([word])[0].tolist()


def test_bpe_looks_for_newer_letters_only_where_they_can_be(monkeypatch, library):
    coder, asked = bpe.Coder(open(PATH, "rb").read(), PATTERN), []
    search = coder.newer.search
    monkeypatch.setattr(coder, "newer", type("Counted", (), {"search": lambda self, t: asked.append(t) or search(t)})())
    texts = ["déjà vu 12", "слово", "a\u0557b", "a\u0558b 1", "日本 x", "a\U0003fc3f b", "x\u0c5cy"]
    assert [list(x) for x in coder.encode(texts)] == [library.encode_ordinary(t) for t in texts]
    assert asked == texts[3:]
    assert [coder.pattern(t) is coder.careful for t in texts] == [False, False, False, True, False, True, True]


def test_bpe_finished_words_leave_the_rounds(library):
    coder = bpe.Coder(open(PATH, "rb").read(), PATTERN)
    words = [b"zq", b" anhaha", b"\xff\xfe", "é".encode() * 30, b"ab" * 128, b"x"]
    own = coder.contract(words)
    assert [x.tolist() for x in own] == [coder.contract_long(w) for w in words]
    assert coder.decode(own) == words
    steps = coder.db.execute(bpe._CONTRACT.replace("WHERE done ORDER BY word, pos", "WHERE done")).fetchall()
    assert len(steps) == sum(map(len, own))  # every word is told once, in the round in which it has no pair left


@pytest.mark.parametrize("size", [1, 1000, 4 << 20])
def test_token_counts_as_the_library(documents, some, size):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = list(enumerate(ODD)) + [(100 + i, t) for i, t in some[:60]]
    for r in token_counts(documents(*rows, extra=("n_tokens",)), path, limit=100, batch_bytes=size).collect():
        text = dict(rows)[r["doc_id"]] or ""
        assert r["n_tokens"] == len(library.encode(text)) and r["n_bytes"] == len(text.encode())
        assert r["over_limit"] == (r["n_tokens"] > 100)


# fixed values: the contract's patterns
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": lambda: True, "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                  "card": lambda d=digits: 14 <= len(d) <= 19 and luhn(d), "phone": lambda d=digits: 10 <= len(d) <= 15}[kind]()
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_as_the_patterns(some):
    rng = random.Random(3)
    made = ["".join(rng.choice("a1.@-+ ()9Z%\n2٣") for _ in range(rng.randrange(60))) for _ in range(20000)]
    made += ["4" * 5000, "1." * 3000, "+1" + " " * 3000, "a" * 3000 + "@b", "@@a.b@c.d"]
    for text in made + [t for _, t in some]:
        assert base_spans(text) == plain_spans(text)


def test_terms_that_give_entities_away(documents):
    pairs = [f"{c}{w}" for c in "bcdfg" for w in ("ala", "elo", "ipu")]
    rows = [(i, f"{pairs[i % 15]} zorblax the {pairs[i % 7]} mail bob@x.org and {pairs[i % 5]} Quixand") for i in range(12)]
    rows += [(100 + i, f"the and mail {p} " * 3) for i, p in enumerate(pairs * 6)]
    rows += [(300, None), (301, ""), (302, "zorblax alone"), (303, "one time a@b.cd only")]
    rows += [(400 + i, "same place wumpus c@d.ef") for i in range(9)]  # copies prove nothing
    frame = documents(*rows, extra=("spans", "term", "entity"))
    found = find_pii(frame)
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert len(by_id) == len(rows)
    for i, text in rows:
        base = [s for s in by_id[i]["spans"].split(",") if s.split(":")[0] in PATTERNS]
        assert base == [s for s in written(plain_spans(text or "")).split(",") if s]
        assert by_id[i]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert (by_id[i]["n_added"] > 0) == (i < 12)
    clean = {r["doc_id"]: r["text"] for r in sanitise(frame, found).collect()}
    assert "zorblax" not in clean[0] and "bob@" not in clean[0] and "mail [email] and" in clean[0]
    assert clean[302] == "zorblax alone" and clean[303] == "one time [email] only" and clean[401] == "same place wumpus [email]"


def test_terms_far_from_entities_seen_twice(documents):
    rng = random.Random(8)
    common = [a + b for a in "bcdfghjk" for b in ("ala", "elo", "ipu", "ora", "umi")]

    def prose(n):
        return " ".join(rng.choice(common) for _ in range(n))

    rows = [(i, f"Vexmoor {prose(60)} ann@x.org {prose(60)} so vexmoor") for i in range(2)]
    once = f"{prose(50)} krandle {prose(50)} tel +49 30 1234567 89 {prose(30)}"
    rows += [(2, once), (3, once + " end")]  # near copies
    rows += [(10 + i, prose(40)) for i in range(400)]
    frame = documents(*rows)
    found = find_pii(frame)
    added = {r["doc_id"]: r["n_added"] for r in found.collect()}
    assert added == {i: 2 if i < 2 else 0 for i, _ in rows}
    clean = {r["doc_id"]: r["text"] for r in sanitise(frame, found).collect()}
    assert "exmoor" not in clean[0] + clean[1] and clean[0].count("[email]") == 1 and "krandle" in clean[2]


@pytest.mark.parametrize("name", ["op1_byte_bpe", "op2_pii", "op3_language_id", "op4_token_counts", "op6_toxicity"])
def test_empty_tables(spark, documents, folder, name):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert QUERIES[name](spark, folder(documents=documents(), labels=labels)).collect() == []


def test_suffix_automaton_knows_all_substrings():
    rng = random.Random(4)
    text = [rng.randrange(2, 5) for _ in range(60)]
    follow = suffix_automaton(text)

    def known(part):
        state = 0
        for c in part:
            if not (state := follow[state].get(c, 0)):
                return False
        return True

    inside = {tuple(text[i:j]) for i in range(60) for j in range(i + 1, 61)}
    assert all(map(known, inside))
    for _ in range(300):
        part = tuple(rng.randrange(2, 5) for _ in range(rng.randrange(1, 9)))
        assert known(part) == (part in inside)


def plain_phrases(text, sample):
    """Greedy cross-parsing: longest parts found in the sample; a letter that it lacks is a phrase of its own."""
    text, sample = ("".join(c if c.isalpha() else " " for c in x.lower()) for x in (text, sample))
    count, part = 0, ""
    for c in text:
        if part + c in sample:
            part += c
        else:
            count += bool(part)
            part = c if c in sample else ""
            count += not part
    return count + bool(part)


def test_phrases_as_a_plain_parser():
    from deskmeter.llm.language_id import Parser

    rng = random.Random(6)
    wide = [[chr(0x4E00 + i) for i in range(at, at + 600)] for at in (0, 400)]
    letters = {"a": "abcde é", "b": "abcdxyz ", "wide one": [*wide[0], " "], "wide two": [*wide[1], " "]}
    sample = {k: "".join(rng.choice(v) for _ in range(3000)) for k, v in letters.items()}
    parser = Parser(sample)
    texts_ = ["".join(rng.choice(v) for _ in range(rng.randrange(1, 400))) for v in letters.values() for _ in range(6)]
    texts_ += ["ааж", "abc жж de", "q", "a", "zzzé"]
    symbols = [parser.symbols(t) for t in texts_]
    ends = np.cumsum([len(x) for x in symbols])
    found = parser.phrases(np.concatenate(symbols), ends, 1 << 20)
    for t, row in zip(texts_, found.tolist(), strict=True):
        assert row == [plain_phrases(t, sample[k]) for k in parser.labels]
    long = ["".join(rng.choice(letters[k]) for _ in range(3000)) for k in letters]
    assert parser.predict(long, 1024)[0] == list(letters)
    # what is counted decides: fewest phrases times bits
    bits = found * parser.bits
    assert parser.predict(texts_, 1 << 20)[0] == [parser.labels[i] for i in bits.argmin(axis=1)]


def test_language_held_out(spark, small, documents):
    found = QUERIES["op3_language_id"](spark, small)
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    held = [r for r in found.collect() if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.93 * len(held)
    from pyspark.sql import functions as F

    frame = spark.read.parquet(f"{small}/documents.parquet")
    sample = training_sample(frame, F.lit(True))
    odd = identify(documents((1, None), (2, ""), (3, "12 !?"), (4, "中"), (5, "the and of " * 4000), (5, "the and of " * 4000), extra=("score",)), sample)
    rows = [(r["doc_id"], r["lang_pred"]) for r in odd.collect()]
    assert rows[:3] == [(1, "und"), (2, "und"), (3, "und")] and rows[3][1] in sample and rows[4:] == [(5, "en")] * 2
    assert {r["lang_pred"] for r in identify(documents((1, "abc")), {}).collect()} == {"und"}


def test_language_below_a_common_beginning(documents):
    from pyspark.sql import functions as F

    rng, head = random.Random(9), "this licence applies to all of the files " * 30
    words = {"aa": ["lorem", "ipsum", "dolor", "amet"], "bb": ["kukka", "talvi", "metsa", "jarvi"]}

    def body(lang, n):
        return " ".join(rng.choice(words[lang]) for _ in range(n))

    rows = [(i, head + body(lang, 3000), lang) for i, lang in enumerate(["aa", "bb"] * 8)]
    rows += [(100 + i, head + "copied " * 50, "aa") for i in range(60)]
    sample = training_sample(documents(*rows), F.lit(True))
    assert all(len(t) <= 32 * 1001 for t in sample.values()) and sample["aa"].count("copied") <= 50
    assert all(sample[x].count(w) > 100 for x, ws in words.items() for w in ws)
    assert all(t.count("licence") <= 60 for t in sample.values())
    asked = documents(*[(i, body(x, 30), x) for i, x in enumerate(["aa", "bb"] * 5)])
    assert [r["lang_pred"] for r in identify(asked, sample).orderBy("doc_id").collect()] == ["aa", "bb"] * 5
    few = documents((1, "eins zwei drei " * 100, "de"), (2, "vier fünf", "de"))
    assert sorted(training_sample(few, F.lit(True))["de"].split("\n")) == ["eins zwei drei " * 100, "vier fünf"]


def test_toxicity_learns(spark, documents):
    from pyspark.sql import functions as F

    rng = random.Random(6)
    words = [f"{a}{b}" for a in ("lor", "mip", "sen", "tur") for b in ("a", "em", "is", "ont")]
    rows, labels = [], []
    for i in range(1200):
        toxic = i % 6 == 0
        text = [rng.choice(words) for _ in range(40)]
        if toxic:
            text[rng.randrange(40)] = rng.choice(["grubnosed", "Snarkface"])
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    rows += [(5000, None), (5001, ""), (5002, "grubnosed " * 5000)]
    labels += [(None, 1), (17, None), (3, 0)]
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    frame = documents(*rows, extra=("_features", "score"))
    model = fit_toxicity(frame, marks, F.col("doc_id") % 5 != 0)
    assert {"grubnosed ", "snarkface "} == {t for t in model.lexicon if t.endswith(" ")}
    scored = {r["doc_id"]: r["toxicity"] for r in model.score(frame, ["doc_id"], "toxicity").collect()}
    assert all(0 <= s <= 1 for s in scored.values()) and len(scored) == len(rows)
    held = [i for i in range(0, 1200, 5)]
    assert sum((scored[i] >= 0.5) == (i % 6 == 0) for i in held) >= 0.97 * len(held)
    assert scored[5000] < 0.5 and scored[5001] < 0.5 and scored[5002] >= 0.5
    assert model.score(frame, name="toxicity").columns == [*frame.columns, "toxicity"]
    none = fit_toxicity(frame, marks.limit(0), F.lit(True)).score(frame, ["doc_id"], "s")
    assert {r["s"] for r in none.collect()} == {0.0}


def test_features_of_bytes():
    import pyarrow as pa

    rows = feature_rows(pa.array(["", "AB!? i.d", "you IDIOT", "1d1ot x", "é\n"]), (("idiot ", 3.0),))
    named = [dict(zip(FEATURES, r, strict=True)) for r in rows.tolist()]
    assert not any(rows[0])
    assert named[1]["exclamations"] == named[1]["questions"] == 1 / 8 and named[1]["capitals"] == 2 / 8
    assert named[1]["signs_in_words"] == 1 / 2
    assert (named[2]["lexicon_hits"], named[2]["you_hits"]) == (1, 1)
    assert (named[3]["lexicon_hits"], named[3]["hidden_hits"]) == (0, 1)


@pytest.mark.parametrize(("text", "hidden", "signs"), [
    ("$tupid", 1, 1), ("1d10t", 1, 3), ("a55hole", 1, 2), ("1d1ot", 1, 2), ("st..upid.", 1, 2), ("x 1d10t. e.g", 1, 4),
    ("stupid. - 455 1.5", 0, 0), ("455 e.g", 0, 1), ("stupid", 0, 0)])
def test_disguised_words_at_edges(text, hidden, signs):
    import pyarrow as pa

    lexicon = tuple((f"{w} ", 3.0) for w in ("ass", "asshole", "idiot", "stupid"))
    row = dict(zip(FEATURES, feature_rows(pa.array(["e", text, "1"]), lexicon)[1].tolist(), strict=True))
    assert row["hidden_hits"] == hidden and round(row["signs_in_words"] * len(text.split())) == signs


def test_features_of_a_very_long_text_within_memory():
    import tracemalloc

    import pyarrow as pa

    from deskmeter.llm.toxicity import FEATURES, feature_rows

    text = "You are a st*pid f00l! " * (1 << 20)  # 23 MB
    column = pa.array([text])
    tracemalloc.start()
    rows = feature_rows(column, (("fool", 1.0),))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows.shape == (1, len(FEATURES)) and peak < 14 * len(text)


def test_remembered_words_have_a_bound_and_change_nothing(monkeypatch):
    import public_tokenizers

    from deskmeter.llm import bpe

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        coder = bpe.Coder(file.read(), public_tokenizers.PATTERN)
    texts_ = [f"word{i} and another{i * 7} é{i}" for i in range(400)]
    want = coder.digests(texts_)
    coder.rest()
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 2000)
    coder.forget()
    assert [d for i in range(0, 400, 50) for d in coder.digests(texts_[i : i + 50])] == want
    assert len(coder.words) < 400 and coder._db is not None
    coder.rest()
    assert coder._db is None and coder.digests(texts_[:3]) == want[:3]
