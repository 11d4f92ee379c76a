"""Personal data, fertility rules, secrets, lines and tokens against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import fixtures
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickloom.llm import fertility, lines, pii, secrets, tokens

BLANKS = " \t\n\x0b\x0c\r"
WORD = re.compile("[^\x20\x09-\x0d]+")
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and pii.luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, *m.span()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.@-+ (9%é4", max_size=60))
def test_base_spans_of_any_text(text):
    assert [s[:3] for s in pii.find(text) if s.kind in pii.BASE] == plain_spans(text)


def test_personal_data_examples():
    text = "Card 4111 1111 1111 1111, tel +49 (30) 1234567, a@b.co, 10.0.0.256, IBAN DE89 3704 0044 0532 0130 00"
    kinds = Counter(s.kind for s in pii.find(text))
    assert kinds == {"card": 1, "phone": 1, "email": 1, "iban": 1}
    assert not [s for s in pii.find("DE89 3704 0044 0532 0130 01") if s.kind == "iban"]
    for account, after in (
        ("DE89 3704 0044 0532 0130 00", " AND MORE"),
        ("DE89370400440532013000", " BIC COBADEFF"),
        ("GB82 WEST 1234 5698 7654 32", " DE8 "),
        ("NO9386011117947", " 12 34"),
        ("MT84MALT011000012345MTLCAST001S", "."),
    ):
        text = f"to DE89 {account}{after}"
        found = [text[s.start : s.end] for s in pii.find(text) if s.kind == "iban"]
        assert found == [account]
        two = f"{account} {account}"
        assert len([s for s in pii.find(two) if s.kind == "iban"]) == 2
    assert [s.kind for s in pii.find("my ssn is 123-45-6789")] == ["ssn"]
    assert not pii.find("part 123-45-6789")
    assert pii.score("call +491234567890", "phone", 5, 18) > pii.score("x +491234567890", "phone", 2, 15)


def test_long_runs_are_linear():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "a@" * 100_000, "1.1" * 100_000, "+1" * 100_000):
        pii.find(text)


def test_long_runs_of_zeros_in_addresses():
    text = "0" * 5000 + ".1.1.1"
    assert [(s.kind, s.start, s.end) for s in pii.find(text) if s.kind == "ip"] == [("ip", 0, len(text))]
    assert not [s for s in pii.find("0" * 5000 + "256.1.1.1") if s.kind == "ip"]


def test_personal_data_rows(spark):
    docs = fixtures.frame(spark)
    rows = pii.report(pii.scan(docs)).collect()
    want = Counter(
        (d[0], hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in plain_spans(d[1] or "")).encode()).hexdigest())
        for d in fixtures.documents()
    )
    assert Counter((r.doc_id, r.base_sha256) for r in rows) == want
    assert pii.report(pii.scan(fixtures.empty(spark))).count() == 0


def plain_repeats(found):
    windows = Counter(tuple(found[i : i + 8]) for i in range(len(found) - 7))
    inside = {i + k for i in range(len(found) - 7) if windows[tuple(found[i : i + 8])] > 1 for k in range(8)}
    return len(inside)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60))
def test_repeated_words(found):
    assert fertility.repeated_words(np.array(found, np.int64)) == plain_repeats(found)


def test_fertility_rows(spark):
    rows = fertility.rules(fixtures.frame(spark)).collect()
    want = Counter()
    for doc_id, text, *_ in fixtures.documents():
        text = text or ""
        found, seen, repeats = WORD.findall(text), set(), 0
        for line in text.split("\n"):
            repeats += line in seen and bool(WORD.search(line))
            seen.add(line)
        n, again = len(found), plain_repeats(found)
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        failed = n < 20 or 100 * again > 30 * n
        want[(doc_id, n, sum(map(len, found)), symbols, repeats, again, failed)] += 1
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[n] for n in names) for r in rows) == want
    assert not [r for r in rows if r.base_failed and r.kept]
    assert fertility.rules(fixtures.empty(spark)).count() == 0


def test_fertility_bands():
    low = fertility.Measure(1.0, 0.0, 6.0)
    assert not fertility.inside(low, fertility.BANDS["en"], 100)
    assert fertility.inside(fertility.Measure(4.2, 0.0, 8.0), fertility.BANDS["en"], 500)
    assert not fertility.inside(fertility.Measure(4.2, 0.3, 8.0), fertility.BANDS["en"], 500)
    assert fertility.script_of("привет мир") == "cyrillic" and fertility.script_of("") == "latin"


def test_fertility_keeps_clean_text(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = fertility.rules(docs).join(labels, "doc_id").where("quality = 1 and not base_failed")
    assert rows.where("not kept").count() <= 0.01 * rows.count()


def secret_rows(spark, docs, ledger, rules=secrets.RULES):
    paths = secrets.update(docs, ledger, rules=rules)
    found = paths.join(secrets.findings(spark, ledger, rules), "blob")
    return Counter((r.path, r.kind, r.start, r.end) for r in found.collect())


def test_secret_ledger_scans_only_what_is_new(spark, tmp_path):
    schema = "doc_id long, text string, blob string"
    first = [(1, "é token = abcdefgh1 x", "b"), (2, "é token = abcdefgh1 x", "b"), (3, None, None), (4, "AKIA" + "A" * 12, "c")]
    ledger = str(tmp_path / "ledger")
    one = spark.createDataFrame(first, schema)
    assert secret_rows(spark, one, ledger) == {(1, "assign", 2, 19): 1, (2, "assign", 2, 19): 1, (4, "access", 0, 16): 1}
    seen = secrets.read_ledger(spark, ledger, "seen", secrets.SEEN)
    assert seen.count() == 3
    # A second run with one new version adds one blob; the same run again adds nothing.
    two = spark.createDataFrame([*first, (1, "f" * 40, "d")], schema)
    for _ in range(2):
        found = secret_rows(spark, two, ledger)
        assert found[(1, "hex", 0, 40)] == 1 and len(found) == 4
        assert secrets.read_ledger(spark, ledger, "seen", secrets.SEEN).count() == 4
    # A new rule version is scanned over all blobs, without the old ones.
    changed = (*secrets.RULES[:2], secrets.Rule("hex", "[0-9a-f]{36,}"))
    found = secret_rows(spark, two, ledger, changed)
    assert found[(1, "hex", 0, 40)] == 1
    marks = secrets.read_ledger(spark, ledger, "seen", secrets.SEEN).collect()
    assert len(marks) == 8 and sum(r.rules == [changed[2].version] for r in marks) == 4


def test_secret_matches_are_not_retried(spark, tmp_path):
    rows = [(1, "password: token: abcdefgh1"), (2, "PassWord='12345678' secret=1 api_key: \"a.b/c+d=e\""), (3, "api" * 9 + "key")]
    found = secret_rows(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "l"))
    pattern = re.compile(secrets.BASE[0].pattern)
    want = Counter(
        (i, "assign", *m.span()) for i, t in rows for m in pattern.finditer(t) if len(m[1]) >= 8
    )
    assert found == want


def test_secrets_of_repeated_rows(spark, tmp_path):
    text = "x token=abcdefgh1, secret=12345678 z"
    rows = [(1, text), (1, text), (1, text), (None, "y " + text), (None, "y " + text), (5, text)]
    pattern = re.compile(secrets.BASE[0].pattern)
    want = Counter((i, "assign", *m.span()) for i, t in rows for m in pattern.finditer(t))
    assert len(want) == 6
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert secret_rows(spark, docs, str(tmp_path / "l")) == want


def test_secrets_special_rows(spark, tmp_path):
    docs = fixtures.frame(spark)
    paths = secrets.update(docs, str(tmp_path / "a"))
    assert paths.count() == docs.count()
    assert secrets.update(fixtures.empty(spark), str(tmp_path / "b")).count() == 0
    assert secrets.findings(spark, str(tmp_path / "b")).count() == 0


def plain_lines(docs):
    def key(line):
        return line.strip(BLANKS).translate(str.maketrans(lines.UPPER, lines.LOWER))

    holders: dict[str, set] = {}
    for doc_id, text, *_ in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(doc_id)
    low = float("-inf")
    keeper = {k: max(v, key=lambda d: low if d is None else d) for k, v in holders.items() if len(v) >= 5}
    for doc_id, text, *_ in docs:
        found = (text or "").split("\n")
        kept = [x for x in found if keeper.get(key(x), doc_id) == doc_id]
        yield doc_id, len(found), len(found) - len(kept), "\n".join(kept)


def test_line_dedup_rows(spark, monkeypatch):
    docs = fixtures.frame(spark)
    want = Counter(plain_lines(fixtures.documents()))
    assert sum(r[2] for r in want.elements()) > 10
    for most in (lines.MAX_BITS, 1 << 16):
        monkeypatch.setattr(lines, "MAX_BITS", most)
        rows = lines.dedup(docs).collect()
        got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in rows)
        assert got == want
    assert lines.dedup(docs).columns == [*docs.columns, "n_lines", "n_dropped"]
    assert lines.dedup(fixtures.empty(spark)).count() == 0


def test_long_documents_that_lose_most_lines(spark):
    shared = [f"  Shared line number {i} with some more words\t" for i in range(20_000)]
    docs = [(i, "\n".join([*shared, f"own {i}" * 12]), None, None) for i in range(6)]
    df = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in lines.dedup(df).collect())
    assert got == Counter(plain_lines(docs))


def test_one_id_with_most_documents_and_lines(spark):
    docs = [(7, "\n".join(f"A line of the hot one {i % 50} with more words {i % 3}" for i in range(n, n + 40))) for n in range(60)]
    docs += [(i, docs[0][1]) for i in range(8, 14)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = lines.dedup(df).collect()
    assert len(got) == len(docs)
    # All ids but the largest lose what they share with at least four others.
    assert {r.n_dropped for r in got if 7 < r.doc_id < 13} == {40}
    assert {r.n_dropped for r in got if r.doc_id == 13} == {0}
    first = set(docs[0][1].split("\n"))
    assert all(set(r.text.split("\n")).isdisjoint(first) for r in got if r.doc_id == 7)


def test_line_filter_keeps_repeats_across_partitions(spark):
    hashes = spark.range(5000).selectExpr("xxhash64(id % 4000) as h").repartition(7)
    bits = lines.filter_bits(5000)
    seen = np.array([r.h for r in spark.range(1000).selectExpr("xxhash64(id) as h").collect()])
    once = np.array([r.h for r in spark.range(1000, 4000).selectExpr("xxhash64(id) as h").collect()])
    twice = np.frombuffer(zlib.decompress(lines.merged_filter(hashes, bits, "twice").value), np.uint8)
    assert lines.has(twice, lines.positions(seen, bits)).all()
    assert lines.has(twice, lines.positions(once, bits)).mean() < 0.05


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x17F), max_size=80))
def test_pieces_give_the_same_ids(text):
    encoder = tokens.encoder_of(public_tokenizers.path(tokens.VOCABULARY))
    for value in (text, f"it's  {text}\n\nwe'll", text + "日本 <|endoftext|>"):
        want = encoder.tokenizer.encode(value, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(value), np.uint16).tolist() == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50_256), max_size=300), st.integers(1, 40))
def test_wavelet_matrix(ids, few):
    ids = [i % (few * 3) if few < 30 else i for i in ids]
    matrix = tokens.WaveletMatrix.build(np.array(ids, np.uint16))
    assert matrix.decode().tolist() == ids
    for at in range(0, len(ids), 7):
        assert matrix.access(at) == ids[at]
    for token in {*ids[:5], 49_999}:
        places = [i for i, x in enumerate(ids) if x == token]
        assert list(matrix.occurrences(token)) == places
        assert matrix.count(token) == len(places)
        assert matrix.count(token, 3, 20) == ids[3:20].count(token)
        assert matrix.select(token, len(places)) is None


@pytest.mark.parametrize("shard_tokens", [tokens.SHARD_TOKENS, 500])
def test_token_files(spark, tmp_path, tokenizer, shard_tokens):
    docs = fixtures.frame(spark)
    path = str(tmp_path / "shards")
    tokens.write_shards(docs, path, shard_tokens=shard_tokens)
    shards = tokens.read_shards(spark, path)
    rows = tokens.decoded(shards).join(tokens.shard_starts(shards), ["part", "shard"]).collect()
    rows.sort(key=lambda r: r.before + r.offset)
    named = docs.selectExpr("doc_id", "text", "xxhash64(coalesce(text, '')) AS name").collect()
    source = sorted(named, key=lambda d: (d[0] is not None, d[0] or 0, d[2]))
    sums = tokens.decoded(shards, digest=True).collect()
    assert Counter(r.ids_crc32 for r in sums) == Counter(zlib.crc32(r.ids) for r in rows)
    at = 0
    for row, (doc_id, text, _) in zip(rows, source, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, tokens.END]
        assert (row.doc_id, row.before + row.offset) == (doc_id, at)
        assert np.frombuffer(row.ids, "<u4").tolist() == ids
        at += len(ids)
    tokens.write_shards(fixtures.empty(spark), str(tmp_path / "none"))
    assert tokens.decoded(tokens.read_shards(spark, str(tmp_path / "none"))).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b'll", "it's", "x\ny", "é,", "\n", "", " ", "\t", "7th", "end.\n\nNew"]), max_size=30))
def test_words_give_the_same_ids(parts):
    encoder = tokens.encoder_of(public_tokenizers.path(tokens.VOCABULARY))
    for value in (" ".join(parts), "".join(parts)):
        want = encoder.tokenizer.encode(value, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(value), np.uint16).tolist() == want


def test_memory_keeps_what_is_in_use(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_PIECES", 8)
    monkeypatch.setattr(fertility, "MAX_WORDS", 8)
    encoder = tokens.Encoder(public_tokenizers.path(tokens.VOCABULARY))
    fresh = fertility.Words(public_tokenizers.path(fertility.VOCABULARY))
    rng = random.Random(4)
    for _ in range(60):
        words = [f"word{rng.randrange(30)}" for _ in range(20)]
        want = encoder.tokenizer.encode(" ".join(words), add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(" ".join(words)), np.uint16).tolist() == want
        assert len(encoder.pieces) <= 4 and len(encoder.pieces.older) <= 4
        raw = [w.encode() for w in words]
        fresh.learn([raw])
        numbers, ids = fresh.encode(raw)
        assert len(set(numbers.tolist())) == len(set(words))
        assert ids.tolist() == [i for w in words for i in fresh.encoder.encode(w)]


def test_a_hot_id_fills_several_files(spark, tmp_path):
    rows = [(7, f"text {i}") for i in range(2000)] + [(8, "same")] * 2000 + [(i, "t") for i in range(500)]
    path = str(tmp_path / "hot")
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    tokens.write_shards(df, path)
    shards = tokens.read_shards(spark, path)
    decoded = tokens.decoded(shards).select("part", "doc_id").collect()
    for hot in (7, 8):
        assert len({r.part for r in decoded if r.doc_id == hot}) > 1
    ordered = [r.doc_id for r in sorted(decoded, key=lambda r: r.part)]
    assert Counter(ordered) == Counter(r[0] for r in rows)
    assert ordered == sorted(ordered)


def test_random_lines(spark):
    rng = random.Random(5)
    shared = [f"{c * 45} {i}" for i, c in enumerate("abcdefg")]
    docs = [(i, "\n".join(rng.choices([*shared, "short", f"{i}" * 45], k=6)), None, None) for i in range(60)]
    df = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string").repartition(9)
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in lines.dedup(df).collect())
    assert got == Counter(plain_lines(docs))
