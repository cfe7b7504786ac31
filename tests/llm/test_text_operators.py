import hashlib
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluice.llm import byte_bpe, line_dedup, packing, secrets, shingle_join, substring_dedup, toxicity

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
LONG = "alpha beta gamma delta. " * 6000
ODD = [None, "", " ", "\n\n", "a", "İſ Σ é \x1c\x85 日本 🙂", "don't  stop\tit's", LONG, "same text", "same text", "a <|endoftext|> b<|startoftext|>\x00  \n c  "]
SIGNS = [*"abcXYZ012'’ .,!?-_\n\n  \t\r\v\f\\|<>", "\u00a0", "\u3000", "\u200b", "\u2028", "é", "e\u0301", "ß", "İ", "Σ", "ς", "日", "ж", "١", "½", "🙂", "'s", "'RE", " the", "<|endoftext|>", "<|ENDOFTEXT|>", "\ufeff", "\x00", "\x1c", "\x85", "ﬁ", "ǅ", "א", "क्", "\u1c89", "\ua7cb"]


def fuzz(seed, n):
    rnd = np.random.default_rng(seed)
    return ["".join(SIGNS[k] for k in rnd.integers(0, len(SIGNS), rnd.integers(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns with the operators' own names."""
    rows = [(i, t, "h", 0, "x", 1.0, 7, 3) for i, t in enumerate(ODD)] + [(9, ODD[9], "h", 0, "x", 1.0, 7, 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, spans string, score double, rank int, hash int")


def test_byte_bpe_is_tiktoken(spark, odd):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.parse_ranks(open(RANKS, "rb").read()), special_tokens={})
    rows = byte_bpe.round_trip(odd, RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(ODD) + 1
    for r in rows:
        text = ODD[r["doc_id"]] or ""
        ids = own.encode_ordinary(text)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest() and r["n_decoded_chars"] == len(text)
    encoded = byte_bpe.encode(odd, RANKS, public_tokenizers.PATTERN)
    assert {r["doc_id"]: r["text"] for r in byte_bpe.decode(encoded, RANKS).collect()} == {i: t or "" for i, t in enumerate(ODD)}
    assert byte_bpe.round_trip(odd.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_long_pre_token_takes_linear_time_and_memory(monkeypatch):
    ranks = byte_bpe.parse_ranks(open(RANKS, "rb").read())
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    transducer = byte_bpe.BpeTransducer(ranks)
    letters = np.random.default_rng(3).integers(97, 123, 2_000_000).astype(np.uint8).tobytes()
    start = time.perf_counter()
    found = np.frombuffer(transducer.encode(letters), "<u4")
    assert time.perf_counter() - start < 60 and transducer.arcs <= byte_bpe.MAX_ARCS + byte_bpe.STRETCH
    assert b"".join(transducer.token[i] for i in found.tolist()) == letters
    monkeypatch.setattr(byte_bpe, "MAX_ARCS", 3_000)  # forgets within a pre-token
    assert np.array_equal(np.frombuffer(transducer.encode(letters[:60_000]), "<u4"), own.encode_ordinary(letters[:60_000].decode()))
    assert np.array_equal(found[:10_000], own.encode_ordinary(letters[:60_000].decode())[:10_000])


def test_encoders_are_the_libraries():
    ranks = byte_bpe.parse_ranks(open(RANKS, "rb").read())
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = np.random.default_rng(9)
    parts = [t for t in ranks if not t.strip(b"abcdefghijklmnopqrstuvwxyzABC ")]
    texts = fuzz(1, 3000) + ["".join(map(chr, rnd.integers(97, 101, 30))) for _ in range(1000)]
    texts += [b"".join(parts[k] for k in rnd.integers(len(parts), size=6)).decode() for _ in range(3000)]
    encoder = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)
    assert encoder.usual
    assert [np.frombuffer(p, "<u4").tolist() for p in encoder.encode(texts)] == own.encode_ordinary_batch(texts)
    byte_bpe.MAX_ARCS, kept = 1000, byte_bpe.MAX_ARCS  # states are made afresh
    try:
        assert encoder.encode(texts[::-1])[::-1] == encoder.encode(texts)
    finally:
        byte_bpe.MAX_ARCS = kept
    words = packing.PieceEncoder(open(WORDS, encoding="utf-8").read())
    expected = Tokenizer.from_file(WORDS).encode_batch(texts, add_special_tokens=False)
    for _ in range(2):
        assert [np.frombuffer(p, "<u4").tolist() for p in words.encode(texts)] == [e.ids for e in expected]
        words.known, words.former = {}, words.known
    assert np.frombuffer(words.encode(["a <|endoftext|> b"])[0], "<u4").tolist() == [320, 49407, 321]


def test_utf8_machine_holds_back_open_characters():
    machine = byte_bpe.Utf8Machine()
    data = "a🙂é".encode() + b"\xe2\x82" + b"A\xff"
    assert "".join([*(machine.feed(data[i : i + 1]) for i in range(len(data))), machine.close()]) == data.decode("utf-8", "replace")


def brute_secrets(text):
    out = [(m.start(), m.end(), "assign") for m in re.finditer(secrets.ASSIGN, text, re.I | re.A) if len(m[2]) >= 8]
    out += [(m.start(), m.end(), "access") for m in re.finditer(secrets.ACCESS, text) if len(m[0]) >= 16]
    out += [(m.start(), m.end(), "hex") for m in re.finditer(secrets.HEX, text) if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[0], secrets.KINDS.index(s[2])))


def test_secrets(spark, odd):
    body = "A1" * 15
    good, bad = f"ghp_{body}{secrets.checksum(body)}", f"ghp_{body}{secrets.checksum(body[::-1])}"
    texts = [f"İ {good} {bad}", 'é API_KEY: "abcdefgh1" token=short secret=token=abcdefgh', "AKIA" + "X" * 12 + " " + "0" * 15 + "f" * 40 + "g", "x" * 50 + "a" * 31]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in secrets.digest_of_secrets(df).collect()}
    for i, t in enumerate(texts):
        base = ",".join(f"{k}:{a}:{b}" for a, b, k in brute_secrets(t))
        assert rows[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
    assert rows[0]["spans"] == f"forge:2:{2 + len(good)}" and rows[1]["n_assign"] == 2 and rows[2]["n_hex"] == 1 and rows[3]["spans"] == ""
    assert secrets.digest_of_secrets(odd).agg(F.sum("n_assign")).first()[0] == 0
    masked = secrets.mask_secrets(df.withColumn("n_chars", F.char_length("text").cast("long"))).orderBy("doc_id").collect()
    assert masked[0]["text"] == f"İ [forge] {bad}" and masked[0]["n_chars"] == len(masked[0]["text"])
    kept = secrets.mask_secrets(odd)
    assert kept.columns == odd.columns and sorted(map(str, kept.collect())) == sorted(map(str, odd.collect()))


def packed(rows, texts):
    reference = Tokenizer.from_file(WORDS)
    ids = {i: [*reference.encode(t or "", add_special_tokens=False).ids, 1] for i, t in texts.items()}
    by_doc, by_sequence = {}, {}
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, spans in by_doc.items():
        assert [s for s, _ in sorted(spans)] == [sum(n for _, n in sorted(spans)[:k]) for k in range(len(spans))]
        assert sum(n for _, n in spans) == len(ids[i])
    assert by_doc.keys() == ids.keys()
    for spans in by_sequence.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
        assert sum(n for _, n in spans) <= packing.WINDOW
    return by_sequence


@pytest.mark.parametrize("rows", [packing.RANKED_ROWS, 3])
def test_packing(spark, odd, rows, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_ROWS", rows)  # lengths in one bin, and in several
    texts = dict(enumerate(ODD)) | {20 + i: "tick tock " * (i * 37 % 700) for i in range(60)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("length", F.lit(1)).withColumn("rank", F.lit("x"))
    rows = packing.pack(df, WORDS, 1).collect()
    sequences = packed(rows, texts)
    tokens = sum(r["length"] for r in rows)
    assert len(sequences) <= -(-tokens // packing.WINDOW) + 2
    assert packing.pack(df.limit(0), WORDS, 1).count() == 0
    repeated = packing.pack(odd.where("doc_id in (8, 9)"), WORDS, 1).collect()
    assert len(repeated) == 3 and len({(r["sequence_id"], r["offset"]) for r in repeated}) == 3


def test_least_squares_beats_zero_and_stays_nonnegative():
    target = np.zeros(9)
    target[[2, 3, 5, 8 - 3]] = [4, 5, 6, 6]
    columns = [(5, 3), (3, 3, 2), (2, 2, 2, 2)]
    x = packing.nnls(columns, target)
    made = sum(v * np.bincount(c, minlength=9) for v, c in zip(x, columns))
    assert (x >= 0).all() and np.linalg.norm(made - target) < np.linalg.norm(target) / 2


def brute_lines(rows, ratio, min_pages, min_count):
    pages, on = {}, {}
    for _, s, t in rows:
        pages[s] = pages.get(s, 0) + 1
        for line in {x.strip(" ") for x in (t or "").split("\n")} - {""}:
            on[s, line] = on.get((s, line), 0) + 1
    bad = {k for k, n in on.items() if n >= min_count and pages[k[0]] >= min_pages and n > ratio * pages[k[0]]}
    return {i: None if t is None else "\n".join(x for x in t.split("\n") if (s, x.strip(" ")) not in bad) for i, s, t in rows}


def test_line_dedup(spark, monkeypatch):
    rows = [(i, "a" if i < 30 else None if i < 36 else "c", f"own {i}\n menu \nfoot\n\nlast{i % 3}") for i in range(40)] + [(90, "a", None), (91, "a", ""), (92, "c", "menu")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("site", F.lit(1)).withColumn("n_chars", F.lit(-1).cast("long"))
    expected = brute_lines(rows, 0.4, 5, 3)
    for most, bucket in ((line_dedup.BROADCAST_LINES, line_dedup.BUCKET), (line_dedup.BROADCAST_LINES, 1), (0, 8)):  # both ways of joining
        monkeypatch.setattr(line_dedup, "BROADCAST_LINES", most)
        monkeypatch.setattr(line_dedup, "BUCKET", bucket)
        found = line_dedup.dedup_lines(df, ratio=0.4)
        assert found.columns == [*df.columns, "n_dropped"]
        got = found.collect()
        assert {r["doc_id"]: r["text"] for r in got} == expected
        assert all(r["n_chars"] == (len(r["text"]) if r["n_dropped"] else -1) for r in got)
    copies = spark.createDataFrame([(i, "a", "x\ny") for i in range(9)], "doc_id long, source string, text string")
    assert {r["text"] for r in line_dedup.dedup_lines(copies).collect()} == {""}
    assert {r["text"] for r in line_dedup.dedup_lines(copies, spare_copies=True).collect()} == {"x\ny"}
    assert line_dedup.dedup_lines(copies.limit(0)).count() == 0


def test_substring_dedup(spark, odd, monkeypatch):
    passage = " ".join(f"Word{i} word{i} word{i} word{i} word{i} word{i} word{i}." for i in range(8))
    one = " ".join(f"w{i}" for i in range(60)) + "."
    rows = [(1, f"First here. {passage} End one."), (2, f"Other start!\n{passage}\nEnd two."), (3, f"A. B. {one} C."), (4, f"D? {one} E."), (5, "Short. Short."), (6, "Short. Short.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("hash", F.lit("x"))
    for hot in (substring_dedup.HOT, 1):  # plain and salted
        monkeypatch.setattr(substring_dedup, "HOT", hot)
        got = {r["doc_id"]: r for r in substring_dedup.dedup_substrings(df).collect()}
        assert got[1]["text"] == rows[0][1] and got[1]["n_removed"] == 0
        assert got[2]["text"] == "Other start!\nEnd two." and got[2]["n_removed"] == 8
        assert "w30" in got[3]["text"] and "w30" not in got[4]["text"]
        assert got[5]["text"] == got[6]["text"] == "Short. Short."
    got = substring_dedup.dedup_substrings(odd).collect()
    assert len(got) == len(ODD) + 1 and {r["text"] for r in got if r["doc_id"] == 0} == {None}
    repeated = next(r for r in got if r["doc_id"] == 7)
    assert 0 < len(repeated["text"]) < 400  # the later occurrences within one text go as well
    assert substring_dedup.dedup_substrings(odd.limit(0)).count() == 0


def brute_substrings(rows, run=2, words=20):
    """Of (id, text) rows with their own ids: the words that are left, by comparing all spans word by word."""
    units = {i: substring_dedup.sentences(t or "") for i, t in rows}
    seen = {}
    for i, own in units.items():
        spans = set()
        for a in range(len(own)):
            spans.add(next(((a, b) for b in range(a + run - 1, len(own)) if sum(map(len, own[a : b + 1])) >= words), None))
        for b in range(len(own)):
            spans.add(next(((a, b) for a in range(b - run + 1, -1, -1) if sum(map(len, own[a : b + 1])) >= words), None))
        for a, b in spans - {None}:
            seen.setdefault(tuple(w for u in own[a : b + 1] for w in u), []).append((i, a, b))
    gone = {(i, k) for places in seen.values() for i, a, b in sorted(places)[1:] for k in range(a, b + 1)}
    return {i: ([w for k, u in enumerate(own) if (i, k) not in gone for w in u], sum(j == i for j, _ in gone)) for i, own in units.items()}


def test_substring_dedup_is_what_brute_force_finds(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    expected = brute_substrings([tuple(r) for r in df.select("doc_id", "text").collect()])
    found = {r["doc_id"]: r for r in substring_dedup.dedup_substrings(df).collect()}
    assert {i: ((r["text"] or "").split(), r["n_removed"]) for i, r in found.items()} == expected
    assert sum(n for _, n in expected.values()) > 1000
    for r in df.where("doc_id < 300").collect():  # what went is what the stretches say
        cut = [tuple(map(int, x.split(":"))) for x in found[r["doc_id"]]["removed"].split(",") if x]
        left = "".join(c for k, c in enumerate(r["text"] or "") if not any(a <= k < b for a, b in cut))
        assert left.split() == expected[r["doc_id"]][0]


def test_substring_dedup_of_rows_that_share_an_id(spark):
    say = lambda w: " ".join(f"{w}{k} {w} said this and that." for k in range(10))
    rows = [(1, say("p")), (7, say("p")), (None, say("p")), (7, say("own")), (None, say("lone")), (7, say("p")), (None, None)]
    for left in ((7, say("lone")), (None, say("own"))):  # once more, elsewhere
        got = substring_dedup.dedup_substrings(spark.createDataFrame([*rows, left], "doc_id long, text string")).collect()
        texts = sorted((str(r["doc_id"]), r["text"] or "") for r in got)
        kept = [t for _, t in texts if t]
        # what occurs once stays whole, of what occurs several times one place does: a row without an id comes first, then the smallest id
        assert sorted(kept) == sorted([say("p"), say("own"), say("lone")]) and ("None", say("p")) in texts and len(got) == 8


def test_long_sentences_are_cut_alike_at_any_offset(spark):
    rnd = np.random.default_rng(5)
    draw = lambda n: " ".join(f"w{k}" for k in rnd.integers(0, 10**6, n))
    for _ in range(100):
        passage = draw(50)
        texts = [f"{draw(rnd.integers(1, 60))} {passage} {draw(rnd.integers(1, 60))}" for _ in range(2)]
        own = [[" ".join(u) for u in substring_dedup.sentences(t)] for t in texts]
        assert [" ".join(u) for u in own] == texts
        hashes = [{substring_dedup.span_hash(u, a, b) for a, b in substring_dedup.spans([x.split() for x in u])} for u in own]
        assert hashes[0] & hashes[1]
    rows = [(1, f"{draw(7)} {passage} {draw(30)}"), (2, f"{draw(12)} {passage} {draw(9)}")]
    got = {r["doc_id"]: r for r in substring_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["text"] == rows[0][1] and len(got[2]["text"].split()) <= 71 - 20


def brute_groups(rows, width, percent):
    sets, parent = [], list(range(len(rows)))

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for _, t in rows:
        words = re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower())
        k = min(width, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    for i, x in enumerate(sets):
        for j in range(i):
            common = len(x & sets[j])
            if common and 100 * common >= percent * len(x | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [(len(s), min(rows[v][0] for v in range(len(rows)) if find(v) == find(i))) for i, s in enumerate(sets)]


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_shingle_join(spark, width, percent, monkeypatch):
    rnd = np.random.default_rng(width)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [list(rnd.choice(vocabulary, n)) for n in (4, 9, 10, 40, 200, 400)]
    shared = list(rnd.choice(vocabulary, 60))
    rows = []
    for i in range(160):
        words = list(base[i % 6]) if i % 2 else list(rnd.choice(vocabulary, 120)) + shared
        for _ in range(rnd.integers(0, 4)):
            words[rnd.integers(len(words))] = rnd.choice(vocabulary)
        rows.append((i, " ".join(words).upper() if i % 5 == 0 else "\t".join(words)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "one"), (204, "ONE"), (205, "one two"), (206, LONG), (207, LONG + "tail")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("x")).withColumn("cluster", F.lit(1))
    expected = brute_groups(rows, width, percent)
    for block, long, hot in ((shingle_join.BLOCK_SHINGLES, shingle_join.LONG_LIST, shingle_join.HOT), (2000, 8, 1000), (700, 4, 12)):  # whole clusters, and blocks of them
        for name, value in (("BLOCK_SHINGLES", block), ("LONG_LIST", long), ("HOT", hot), ("SEEDS", 6)):
            monkeypatch.setattr(shingle_join, name, value)
        found = shingle_join.jaccard_groups(df, width, percent).orderBy("doc_id").collect()
        assert [(r["n_shingles"], r["component_id"]) for r in found] == expected
    assert shingle_join.jaccard_groups(df.limit(0), width, percent).count() == 0
    nameless = shingle_join.jaccard_groups(df.limit(3).withColumn("doc_id", F.expr("nullif(doc_id, 0)")), width, percent).where("doc_id is null").first()
    assert nameless["n_shingles"] == expected[0][0] and nameless["component_id"] is None


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_no_link_is_lost_in_any_wording(spark, width, percent, monkeypatch):
    """Many passages, each in documents with more, less or next to nothing else, on lists that are short, long and hot."""
    rnd = np.random.default_rng(percent)
    rows = []
    for wording in range(100):
        word = iter(f"w{wording}n{k}" for k in range(10_000))
        draw = lambda n: [next(word) for _ in range(n)]
        passage = draw(int(rnd.integers(30, 100)))
        title = draw(int(rnd.integers(0, 6)))
        texts = [[*title, *passage], [*title, *passage, *draw(int(rnd.integers(1, 7)))], [*passage, *draw(int(rnd.integers(1, 12)))], [*draw(3), *passage[5:], *draw(2)]]
        for _ in range(int(rnd.integers(4, 30))):
            at = int(rnd.integers(len(passage) - 12))
            texts.append([*draw(int(rnd.integers(2, 24))), *passage[at : at + 12 + int(rnd.integers(60))], *draw(int(rnd.integers(2)))])
        rows += [(int(k), " ".join(t)) for k, t in zip(10_000 * wording + rnd.permutation(len(texts)), texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = {r[0]: e for r, e in zip(rows, brute_groups(rows, width, percent))}
    for long, hot in ((256, 4096), (6, 4096), (3, 8)):
        monkeypatch.setattr(shingle_join, "LONG_LIST", long)
        monkeypatch.setattr(shingle_join, "HOT", hot)
        found = shingle_join.jaccard_groups(df, width, percent).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected


def test_a_copy_keeps_its_link_where_only_one_of_both_is_mostly_on_long_lists(spark):
    passage = " ".join(f"r{i}" for i in range(13))
    rows = [(0, f"{passage} a b"), (1, f"{passage} a b c")]
    rows += [(k, " ".join([*(f"x{k}v{i}" for i in range(9)), passage, *(f"y{k}v{i}" for i in range(9))])) for k in range(10, 110)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = shingle_join.jaccard_groups(df, 3, 90).orderBy("doc_id").collect()
    assert [(r["n_shingles"], r["component_id"]) for r in found] == brute_groups(rows, 3, 90)
    assert found[1]["component_id"] == 0


def test_divide_skip_finds_what_brute_force_finds(monkeypatch):
    rnd = np.random.default_rng(0)
    base = rnd.integers(0, 500, 80).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rnd.random(80) < 0.97], rnd.integers(500, 2000, rnd.integers(0, 6)).astype(np.uint64)])) for _ in range(40)]
    cell = shingle_join.Cell(sets, 85)
    for x, most in ((x, most) for x in range(40) for most in (0, 10_000)):  # counting, and the heap
        monkeypatch.setattr(shingle_join, "HEAP_ENTRIES", most)
        expected = [y for y in range(40) if y != x and 100 * len(np.intersect1d(sets[x], sets[y])) >= 85 * len(np.union1d(sets[x], sets[y]))]
        assert cell.partners(x, np.zeros(40, bool)).tolist() == expected


def test_groups_are_what_links_reach_in_any_order():
    rnd = np.random.default_rng(1)
    for _ in range(200):
        # chains of versions, of which each links with the next one only
        n = int(rnd.integers(5, 21))
        sets = [np.arange(3 * k, 3 * k + 30, dtype=np.uint64) for k in rnd.permutation(n)]
        gap = int(rnd.integers(n))
        sets = [s if s[0] < 3 * gap else s + np.uint64(1000) for s in sets]
        links = lambda x, y: 100 * len(np.intersect1d(x, y)) >= 80 * len(np.union1d(x, y))
        expected = list(range(n))
        for i in range(n):
            for j in range(i):
                if links(sets[i], sets[j]) and expected[i] != expected[j]:
                    low, high = sorted((expected[i], expected[j]))
                    expected = [low if g == high else g for g in expected]
        assert shingle_join.Cell(sets, 80).groups() == expected
        assert shingle_join.Cell(sets, 80).groups(np.arange(n) < n - 1) == expected


def test_toxicity_sample_is_as_large_as_it_was():
    assert toxicity.SAMPLE_DOCS == 4_000


def test_long_words_are_learned_in_windows():
    long = "a" * 30 + "scumbag" + "b" * 30
    assert any("scumbag" in w for w in toxicity.windows_of(f"x {long}")) and max(map(len, toxicity.windows_of(long))) <= toxicity.WINDOW
    rows = [(["plain", "words", *(["scumbag"] if k % 3 == 0 else [])] + [f"w{k % 7}"], int(k % 3 == 0)) for k in range(90)]
    model = toxicity.fit(rows)
    assert model.machine.scores([long])[0] > model.machine.scores(["a" * 30 + "window" + "b" * 30])[0]


def test_toxicity_of_labels_that_were_held_out(spark):
    data = "/root/testdata/sf0.1"
    found = toxicity.classify(spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet"))
    told = found.where("held_out").join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id").groupBy("toxic").agg(F.avg("predicted").alias("share"), F.count(F.lit(1)).alias("n"))
    share = {r["toxic"]: (r["share"], r["n"]) for r in told.collect()}
    assert share[1][1] > 100 and share[1][0] > 0.83 and share[0][0] < 0.01


def test_labels_without_a_document_take_no_place_in_the_sample(spark):
    docs = spark.createDataFrame([(k, f"word{k}") for k in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1000)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    sample = toxicity.labelled_sample(docs, labels, most=50)
    assert len(sample) == 50 and sum(y for _, y in sample) == 25 and all(len(w) == 1 for w, _ in sample)


def test_toxicity(spark, odd):
    rnd = np.random.default_rng(4)
    plain = ["the", "house", "green", "walks", "over", "river", "slowly", "and", "bread", "window", "paper", "stone"]
    bad = ["idiot", "scumbag", "moronic"]
    rows = []
    for i in range(400):
        words = list(rnd.choice(plain, 30))
        if i % 4 == 0:
            for _ in range(3):
                words.insert(rnd.integers(30), rnd.choice(bad))
        rows.append((i, " ".join(words) + ".", int(i % 4 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").withColumn("score", F.lit("own"))
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.classify(docs, labels).collect()}
    assert len(got) == 400 and all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(got[i]["predicted"] == y for i, _, y in rows)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 300 and kept.first()["score"] == "own"
    model = toxicity.fit([(toxicity.windows_of(r[1]), r[2]) for r in rows])
    hidden = spark.createDataFrame(enumerate(["green river i d i o t walks idiot", "an idi.ot and a sc*umbag", "green river walks"]), "doc_id long, text string")
    scores = [r["score"] for r in toxicity.score(hidden, model).orderBy("doc_id").collect()]
    assert min(scores[:2]) > scores[2]
    assert toxicity.score(odd, model).count() == len(ODD) + 1
    # without both labels nothing is toxic
    assert toxicity.classify(docs, labels.where("toxic = 0")).agg(F.max("score")).first()[0] == 0
    assert toxicity.classify(docs.limit(0), labels.limit(0)).count() == 0
