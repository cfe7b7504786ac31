"""Fingerprints, spelling variants and collocations, against brute force and SQL."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from sluice.llm import collocations, fingerprints, spelling
from sluice.llm.fingerprints import K, Sketcher

LONG = "alpha beta gamma delta. " * 6000
ODD = [None, "", " ", "a", "same text of six words here", "same text of six words here", LONG, "é ü 日本 🙂 ß one two three", "x" * 3000, "A, b. C d"]


def words_like(seed, n):
    rnd = np.random.default_rng(seed)
    parts = ["ab", "ba", "ée", "ca", "a", "bb", "Ab", "ÿ"]
    return [" ".join("".join(parts[k] for k in rnd.integers(0, 8, rnd.integers(2, 6))) for _ in range(rnd.integers(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None if i % 2 else "de", 0, 1.0, 7) for i, t in enumerate(ODD)] + [(5, ODD[5], "de", 0, 1.0, 7), (None, "no id at all in this row", "de", 0, 1.0, 7), (None, None, "de", 0, 1.0, 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long, rank double, word int")


def true_resemblance(a, b, width=5):
    def shingles(text):
        w = (text or "").encode().lower().split()
        return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()

    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0, len(a & b) / len(a) if a else 1.0, len(a)


@pytest.mark.parametrize("range_rows", [20_000, 2])
def test_edited_likeness(spark, odd, range_rows, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", range_rows)
    found = fingerprints.edited_likeness(odd).collect()
    assert len(found) == len(ODD) + 3
    rows = sorted(enumerate(ODD), key=lambda r: -r[0])
    by_id = defaultdict(list)
    for r in found:
        by_id[r["doc_id"]].append(r)
    for (own, text), (_, following) in zip(rows, rows[1:]):
        text, following = text or "", following or ""
        if own == 5:  # twice: once its own next
            continue
        edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        (r,) = by_id[own]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for name, other in ("near_edited", edited), ("near_next", following):
            assert abs(r[name] - true_resemblance(text, other)[0]) < 0.15
    assert len({r["fingerprint"] for r in by_id[4] + by_id[5]}) == 1
    assert sorted(r["near_next"] for r in by_id[5])[1] == 1.0
    # rows without an id come last, by their texts' hashes; after the last comes the first
    text = "no id at all in this row"
    last = {hashlib.sha256(x.encode()).hexdigest() for x in (text[:12] + "A, b. C d", text[:12])}
    assert len(by_id[None]) == 2 and {r["edited_sha256"] for r in by_id[None] if r["n_chars"]} < last
    assert fingerprints.edited_likeness(odd.limit(0)).count() == 0
    assert fingerprints.edited_likeness(odd.where("doc_id = 6")).first()["near_next"] == 1.0


def test_edited_texts_of_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted(map(tuple, docs.select("doc_id", "text").collect()), reverse=True)
    found = {r["doc_id"]: r for r in fingerprints.edited_likeness(docs).collect()}
    errors = []
    for (own, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        r = found[own]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert np.array_equal(fingerprints.read(r["fingerprint"]), Sketcher()(text)) and np.array_equal(fingerprints.read(r["edited_fingerprint"]), Sketcher()(edited))
        near, inside, n = true_resemblance(text, edited)
        errors.append((r["near_edited"] - near, r["in_edited"] - inside, r["n_shingles"] / max(n, 1) - (n > 0)))
    spread = np.sqrt(np.mean(np.square(errors), axis=0))
    assert (spread < [0.05, 0.08, 0.12]).all(), spread


def test_sketches_merge(spark):
    texts = words_like(1, 200)
    whole = Sketcher(words=2)
    docs = spark.createDataFrame([(i, t, i % 3 or None, "x") for i, t in enumerate(texts)], "doc_id int, text string, part int, sketch_of string")
    sketches = fingerprints.fingerprints(docs, words=2).join(docs.select("doc_id", "part"), "doc_id")
    found = {r["part"]: r["sketch"] for r in fingerprints.merge_sketches(sketches, ["part"]).collect()}
    for part in (None, 1, 2):
        expected = fingerprints.merge([whole(t) for i, t in enumerate(texts) if (i % 3 or None) == part])
        assert found[part] == expected.tolist() and len(expected) == K
    empty = fingerprints.merge_sketches(fingerprints.fingerprints(spark.createDataFrame([(1, None)], "doc_id int, text string")), ["doc_id"])
    assert [tuple(r) for r in empty.collect()] == [(1, [])]
    pairs = spark.createDataFrame([(found[1], found[2]), (found[1], []), ([], []), (None, [])], "a array<bigint>, b array<bigint>")
    said = pairs.select(fingerprints.resemblance_of(pairs.a, pairs.b).alias("r"), fingerprints.distinct_of(pairs.b).alias("n")).collect()
    arrays = [np.array(found[k]) for k in (1, 2)]
    assert said[0]["r"] == pytest.approx(fingerprints.resemblance(*arrays)) and said[0]["n"] == pytest.approx(fingerprints.distinct_shingles(arrays[1]))
    assert [r["r"] for r in said[1:]] == [0.0, 1.0, None]


def brute_variants(counts, ratio=10):
    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    others = {w: [v for v in counts if near(w, v)] for w in counts}
    form = {}
    for w, vs in others.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(others[w]), counts[form[w]] if form[w] else None)
    return out


def as_map(frame):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in frame.collect()}


@pytest.mark.parametrize("seed", range(4))
def test_variants(spark, seed):
    rnd = np.random.default_rng(seed)
    counts = {w: int(10 ** rnd.uniform(0, 5)) for t in words_like(seed, 12) for w in t.split()}
    counts |= {"a": 4, "aa": 400, "aaa": 40000, "": 3} if seed else {}
    found = as_map(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n int")))
    assert found == brute_variants(counts)


def test_variants_of_odd_words(spark):
    long = "é" * 20_000
    rows = [(long, 1), (long[:-1] + "a", 50), (long + "é", 50), (None, 3), ("abc", None), ("日本語", 1), ("日本", 10)]
    found = as_map(spelling.variants(spark.createDataFrame(rows, "word string, n long")))
    assert found[long] == (long[:-1] + "a", long[:-1] + "a", 1, 2, 50) and found["日本語"] == ("日本", "日本", 1, 1, 10) and len(found) == 5
    assert spelling.variants(spark.createDataFrame([], "word string, n long")).collect() == []


def brute_words(rows):
    counts = Counter()
    for own, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if own is None else own}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_spelling_of_texts(spark, odd):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()] + list(enumerate(words_like(9, 400)))
    docs = spark.createDataFrame([(*r, "w") for r in rows], "doc_id long, text string, word string")
    expected = brute_words(rows)
    assert as_map(spelling.spelling_variants(docs)) == brute_variants(expected) and len(expected) > 50
    assert spelling.spelling_variants(docs.limit(0)).count() == 0


def brute_collocations(rows, min_count, first=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for m in range(1, 5):
                f[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, own in f.items():
        cand = {p: a for p, a in own.items() if len(p) > 1 and a >= min_count}
        kept = []
        for p, a in cand.items():
            if any(100 * b >= 80 * a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, k = min((2000000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:first], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_collocations(spark, odd, seed, monkeypatch):
    if seed:
        monkeypatch.setattr(collocations, "TASK_POINTERS", [0, 300, 40, 1 << 30][seed])
    rnd = np.random.default_rng(seed)
    said = [*"abcd", "É", "日", "E", ".", "\t", "b,", "c\n", " ", " ", "\x1c"]
    weights = rnd.dirichlet(np.ones(len(said)))
    rows = [(["en", "de", None][rnd.integers(3)], " ".join(said[k] for k in rnd.choice(len(said), rnd.integers(0, 60), p=weights))) for _ in range(150)]
    rows += [(r["lang"], r["text"]) for r in odd.collect()] + [("en", "a passage that is in many texts, and more")] * 40
    docs = spark.createDataFrame([(i, *r, 1) for i, r in enumerate(rows)], "doc_id int, lang string, text string, n int")
    for min_count, first in (8, 2000), (30, 5):
        found = sorted(tuple(r) for r in collocations.collocations(docs, min_count=min_count, first=first).collect())
        assert found == brute_collocations(rows, min_count, first) and found
    assert collocations.collocations(docs.limit(0)).collect() == []


def test_scores_are_exact(spark):
    big = 4 * 10**17
    phrases = spark.createDataFrame([("en", "a b", big - 1), ("en", "a b c", big - 3)], "lang string, phrase string, a long")
    words = spark.createDataFrame([("en", w, big + k) for k, w in enumerate("abc")], "lang string, word string, n long")
    found = {r["phrase"]: (r["l"], r["r"], r["score"]) for r in collocations.scored(phrases, words).collect()}
    assert found["a b"] == (big, big + 1, 2000000 * (big - 1) // (2 * big + 1))
    assert [tuple(r) for r in collocations.unheld(phrases).collect()] == [("en", "a b c")]


@pytest.mark.parametrize("name", ["op12_spelling_variants", "op13_collocations"])
def test_queries_equal_their_sql(spark, name):
    from sluice.llm import registry

    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{folder}/documents.parquet'")
    expected = con.sql(registry.oracle_sql()[name])
    found = registry.queries()[name](spark, folder)
    columns = expected.columns
    assert sorted(map(str, expected.fetchall())) == sorted(str(tuple(r)) for r in found.select(*columns).collect())


def test_pointers_are_read_piecewise(monkeypatch):
    import tracemalloc

    monkeypatch.setattr(collocations, "LINE_BYTES", 1 << 16, raising=False)
    said = pa.array([f"word{k:05}" for k in range(5000)])
    rnd = np.random.default_rng(1)
    batches, sent = [], []
    for _ in range(50):
        words = rnd.integers(0, 5000, (4000, 4))
        words[np.arange(4) >= rnd.integers(2, 5, 4000)[:, None]] = -1
        out = collocations.packed(words, np.full(4000, 2), rnd.integers(1, 9, 4000), np.zeros(4000, np.int64), np.zeros(5000, np.int64), said)
        batches.append(pa.RecordBatch.from_pydict({"lang": ["en"] * len(out["rows"]), "rows": out["rows"], "size": out["size"], "packed": out["packed"]}))
        sent += [[said[k].as_py() for k in row if k >= 0] for row in words[:20].tolist()]
    tracemalloc.start()
    table, _, times, names, *_ = collocations.unpacked(batches)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(table) == len(times) == 200_000 and peak < 200 * len(table)
    assert [[names[k] for k in row if k >= 0] for at in range(0, 200_000, 4000) for row in table[at : at + 20].tolist()] == sent
