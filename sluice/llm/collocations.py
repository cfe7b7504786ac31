"""Phrase collocations by prefix-projected growth.

Phrases are runs of words within a piece of a text. As in PrefixSpan, every
occurrence of a frequent word points to what follows it; the pointers of one
prefix come together in one task, which extends the prefix to the right, depth
first, by the words that follow often enough, each with its own share of the
pointers. A pointer carries the words it points at (three at most, up to the
first that is not frequent), so a task needs no text.

A word that opens more phrases than one task should hold is hot. A prefix whose
words are all hot is extended before it is dealt out: its pointers go by the
first word that is not hot, or by the whole run, and what it loses thereby, the
counts of the run so far, is counted where the texts are. So no task's prefix
has more pointers than a hot word has, however common a word, a pair or a
passage is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.llm.batches import Kernel, give_back, map_slices
from sluice.session import stored

#: Phrases have up to LONGEST words and occur so often at least; a longer one that holds a phrase in PERCENT of its places replaces it; the best of each language are kept.
LONGEST, MIN_COUNT, PERCENT, FIRST = 4, 30, 80, 2000
#: The language of texts without one.
UNKNOWN = "und"
#: Pointers that one task holds, on average; a word is hot with a part of so many as PARTS, and there are no more hot words than HOT_WORDS.
TASK_POINTERS, PARTS, HOT_WORDS = 2_000_000, 4, 1_000_000
#: Bytes of pointers' words that are read at once.
LINE_BYTES = 1 << 22
#: Bits of the table that tells which words can't be frequent.
BITS = 1 << 26

_SPACE, _BREAK = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _SPACE
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_in(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """(codes, their words, text of each word, whether the next word is in the same piece) of the words of some texts, in one pass over their bytes."""
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], "<i4")[texts.offset : texts.offset + n + 1] if n else np.zeros(1, "<i4")
    data = texts.buffers()[2] if n else None
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    edges = (offsets - offsets[0]).astype(np.int64)
    kind = _KIND[raw]
    word = kind == 0
    opens = np.zeros(len(raw) + 1, bool)
    opens[edges] = True
    starts = np.flatnonzero(word & np.append(True, ~word[:-1] | opens[1 : len(raw)])[: len(raw)])
    ends = np.flatnonzero(word & (np.append(~word[1:], True)[: len(raw)] | opens[1:])) + 1
    pieces = np.searchsorted(np.flatnonzero(kind == _BREAK), starts)
    of = np.searchsorted(edges, starts, "right") - 1
    cuts = np.append(0, np.cumsum(ends - starts)).astype("<i4")
    said = pa.StringArray.from_buffers(len(starts), pa.py_buffer(cuts.tobytes()), pa.py_buffer(_LOWER[raw[word]].tobytes()))
    coded = said.dictionary_encode()
    more = np.append((pieces[1:] == pieces[:-1]) & (of[1:] == of[:-1]), False)[: len(starts)]
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, of, more


def _filled(batch: pa.RecordBatch) -> tuple[pa.Array, pa.Array]:
    langs = pc.fill_null(batch.column("lang"), UNKNOWN).dictionary_encode()
    return pc.fill_null(batch.column("text"), ""), langs


def _told_apart(codes: np.ndarray, words: pa.Array, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(index of each word, counts, language, word) of the distinct (language, word)."""
    width = max(1, len(words))
    both, index, counts = np.unique(lang * width + codes, return_inverse=True, return_counts=True)
    return index, counts, both // width, words.take(pa.array(both % width))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of all words of (lang, text)."""

    def make() -> Kernel:
        def kernel(batch: pa.RecordBatch) -> dict:
            texts, langs = _filled(batch)
            codes, words, of, _ = words_in(texts)
            _, counts, lang, word = _told_apart(codes, words, langs.indices.to_numpy()[of].astype(np.int64))
            return {"lang": langs.dictionary.take(pa.array(lang)), "word": word, "n": counts}

        return kernel

    return map_slices(docs, make, "lang string, word string, n bigint", 1024).groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _hash(lang: str, word: str):
    return F.xxhash64(F.concat(lang, F.lit("\0"), word))


def _hashes(langs: list[str], words: list[str]) -> np.ndarray:
    """What ``_hash`` says."""
    return np.fromiter((xxhash.xxh64_intdigest(f"{a}\0{w}".encode(), 42) for a, w in zip(langs, words)), np.uint64, len(words))


def frequent_bits(words: DataFrame) -> np.ndarray:
    """A table of BITS bits, set where words of (lang, word) are; its size doesn't depend on them."""
    place = F.pmod(_hash("lang", "word"), F.lit(BITS)) + 1
    rows = words.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    out = np.zeros(BITS // 8, np.uint8)
    for r in rows.toLocalIterator():
        out[(r["part"] - 1) * 4096 : r["part"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


class Pointers:
    """The pointers that words of texts give, as columns of words' places in a dictionary; -1 where there is none."""

    def __init__(self, bits: np.ndarray, hot: np.ndarray, buckets: int, longest: int) -> None:
        self.bits, self.hot, self.buckets, self.longest = bits, hot, np.uint64(buckets), longest

    def __call__(self, index: np.ndarray, more: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(words, least length they count for, times, bucket) of every pointer; index is of (language, word), hashes are theirs."""
        place = (hashes % np.uint64(BITS)).astype(np.int64)
        usual = (self.bits[place >> 3] >> (place & 7)) & 1 == 1
        hot = np.isin(hashes, self.hot)
        usual, hot = usual[index], hot[index]
        reach = usual.astype(np.int8)  # how many words from here on are frequent and in one piece
        for _ in range(self.longest - 1):
            reach = np.where(usual, 1 + np.where(more, np.append(reach[1:], 0), 0), 0)
        reach = np.minimum(reach, self.longest)
        at = np.flatnonzero(reach >= 2)
        reach = reach[at]
        words = np.full((len(at), self.longest), -1, np.int64)
        for k in range(self.longest):
            there = reach > k
            words[there, k] = index[at[there] + k]
        # the prefix that a pointer goes by: up to the first word that isn't hot, or all it has
        size = np.ones(len(at), np.int64)
        for k in range(self.longest - 1):
            size += (size == k + 1) & (reach > k + 1) & hot[at + np.minimum(k, reach - 1)]
        parts = [(words, np.maximum(size, 2), np.ones(len(at), np.int64), size)]
        for k in range(2, self.longest):  # what comes before such a prefix is counted here
            rows = words[size > k, :k]
            if len(rows):
                distinct, times = np.unique(rows, axis=0, return_counts=True)
                short = np.full((len(distinct), self.longest), -1, np.int64)
                short[:, :k] = distinct
                parts.append((short, np.full(len(distinct), k), times, np.full(len(distinct), k)))
        words, least, times, size = (np.concatenate(p) for p in zip(*parts))
        mixed = np.zeros(len(words), np.uint64)
        for k in range(self.longest):
            mixed = np.where(size > k, (mixed ^ hashes[words[:, k]]) * _MULTIPLIER, mixed)
            mixed ^= mixed >> np.uint64(29)
        return words, least, times, (mixed % self.buckets).astype(np.int64)


_CODEC = ("zstd", 1)


def packed(words: np.ndarray, least: np.ndarray, times: np.ndarray, bucket: np.ndarray, lang: np.ndarray, said: pa.Array) -> dict:
    """Pointers as one row for each (bucket, language): their least lengths, times and words, a line each, compressed."""
    codec = pa.Codec(_CODEC[0], compression_level=_CODEC[1])
    own = lang[words[:, 0]] if len(words) else np.zeros(0, np.int64)
    group = bucket * (int(lang.max(initial=0)) + 1) + own
    order = np.argsort(group, kind="stable")
    words, least, times, group = words[order], least[order].astype("<i1"), times[order].astype("<i8"), group[order]
    columns = [said.take(pa.array(words[:, k], mask=words[:, k] < 0)) for k in range(words.shape[1])]
    lines = pc.binary_join_element_wise(*columns, " ", null_handling="skip")
    lines = pc.binary_join_element_wise(lines, "", "\n")
    if isinstance(lines, pa.ChunkedArray):
        lines = lines.combine_chunks()
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))[: len(group)]
    out: dict = {"bucket": bucket[order][starts], "lang": own[order][starts], "rows": [], "size": [], "packed": []}
    if len(group):
        offsets = np.frombuffer(lines.buffers()[1], "<i4")[lines.offset :]
        text = memoryview(lines.buffers()[2])
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(group)]):
        raw = b"".join((least[a:b].tobytes(), times[a:b].tobytes(), text[offsets[a] : offsets[b]]))
        out["rows"].append(b - a)
        out["size"].append(len(raw))
        out["packed"].append(codec.compress(raw, asbytes=True))
    return out


def unpacked(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str], list[str], np.ndarray]:
    """(words by row, least, times, words, languages, language by row) of rows that ``packed`` made. Their lines are read LINE_BYTES at a time."""
    codec = pa.Codec(_CODEC[0])
    whole = pa.Table.from_batches(batches)
    sizes = whole.column("rows").to_pylist()
    least, times, tables, lines, held = [], [], [], [], 0
    known: dict[str, int] = {}

    def read() -> np.ndarray:
        codes, words, _, more = words_in(pa.array(lines, pa.string()))
        own = np.fromiter((known.setdefault(w, len(known)) for w in words.to_pylist()), np.int32, len(words))
        begins = np.append(True, ~more[:-1])
        row, firsts = np.cumsum(begins) - 1, np.flatnonzero(begins)
        place = np.arange(len(codes)) - firsts[row]
        table = np.full((len(firsts), int(place.max()) + 1), -1, np.int32)
        table[row, place] = own[codes]
        return table

    for rows, size, blob in zip(sizes, whole.column("size").to_pylist(), whole.column("packed")):
        raw = codec.decompress(blob.as_buffer(), size, asbytes=True)
        least.append(np.frombuffer(raw[:rows], "<i1"))
        times.append(np.frombuffer(raw[rows : 9 * rows], "<i8"))
        lines.append(raw[9 * rows :])
        held += len(lines[-1])
        if held > LINE_BYTES:
            tables.append(read())
            lines, held = [], 0
    if lines:
        tables.append(read())
    table = np.full((sum(map(len, tables)), max(t.shape[1] for t in tables)), -1, np.int32)
    at = 0
    for t in tables:
        table[at : at + len(t), : t.shape[1]] = t
        at += len(t)
    langs = whole.column("lang").combine_chunks().dictionary_encode()
    return table, np.concatenate(least), np.concatenate(times), list(known), langs.dictionary.to_pylist(), np.repeat(langs.indices.to_numpy(), np.array(sizes))


def _runs(keys: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The order that sorts keys, and where the runs of equal ones begin in it, the end included."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    return order, [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]


def grown(words: np.ndarray, least: np.ndarray, times: np.ndarray, lang: np.ndarray, min_count: int) -> Iterator[tuple[int, tuple[int, ...], int]]:
    """(language, words, count) of the frequent phrases that some pointers tell of, depth first."""
    longest = words.shape[1]

    def grow(rows: np.ndarray, prefix: tuple[int, ...]) -> Iterator[tuple[tuple[int, ...], int]]:
        depth = len(prefix)
        following = words[rows, depth]
        rows = rows[following >= 0]
        if len(rows) < min_count and times[rows].sum() < min_count:
            return
        order, cuts = _runs(words[rows, depth])
        rows = rows[order]
        for a, b in zip(cuts, cuts[1:]):
            own = rows[a:b]
            weight = times[own]
            if b - a < min_count and weight.sum() < min_count:
                continue
            phrase = (*prefix, int(words[own[0], depth]))
            count = int(weight[least[own] <= depth + 1].sum())
            if count >= min_count:
                yield phrase, count
            if depth + 1 < longest:
                yield from grow(own, phrase)

    order, cuts = _runs(lang.astype(np.int64) * (int(words.max(initial=0)) + 1) + words[:, 0])
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            own = order[a:b]
            for phrase, count in grow(own, (int(words[own[0], 0]),)):
                yield int(lang[own[0]]), phrase, count


def frequent_phrases(docs: DataFrame, words: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, a) of the phrases of 2 to ``longest`` words of (lang, text); words are the frequent ones, as (lang, word, n).

    Two bounded tables go to the tasks: a bit for every frequent word's hash, of
    fixed size, and the hashes of hot words, of which there are few by the sum
    of their counts.
    """
    spark = docs.sparkSession
    total = words.agg(F.sum("n")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_POINTERS))
    limit = max(min_count, total // (PARTS * buckets), total // HOT_WORDS)
    hot = np.array([r[0] for r in words.where(F.col("n") > limit).select(_hash("lang", "word")).toLocalIterator()], np.int64).view(np.uint64)
    bits = frequent_bits(words)

    def deal() -> Kernel:
        pointers = Pointers(bits, hot, buckets, longest)

        def kernel(batch: pa.RecordBatch) -> dict:
            texts, langs = _filled(batch)
            codes, known, of, more = words_in(texts)
            index, _, lang, said = _told_apart(codes, known, langs.indices.to_numpy()[of].astype(np.int64))
            names = langs.dictionary.take(pa.array(lang)).to_pylist()
            out = packed(*pointers(index, more, _hashes(names, said.to_pylist())), lang, said)
            return out | {"lang": langs.dictionary.take(pa.array(out["lang"]))}

        return kernel

    def mine(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in source if b.num_rows]
        if batches:
            table, least, times, said, langs, lang = unpacked(batches)
            batches = None
            out: list[list] = [[], [], []]
            for own, phrase, count in grown(table, least, times, lang, min_count):
                for column, value in zip(out, (langs[own], " ".join(said[w] for w in phrase), count)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], ["lang", "phrase", "a"])
        give_back()

    dealt = map_slices(docs, deal, "bucket int, lang string, rows int, size int, packed binary", 1024)
    return dealt.repartitionById(buckets, F.col("bucket")).mapInArrow(mine, "lang string, phrase string, a bigint")


def scored(phrases: DataFrame, words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, a, l, r, score): of each phrase the cut with the least floor(2,000,000 a / (l + r)), the first of equal ones; l and r are the counts of both parts."""
    said = F.split("phrase", " ")
    count = F.size(said)
    parts = [
        F.struct(F.lit(f"{side}{k}").alias("side"), F.when(count > k, F.array_join(F.slice(said, *((1, F.lit(k)) if side == "l" else (F.lit(k + 1), F.greatest(count - k, F.lit(0))))), " ")).alias("part"))
        for k in range(1, longest)
        for side in "lr"
    ]
    counts = words.select("lang", F.col("word").alias("part"), F.col("n").alias("f")).union(phrases)
    cut = phrases.select("lang", "phrase", "a", F.explode(F.array(*parts)).alias("p")).select("lang", "phrase", "a", "p.side", "p.part").where("part is not null")
    sides = [F.max(F.when(F.col("side") == f"{s}{k}", F.col("f"))).alias(f"{s}{k}") for k in range(1, longest) for s in "lr"]
    wide = cut.join(counts, ["lang", "part"]).groupBy("lang", "phrase", "a").agg(*sides)
    score = lambda k: F.expr(f"cast(2000000 as decimal(38, 0)) * cast(a as decimal(20, 0)) div (cast(l{k} as decimal(20, 0)) + r{k})")
    cuts = F.array_min(F.array(*(F.when(F.col(f"l{k}").isNotNull(), F.struct(score(k).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in range(1, longest))))
    return wide.withColumn("_cut", cuts).select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")


def unheld(phrases: DataFrame, percent: int = PERCENT, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase) of the phrases that no longer one holds in ``percent`` of their places."""
    said = F.split("phrase", " ")
    count = F.size(said)
    inside = [
        F.when((count > size) & (count >= size + start), F.array_join(F.slice(said, F.lit(start + 1), F.lit(size)), " "))
        for size in range(2, longest)
        for start in range(longest - size + 1)
    ]
    held = phrases.select("lang", F.col("a").alias("f"), F.explode(F.array_compact(F.array(*inside))).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    exact = lambda c, by: F.col(c).cast("decimal(20,0)") * F.lit(by).cast("decimal(10,0)")
    return phrases.join(held, ["lang", "phrase"], "left").where(F.col("f").isNull() | (exact("f", 100) < exact("a", percent))).select("lang", "phrase")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, percent: int = PERCENT, first: int = FIRST, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of every language; the limit is the feature.

    A-Z count as a-z; texts are cut into pieces at . , ; : ! ? and line ends,
    these into words at spaces and tabs. Null texts have no words, a null
    language is ``und``, repeated rows count as often as they occur, texts are
    counted whole, and an empty table gives an empty result. Other columns are
    not read. All counts are over all occurrences, overlapping ones too.
    """
    docs = docs.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text"))
    counts = stored(word_counts(docs))
    sizes = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    words = stored(counts.where(F.col("n") >= min_count))
    phrases = stored(frequent_phrases(docs, words, min_count, longest))
    best = scored(phrases, words, longest).join(unheld(phrases, percent, longest), ["lang", "phrase"], "left_semi")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    top = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return top.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle() -> str:
    """DuckDB's twin of the query over documents."""
    return f"""
    with piece as (
      select lang, row_number() over () as id, list_filter(string_split_regex(said, '[\\x20\\x09]+'), lambda w: w <> '') as ws
      from (
        select coalesce(lang, '{UNKNOWN}') as lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as said
        from documents)),
    place as (select lang, id, unnest(ws) as w, generate_subscripts(ws, 1) as i from piece),
    ahead as (select lang, w, lead(w, 1) over o as w2, lead(w, 2) over o as w3, lead(w, 3) over o as w4 from place window o as (partition by id order by i)),
    counted as materialized (
      select lang, 1 as m, w as phrase, count(*) as a from ahead group by all
      union all select lang, 2, w || ' ' || w2, count(*) from ahead where w2 is not null group by all
      union all select lang, 3, w || ' ' || w2 || ' ' || w3, count(*) from ahead where w3 is not null group by all
      union all select lang, 4, w || ' ' || w2 || ' ' || w3 || ' ' || w4, count(*) from ahead where w4 is not null group by all),
    size as (select lang, sum(a)::bigint as n from counted where m = 1 group by lang),
    cand as materialized (select lang, m, phrase, a, string_split(phrase, ' ') as ws from counted where m > 1 and a >= {MIN_COUNT}),
    frequent as materialized (select * from counted where a >= {MIN_COUNT}),
    side as materialized (
      select lang, phrase, a, k, array_to_string(ws[1 : k], ' ') as lp, array_to_string(ws[k + 1 : ], ' ') as rp
      from (select *, unnest(range(1, m)) as k from cand)),
    cut as (
      select s.lang, s.phrase, s.a, k, l.a as l, r.a as r, (2000000::hugeint * s.a) // (l.a + r.a) as score
      from side s join frequent l on l.lang = s.lang and l.phrase = s.lp join frequent r on r.lang = s.lang and r.phrase = s.rp),
    least as (select * from cut qualify row_number() over (partition by lang, phrase order by score, k) = 1),
    held as (
      select lang, array_to_string(ws[s : s + z - 1], ' ') as phrase, max(a) as f
      from cand, range(2, {LONGEST}) t(z), range(1, {LONGEST} + 1) u(s) where z < m and s + z - 1 <= m group by all),
    kept as (
      select least.lang, least.phrase, a, l, r, score, row_number() over (partition by least.lang order by score desc, a desc, least.phrase) as rank
      from least left join held on held.lang = least.lang and held.phrase = least.phrase where f is null or 100::hugeint * f < {PERCENT}::hugeint * a)
    select lang, rank, phrase, a, l, r, n, score::bigint as score from kept join size using (lang) where rank <= {FIRST}"""
