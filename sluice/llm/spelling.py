"""Spelling variants: words that differ by one letter, grouped without pairs.

Words that differ by one replaced letter agree in (position, prefix, suffix);
a word and another with one letter more agree in the word and what the other
leaves when that letter is deleted. Each word is sent to its groups of both
kinds, and each group keeps no more than its size and its two largest words,
which is all its members need: how many others there are, and which is the
largest but for oneself. No pair of words is ever formed.

Groups go by 128 bits of a hash that is a sum over (letter, place), so that all
keys of a word take time in proportion to its length however long it is. Words
go by their place in code-point order, which settles ties as their letters do.
A wildcard group has a member for each letter of the alphabet at most, the
deletions that meet in a word one for each letter and place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.batches import Kernel, give_back, map_slices
from sluice.operators.order import ranked
from sluice.session import checkpointed, stored

#: Letters of a word, and the case that is folded.
LETTERS, UPPER, LOWER = "A-Za-zÀ-ÿ", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words have so many letters and occur so often at least; a form occurs RATIO times as often as its variant.
MIN_LETTERS, MIN_COUNT, RATIO = 7, 2, 10
#: One in so many (run, document) loses a letter before it is counted.
SLIP = 31
#: Rows of groups that one task holds, on average.
GROUP_ROWS = 1_000_000

_WILD, _SHORTER, _OWN = 0, 1, 2
_SEEDS = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


def vocabulary(docs: DataFrame, slip: int | None = SLIP, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, n) of the words of all whole texts, folded to lower case in A-Z only.

    With ``slip`` a run loses the letter crc32 % length where ``slip`` divides
    the crc32 of ``<id>:<run>``. Null texts have no words; a null id is written
    as nothing; repeated rows count as often as they occur.
    """
    runs = docs.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("_id"),
        F.explode(F.regexp_extract_all(text_column, F.lit(f"[{LETTERS}]{{{min_letters},}}"), F.lit(0))).alias("run"),
    ).select("_id", F.translate("run", UPPER, LOWER).alias("word"))
    if slip:
        at = F.pmod("_crc", F.char_length("word")).cast("int")
        slipped = F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2))
        runs = runs.withColumn("_crc", F.crc32(F.concat("_id", F.lit(":"), "word")))
        runs = runs.select(F.when(F.pmod("_crc", F.lit(slip)) == 0, slipped).otherwise(F.col("word")).alias("word"))
    return runs.where(F.char_length("word") >= min_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _mixed(letters: np.ndarray, places: np.ndarray, seed: int) -> np.ndarray:
    """64 bits of a letter at a place."""
    x = (letters.astype(np.uint64) << np.uint64(40)) + places.astype(np.uint64) + np.uint64(seed)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def keys_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word's index, role, key, key) of every group that some words belong to.

    A word is in a wildcard group for each place, in the group of each distinct
    string that it leaves by losing a letter, and in its own.
    """
    letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    of = np.repeat(np.arange(len(words)), sizes)
    firsts = np.cumsum(sizes) - sizes
    places = np.arange(len(letters)) - firsts[of]
    # of equal neighbours the last one's deletion stands for all
    ends = np.append((letters[1:] != letters[:-1]) | (of[1:] != of[:-1]), True)[: len(letters)]
    keys = []
    for seed in _SEEDS:
        here, before = _mixed(letters, places, seed), _mixed(letters, places - 1, seed)
        total = np.concatenate([[np.uint64(0)], np.cumsum(here)])
        moved = np.concatenate([[np.uint64(0)], np.cumsum(before)])
        own = total[firsts + sizes] - total[firsts]
        wild = own[of] - here + _mixed(np.zeros(len(letters), np.uint32), places, seed)
        shorter = (total[:-1] - total[firsts][of]) + (moved[firsts + sizes][of] - moved[1:])
        keys.append(np.concatenate([wild, shorter[ends], own]).view(np.int64))
    roles = np.repeat([_WILD, _SHORTER, _OWN], [len(letters), int(ends.sum()), len(words)])
    return np.concatenate([of, of[ends], np.arange(len(words))]), roles, *keys


def _near(who: np.ndarray, n: np.ndarray, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, ...]:
    """(id, near words, count and id of the largest) that the groups of some rows tell their members; who is id * 4 + role."""
    role, ids = who & 3, who >> 2
    # within a group its own word first, then by size, then in the words' order
    order = np.lexsort((ids, -n, -(role == _OWN).astype(np.int8), k2, k1))
    role, ids, n, k1, k2 = role[order], ids[order], n[order], k1[order], k2[order]
    starts = np.flatnonzero(np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])))[: len(ids)]
    sizes = np.diff(np.append(starts, len(ids)))
    head, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
    own = role[head] == _OWN
    here = np.arange(len(ids))
    # members of a wildcard group, and of a group with its own word, that have others there
    some = (size > 1) & (own | (role == _WILD))
    here, head, size, own = here[some], head[some], size[some], own[some]
    best = np.where(here == head, head + 1, head)
    count = np.where(own & (here != head), 1, size - 1)
    return ids[here], count, n[best], ids[best]


def near_counts(words: DataFrame) -> DataFrame:
    """(id, n_near, form_n, form_id) of the words that have near ones, of (id, word, n); id is the word's place in order."""
    spark = words.sparkSession

    def make() -> Kernel:
        def kernel(batch: pa.RecordBatch) -> dict:
            of, roles, k1, k2 = keys_of(batch.column("word").to_pylist())
            ids, n = (batch.column(c).to_numpy() for c in ("id", "n"))
            return {"k1": k1, "k2": k2, "who": ids[of] * 4 + roles, "n": n[of]}

        return kernel

    keyed = map_slices(words.select("id", "word", "n"), make, "k1 bigint, k2 bigint, who bigint, n bigint", 2048)
    rows = words.agg(F.sum(2 * F.char_length("word") + 1)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // GROUP_ROWS))
    names = ["id", "n_near", "top_n", "top_id"]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in source if b.num_rows]
        if batches:
            whole = pa.Table.from_batches(batches)
            found = _near(*(whole.column(c).to_numpy() for c in ("who", "n", "k1", "k2")))
            batches = whole = None
            for start in range(0, len(found[0]), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(f[start : start + 100_000], pa.int64()) for f in found], names)
        give_back()

    # keys are hashes and groups are small, so parts are alike
    told = keyed.repartition(parts, "k1", "k2").mapInArrow(run, ", ".join(f"{n} bigint" for n in names))
    top = F.min(F.struct((-F.col("top_n")).alias("n"), F.col("top_id").alias("id"))).alias("top")
    return told.groupBy("id").agg(F.sum("n_near").alias("n_near"), top).select("id", "n_near", (-F.col("top.n")).alias("form_n"), F.col("top.id").alias("form_id"))


def roots_of(forms: DataFrame) -> DataFrame:
    """(id, root_id) of (id, form_id), following forms to the last, in rounds that double the steps; forms grow, so there is no circle."""
    reached = checkpointed(forms.select("id", F.col("form_id").alias("root_id")))
    while True:
        further = reached.select(F.col("id").alias("root_id"), F.col("root_id").alias("_next"))
        both = checkpointed(reached.join(further, "root_id", "left"))
        if not both.where("_next is not null").limit(1).count():
            return reached
        reached = both.select("id", F.coalesce("_next", "root_id").alias("root_id"))


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n), each word once.

    Two words are near if one inserted, deleted or replaced letter tells them
    apart. A word's form is its near word of largest n, of equal ones the first
    in code-point order, if that n is at least ``ratio`` times its own; root is
    the last form from the word on, itself without one. An empty table gives an
    empty result; null words and counts are left out; words of any length are
    compared whole.
    """
    counted = stored(ranked(words.select("word", F.col("n").cast("long")).dropna(), [], ["word"], "id"))
    near = near_counts(counted)
    own = counted.join(near, "id", "left").withColumn("form_id", F.when(F.col("form_n") >= ratio * F.col("n"), F.col("form_id")))
    own = stored(own.withColumn("form_n", F.when(F.col("form_id").isNotNull(), F.col("form_n"))))
    roots = roots_of(own.where("form_id is not null"))
    named = lambda name: counted.select(F.col("id").alias(f"{name}_id"), F.col("word").alias(name))
    with_form = own.where("form_id is not null").join(named("form"), "form_id").join(roots, "id").join(named("root"), "root_id")
    without = own.where("form_id is null").select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n")
    out = with_form.select("word", "form", "root", "n", "n_near", "form_n").union(without)
    return out.withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("long")))


def spelling_variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of all whole texts; see ``vocabulary`` and ``variants``."""
    words = stored(vocabulary(docs, id_column=id_column, text_column=text_column))
    return variants(words)



def oracle() -> str:
    """DuckDB's twin. Its crc32 is worked out byte by byte from a table that a recursion makes by shifting."""
    shift = "case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end"
    return f"""
    with recursive run as (
      select doc_id, translate(r, '{UPPER}', '{LOWER}') as run, count(*) as times
      from (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[{LETTERS}]+')) as r from documents) where length(r) >= {MIN_LETTERS} group by all),
    line as materialized (select row_number() over () as id, run, times, encode(coalesce(doc_id::varchar, '') || ':' || run) as bytes from run),
    shifted(b, v, k) as (select b, b, 0 from range(256) t(b) union all select b, {shift}, k + 1 from shifted where k < 8),
    entry as materialized (select list(v order by b) as crc from shifted where k = 8),
    summed as (
      select run, times, xor(list_reduce(
          list_prepend(4294967295::bigint, list_transform(range(1, 2 * octet_length(bytes), 2), lambda i: ('0x' || hex(bytes)[i : i + 1])::bigint)),
          lambda a, c: xor(a >> 8, crc[(xor(a, c) & 255) + 1])), 4294967295) as h
      from line, entry),
    word as materialized (
      select word, sum(times)::bigint as n from (
        select case when h % {SLIP} = 0 then run[1 : h % length(run)] || run[h % length(run) + 2 : ] else run end as word, times from summed)
      where length(word) >= {MIN_LETTERS} group by word having sum(times) >= {MIN_COUNT}),
    place as (select word, n, unnest(range(1, length(word) + 1)) as i from word),
    wild as materialized (select word, n, word[1 : i - 1] || '*' || word[i + 1 : ] as k from place),
    less as materialized (select distinct word, n, word[1 : i - 1] || word[i + 1 : ] as k from place),
    near as (
      select a.word, b.word as other, b.n as m from wild a join wild b on a.k = b.k and a.word <> b.word
      union all select l.word, w.word, w.n from less l join word w on l.k = w.word
      union all select w.word, l.word, l.n from less l join word w on l.k = w.word),
    top as (select word, count(*) as n_near, max(m) as m from near group by word),
    first as (select word, n_near, m, min(other) as other from top join near using (word, m) group by all),
    own as materialized (
      select word, n, coalesce(n_near, 0) as n_near, case when m >= {RATIO} * n then other end as form, case when m >= {RATIO} * n then m end as form_n
      from word left join first using (word)),
    chain(word, reached, depth) as (
      select word, word, 0 from own union all select chain.word, own.form, depth + 1 from chain join own on chain.reached = own.word where own.form is not null)
    select o.word, form, root, n, n_near, form_n
    from own o join (select word, arg_max(reached, depth) as root from chain group by word) using (word)"""
