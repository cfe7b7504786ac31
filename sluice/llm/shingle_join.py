"""N-gram Jaccard join by T-occurrence search.

A document is the set of its word shingles, as 64-bit hashes; two documents
link when their Jaccard similarity reaches a percentage, and groups are what
links reach. Equal sets are collapsed first. Then the search goes from coarse
to fine, and every step keeps every link:

1. All sets are ordered alike, common shingles last. How common they are is
   known from a table of fixed size that counts the shingles of all documents
   by hash; what many documents share (a passage, a licence) stands out in it.
2. Two sets that overlap in T elements share at least t of their first
   (size - T + t) elements. Only these extended prefixes are indexed. A pair
   counts as a candidate if it shares t elements there, and if sizes and the
   places of what it shares leave room for T. Of lists of more than LONG_LIST
   entries no pairs are formed, as in DivideSkip: with h of them among a
   document's prefix, t - h common elements, one at least, remain to be found
   in the others. Only documents with t or more of them can share nothing
   else; those are candidates of the first such document on each such list.
3. What candidates reach is a cluster. Clusters are searched by DivideSkip on
   whole sets: a query merges its short inverted lists on a heap, skipping
   ahead by the overlap it needs from them, and probes the long ones by binary
   search.
4. A search only has to find which documents hang together: documents of one
   group need no query of their own if all others are queried. Those of the
   largest group so far are put off, and queried in the end unless they are in
   the one group that holds most of them. Spanning edges are what goes on.
5. A cluster of many shingles is cut into blocks, each searched on its own
   with some documents that all blocks get. Then the documents outside the
   cluster's largest group so far, few in a group of copies, are searched
   against all blocks of that group and among themselves. So copies go to one
   task each, however many there are, and no pair is left out.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.llm.batches import SLICE_ROWS, Kernel, map_slices
from sluice.llm.components import components
from sluice.session import checkpointed, ship

#: Lists of up to so many entries are compared pair by pair.
LONG_LIST = 256
#: Common elements asked for in prefixes: at least so many, and this part of the elements that a set may miss.
FEW, PART = 4, 4
#: A shingle is hot if its bucket counts so many more than twice the average; the lists of these, which are long, are dealt over SALTS tasks.
HOT, SALTS = 4_096, 16
#: Shingles in a block of a cluster, and documents of a cluster that go to all its blocks, on average.
BLOCK_SHINGLES, SEEDS = 500_000, 32
#: Words a task keeps hashed before it starts afresh; bounds memory, not results.
MAX_WORDS = 200_000
#: Ids of documents in clusters that are sent to every task; more are joined.
BROADCAST_IDS = 500_000
#: DivideSkip's weight of a probe against a step of the heap.
PROBE = 0.01
#: Short lists of more entries than this together are merged by counting.
HEAP_ENTRIES = 3_000
#: Hash buckets in which shingles are counted, the parts in which tasks send their counts, and the tasks that first add up a part.
BUCKETS, PARTS, BINS = 1 << 20, 1 << 8, 16
#: Parts of a group of equal sets.
COPY_BINS = 64

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Runs of other than ASCII white space, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class WordHashes:
    """64-bit hashes of words, those met lately kept."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if len(known) > MAX_WORDS:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Of hashed words, the hash of every run of ``width`` of them, or of all if they are fewer."""
    width = min(width, len(words))
    n = len(words) - width + 1
    mixed = np.full(n, width, np.uint64)
    for k in range(width):
        mixed = (mixed ^ words[k : k + n]) * _MULTIPLIER
        mixed ^= mixed >> np.uint64(29)
    return mixed


def shingle_counts(docs: DataFrame, width: int, text_column: str) -> np.ndarray:
    """How many shingles of all documents fall in each of BUCKETS hash buckets.

    A task counts in a table of that size and sends it in PARTS parts. These
    are added up as they stream by, in two steps, the first of which deals a
    part's tables over BINS tasks. Only the sums come to the driver.
    """
    ship(docs.sparkSession)
    step = BUCKETS // PARTS

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts, some = WordHashes(), np.zeros(BUCKETS, np.int64), False
        for batch in source:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                found = [shingle_hashes(hashes(w), width) for t in batch.column(0).slice(start, SLICE_ROWS).to_pylist() if (w := words_of(t))]
                if found:
                    some = True
                    counts += np.bincount((np.concatenate(found) & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
        if some:
            yield pa.RecordBatch.from_pydict({"part": pa.array(range(PARTS), pa.int32()), "counts": [part.tobytes() for part in counts.reshape(PARTS, step).astype("<u4")]})

    def add(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in source:
            for part, packed in zip(batch.column("part").to_pylist(), batch.column("counts")):
                total.setdefault(part, np.zeros(step, np.int64))
                total[part] += np.frombuffer(packed.as_buffer(), "<u4")
        if total:
            packed = [np.minimum(t, (1 << 32) - 1).astype("<u4").tobytes() for t in total.values()]
            yield pa.RecordBatch.from_pydict({"part": pa.array(total, pa.int32()), "counts": packed})

    ddl = "part int, counts binary"
    sent = docs.select(text_column).mapInArrow(run, ddl).withColumn("bin", F.spark_partition_id() % BINS)
    sums = sent.repartition("part", "bin").select("part", "counts").mapInArrow(add, ddl).repartition("part").mapInArrow(add, ddl)
    table = np.zeros((PARTS, step), np.int64)
    for r in sums.collect():
        table[r["part"]] += np.frombuffer(r["counts"], "<u4")
    return table.reshape(-1)


def levels_of(counts: np.ndarray) -> np.ndarray:
    """The place of each bucket's shingles in the order of all, 0 to 127: by half octaves above the average; from 64 on they are hot."""
    mean = max(1.0, counts.mean())
    level = np.clip(2 * np.log2(np.maximum(counts, 1) / mean), 0, 63)
    return (level + np.where(counts > 2 * mean + HOT, 64, 0)).astype(np.uint8)


class Shingler:
    """Sets of word shingles as 64-bit numbers in the order in which they are indexed.

    The upper bits are the shingle's level, the others its hash: what many texts
    share comes last.
    """

    def __init__(self, width: int, levels: np.ndarray):
        self.width, self.levels = width, levels
        self.hashes = WordHashes()

    def __call__(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        if not words:
            return np.zeros(0, np.uint64)
        mixed = shingle_hashes(self.hashes(words), self.width)
        level = self.levels[(mixed & np.uint64(BUCKETS - 1)).astype(np.int64)].astype(np.uint64)
        return np.unique(level << np.uint64(57) | mixed >> np.uint64(7))


def overlap(size: int, percent: int) -> int:
    """The least overlap with any partner: percent of the size, rounded up."""
    return -(-size * percent // 100)


def extra(size: int, percent: int) -> int:
    """How many common elements the extended prefix of a set of this size is to hold. Never less for a larger set."""
    least = overlap(size, percent)
    return max(1 + (size - least) // PART, min(least, FEW))


def prefix_length(size: int, percent: int) -> int:
    return size - overlap(size, percent) + extra(size, percent)


def _overlap(size: Column, percent: int) -> Column:
    return F.floor((size * percent + 99) / 100)


def _extra(size: Column, percent: int) -> Column:
    least = _overlap(size, percent)
    return F.greatest(1 + F.floor((size - least) / PART), F.least(least, F.lit(FEW)))


def sets(docs: DataFrame, width: int, percent: int, levels: np.ndarray, id_column: str, text_column: str) -> DataFrame:
    """(id, n_shingles, signature, prefix): of every whole text its set's size, 128-bit digest and prefix."""

    def make() -> Kernel:
        shingler = Shingler(width, levels)

        def kernel(batch: pa.RecordBatch) -> dict:
            found = [shingler(t) for t in batch.column(text_column).to_pylist()]
            return {
                "id": batch.column(id_column),
                "n_shingles": [len(s) for s in found],
                "signature": [xxhash.xxh3_128_digest(s.tobytes()) for s in found],
                "prefix": [s[: prefix_length(len(s), percent)].view(np.int64) for s in found],
            }

        return kernel

    kind = dict(docs.dtypes)[id_column]
    return map_slices(docs.select(id_column, text_column), make, f"id {kind}, n_shingles bigint, signature binary, prefix array<bigint>", 256)


def with_first(found: DataFrame) -> DataFrame:
    """The sets with ``rep``, the smallest id of equal ones. Equal sets are dealt into bins, so none of the steps gathers a large group of them."""
    key = ["signature", "n_shingles"]
    dealt = found.select("id", *key, F.pmod(F.xxhash64("id"), F.lit(COPY_BINS)).alias("bin"))
    bins = dealt.groupBy(*key, "bin").agg(F.min("id").alias("least"))
    first = bins.groupBy(*key).agg(F.min("least").alias("rep"))
    return dealt.join(bins.drop("least").join(first, key), [*key, "bin"]).drop("bin")


def candidates(reps: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of sets such that all that link hang together by them."""
    entries = reps.select("id", "n_shingles", F.posexplode("prefix").alias("place", "shingle"))
    entries = entries.select("shingle", "id", F.shiftleft("n_shingles", 32).bitwiseOR(F.col("place").cast("long")).alias("sized"))
    # hot shingles are negative; the list of another one has no more entries than its bucket counts
    hot = entries.where("shingle < 0").select("shingle", "id", F.shiftright("sized", 32).alias("n"))
    shared = entries.where("shingle >= 0").withColumn("on", F.count(F.lit(1)).over(Window.partitionBy("shingle"))).where("on > 1")
    shared = checkpointed(shared.select("shingle", "id", F.shiftright("sized", 32).alias("n"), F.col("sized").bitwiseAND(F.lit((1 << 32) - 1)).alias("place"), "on"))
    long = checkpointed(hot.union(shared.where(F.col("on") > LONG_LIST).select("shingle", "id", "n")))
    longs = long.groupBy("id").agg(F.count(F.lit(1)).alias("longs"), F.min("n").alias("n"))
    # by shorter lists: pairs with enough in common
    short = shared.where(F.col("on") <= LONG_LIST)
    x, y = short.alias("x"), short.alias("y")
    sizes = F.col("x.n") + F.col("y.n")
    close = (F.col("x.n") * 100 >= F.col("y.n") * percent) & (F.col("y.n") * 100 >= F.col("x.n") * percent)
    room = F.least("x.place", "y.place") + F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    met = (
        x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.id") < F.col("y.id")) & close & (room * (100 + percent) >= sizes * percent))
        .groupBy(F.col("y.id").alias("a"), F.col("x.id").alias("b"))
        .agg(F.count(F.lit(1)).alias("common"), F.min(F.least("x.n", "y.n")).alias("n"))
    )
    held = longs.select("id", "longs")
    met = met.join(held.select(F.col("id").alias("a"), F.col("longs").alias("longs_a")), "a", "left").join(held.select(F.col("id").alias("b"), F.col("longs").alias("longs_b")), "b", "left")
    unseen = F.least(F.coalesce("longs_a", F.lit(0)), F.coalesce("longs_b", F.lit(0)))
    pairs = met.where(F.col("common") >= F.greatest(F.lit(1), _extra(F.col("n"), percent) - unseen)).select("a", "b")
    # by long lists: those that may share nothing else
    heavy = longs.where(F.col("longs") >= _extra(_overlap(F.col("n"), percent), percent)).select("id")
    crowd = long.join(heavy, "id").select("shingle", "id", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt"))
    hubs = crowd.groupBy("shingle").agg(F.min("id").alias("hub")).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    starred = crowd.join(hubs, ["shingle", "salt"]).where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b"))
    return pairs.union(starred.distinct())


class Cell:
    """Some documents and the inverted lists of their shingles."""

    def __init__(self, found: list[np.ndarray], percent: int):
        self.sets, self.percent = found, percent
        self.sizes = np.array([len(s) for s in found], np.int64)
        flat = np.concatenate(found)
        order = np.argsort(flat, kind="stable")
        flat, self.owner = flat[order], np.repeat(np.arange(len(found)), self.sizes)[order]
        starts = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
        self.keys, self.starts, self.lengths = flat[starts], starts, np.diff(np.r_[starts, len(flat)])

    def merged(self, lists: list[np.ndarray], enough: int) -> tuple[np.ndarray, np.ndarray]:
        """The documents on at least so many lists, ascending, and on how many: on a heap, or by counting where the lists are dense."""
        if sum(map(len, lists)) > HEAP_ENTRIES:
            counts = np.bincount(np.concatenate(lists), minlength=len(self.sets))
            found = np.flatnonzero(counts >= enough)
            return found, counts[found]
        rows = [p.tolist() for p in lists]
        heap = [(p[0], k, 0) for k, p in enumerate(rows)]
        heapq.heapify(heap)
        found, counts = [], []
        while len(heap) >= enough:
            y, taken = heap[0][0], []
            while heap and heap[0][0] == y:
                taken.append(heapq.heappop(heap))
            if len(taken) >= enough:
                found.append(y)
                counts.append(len(taken))
                ahead = y + 1
            else:
                # fewer lists than it takes are here: none before the next document of the rest can be on enough
                while heap and len(taken) < enough - 1:
                    taken.append(heapq.heappop(heap))
                if not heap:
                    break
                ahead = heap[0][0]
            for _, k, at in taken:
                at = bisect_left(rows[k], ahead, at)
                if at < len(rows[k]):
                    heapq.heappush(heap, (rows[k][at], k, at))
        return np.array(found, np.int64), np.array(counts, np.int64)

    def partners(self, x: int, skip: np.ndarray) -> np.ndarray:
        """The documents linked with x, leaving out those that ``skip`` marks, by DivideSkip."""
        at = np.searchsorted(self.keys, self.sets[x])
        lengths = self.lengths[at]
        at, lengths = at[lengths > 1], lengths[lengths > 1]
        least = overlap(len(self.sets[x]), self.percent)
        if len(at) < least:
            return np.zeros(0, np.int64)
        order = np.argsort(lengths, kind="stable")
        at, lengths = at[order], lengths[order]
        lists = [self.owner[a : a + n] for a, n in zip(self.starts[at].tolist(), lengths.tolist())]
        several = min(least - 1, int(least / (PROBE * math.log2(1 + int(lengths[-1])) + 1)))
        short, long = lists[: len(lists) - several], lists[len(lists) - several :]
        found, common = self.merged(short, least - several)
        fine = ~skip[found] & (found != x)
        found, common = found[fine], common[fine]
        for k, p in enumerate(long):
            if not len(found):
                break
            place = np.searchsorted(p, found)
            common = common + (p[np.minimum(place, len(p) - 1)] == found)
            fine = common + (len(long) - k - 1) >= least
            if not fine.all():
                found, common = found[fine], common[fine]
        union = len(self.sets[x]) + self.sizes[found] - common
        return found[(common >= least) & (100 * common >= self.percent * union)]

    def groups(self, asked: np.ndarray | None = None) -> list[int]:
        """Of each document the first of its group. All documents without a query of their own are in one group.

        With ``asked``, only the documents that it marks are queried.
        """
        group, size = np.arange(len(self.sets)), np.ones(len(self.sets), np.int64)
        largest, put_off = 0, []

        def query(x: int) -> None:
            nonlocal largest
            for y in self.partners(x, group == group[x]).tolist():
                low, high = sorted((int(group[x]), int(group[y])))
                if low != high:
                    group[group == high] = low
                    size[low] += size[high]
            if size[group[x]] > size[group[largest]]:
                largest = x

        for x in range(len(self.sets)) if asked is None else np.flatnonzero(asked).tolist():
            if asked is None and x and group[x] == group[largest]:
                put_off.append(x)
            else:
                query(x)
        if put_off:
            # a link between two that were put off while different groups were the largest is still to be found
            seed = put_off[int(np.argmax(np.bincount(group[put_off])[group[put_off]]))]
            for x in put_off:
                if group[x] != group[seed]:
                    query(x)
        return group.tolist()


def searched(texts: DataFrame, width: int, percent: int, levels: np.ndarray) -> DataFrame:
    """(a, b): spanning edges of what the links within each cell connect. Of (_id, _text, asked, cell...), queries are the
    rows that are asked, or all if none is."""
    cell = [c for c in texts.columns if c not in ("_id", "_text", "asked")]
    kind = dict(texts.dtypes)["_id"]

    def search(table: pa.Table) -> pa.Table:
        ids = table.column("_id").to_pylist()
        rows = sorted(range(len(ids)), key=ids.__getitem__)
        shingler = Shingler(width, levels)
        said = table.column("_text").to_pylist()
        asked = table.column("asked").to_numpy(zero_copy_only=False).astype(bool)[rows]
        groups = Cell([shingler(said[r]) for r in rows], percent).groups(asked if asked.any() else None) if rows else []
        edges = [(ids[rows[k]], ids[rows[g]]) for k, g in enumerate(groups) if k != g]
        like = table.schema.field("_id").type
        return pa.table({"a": pa.array([a for a, _ in edges], like), "b": pa.array([b for _, b in edges], like)})

    return texts.groupBy(*cell).applyInArrow(search, f"a {kind}, b {kind}")


def _hashed(parts: str, salt: int = 0):
    return F.pmod(F.xxhash64("_id", F.lit(salt)), F.col(parts)).cast("int")


def _blocks(shingles):
    return F.greatest(F.lit(1), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")


def links(docs: DataFrame, places: DataFrame, width: int, percent: int, levels: np.ndarray, id_column: str, text_column: str) -> DataFrame:
    """(a, b): edges that connect what the links within each cluster connect. ``places`` has (_id, cluster, n)."""

    def with_texts(placed: DataFrame) -> DataFrame:
        few = placed.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
        return docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text")).join(F.broadcast(placed) if few else placed, "_id")

    def cells(*names: str) -> list[str]:
        return ["_id", "_text", "asked", *names]

    sizes = places.groupBy("cluster").agg(_blocks(F.sum("n")).alias("blocks"), F.count(F.lit(1)).alias("docs"))
    placed = checkpointed(places.join(sizes, "cluster"))
    seed = (F.col("blocks") > 1) & (F.pmod(F.xxhash64("_id", F.lit(1)), F.greatest(F.lit(1), F.floor(F.col("docs") / SEEDS))) == 0)
    blocks = F.when(seed, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(_hashed("blocks")))
    whole = with_texts(placed.select("_id", "cluster", blocks.alias("blocks")))
    found = searched(whole.withColumn("block", F.explode("blocks")).withColumn("asked", F.lit(False)).select(*cells("cluster", "block")), width, percent, levels)
    several = checkpointed(placed.where("blocks > 1").select("_id", "cluster", "n"))
    if not several.limit(1).count():
        return found
    # what is outside a cluster's largest group: against that group's blocks, and among itself
    found = checkpointed(found)
    groups = components(found.join(several.select(F.col("_id").alias("a")), "a", "left_semi"))
    grouped = checkpointed(several.join(groups.withColumnRenamed("id", "_id"), "_id", "left").withColumn("part", F.coalesce("component_id", "_id")).drop("component_id"))
    largest = grouped.groupBy("cluster", "part").agg(F.count(F.lit(1)).alias("docs")).groupBy("cluster").agg(F.max_by("part", F.struct("docs", -F.col("part"))).alias("main"))
    sided = grouped.join(F.broadcast(largest), "cluster").withColumn("out", F.col("part") != F.col("main"))
    counts = sided.groupBy("cluster").agg(_blocks(F.sum(F.when(~F.col("out"), F.col("n")))).alias("inner"), _blocks(F.sum(F.when(F.col("out"), F.col("n")))).alias("outer"), F.max("out").alias("some"))
    dealt = sided.join(F.broadcast(counts.where("some").drop("some")), "cluster").withColumn("own", F.when(F.col("out"), _hashed("outer", 2)).otherwise(_hashed("inner", 2)))
    inner, outer = F.sequence(F.lit(0), F.col("inner") - 1), F.sequence(F.lit(0), F.col("outer") - 1)
    cell = lambda kind, low, high: F.struct(F.lit(kind).alias("kind"), low.alias("low"), high.alias("high"))
    mixed = F.when(F.col("out"), F.transform(inner, lambda k: cell("across", k, F.col("own")))).otherwise(F.transform(outer, lambda k: cell("across", F.col("own"), k)))
    among = F.when(F.col("out"), F.transform(outer, lambda k: cell("among", F.least(F.col("own"), k), F.greatest(F.col("own"), k)))).otherwise(F.array().cast("array<struct<kind:string,low:int,high:int>>"))
    again = with_texts(dealt.select("_id", "cluster", "out", F.concat(mixed, among).alias("cells")))
    rest = again.select("_id", "_text", "cluster", "out", F.explode("cells").alias("cell")).select("_id", "_text", "cluster", "out", "cell.*")
    more = searched(rest.withColumn("asked", F.col("out") & (F.col("kind") == "across")).select(*cells("cluster", "kind", "low", "high")), width, percent, levels)
    return found.union(more)


def jaccard_groups(docs: DataFrame, width: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every document.

    n_shingles is the size of the document's set; component_id the smallest id
    that links reach, its own included. Documents of fewer words than a shingle
    have the whole sequence as one; those without words, or with a null text,
    have none and link with nothing. Rows with one id are compared as separate
    texts and share a component if they link; rows with a null id link with
    nothing and have no component.
    """
    levels = levels_of(shingle_counts(docs, width, text_column))
    found = checkpointed(sets(docs, width, percent, levels, id_column, text_column))
    able = found.where("id is not null and n_shingles > 0")
    members = checkpointed(with_first(able))
    # of equal sets, the first one's row
    reps = able.join(members.where("id = rep").select("id", "signature").distinct(), ["id", "signature"], "left_semi").dropDuplicates(["id", "signature"])
    clusters = components(candidates(reps, percent))
    sizes = reps.groupBy("id").agg(F.sum("n_shingles").alias("n"))
    places = clusters.join(sizes, "id").select(F.col("id").alias("_id"), F.col("component_id").alias("cluster"), "n")
    groups = components(links(docs.where(F.col(id_column).isNotNull()), places, width, percent, levels, id_column, text_column))
    linked = members.join(groups.withColumnRenamed("id", "rep"), "rep", "left").select("id", "n_shingles", F.coalesce("component_id", "rep").alias("component_id"))
    alone = found.where("id is null or n_shingles = 0").select("id", "n_shingles", F.col("id").alias("component_id"))
    return linked.union(alone).withColumnRenamed("id", id_column)
