"""N-gram Jaccard join by a token-group matrix.

A document's set holds the hashes of its distinct 5-word shingles (64 bits; two shingles of one
hash count as one). Two documents link when their sets' Jaccard similarity is 3/4 or more:
7 * shared tokens >= 3 * (summed sizes).

1. Documents of equal sets become one row (``sets``) with a number of its own (``sid``), min-hashes,
   and a bitmap of the parity of tokens by hash. The bits in which two bitmaps differ are at most
   the tokens in which the sets differ, and sets of similarity t differ in at most (1 - t) / (1 + t)
   of their summed sizes: an exact bound from some bytes.
2. Similar sets are partitioned into groups: of the neighbours in the order of each min-hash,
   those with the nearest bitmaps are compared exactly, and the components of those links are
   groups, cut into blocks of bounded size. A set without such a link is a group of its own.
3. Which queries look at which groups comes from the first tokens of a global order, so many that
   linked sets must share one. Tokens that many sets share come last in that order, and only a
   token that one side shows as the smaller set can make a pair.
4. For each such pair the union of the group's tokens bounds the overlap of a query with any
   member; only a group whose bound allows a link is opened, and its members are compared
   exactly. Of a query's and a group's components one link is enough, so groups of copies
   never make all their pairs, and every link between different components is found.

The order of tokens changes the work, never the result: its list of common tokens is counted on
one in SAMPLE documents and has at most MOST_COMMON entries.

Null ids take no part in links and have no component. Texts without words have an empty set,
link with nothing and are their own component. Repeated rows are copies of one document, and
rows of one id with different texts have a set each. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlens.llm.common import cut, cut_small, hashes_by_text, in_chunks, mix, window_hashes
from arborlens.llm.components import components

WORDS = 5
BANDS = 4
#: Places apart in the order of a min-hash at which sets are still neighbours.
GAPS = (1, 2, 3)
#: Sets side by side in that order whose tokens one task holds at a time.
RUN = 64
SAMPLE, COMMON, MOST_COMMON = 16, 3, 1 << 18
#: Tokens in a block of a group of several sets, about.
BLOCK_TOKENS = 50_000
#: Tokens of queries that meet a block in one task, about; more are dealt over copies of the block.
QUERY_TOKENS = 200_000
#: Rows whose prefixes a task holds as entries at a time.
ROWS_AT_ONCE = 1000
#: Groups holding one token that a task pairs at once; tokens that are dealt by a broadcast list, at most.
ENTRIES_AT_ONCE, HOT_TOKENS = 20_000, 1000
MOST_BLOOM_BITS = 1 << 27
ODD = np.random.default_rng(11).integers(0, 2**63, BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[str | None], n: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct hashes of the n-word shingles of each text; of the whole sequence if it is shorter."""
    found = []
    for words in hashes_by_text(texts, fold=True):
        s = np.sort(window_hashes(words, min(n, max(len(words), 1))))
        found.append(s[np.append(True, s[1:] != s[:-1])] if len(s) else s)
    return found


def prefix_sizes(n: int) -> tuple[int, int]:
    """How many first tokens a set of n shows to sets of any size, and to sets at least as large."""
    return n - (3 * n + 3) // 4 + 1, n - (6 * n + 6) // 7 + 1


def parity_bits(tokens: np.ndarray) -> bytes:
    """A bitmap of 2 to 4 bits a token, a power of two of at least 64; each bit is the parity of its tokens."""
    size = max(64, 1 << int(2 * len(tokens) - 1).bit_length())
    bits = np.bincount((tokens >> np.uint64(20)).astype(np.int64) & (size - 1), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def differing(a: bytes, b: bytes) -> int:
    """Bits in which two bitmaps differ, the larger folded to the size of the smaller: a lower bound of the tokens in one set only."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    if len(x) > len(y):
        x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def _lists(sets: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array((np.concatenate(sets) if sets else np.empty(0, np.uint64)).view(np.int64)))


def _digests(sets: list[np.ndarray]) -> pa.Array:
    return pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())


def _common_tokens(read: DataFrame) -> np.ndarray:
    """Hashes of tokens that many documents share, sorted."""
    few = read.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in in_chunks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(shingle_sets(texts)).view(np.int64))], names=["t"])

    counted = few.mapInArrow(run, "t long").groupBy("t").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= COMMON)
    top = counted.orderBy(F.desc("c"), "t").limit(MOST_COMMON).select("t").toArrow()
    return np.sort(top.column("t").to_numpy().view(np.uint64))


def _sketch(rows: DataFrame, held: object) -> DataFrame:
    """Per row doc_id, set size, digest, min-hashes and bitmap of its set, and its prefix in the order of tokens with how many of it are shown to larger sets."""
    bands = [f"b{k}" for k in range(BANDS)]
    schema = f"doc_id long, n int, digest binary, {', '.join(f'{b} long' for b in bands)}, bits binary, prefix array<long>, shown int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = held.value
        for part, texts in in_chunks(batches):
            sets = shingle_sets(texts)
            least = np.array([[(s * o).min() for o in ODD] if len(s) else [0] * BANDS for s in sets], np.uint64).view(np.int64)
            prefixes, shown = [], []
            for s in sets:
                p, q = prefix_sizes(len(s)) if len(s) else (0, 0)
                if len(common) and len(s):
                    last = common[np.minimum(np.searchsorted(common, s), len(common) - 1)] == s
                    s = np.concatenate([s[~last], s[last]]) if last.any() else s
                prefixes.append(s[:p])
                shown.append(q)
            columns = [part.column(0), pa.array([len(s) for s in sets], pa.int32()), _digests(sets), *(pa.array(least[:, k]) for k in range(BANDS)), pa.array([parity_bits(s) if len(s) else b"" for s in sets], pa.binary()), _lists(prefixes), pa.array(shown, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "digest", *bands, "bits", "prefix", "shown"])

    return rows.mapInArrow(run, schema)


def _neighbours(sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets that stand near each other in the order of a min-hash that both have and that sizes and bitmaps allow to link.

    With ``apart``, the bits in which they differ over their summed sizes, and ``run``, a number of RUN sets side by side that both are of.
    """
    rows = sets.select("sid", "n", "bits", F.posexplode(F.array(*[f"b{k}" for k in range(BANDS)])).alias("band", "key")).withColumn("h", F.xxhash64("sid", "band"))
    # a range partition on all three, so that a min-hash of many sets is dealt over tasks; pairs over an edge are found by step 3
    ordered = rows.repartitionByRange("key", "band", "h").sortWithinPartitions("key", "band", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sid, n, band, key = (batch.column(c).to_numpy() for c in ("sid", "n", "band", "key"))
            bits = batch.column("bits")
            places = np.arange(len(key))
            first = np.maximum.accumulate(np.where(np.append(True, (key[1:] != key[:-1]) | (band[1:] != band[:-1])), places, 0))
            start = places - (places - first) % RUN
            found = []
            for gap in GAPS:
                at = np.flatnonzero((start[gap:] == start[:-gap]) & (sid[gap:] != sid[:-gap])) if len(key) > gap else np.empty(0, np.int64)
                at = at[4 * np.minimum(n[at], n[at + gap]) >= 3 * np.maximum(n[at], n[at + gap])]
                found.append((at, at + gap))
            a, b = (np.concatenate([f[i] for f in found]) for i in range(2))
            both = n[a].astype(np.int64) + n[b]
            d = np.fromiter((differing(bits[i].as_py(), bits[j].as_py()) for i, j in zip(a.tolist(), b.tolist(), strict=True)), np.int64, len(a))
            few = 7 * d <= both
            x, y, at = sid[a[few]], sid[b[few]], start[a[few]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(d[few] / both[few]), pa.array(sid[at] * BANDS + band[at])], names=["a", "b", "apart", "run"])

    return ordered.select("sid", "n", "bits", "band", "key").mapInArrow(run, "a long, b long, apart double, run long")


def _nearest(near: DataFrame) -> DataFrame:
    """Of each set's neighbours (2 * BANDS * len(GAPS) at most) the two nearest: distinct pairs (a, b) with a run."""
    once = near.groupBy("a", "b").agg(F.min("apart").alias("apart"), F.min("run").alias("run"))
    ends = once.select(F.explode(F.array("a", "b")).alias("x"), F.struct("apart", "a", "b", "run").alias("p"))
    two = ends.groupBy("x").agg(F.slice(F.array_sort(F.collect_list("p")), 1, 2).alias("p"))
    return two.select(F.explode("p").alias("p")).select("p.a", "p.b", "p.run").distinct()


def _bounded(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and bitmaps allow to link, with their sizes n_a and n_b."""
    side = lambda x: sets.select(F.col("sid").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b").where("4 * least(n_a, n_b) >= 3 * greatest(n_a, n_b)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n_a").to_numpy().astype(np.int64) + batch.column("n_b").to_numpy()
            d = np.fromiter(map(differing, batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist()), np.int64, len(n))
            yield batch.select(["a", "b"]).filter(pa.array(7 * d <= n))

    return sized.mapInArrow(run, "a long, b long")


def _bloom(ids: DataFrame) -> np.ndarray:
    """A filter of the ids (column id) of at most MOST_BLOOM_BITS: larger sets of ids let more others through, which a join drops. Twice its size reaches the driver."""
    n = ids.count()
    size = min(MOST_BLOOM_BITS, 1 << max(10, int(16 * n).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(size // 32, np.uint32)
        for batch in batches:
            for p in _places(batch.column(0).to_numpy(), size):
                np.bitwise_or.at(words, p >> 5, np.uint32(1) << (p & 31).astype(np.uint32))
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(words[at].view(np.int32))], names=["w", "v"])

    rows = ids.select("id").mapInArrow(run, "w int, v int").groupBy("w").agg(F.bit_or("v").alias("v")).toArrow()
    bits = np.zeros(size // 32, np.uint32)
    bits[rows.column("w").to_numpy()] = rows.column("v").to_numpy().view(np.uint32)
    return bits


def _places(ids: np.ndarray, size: int) -> list[np.ndarray]:
    h = mix(ids.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return [((h >> np.uint64(k * 16)) ^ (h << np.uint64(k))).astype(np.int64) & (size - 1) for k in range(4)]


def _holds(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether the filter lets each id through."""
    hit = np.ones(len(ids), bool)
    for p in _places(ids, len(bits) * 32):
        hit &= (bits[p >> 5] >> (p & 31).astype(np.uint32)) & 1 == 1
    return hit


def _sent(read: DataFrame, wanted: DataFrame, sets: DataFrame, keys: list[str], run: Callable, schema: str) -> DataFrame:
    """run over the wanted rows (sid, keys, what else they have) with the tokens of their sets, in the order of keys, each key in one task; rows without sid have null tokens. The outcome is written.

    Only the wanted documents' tokens leave the scan; they move twice, to meet what is wanted of them and to their keys.
    """
    rows = cut_small(wanted.join(sets.select("sid", "digest", "label"), "sid", "left"))
    labels = rows.where("sid is not null").select(F.col("label").alias("id")).distinct()
    held = read.sparkSession.sparkContext.broadcast(_bloom(labels))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value
        for batch in batches:
            for _, texts in in_chunks([batch.filter(pa.array(_holds(bits, batch.column(0).to_numpy())))]):
                made = shingle_sets(texts)
                yield pa.RecordBatch.from_arrays([_digests(made), _lists(made)], names=["digest", "tokens"])

    # one row for each set before the join: an id may be repeated over many rows
    found = read.mapInArrow(scan, "digest binary, tokens array<long>").groupBy("digest").agg(F.first("tokens").alias("tokens"))
    met = rows.where("sid is not null").join(found, "digest").drop("digest", "label").unionByName(rows.where("sid is null").drop("digest", "label").withColumn("tokens", F.lit(None).cast("array<long>")))
    out = cut_small(met.repartition(*keys[:-1]).sortWithinPartitions(*keys).mapInArrow(run, schema))
    held.destroy()
    return out


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Tokens in both of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) that link; of each run first the sets, then the pairs."""
    run, sets = None, {}
    for batch in batches:
        found = []
        tokens = batch.column("tokens")
        for i, (at, sid, a, b) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("run", "sid", "a", "b")), strict=True)):
            if at != run:
                run, sets = at, {}
            if sid is not None:
                sets[sid] = tokens[i].values.to_numpy().view(np.uint64)
            elif 7 * _shared(sets[a], sets[b]) >= 3 * (len(sets[a]) + len(sets[b])):
                found.append((a, b))
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(2)], names=["a", "b"])


def _linked_neighbours(near: DataFrame, sets: DataFrame, read: DataFrame) -> DataFrame:
    """Of the pairs (a, b, run) those that link."""
    none = F.lit(None).cast("long")
    ends = near.select("run", F.explode(F.array("a", "b")).alias("sid")).distinct().select("sid", "run", none.alias("a"), none.alias("b"), F.lit(0).alias("role"))
    wanted = ends.unionByName(near.select(none.alias("sid"), "run", "a", "b", F.lit(1).alias("role")))
    return _sent(read, wanted, sets, ["run", "role"], _verify, "a long, b long")


def _grouped(sets: DataFrame, linked: DataFrame) -> DataFrame:
    """sets with comp, the component that a set is in, and blk, its block of that, or -1 for a set alone."""
    members = sets.select("sid", "n").join(linked.withColumnRenamed("node", "sid"), "sid")
    blocks = members.groupBy("component").agg(F.ceil(F.sum("n") / F.lit(BLOCK_TOKENS)).alias("blocks"))
    placed = members.join(blocks, "component").select("sid", F.col("component").alias("comp"), F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int").alias("blk"))
    return sets.join(placed, "sid", "left").withColumns({"comp": F.coalesce("comp", "sid"), "blk": F.coalesce("blk", F.lit(-1))})


def _entries(groups: DataFrame, held: object | None = None) -> DataFrame:
    """The rows (token, comp, blk, lo, hi, shown) of prefixes; held: a filter that drops tokens which aren't in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value if held is not None else None
        for batch in (b.slice(i, ROWS_AT_ONCE) for b in batches for i in range(0, len(b), ROWS_AT_ONCE)):
            prefix = batch.column("prefix")
            sizes = np.diff(prefix.offsets.to_numpy())
            token, row = prefix.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)
            shown = np.arange(len(token)) - np.repeat(np.cumsum(sizes) - sizes, sizes) < batch.column("shown").to_numpy()[row]
            if bits is not None:
                hit = _holds(bits, token)
                token, row, shown = token[hit], row[hit], shown[hit]
            columns = [pa.array(token), *(batch.column(c).take(pa.array(row)) for c in ("comp", "blk", "n", "n")), pa.array(shown)]
            yield pa.RecordBatch.from_arrays(columns, names=["token", "comp", "blk", "lo", "hi", "shown"])

    each = groups.select("comp", "blk", "n", "shown", "prefix").mapInArrow(run, "token long, comp long, blk int, lo int, hi int, shown boolean")
    # pre-aggregated where a group has several members, so that a token of many copies is few rows
    many = each.where("blk >= 0").groupBy("token", "comp", "blk").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("shown").alias("shown"))
    return each.where("blk < 0").unionByName(many)


def _looked_at(groups: DataFrame) -> DataFrame:
    """Pairs of groups (comp, blk | comp2, blk2) of different components that share a token which linked sets of theirs could share first."""
    # tokens of one component, and those that none shows, make no pairs: counted by partial sums, however many groups hold a token
    flag = F.lit(1).cast("long") + F.shiftleft(F.col("shown").cast("long"), 40)
    entries = _entries(groups)
    by_comp = entries.where("blk < 0").select("token", "shown").unionByName(entries.where("blk >= 0").groupBy("token", "comp").agg(F.max("shown").alias("shown")).select("token", "shown"))
    used = by_comp.groupBy("token").agg(F.sum(flag).alias("s")).select("token", F.expr("s & 1099511627775").alias("c"), (F.shiftright("s", 40) > 0).alias("any")).where("any and c > 1")
    used = cut_small(used.select("token", "c", F.ceil(F.col("c") / ENTRIES_AT_ONCE).alias("parts")))
    held = groups.sparkSession.sparkContext.broadcast(_bloom(used.select(F.col("token").alias("id"))))
    # those of over a thousandth of the entries, so a thousand rows at most
    hot = F.broadcast(used.where(F.col("c") > max(ENTRIES_AT_ONCE, (used.agg(F.sum("c")).first()[0] or 0) / HOT_TOKENS)).select("token", F.col("parts").alias("hot")))
    known = _entries(groups, held).join(hot, "token", "left")
    kept = cut_small(known.where("hot is null").drop("hot").join(used.select("token", "parts"), "token").unionByName(known.where("hot is not null").withColumnRenamed("hot", "parts")))
    held.destroy()
    # those that show the token meet all that hold it, in as many parts as these need
    smaller = kept.where("shown").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts", "shown")
    larger = kept.select("token", F.pmod(F.xxhash64("comp", "blk"), F.col("parts")).alias("part"), *[F.col(c).alias(f"{c}2") for c in ("comp", "blk", "lo", "hi")])
    fits = smaller.join(larger, ["token", "part"]).where("comp <> comp2 and lo <= hi2 and 4 * hi >= 3 * lo2")
    ends = F.array_sort(F.array(F.struct("comp", "blk"), F.struct(F.col("comp2").alias("comp"), F.col("blk2").alias("blk"))))
    return fits.select(ends.alias("e")).distinct().select(*[F.col("e")[k][c].alias(f"{c}{x}") for k, x in enumerate(("", "2")) for c in ("comp", "blk")])


class _Block:
    """The members of a block of a group, and the union of their tokens."""

    def __init__(self, comp: int, members: list[np.ndarray]) -> None:
        self.comp, self.found = comp, set()
        self.sizes = np.array([len(m) for m in members])
        self.union, self.place = np.unique(np.concatenate(members), return_inverse=True)
        self.owner, self.least = np.repeat(np.arange(len(members)), self.sizes), int(self.sizes.min())

    def links(self, q: np.ndarray) -> bool:
        """Whether a member links with the query. It is opened only if the overlap of query and union, which no member's exceeds, allows that."""
        at = np.minimum(np.searchsorted(self.union, q), len(self.union) - 1)
        at = at[self.union[at] == q]
        if 4 * len(at) < 3 * len(q) or 7 * len(at) < 3 * (len(q) + self.least):
            return False
        mine = np.zeros(len(self.union), bool)
        mine[at] = True
        shared = np.bincount(self.owner[mine[self.place]], minlength=len(self.sizes))
        return bool((7 * shared >= 3 * (len(q) + self.sizes)).any())


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of queries' components with those of the blocks that they meet; of each key first the members, then the queries, of which a task holds one at a time."""
    key, members, block = None, [], None
    for batch in batches:
        found = []
        tokens = batch.column("tokens")
        for i, (*at, role, comp) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("gc", "gb", "copy", "role", "comp")), strict=True)):
            if at != key:
                key, members, block = at, [], None
            own = tokens[i].values.to_numpy().view(np.uint64)
            if role == 0:
                members.append(own)
                continue
            block = block or _Block(at[0], members)
            if comp not in block.found and block.links(own):
                block.found.add(comp)
                found.append((comp, block.comp))
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(2)], names=["a", "b"])


def _links(pairs: DataFrame, groups: DataFrame, read: DataFrame) -> DataFrame:
    """Links (a, b) between the components of pairs of groups: some link of any two components that have one.

    Pairs of single sets pass the bound by bitmaps first. A group's block meets its queries, the
    members of the other group, in a task; many queries are dealt over copies of the block.
    """
    single = _bounded(pairs.where("blk < 0 and blk2 < 0").select(F.col("comp").alias("a"), F.col("comp2").alias("b")), groups)
    alone = F.lit(-1).alias
    pick = lambda yes, no: F.when(F.col("blk2") >= 0, F.col(yes)).otherwise(F.col(no))
    many = pairs.where("blk >= 0 or blk2 >= 0").select(pick("comp", "comp2").alias("comp"), pick("blk", "blk2").alias("blk"), pick("comp2", "comp").alias("gc"), pick("blk2", "blk").alias("gb"))
    met = many.unionByName(single.select(F.col("b").alias("comp"), alone("blk"), F.col("a").alias("gc"), alone("gb")))
    members = groups.select("comp", "blk", "sid", "n")
    queries = cut_small(met.join(members, ["comp", "blk"]).select("gc", "gb", "sid", "n", "comp"))
    copies = queries.groupBy("gc", "gb").agg(F.ceil(F.sum("n") / F.lit(QUERY_TOKENS)).alias("copies"))
    asked = queries.join(copies, ["gc", "gb"]).select("sid", "gc", "gb", F.pmod(F.xxhash64("sid"), F.col("copies")).alias("copy"), F.lit(1).alias("role"), "comp")
    blocks = copies.join(members, (F.col("gc") == F.col("comp")) & (F.col("gb") == F.col("blk"))).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    wanted = asked.unionByName(blocks.select("sid", "gc", "gb", "copy", F.lit(0).alias("role"), F.col("gc").alias("comp")))
    return _sent(read, wanted, groups, ["gc", "gb", "copy", "role"], _open, "a long, b long")


def join(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of docs: doc_id, n_shingles, component_id (the least id reachable over links, itself included)."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    read = rows.where("doc_id is not null and text is not null")
    held = docs.sparkSession.sparkContext.broadcast(_common_tokens(read))
    sketched = cut(_sketch(rows, held))
    held.destroy()
    firsts = [F.first(c).alias(c) for c in sketched.columns if c not in ("doc_id", "digest")]
    distinct = sketched.where("n > 0 and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("label"), *firsts)
    # numbered while they are written, so the numbers stay
    sets = cut(distinct.withColumn("sid", F.monotonically_increasing_id()))

    # groups of similar sets
    linked = components(_linked_neighbours(cut_small(_nearest(_neighbours(sets))), sets, read))
    groups = cut(_grouped(sets.drop(*[f"b{k}" for k in range(BANDS)]), linked))

    # open the groups that qualify
    joined = components(_links(cut_small(_looked_at(groups)), groups, read))
    of = groups.select("digest", "label", "comp").join(joined.withColumnsRenamed({"node": "comp"}), "comp", "left").select("digest", "label", F.coalesce("component", "comp").alias("root"))
    of = cut_small(of)
    named = of.select("digest", "root").join(of.groupBy("root").agg(F.min("label").alias("component_id")), "root").select("digest", "component_id")
    done = sketched.select("doc_id", "n", F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("digest")).alias("digest")).join(named, "digest", "left")
    return done.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
