"""Documents linked by the Jaccard similarity of their word shingles: an exact prefix-filter join.

Shingles are ordered rare first.  Two sets that reach the threshold t must share one of the first
|x| - ceil(t |x|) + 1 shingles of each, their sizes must lie within t of each other (length filter),
and the places of a shared shingle bound the overlap that is still possible (positional filter); the
pairs left are verified on their whole sets, after a last bound from where the median of one splits
the other (suffix filter).

* Documents with equal sets form one class before anything is joined, so copies cost one row each.
* How rare a shingle is, is estimated from a table of counters over all documents.  Any order that is
  the same everywhere gives the same links; the estimate only decides the cost.
* Classes that share a prefix shingle form a list; of lists with the same members one is kept.
  Large groups of near copies are not paired off: a list's members are first compared with a few of
  them, and what is found to be connected is not compared again; while many members are left and
  links are found, with a few others.  Then all pairs of a list that pass the filters and are not
  connected yet are made, each in the first of the lists that its two members share, and verified,
  so no link between components is lost.
* Besides the filters by prefix, each class has a sketch of its whole set: bits that say whether an odd
  number of shingles fell on them.  Where two sketches differ, the sets do, so the number of
  differing bits bounds the overlap from above, whatever the size of the sets.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .encoding import strings
from .shared import Scratch, small_batches, written

WORDS, PERCENT = 5, 75
#: Least and most counters of the rarity table, and bits of a table that says which sets are wanted: between them,
#: so many for each document, or for each set that is wanted.
COUNTERS, WANTED, EACH, BLOCKS = (1 << 21, 1 << 24), (1 << 24, 1 << 28), 64, 16
#: Members of a list with which all its others are compared in a round; comparisons for each member, mere arithmetic, up to
#: which no further round is worth its passes.
STARS, FEW = 3, 1024
#: Longs of a set's sketch, and shared prefix shingles by which a pair's first list is told.
SKETCH, FIRST = 16, 16
#: Bytes that part words; a random number for each byte, the same for A-Z as for a-z; an odd base and its inverse.
_PARTS = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BYTES = np.random.default_rng(20).integers(0, 2**64, 256, "uint64")
_BYTES[65:91] = _BYTES[97:123]
_BASE = 0x9E3779B97F4A7C15
_POWERS = {"base": np.ones(1, "uint64"), "inverse": np.ones(1, "uint64")}


def _powers(kind: str, n: int) -> np.ndarray:
    """The first n powers of the base or its inverse, modulo 2**64; kept and grown as needed."""
    if len(_POWERS[kind]) < n:
        step = np.full(max(n, 1 << 16) * 2, _BASE if kind == "base" else pow(_BASE, -1, 2**64), "uint64")
        step[0] = 1
        _POWERS[kind] = np.cumprod(step)
    return _POWERS[kind][:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, n: int = WORDS) -> np.ndarray:
    """The text's set: sorted 64-bit hashes of its distinct runs of n words, or of all words if fewer.

    A-Z is lower-cased; words are parted by ASCII white space.  Empty for no words or a null text.
    """
    if not text:
        return np.empty(0, "uint64")
    raw = np.frombuffer(text.encode("utf-8", "replace"), "uint8")
    inside = np.zeros(len(raw) + 2, "int8")
    inside[1:-1] = ~_PARTS[raw]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, "uint64")
    # Polynomial hashes of all words from one running sum over the bytes; the length goes in as well.
    sums = np.zeros(len(raw) + 1, "uint64")
    np.cumsum(_BYTES[raw] * _powers("base", len(raw)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _powers("inverse", len(raw))[starts]
    h = _mixed(h + (ends - starts).astype("uint64"))
    k = min(n, len(h))
    # A polynomial in an odd number over the words' hashes, which are themselves well spread.
    out = np.full(len(h) - k + 1, k, "uint64")
    for i in range(k):
        out *= np.uint64(_BASE)
        out += h[i : len(h) - k + 1 + i]
    return np.unique(_mixed(out))


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether 100 |a & b| >= percent |a | b|, for sorted sets."""
    need = -(-percent * (len(a) + len(b)) // (100 + percent))  # overlap that reaches the threshold
    if min(len(a), len(b)) < need:
        return False
    # Suffix filter: what lies below and above the median of b can at most pair off side by side.
    cut = len(b) // 2
    at = int(np.searchsorted(a, b[cut]))
    if min(at, cut) + min(len(a) - at, len(b) - cut) < need:
        return False
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    place = np.searchsorted(large, small)
    place[place == len(large)] = 0
    return int((large[place] == small).sum()) >= need


def _texts(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col(text).alias("text"))


def _squeezed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype("<u4").tobytes(), 1)


def _summed(parts: DataFrame) -> DataFrame:
    """(block, counts) summed up by block: as many rows as there are blocks."""

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(x), "<u4").astype("uint64") for x in frame["counts"])
        return pd.DataFrame({"block": [frame["block"].iloc[0]], "counts": [_squeezed(np.minimum(total, 2**32 - 1))]})

    # Two steps, so that no task adds up more than a few tables of a block.
    step = parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(8))).groupBy("block", "salt").applyInPandas(add, "block int, counts binary")
    return step.groupBy("block").applyInPandas(add, "block int, counts binary")


def _sized(n: int, bounds: tuple[int, int]) -> int:
    """A power of two within the bounds that grows with a number of documents, tokens or sets."""
    return min(bounds[1], max(bounds[0], 1 << (n * EACH).bit_length()))


def rarity(docs: DataFrame, text: str = "text", n: int = WORDS, counters: int = COUNTERS[0]) -> np.ndarray:
    """For each counter a level that grows with the number of documents that hold its shingles."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(counters, "uint32")
        for batch in batches:
            for t in strings(batch.column("text")):
                np.add.at(table, (shingles(t, n) & np.uint64(counters - 1)).astype("int64"), np.uint32(1))
        for i, part in enumerate(np.split(table, BLOCKS)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([_squeezed(part)])], names=["block", "counts"])

    levels = np.zeros(counters, "uint8")
    size = counters // BLOCKS
    for row in _summed(_texts(docs, text).select("text").mapInArrow(count, "block int, counts binary")).collect():
        counts = np.frombuffer(zlib.decompress(row["counts"]), "<u4").astype("float64")
        levels[row["block"] * size : (row["block"] + 1) * size] = np.minimum(255, 8 * np.log2(1 + counts))
    return levels


def sketch(s: np.ndarray) -> np.ndarray:
    """Bits that say whether an odd number of the set's shingles fell on them, as ``SKETCH`` longs."""
    odd = np.bincount((s >> np.uint64(40)).astype("int64") % (64 * SKETCH), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(bool)).view("int64")


def prefixes(docs: DataFrame, levels: np.ndarray, text: str = "text", n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, size of its set, two hashes of the set, its prefix, rarest shingles first, and its sketch."""
    level = docs.sparkSession.sparkContext.broadcast(levels)
    longs = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = level.value
        for batch in batches:
            sizes, halves, firsts, sketches = [], [], [], []
            for t in strings(batch.column("text")):
                s = shingles(t, n)
                first = len(s) - -(-percent * len(s) // 100) + 1 if len(s) else 0
                order = np.lexsort((s, rare[(s & np.uint64(len(rare) - 1)).astype("int64")]))[:first]
                h = xxhash.xxh3_128_intdigest(s.tobytes())
                sizes.append(len(s))
                halves.append((h & (2**64 - 1), h >> 64))
                firsts.append(s[order].view("int64"))
                sketches.append(sketch(s))
            if sizes:
                a, b = np.array(halves, "uint64").view("int64").T
                columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(a), pa.array(b), pa.array(firsts, longs), pa.array(sketches, longs)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "a", "b", "prefix", "sketch"])

    return _texts(docs, text).mapInArrow(run, "doc_id long, n long, a long, b long, prefix array<long>, sketch array<long>")


def _wanted(ids: DataFrame, bits: int) -> np.ndarray:
    """Bits by hash of the identifiers in ``ids`` (id)."""
    size = bits // BLOCKS

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = np.unique(np.concatenate([np.empty(0, "int64"), *[np.unique(_bit(batch["id"].to_numpy(), bits)) for batch in batches]]))
        for i in np.unique(at // size).tolist():
            part = np.zeros(size, bool)
            part[at[(at >= i * size) & (at < (i + 1) * size)] - i * size] = True
            yield pd.DataFrame({"block": [i], "counts": [zlib.compress(np.packbits(part).tobytes(), 1)]})

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        out = np.bitwise_or.reduce([np.frombuffer(zlib.decompress(x), "uint8") for x in frame["counts"]])
        return pd.DataFrame({"block": [frame["block"].iloc[0]], "counts": [zlib.compress(out.tobytes(), 1)]})

    found = np.zeros((BLOCKS, size // 8), "uint8")
    parts = ids.filter("id is not null").mapInPandas(mark, "block int, counts binary").groupBy("block").applyInPandas(merge, "block int, counts binary")
    for row in parts.collect():
        found[row["block"]] = np.frombuffer(zlib.decompress(row["counts"]), "uint8")
    return found.reshape(-1)


def _bit(ids: np.ndarray, bits: int) -> np.ndarray:
    return (_mixed(ids.astype("int64").view("uint64")) & np.uint64(bits - 1)).astype("int64")


def _marked(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at = _bit(ids, 8 * len(bits))
    return (bits[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)


def texts_of(texts: DataFrame, ids: DataFrame, size: int = WANTED[0]) -> DataFrame:
    """The rows of ``texts`` (id, text) whose id is in ``ids`` (id): no shuffle, as a table of ``size`` bits lets
    them through, and in a very large join some others that later joins drop."""
    bits = texts.sparkSession.sparkContext.broadcast(_wanted(ids, size))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_marked(bits.value, batch.column("id").to_numpy(zero_copy_only=False))))

    return texts.filter("id is not null").mapInArrow(some, "id long, text string")


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is not in ``ids`` (id); those without identifier stay.

    A table of bits says of most rows that they stay, and these are not shuffled, however many ids there are; the
    rows that go, and a few others, are joined exactly.
    """
    bits = docs.sparkSession.sparkContext.broadcast(_wanted(ids, _sized(ids.count(), WANTED)))

    @F.pandas_udf("boolean")
    def marked(found: pd.Series) -> pd.Series:
        return pd.Series(_marked(bits.value, found.to_numpy("int64")))

    held = F.col("doc_id").isNotNull() & marked(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)))
    some = docs.filter(held).join(ids.select(F.col("id").alias("doc_id")), "doc_id", "left_anti")
    return docs.filter(~held).union(some.select(*docs.columns))


def verified(pairs: DataFrame, texts: DataFrame, scratch: Scratch, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``pairs`` (x, y) whose texts' sets reach the threshold."""
    ids = pairs.select(F.col("x").alias("id")).unionByName(pairs.select(F.col("y").alias("id"))).distinct()
    some = scratch.written(texts_of(texts, ids), "paired")
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}  # the joins leave pairs of one text side by side

        def of(i: int, text: str) -> np.ndarray:
            if i not in known:
                if len(known) == 64:
                    known.clear()
                known[i] = shingles(text, n)
            return known[i]

        for batch in batches:
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            good = [similar(of(i, a.as_py()), of(j, b.as_py()), percent) for i, j, a, b in zip(x, y, batch.column("s"), batch.column("t"))]
            yield batch.select(["x", "y"]).filter(pa.array(good, pa.bool_()))

    left = pairs.join(some.select(F.col("id").alias("x"), F.col("text").alias("s")), "x")
    both = left.join(some.select(F.col("id").alias("y"), F.col("text").alias("t")), "y")
    return both.select("x", "y", "s", "t").mapInArrow(check, "x long, y long").distinct()


def shared_postings(classes: DataFrame, tokens: DataFrame, size: int = WANTED[0]) -> DataFrame:
    """(token, c, i) for the prefix shingles that are in ``tokens`` (token), and some others."""
    bits = classes.sparkSession.sparkContext.broadcast(_wanted(tokens.select(F.col("token").alias("id")), size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("prefix")
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype("int64")
            token = pc.list_flatten(lists).to_numpy(zero_copy_only=False)
            i = np.arange(len(token)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            keep = _marked(bits.value, token)
            row = pa.array(np.repeat(np.arange(len(sizes)), sizes)[keep])
            yield pa.RecordBatch.from_arrays([pa.array(token[keep], pa.int64()), batch.column("c").take(row), pa.array(i[keep], pa.int64())], names=["token", "c", "i"])

    return classes.select("c", "prefix").mapInArrow(run, "token long, c long, i long")


def _near(percent: int) -> Column:
    """The filters for a row (n, i, s, k*) and another (m, j, other_s, o*) of one list; plain arithmetic, as it
    runs for every pair that a list brings together.

    Length; position (a shared shingle at places i and j of the two orders leaves room for so much
    overlap); prefix (what is shared up to the smaller of the two last prefix shingles lies in both
    prefixes, and what follows is less than the rest of one of the two sets); and sketch (the sets
    differ in as many shingles as their sketches do in bits, at least).
    """
    least, most = F.least("n", "m"), F.greatest("n", "m")
    need = F.ceil(percent * (F.col("n") + F.col("m")) / (100 + percent))
    possible = F.least("i", "j") + 1 + F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j")) - 1
    length = 100 * least >= percent * most
    after = F.ceil(percent * most / 100) - 1
    apart = sum((F.bit_count(F.col(f"k{k}").bitwiseXOR(F.col(f"o{k}"))) for k in range(1, SKETCH)), F.bit_count(F.col("k0").bitwiseXOR(F.col("o0"))))
    return length & (possible >= need) & (F.least("s", "other_s") + after >= need) & (apart <= F.col("n") + F.col("m") - 2 * need)


#: The columns of a member that a pair's filters read, and their names on the other side.
SIDES = {"c": "d", "n": "m", "i": "j", "s": "other_s", **{f"k{k}": f"o{k}" for k in range(SKETCH)}}


def _members(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """The lists: a row for each class and prefix shingle that it shares with another class.

    token, c, n, the shingle's place i, the class's number s of shared shingles, its sketch k*, and
    earlier, the first of its shared shingles that come before this one.
    """
    # Most prefix shingles occur once: counting them needs only themselves, and the postings of the
    # others are picked out by a table of bits before they are shuffled.
    tokens = classes.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count("*").alias("k"))
    often = scratch.written(tokens.filter("k > 1").select("token"), "often")
    # So many bits for each token that the share of others that pass does not grow with the input.
    members = shared_postings(classes, often, _sized(often.count(), WANTED)).join(often, "token", "left_semi")
    # Lists with the same members (the same count and hashes) give the same candidates: one of them stays.
    who = members.groupBy("token").agg(F.count("*").alias("k"), F.bit_xor(F.xxhash64("c")).alias("who"), F.bit_xor(F.xxhash64("c", F.lit(1))).alias("too"))
    lists = who.groupBy("k", "who", "too").agg(F.min("token").alias("token")).select("token", F.lit(True).alias("stays"))
    # All shared shingles of a class count, those of dropped lists too; it has at most as many as its prefix is long.
    kept = members.join(lists, "token", "left").groupBy("c").agg(
        F.count("*").alias("s"), F.sort_array(F.collect_list(F.when(F.col("stays"), F.struct("i", "token")))).alias("own")).join(classes.select("c", "n", "sketch"), "c")
    earlier = F.slice("own", F.lit(1), F.least(F.col("r"), F.lit(FIRST)))["token"].alias("earlier")
    rows = kept.select("c", "n", "s", "sketch", "own", F.posexplode("own").alias("r", "p"))
    return scratch.written(rows.select("p.token", "c", "n", "p.i", "s", *[F.col("sketch")[k].alias(f"k{k}") for k in range(SKETCH)], earlier), "members")


def _open(members: DataFrame, tied: DataFrame | None) -> DataFrame:
    """The members of the lists that hold more than one component, with component, the list's largest one and its total."""
    component = F.col("c").alias("component")
    if tied is not None:
        members = members.join(tied.withColumnRenamed("component", "tied"), members["c"] == F.col("node"), "left").drop("node")
        component = F.coalesce("tied", "c").alias("component")
    joined = members.select("*", component).drop("tied")
    parts = joined.groupBy("token", "component").agg(F.count("*").alias("k"))
    lists = parts.groupBy("token").agg(F.max_by("component", F.struct("k", "component")).alias("largest"), F.sum("k").alias("total"), F.count("*").alias("parts"))
    return joined.join(lists.filter("parts > 1").drop("parts"), "token")


def _stars(members: DataFrame, outside: DataFrame, percent: int, salt: int) -> DataFrame:
    """Pairs of members with a few members of the same list in ``outside``, which pass the filters."""
    other = outside.select("token", *[F.col(old).alias(new) for old, new in SIDES.items()])
    picks = [F.min_by(F.struct(*SIDES.values()), F.xxhash64("d", F.lit(salt + k))).alias(f"p{k}") for k in range(STARS)]
    centres = other.groupBy("token").agg(*picks)
    centres = centres.select(F.col("token").alias("t"), F.explode(F.array_distinct(F.array(*[f"p{k}" for k in range(STARS)]))).alias("p")).select("t", "p.*")
    return _pairs(members.join(centres, (F.col("token") == F.col("t")) & (F.col("c") != F.col("d")) & _near(percent)))


def join(docs: DataFrame, text: str = "text", n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, and component_id, the smallest doc_id that
    links reach.  Other columns are ignored.

    Texts without words, null texts and null identifiers link with nothing (component_id is the
    row's own doc_id).  doc_id is taken to name one text; if rows repeat it, all their classes are
    tied together by it.  An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    with Scratch(docs.sparkSession) as scratch:
        rows = docs.count()
        bits = _sized(rows, WANTED)
        levels = rarity(docs, text, n, _sized(rows, COUNTERS))
        table = scratch.written(prefixes(docs, levels, text, n, percent), "prefixes")
        real = table.filter("n > 0 and doc_id is not null")
        # Equal sets: one row per class, its first document, prefix and sketch; combined before the shuffle.
        classes = scratch.written(real.groupBy("a", "b").agg(F.min("doc_id").alias("c"), *[F.first(x).alias(x) for x in ("n", "prefix", "sketch")]), "classes")
        members = _members(classes, scratch)
        texts = _texts(docs, text).withColumnRenamed("doc_id", "id")
        texts = scratch.written(texts_of(texts, members.select(F.col("c").alias("id")).distinct(), bits), "texts")

        # First each list's members against a few of them; again with others, while that finds links and leaves many.
        tried = scratch.written(_stars(members, members, percent, 0), "pairs")
        links = scratch.written(verified(tried, texts, scratch, n, percent), "links")
        tied, salt, limit = _components(links, scratch), STARS, FEW * members.count()
        open_ = scratch.written(_open(members, tied), "open")
        while _gaps(open_) > limit:
            new = scratch.written(_stars(open_, open_.filter("component <> largest"), percent, salt).join(tried, ["x", "y"], "left_anti"), "pairs")
            found = scratch.written(verified(new, texts, scratch, n, percent), "links")
            tried, salt = tried.unionByName(new), salt + STARS
            if found.isEmpty():
                break
            links = links.unionByName(found)
            tied = _components(links, scratch)
            open_ = scratch.written(_open(members, tied), "open")
        # Then every pair across the gaps: those outside a list's largest component against all others of the list, in
        # the first list that they share.
        sides = SIDES | {"component": "other", "earlier": "before"}
        other = open_.select(F.col("token").alias("t"), *[F.col(old).alias(new) for old, new in sides.items()])
        apart = (F.col("token") == F.col("t")) & (F.col("component") != F.col("other")) & ((F.col("other") == F.col("largest")) | (F.col("c") < F.col("d")))
        small = open_.filter(F.col("component") != F.col("largest"))
        rest = _pairs(small.join(other, apart & _near(percent) & ~F.arrays_overlap("earlier", "before")))
        rest = scratch.written(rest.join(tried, ["x", "y"], "left_anti"), "pairs")
        more = not rest.isEmpty()
        if more:
            links = links.unionByName(scratch.written(verified(rest, texts, scratch, n, percent), "links"))

        # Documents to classes to components; a repeated identifier ties the classes that it is in.
        ids = table.join(classes.select("a", "b", "c"), ["a", "b"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("c")).alias("node"))
        ids = scratch.written(ids, "ids")
        twice = ids.filter("doc_id is not null and node is not null").groupBy("doc_id").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi")
        if not twice.isEmpty():
            ties = ids.join(twice, "doc_id").filter("node <> lo").select(F.col("lo").alias("x"), F.col("node").alias("y")).distinct()
            links, more = links.unionByName(ties), True
        if more:
            tied = _components(links, scratch)
        component = F.coalesce("component", "node", "doc_id")
        return written(ids.join(tied, "node", "left").select("doc_id", "n_shingles", component.alias("component_id")), "joined")


def _components(links: DataFrame, scratch: Scratch) -> DataFrame:
    return components(links.select(F.col("x").alias("u"), F.col("y").alias("v")), scratch=scratch)


def _gaps(open_: DataFrame) -> int:
    """How many pairs the lists would bring together across their gaps, at most."""
    return open_.filter("component <> largest").agg(F.sum("total")).first()[0] or 0


def _pairs(found: DataFrame) -> DataFrame:
    return found.select(F.least("c", "d").alias("x"), F.greatest("c", "d").alias("y")).distinct()
