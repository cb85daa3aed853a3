"""SimHash near-duplicates, searched with pivot distance tables.

A fingerprint has a bit set where over half of the 64-bit hashes of the document's word
shingles have it.  Two fingerprints link at ``max_bits`` differing bits or fewer; the
operator gives each document the smallest id that links reach.

Search.  The Hamming distances of every fingerprint to fixed reference fingerprints
(pivots) are its coordinates; by the triangle inequality no coordinate of a linked pair
differs by more than ``max_bits``.  On 64 random bits one coordinate only halves the
candidates, so tables of coordinates alone would leave a quadratic rest.  Pivots with one
bit set settle that: the distance to one of them, less the distance to the zero pivot,
is one bit of the fingerprint.  At most ``max_bits`` of the ``max_bits + 2`` blocks of
bits can differ, so a linked pair agrees in two blocks at least: the one-bit
coordinates of each pair of blocks are a key that co-locates it (10 keys for 3 bits).  The
coordinate of a first random pivot splits every key further into cells of
``max_bits + 1`` distances; a fingerprint is at home in its cell and a guest in the next.
Within a cell the table of the remaining pivots discards pairs by their maximum
coordinate difference, and the survivors are verified by their differing bits.

Crowded cells.  In a cell of more than ``CROWD`` rows the bits outside its two blocks are
cut into ``max_bits + 2`` blocks again, and each pair of these is a key: a linked pair agrees
in one of them at least.  What is still crowded is dealt to parts of ``CROWD / 2`` rows by
hash, and each pair of parts is one unit.  So no unit is much above ``CROWD`` rows, and no
link is lost.

Scale.  Only distinct fingerprints are searched.  A cell gives links that span its
linked fingerprints, not all pairs; components come from alternating star contractions
of the link table, written to the shared folder after each round.  No fingerprints,
links or components pass the driver.

Cases: a null or empty text has fingerprint zero and links like any other; fewer words
than a shingle make one shingle; repeated rows share their fingerprint; a null id only
names a component without other ids; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.llm.common import map_text, restore, shared_path, staged

LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
RESULT = T.StructType([T.StructField("fp", T.LongType())])
LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
PIVOTS = 16
CROWD = 2048  # rows of a cell that one task compares


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned 64-bit fingerprint of a text."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(LOWER)
    words = data.split()  # bytes split at ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
    n = max(1, len(words) - shingle + 1)
    ends = (starts + size)[min(shingle, len(words)) - 1:]
    hashed = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    pairs = zip(starts[:n].tolist(), ends.tolist(), strict=True)
    while part := list(itertools.islice(pairs, 1 << 16)):
        h = np.array([hashed(line[s:e], 42) for s, e in part], dtype="<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                 carry: Sequence[str] | None = None) -> DataFrame:
    """The carried columns (default the id) as c0, c1, ... and r_fp, the fingerprint's bits as a long."""
    def start():
        def each(texts: list):
            out = []
            for t in texts:
                f = fingerprint(t, shingle)
                out.append(f - (1 << 64) if f >> 63 else f)
            return (out,)
        return each

    return map_text(docs, text, RESULT, start, list(carry or [doc_id]))


def pivots() -> np.ndarray:
    """Reference fingerprints: fixed random bits."""
    return np.random.default_rng(64).integers(0, 1 << 64, PIVOTS, dtype=np.uint64)


def signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def block_pairs(max_bits: int, left: int = (1 << 64) - 1) -> list[int]:
    """Bit masks of the pairs of ``max_bits + 2`` blocks of the bits that ``left`` has set."""
    bits = [1 << b for b in range(64) if left >> b & 1]
    edges = [len(bits) * i // (max_bits + 2) for i in range(max_bits + 3)]
    return [sum(bits[a:b]) | sum(bits[c:d])
            for (a, b), (c, d) in itertools.combinations(itertools.pairwise(edges), 2)]


def cells(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(band, bits, cell, home, fp): every fingerprint under each pair of blocks, at home and as a guest."""
    masks = block_pairs(max_bits)
    keys = F.array(*[F.struct(F.lit(i).alias("band"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("bits"))
                     for i, m in enumerate(masks)])
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.lit(signed(int(pivots()[0])))))
    home = F.floor(distance / (max_bits + 1)).cast("int")
    places = F.array(F.struct(home.alias("cell"), F.lit(True).alias("home")),
                     F.struct((home + 1).alias("cell"), F.lit(False).alias("home")))
    return distinct.select("fp", F.explode(keys).alias("k"), places.alias("places")).select(
        "fp", "k", F.explode("places").alias("p")).select("k.band", "k.bits", "p.cell", "p.home", "fp")


def linked_within(group: np.ndarray, home: np.ndarray, fp: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that span what is linked in each run of equal ``group`` numbers (rows sorted by it)."""
    n = len(fp)
    table = np.bitwise_count(fp[:, None] ^ pivots()[None, :]).astype(np.int8)
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out: list[tuple[int, int]] = []
    rows = np.arange(n)
    for step in range(1, n):
        rows = rows[rows + step < n]
        rows = rows[group[rows] == group[rows + step]]  # a run's rows end together, so they stay out
        if not len(rows):
            break
        i, j = rows, rows + step
        i, j = i[home[i] | home[j]], j[home[i] | home[j]]
        near = np.abs(table[i] - table[j]).max(axis=1, initial=0) <= max_bits
        i, j = i[near], j[near]
        linked = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
        for x, y in zip(i[linked].tolist(), j[linked].tolist(), strict=True):
            rx, ry = root(x), root(y)
            if rx != ry:
                parent[ry] = rx
                out.append((x, y))
    return out


def units(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(k, home, fp): what is compared under one key ``k``; crowded cells are cut into several."""
    every = (1 << 64) - 1
    finer = F.array(*[F.array(*[F.lit(signed(m)) for m in block_pairs(max_bits, every ^ mask)])
                      for mask in block_pairs(max_bits)])
    placed = cells(distinct, max_bits).select(F.xxhash64("band", "bits", "cell").alias("k"), "band", "home", "fp")

    def crowded(df: DataFrame) -> DataFrame:  # written, so that the planner knows its size before it joins
        return staged(df.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD), "crowded")

    counted = placed.join(crowded(placed), "k", "left")
    cut = counted.where("n is not null").select(
        "k", "home", "fp", F.posexplode(F.element_at(finer, F.col("band") + 1)).alias("part", "mask")).select(
        F.xxhash64("k", "part", F.col("fp").bitwiseAND(F.col("mask"))).alias("k"), "home", "fp")
    recounted = cut.join(crowded(cut), "k", "left")
    parts = F.ceil(F.col("n") * 2 / CROWD).cast("long")
    dealt = recounted.where("n is not null").select(
        "k", "home", "fp", F.pmod(F.xxhash64("k", "fp"), parts).alias("own"),
        F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("other")).select(
        F.xxhash64("k", F.least("own", "other"), F.greatest("own", "other")).alias("k"), "home", "fp")
    return counted.where("n is null").select("k", "home", "fp").unionByName(
        recounted.where("n is null").select("k", "home", "fp")).unionByName(dealt)


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(a, b): links between distinct fingerprints that span every linked group of each unit."""
    keyed = units(distinct, max_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in itertools.chain(batches, [None]):
            if b is not None:
                now = [b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False),
                       b.column(2).to_numpy().view(np.uint64)]
                now = [np.concatenate(x) for x in zip(rest, now, strict=True)] if rest else now
                if not len(now[0]):
                    continue
                # the last key may go on in the next batch
                cut = int(np.searchsorted(now[0], now[0][-1]))
            elif rest:
                now, cut = rest, len(rest[0])
            else:
                break
            rest = [x[cut:] for x in now]
            k, home, fp = (x[:cut] for x in now)
            shared = np.zeros(len(k), bool)
            shared[1:] |= k[1:] == k[:-1]
            shared[:-1] |= k[1:] == k[:-1]
            k, home, fp = k[shared], home[shared], fp[shared]
            if len(k):
                found = linked_within(k, home, fp, max_bits)
                s = fp.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(s[x]) for x, _ in found], pa.int64()),
                     pa.array([int(s[y]) for _, y in found], pa.int64())], names=["a", "b"])

    return keyed.repartition("k").sortWithinPartitions("k").mapInArrow(run, LINKS).where("a <> b").distinct()


def components(edges: DataFrame, name: str = "links") -> DataFrame:
    """(node, root): the smallest node that each linked node reaches.

    Alternating large and small stars: every round connects the larger neighbours, then
    the smaller ones, to the smallest neighbour.  Rounds end when the table stays as it is.
    """
    spark = edges.sparkSession
    now = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(
            F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        path = shared_path(spark, name)
        small.where("u <> v").distinct().write.parquet(path)
        now = spark.read.schema(now.schema).parquet(path)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == tuple(state):
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = tuple(state)


def with_roots(distinct: DataFrame, max_bits: int) -> DataFrame:
    """A staged table with fingerprints ``fp``, with the root of each one's component."""
    roots = components(links(distinct.select("fp"), max_bits))
    return distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        *distinct.columns, F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                    max_bits: int = 3) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a long), component_id (the smallest reachable id)."""
    prints = staged(fingerprints(docs, doc_id, text, shingle).select(
        F.col("c0").alias("doc_id"), F.col("r_fp").alias("fp")), "fingerprints")
    rooted = with_roots(staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct"), max_bits)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = rooted.join(named, "root").select("fp", "component_id")
    return prints.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(c) -> F.Column:
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
               max_bits: int = 3) -> DataFrame:
    """One row of each component, that with the smallest id (then text hash), with all its columns.

    A row without an id stays only where no row of its component has one.
    """
    names = docs.columns
    # row numbers are written with the rows, so that they are the same wherever they are used
    rows = staged(fingerprints(docs, doc_id, text, shingle, names).withColumn(
        "row", F.monotonically_increasing_id()), "fingerprinted")
    key = F.col(f"c{names.index(doc_id)}")
    own = F.struct(key.isNull().alias("no_id"), key.alias("id"), F.xxhash64(f"c{names.index(text)}").alias("th"), "row")
    first = rows.groupBy(F.col("r_fp").alias("fp")).agg(F.min(own).alias("own"))
    rooted = with_roots(staged(first, "first-rows"), max_bits)
    kept = rooted.groupBy("root").agg(F.min("own").alias("own")).select(F.col("own.row").alias("row"))
    return rows.join(kept, "row", "left_semi").select(*restore(rows, names))


def brute_force(ids: Sequence[int], prints: Sequence[int], max_bits: int = 3) -> list[int]:
    """The component of each id, by comparing all pairs."""
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in itertools.combinations(range(len(ids)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= max_bits:
            parent[root(j)] = root(i)
    least: dict[int, int] = {}
    for i, d in enumerate(ids):
        least[root(i)] = min(d, least.get(root(i), d))
    return [least[root(i)] for i in range(len(ids))]
