"""Source divergence audit: how far each source's word use lies from that of its peers.

Terms are the runs of ASCII letters and non-ASCII characters of a text, A-Z lower-cased.  A
language keeps the terms of at least ``min_docs`` of its documents, V of them.  A group is a
(lang, source); with N occurrences of kept terms in all, a term it has ``count`` times gets
``p = 1 + floor(10**9 * (count + 2) / (N + 2 * V))``, so a kept term it never has gets the
group's *baseline*, the p of count zero.  The divergence of two values is
``f(p, q) = floor((p - q)**2 / (p + q))``, and that of two groups is f summed over all kept terms.

Gustavson row accumulation.  The postings are sorted by term (the term-major index: which groups
have a term, with which p).  Every group walks its own terms and scatters, through the index rows
of these terms, into one dense accumulator with a place for each peer; no pair of postings is
ever a row.  Terms that one side lacks are corrected by the baselines: with b the baselines,

    sum f = V f(bg, bh) + sum over g's terms of (f(p, bh) - f(bg, bh))
                        + sum over h's terms of (f(bg, q) - f(bg, bh))
                        + sum over shared terms of (f(p, q) - f(p, bh) - f(bg, q) + f(bg, bh)).

The first three are dense and need only a group's distinct values of p with their numbers; the
last is what the scatter adds.

Scale.  Term counts are summed per task before they are shuffled.  Sources of a language are
numbered and cut into blocks of ``BLOCK``; a tile of two blocks and one bucket of terms is the
unit of work, so a task holds one accumulator of BLOCK x BLOCK and one run of index rows, however
many sources, terms or documents there are.  Tiles emit their accumulators, at most one row for
each pair of groups and bucket, and Spark sums them.  All arithmetic is on integers.

Cases: a null text, lang or source is ''; a group without kept terms diverges by its baselines
only; a language without kept terms has value 0 for each pair; one with a single source has no
pairs; repeated rows and ids are documents of their own; texts are read whole, in pieces cut
between terms; ties in rank go to the smaller item by its UTF-8 bytes; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import col, staged

#: bytes -> bytes: A-Z lower-cased, every other ASCII character that is no letter a space
TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
#: different (group, term) counts that a task holds before it hands them on
HELD_TERMS = 300_000
#: bytes of a text that are Python words at one time
PIECE = 1 << 20
#: sources of one side of a tile
BLOCK = 512
#: index rows that are worked on at one time
RUN = 1 << 16
SCALE = 1_000_000_000


def term_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists from about PIECE bytes each."""
    data = text.translate(TERM_BYTES)
    start = 0
    while start < len(data):
        end = len(data) if start + PIECE >= len(data) else data.find(b" ", start + PIECE)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, df): occurrences and documents of each term of each group."""
    src = docs.select(*[F.coalesce(col(c).cast("string"), F.lit("")).alias(a)
                        for c, a in ((lang, "lang"), (source, "source"), (text, "t"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def handed_on() -> Iterator[pa.RecordBatch]:
            for (lg, so), (n, df) in held.items():
                terms = list(n)
                for i in range(0, len(terms), 50_000):
                    part = terms[i:i + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lg] * len(part)), pa.array([so] * len(part)),
                         pa.array(part, pa.binary()).cast(pa.string()), pa.array([n[t] for t in part], pa.int64()),
                         pa.array([df[t] for t in part], pa.int64())], names=["lang", "source", "term", "n", "df"])
            held.clear()

        for b in batches:
            groups = zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
            texts = b.column(2).cast(pa.binary())
            for i, key in enumerate(groups):
                n, df = held.setdefault(key, (Counter(), Counter()))
                seen: set[bytes] = set()
                for words in term_pieces(texts[i].as_py()):
                    n.update(words)
                    seen.update(words)
                df.update(seen)
                if i % 64 == 0 and sum(len(x) for x, _ in held.values()) > HELD_TERMS:
                    yield from handed_on()
        yield from handed_on()

    part = src.mapInArrow(run, "lang string, source string, term string, n long, df long")
    return part.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def smoothed(n, total, v):
    """p of ``n`` occurrences in a group of ``total``; decimals hold 10**9 times any count exactly."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (n.cast("decimal(19,0)") + 2)
    bottom = total.cast("decimal(19,0)") + v.cast("decimal(19,0)") * 2
    return F.when(v > 0, F.call_function("div", top, bottom) + 1).otherwise(F.lit(0)).cast("long")


def divergence(p, q):
    """f of two columns of p."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def postings_and_groups(docs: DataFrame, min_docs: int, text: str, lang: str, source: str) -> tuple[DataFrame, DataFrame]:
    """The kept postings (lang, source, term, n, lang_n, head: one a term), and the groups with their sums, both written once.

    Groups: lang, source, number ``no`` within the language (from 0), ``total`` (N), ``lang_total``
    (the language's N), ``v``, number of groups ``many``, baseline ``base``.
    """
    own = Window.partitionBy("lang", "term")
    counts = term_counts(docs, text, lang, source).withColumns({
        "docs": F.sum("df").over(own), "lang_n": F.sum("n").over(own), "head": F.min("source").over(own)})
    postings = staged(counts.where(F.col("docs") >= min_docs).select(
        "lang", "source", "term", "n", "lang_n", (F.col("head") == F.col("source")).alias("head")), "kept-terms")
    per_group = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    per_lang = postings.groupBy("lang").agg(F.count_if("head").alias("v"), F.sum("n").alias("lang_total"))
    found = docs.select(F.coalesce(col(lang).cast("string"), F.lit("")).alias("lang"),
                        F.coalesce(col(source).cast("string"), F.lit("")).alias("source")).distinct()
    by_lang = Window.partitionBy("lang")
    zero = F.lit(0).cast("long")
    groups = found.join(per_group, ["lang", "source"], "left").join(per_lang, "lang", "left").select(
        "lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("lang_total", zero).alias("lang_total"),
        F.coalesce("v", zero).alias("v"), (F.row_number().over(by_lang.orderBy("source")) - 1).alias("no"),
        F.count(F.lit(1)).over(by_lang).cast("int").alias("many"))
    return postings, staged(groups.withColumn("base", smoothed(zero, F.col("total"), F.col("v"))), "groups")


def f_of(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """f on arrays; p and q are at most 10**9 + 1, so the square fits 64 bits."""
    d = p - q
    return d * d // (p + q)


class Tile:
    """Accumulator of the groups of one block (rows) against those of another (peers)."""

    def __init__(self, rows: int, peers: int, size: int):
        self.blocks, self.size = (rows, peers), size
        self.base = np.zeros((2, size), np.int64)
        self.here = np.zeros((2, size), bool)
        self.acc = np.zeros((size, size), np.int64)

    def groups(self, no: np.ndarray, base: np.ndarray, v: int, first: bool) -> None:
        """The groups of both blocks; the first bucket adds what the baselines give for every term."""
        for side, block in enumerate(self.blocks):
            own = no // self.size == block
            self.base[side, no[own] % self.size] = base[own]
            self.here[side, no[own] % self.size] = True
        if first and v:
            r, h = (np.flatnonzero(x) for x in self.here)
            self.acc[np.ix_(r, h)] += v * f_of(self.base[0, r][:, None], self.base[1, h][None, :])

    def add(self, term: np.ndarray, no: np.ndarray, p: np.ndarray) -> None:
        """Whole index rows: ``term`` numbers them (ascending), one entry a group that has the term."""
        block, at = no // self.size, no % self.size
        on = [block == self.blocks[0], block == self.blocks[1]]
        t = [term[x] for x in on]
        a = [at[x] for x in on]
        v = [p[x] for x in on]
        # one side has the term: distinct values of each group against the other side's baselines
        for side in (0, 1):
            other = np.flatnonzero(self.here[1 - side])
            b = self.base[1 - side, other]
            for g, values in by_group(a[side], v[side]):
                u, m = np.unique(values, return_counts=True)
                own = self.base[side, g]
                more = np.zeros(len(other), np.int64)
                for i in range(0, len(u), 1024):
                    more += (m[i:i + 1024, None] * (f_of(u[i:i + 1024, None], b[None, :]) - f_of(own, b)[None, :])).sum(axis=0)
                if side:
                    self.acc[other, g] += more
                else:
                    self.acc[g, other] += more
        # both have it: the group's terms, through their index rows, into the accumulator of its peers
        first = np.searchsorted(t[1], t[0], "left")
        size = np.searchsorted(t[1], t[0], "right") - first
        for g, mine in by_group(a[0], np.arange(len(a[0]))):
            many = size[mine]
            total = int(many.sum())
            if not total:
                continue
            entry = np.arange(total) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[mine], many)
            own, peer, q = np.repeat(v[0][mine], many), a[1][entry], v[1][entry]
            bg, bh = self.base[0, g], self.base[1, peer]
            found = f_of(own, q) - f_of(own, bh) - f_of(bg, q) + f_of(bg, bh)
            # sums of a run stay far below 2**53, so that the float weights are exact
            self.acc[g] += np.bincount(peer, found, self.size).astype(np.int64)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        r, h = (np.flatnonzero(x) for x in self.here)
        a = np.repeat(r + self.blocks[0] * self.size, len(h))
        b = np.tile(h + self.blocks[1] * self.size, len(r))
        value = self.acc[np.ix_(r, h)].ravel()
        if self.blocks[0] != self.blocks[1]:
            return np.concatenate((a, b)), np.concatenate((b, a)), np.concatenate((value, value))
        return a[a != b], b[a != b], value[a != b]


def by_group(group: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.diff(group[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(group[part[0]]), values[part]


def changes(column: pa.Array) -> np.ndarray:
    """Where a value differs from that before it (nulls are one value); the first does."""
    out = np.ones(len(column), bool)
    if len(column) > 1:
        c = pc.fill_null(pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)), True)
        both_null = pc.and_(pc.is_null(column.slice(1)), pc.is_null(column.slice(0, len(column) - 1)))
        out[1:] = pc.and_(c, pc.invert(both_null)).to_numpy(zero_copy_only=False)
    return out


def accumulate(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (lang, rows, peers, bucket, term), the groups of a tile (no term) first."""
    tile, key = None, None

    def emitted(of, k) -> pa.RecordBatch:
        a, b, value = of.rows()
        return pa.RecordBatch.from_arrays([pa.array([k[0]] * len(a), pa.string()), pa.array(a.astype(np.int32)),
                                           pa.array(b.astype(np.int32)), pa.array(value)], names=["lang", "a", "b", "value"])

    rest: list[pa.RecordBatch] = []
    for b in itertools.chain(batches, [None]):
        if b is not None:
            rest.append(b)
            if sum(x.num_rows for x in rest) < RUN:
                continue
        if not rest:
            break
        now = pa.Table.from_batches(rest).combine_chunks()
        new_key = np.zeros(now.num_rows, bool)
        for name in ("lang", "rows", "peers", "bucket"):
            new_key |= changes(now[name].combine_chunks())
        new_term = new_key | changes(now["term"].combine_chunks())
        # the last index row may go on in the next batch
        cut = now.num_rows if b is None else int(np.flatnonzero(new_term)[-1])
        rest = [] if b is None else now.slice(cut).to_batches()
        term = np.cumsum(new_term)
        no, p, base = (now[c].to_numpy() for c in ("no", "p", "base"))
        is_group = now["term"].is_null().to_numpy()
        starts = np.flatnonzero(new_key[:cut])
        for s, e in itertools.pairwise([*starts.tolist(), cut]):
            k = tuple(now[c][s].as_py() for c in ("lang", "rows", "peers", "bucket"))
            if k != key:
                if tile:
                    yield emitted(tile, key)
                tile, key = Tile(k[1], k[2], size), k
            g = np.flatnonzero(is_group[s:e]) + s
            if len(g):
                tile.groups(no[g], base[g], int(p[g[0]]), k[3] == 0)
            w = slice(s + len(g), e)
            tile.add(term[w], no[w], p[w])
    if tile:
        yield emitted(tile, key)


def pair_values(postings: DataFrame, groups: DataFrame, size: int = BLOCK) -> DataFrame:
    """(lang, a, b, value): the divergence of each ordered pair of groups of a language, by number."""
    tasks = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_blocks = F.ceil(F.col("many") / size).cast("int")
    # a unit for each task: more buckets would only make more accumulators to be summed
    tiles = groups.where("no = 0").agg(F.sum(n_blocks * (n_blocks + 1) / 2)).first()[0] or 1
    buckets = F.lit(max(1, -(-tasks // int(tiles))))
    block = F.floor(F.col("no") / size).cast("int")
    tile = (F.least("block", "other").alias("rows"), F.greatest("block", "other").alias("peers"))

    def beside(df: DataFrame) -> DataFrame:
        """Every row in each tile of its block."""
        return df.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))

    g = groups.select("lang", "source", "no", "many", "total", "v", "base")
    entries = beside(postings.join(g, ["lang", "source"])).select(
        "lang", *tile, F.pmod(F.xxhash64("term"), buckets).cast("int").alias("bucket"), "term", "no",
        smoothed(F.col("n"), F.col("total"), F.col("v")).alias("p"), "base")
    heads = beside(g).withColumn("bucket", F.explode(F.sequence(F.lit(0), buckets - 1))).select(
        "lang", *tile, "bucket", F.lit(None).cast("string").alias("term"), "no", F.col("v").alias("p"), "base")
    key = ["lang", "rows", "peers", "bucket"]
    dealt = heads.unionByName(entries).repartition(*key).sortWithinPartitions(*key, "term")
    return dealt.mapInArrow(lambda batches: accumulate(batches, size), "lang string, a int, b int, value long").groupBy("lang", "a", "b").agg(
        F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = 10, top_terms: int = 10, text: str = "text", lang: str = "lang",
          source: str = "source", block: int = BLOCK) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair``: every other source of the language with its divergence.  Part ``term``: the
    ``top_terms`` terms that the group has and uses more than its language does.
    """
    postings, groups = postings_and_groups(docs, min_docs, text, lang, source)
    name = groups.select("lang", F.col("no").alias("a"), "source")
    peer = groups.select("lang", F.col("no").alias("b"), F.col("source").alias("item"))
    pairs = pair_values(postings, groups, block).join(name, ["lang", "a"]).join(peer, ["lang", "b"]).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value")
    sums = groups.select("lang", "source", "total", "lang_total", "v")
    of_terms = postings.join(sums, ["lang", "source"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        smoothed(F.col("n"), F.col("total"), F.col("v")).alias("p"),
        smoothed(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q")).where("p > q")
    terms = of_terms.select("lang", "source", "part", "item", divergence(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    return pairs.select("*", rank).unionByName(terms.select("*", rank).where(F.col("rank") <= top_terms))
