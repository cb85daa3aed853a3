"""Document fingerprints by winnowing.

Every run of ``k`` code points is hashed by a rolling polynomial; of each ``window``
consecutive hashes the smallest is chosen, the rightmost of equal ones, and recorded once
with its position.  Texts that share ``k + window - 1`` code points share a fingerprint
entry; no entry stands for less than ``k``.  A text of fewer than ``k`` code points is
one gram, one with fewer grams than a window is one window, and an empty text has no
entry.  The likeness of two fingerprints is the share of distinct hashes that they have
in common (Jaccard); two empty ones are alike.

Short texts may take a smaller window.  With one ``k``, what a window chooses is chosen by
every smaller window too, so texts of either kind share the entries of the larger window.

The query compares each document with its successor in descending id order.  Rows are
dealt to blocks of neighbouring ids, with bounds from a sample of the ids that only sets
the sizes of blocks; ids that fill more than a block, and null ids, are cut further by the
hash of the text.  The first row of each block also goes, as its one guest, to the block
before.  Blocks are sorted by Spark and streamed: a task holds two documents at a time.
The bounds and the table of first rows have about ``MAX_BLOCKS`` rows at most.

Cases: a null text is empty; rows that repeat an id follow each other in the order of text
hashes (if the id fills more than a block) and texts; rows with a null id come last; a lone
row is its own successor; an empty table gives no rows; other columns are ignored.  Rows
alike in id and text stay in one block, where the work on a repeated pair is done once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import col

BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
MAX_BLOCKS = 200_000
ROWS_PER_BLOCK = 2048
SAMPLES = 32  # sampled ids a block


class Winnower:
    """Windows of ``window`` grams, of ``short_window`` in texts of at most ``short`` code points."""

    def __init__(self, k: int, window: int, short: int = 0, short_window: int = 1):
        self.k, self.window, self.short, self.short_window = k, window, short, short_window
        self.powers = self.inverse = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = 1 << n.bit_length()
            step = np.full(n, BASE, np.uint64)
            step[0] = 1
            self.powers = np.cumprod(step)
            step[1:] = pow(BASE, -1, 1 << 64)
            self.inverse = np.cumprod(step)

    def grams(self, text: str) -> np.ndarray:
        """A 32-bit hash for each position where a gram starts."""
        c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        n = len(c)
        if not n:
            return np.zeros(0, np.uint64)
        k = min(self.k, n)
        self.grow(n)
        c += np.uint64(1)
        c *= self.powers[:n]
        upto = np.zeros(n + 1, np.uint64)
        np.cumsum(c, out=upto[1:])
        h = upto[k:] - upto[:-k]
        h *= self.inverse[:n - k + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h >> np.uint64(32)

    def entries(self, text: str) -> np.ndarray:
        """Chosen entries in text order: hash << 32 | position."""
        h = self.grams(text)
        n = len(h)
        if not n:
            return h
        last = np.uint64(0xFFFFFFFF)
        key = (h << np.uint64(32)) | (last - np.arange(n, dtype=np.uint64))  # least: smallest hash, then rightmost
        w, step = min(self.window if len(text) > self.short else self.short_window, n), 1
        while 2 * step <= w:
            key = np.minimum(key[:-step], key[step:])
            step *= 2
        if step < w:
            key = np.minimum(key[:step - w], key[w - step:])
        keep = np.ones(len(key), bool)
        keep[1:] = key[1:] != key[:-1]
        key = key[keep]
        return (key & ~last) | (last - (key & last))


def as_text(entries: np.ndarray) -> str:
    """16 hex digits an entry: the hash, then the position."""
    return entries.astype(">u8").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of two sorted arrays of distinct hashes."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the first as many code points of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


class Bounds:
    """Block numbers, rising in descending id order, nulls last.

    Sampled ids, sorted, are cut at every ``SAMPLES``-th.  An id that is a cut several times
    gets as many blocks of its own, by text hash, and null ids one for each ``SAMPLES``.
    """

    def __init__(self, ids: pa.ChunkedArray):
        down = np.sort(~ids.drop_null().to_numpy())
        self.cuts, times = np.unique(down[SAMPLES - 1::SAMPLES], return_counts=True)
        self.own = np.where(times > 1, times, 0)
        self.begin = 1 + np.concatenate(([0], np.cumsum(1 + self.own)))  # the last one begins the nulls
        self.nulls = max(1, ids.null_count // SAMPLES)
        self.hot = bool(self.own.any()) or self.nulls > 1

    def find(self, down: np.ndarray, null: np.ndarray, th: np.ndarray) -> np.ndarray:
        """The block of each complemented id, null mark and text hash (63 bits)."""
        j = np.searchsorted(self.cuts, down, "right") - 1  # the last cut that is not after the id
        at = np.maximum(j, 0)
        cuts, own = (np.append(x, 0) for x in (self.cuts, self.own))
        share = lambda n: np.minimum(th // (((1 << 63) - 1) // n), n - 1)
        part = np.where((cuts[at] == down) & (own[at] > 0), share(np.maximum(own[at], 1)), own[at])
        block = np.where(j < 0, 0, self.begin[at] + part)
        return np.where(null, self.begin[-1] + share(self.nulls), block)


def blocks(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(block, guest, id, t), sorted by block in descending id order, the guest last."""
    src = docs.select(col(doc_id).alias("id"), col(text).cast("string").alias("t"))
    n = src.count()
    many = max(1, min(MAX_BLOCKS, -(-n // ROWS_PER_BLOCK)))
    bounds = Bounds(src.select(F.col("id").cast("long").alias("id")).where(
        F.rand(1) < F.lit(SAMPLES * many / max(1, n))).toArrow().column("id"))

    @F.pandas_udf("long")
    def find(down: pd.Series, null: pd.Series, th: pd.Series) -> pd.Series:
        return pd.Series(bounds.find(down.to_numpy(), null.to_numpy(bool), th.to_numpy()))

    down = F.bitwise_not(F.col("id").cast("long"))
    # without hot ids the texts are not read for the blocks
    th = F.shiftrightunsigned(F.xxhash64("t"), 1) if bounds.hot else F.lit(0).cast("long")
    home = src.withColumn("th", th).withColumn(
        "block", find(F.coalesce(down, F.lit(0).cast("long")), F.col("id").isNull(), F.col("th")))
    least = F.min(F.struct(F.col("id").isNull().alias("no_id"), down.alias("down"), F.col("th").alias("th")))
    order = Window.orderBy("block")  # MAX_BLOCKS rows or little more
    before = F.coalesce(F.lag("block").over(order), F.last("block").over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    firsts = home.groupBy("block").agg(least.alias("least")).select(
        F.col("block").alias("b"), F.col("least.down").alias("down"), F.col("least.th").alias("first_th"),
        before.alias("before"))
    guests = home.join(F.broadcast(firsts), (F.col("block") == F.col("b")) & (F.col("th") == F.col("first_th"))
                       & down.eqNullSafe(F.col("down"))).groupBy("before").agg(
        F.first("id").alias("id"), F.min(F.coalesce("t", F.lit(""))).alias("t"))
    sent = home.select("block", F.lit(False).alias("guest"), "id", "t", "th").unionByName(
        guests.select(F.col("before").alias("block"), F.lit(True).alias("guest"), "id", "t",
                      F.lit(0).cast("long").alias("th")))
    return sent.repartition("block").sortWithinPartitions(
        "block", "guest", F.desc_nulls_last("id"), "th", F.coalesce("t", F.lit(""))).drop("th")


def fingerprint_neighbours(docs: DataFrame, k: int = 16, window: int = 64, short: int = 512, short_window: int = 16,
                           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    id_type = docs.select(col(doc_id)).schema[0].dataType.simpleString()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Winnower(k, window, short, short_window)
        held = None  # the home row that waits for its successor
        last, made = None, ()  # the last pair of texts and what came of it

        def look(text: str):
            entries = tool.entries(text)
            return entries, np.unique(entries >> np.uint64(32))

        for b in batches:
            rows = []
            for guest, i, t in zip(*(c.to_pylist() for c in b.columns[1:]), strict=True):
                t = t or ""
                entries, own = held[2:] if held is not None and held[1] == t else look(t)
                if held is not None:
                    hi, ht, he, ho = held
                    if last != (ht, t):
                        e = edited(ht, t)
                        ee, eo = look(e)
                        last, made = (ht, t), (
                            len(ht), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), as_text(he),
                            as_text(ee), likeness(ho, eo), likeness(ho, own))
                    rows.append((hi, *made))
                held = None if guest else (i, t, entries, own)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, a) for v, a in zip(zip(*rows, strict=True), (
                        b.schema.field(2).type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(),
                        pa.float64()), strict=True)], names=names)

    return blocks(docs, doc_id, text).mapInArrow(
        run, f"doc_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")


def brute_force(text: str, k: int, window: int) -> list[tuple[str, int]]:
    """(gram, position) chosen by looking at every window, with the same gram hashes."""
    tool = Winnower(k, window)
    h = [int(tool.grams(text[i:i + k])[0]) for i in range(max(1, len(text) - k + 1))] if text else []
    chosen = []
    for i in range(max(1, len(h) - window + 1) if h else 0):
        part = h[i:i + window]
        at = i + max(j for j, x in enumerate(part) if x == min(part))
        if not chosen or chosen[-1][1] != at:
            chosen.append((f"{h[at]:08x}", at))
    return chosen
