"""Substring dedup: words covered by a window that occurred before are removed.

A window is ``window`` consecutive words (runs of anything but ASCII white space) of one
document.  A window whose word sequence also starts earlier - in a document with a
smaller id, or earlier in the same one - is a repeat; every word that a repeat covers goes.
Windows are judged on the input.

Suffix automata find the repeats: of a reference shard in document order, a piece of
text is first read by the automaton - the matching statistic of each word is the length
of the longest run ending there that an earlier piece has, and where it reaches
``window``, the window ending there is a repeat - and then added to it.  Automata of the
whole corpus, with every document read by every shard's, would cost the square of the
corpus.  So shards are made by content, and a piece meets one shard only:

1. Winnowing gives each window an anchor, the smallest hash among its word ``GRAM``-grams
   (rightmost of equals).  Equal windows have equal anchors, so neighbouring windows with
   one anchor form a piece, and anchors are the shards.  Anchors are counted (reduced
   before the shuffle), and pieces of those that occur once are dropped.
2. Equal pieces are reduced to their earliest, also before the shuffle; all windows of the
   others are repeats.
3. The earliest pieces of each anchor that has different ones go, with their words, through
   the automaton of the anchor, in order.
4. An anchor with more than ``MOST_PIECES`` different pieces (a frequent line among
   different neighbours) is no shard of bounded size; its pieces are split into windows,
   which are reduced to their earliest by a 64-bit hash each.

Documents are told apart by id, text hash and length.  Hashes have 64 bits; pieces are equal if hash and anchor are.  Texts are shuffled by
document once, for both steps that read them.  No step holds more than one document, or
one anchor's automaton, in memory.

Cases: a null text has no words; fewer words than a window stay whole; a null id comes
after all others; rows that repeat an id are one document if their texts agree, else
further documents in the order of a text hash; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.llm.common import col, restore, staged

GRAM = 8
MOST_PIECES = 256
MOST_WINDOWS = 15  # of a piece
LAST_ID = (1 << 63) - 1
DOCUMENT = ["okey", "th", "size"]
LOW = np.uint64(0xFFFFFFFF)


class Hasher:
    """Rolling 64-bit hashes of words and of runs of words."""

    BYTE, WORD = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95

    def __init__(self):
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def powers(self, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        if base not in self.tables or len(self.tables[base][0]) < n:
            size = 1 << max(12, n.bit_length())
            up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            self.tables[base] = np.cumprod(up), np.cumprod(down)
        up, down = self.tables[base]
        return up[:n], down[:n]

    def upto(self, values: np.ndarray, base: int) -> np.ndarray:
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers(base, len(values))[0], out=out[1:])
        return out

    def runs(self, upto: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (upto[ends] - upto[starts]) * self.powers(base, len(upto))[1][starts]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))

    def words(self, text: str) -> np.ndarray:
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = (data != 32) & ((data < 9) | (data > 13))
        starts = np.flatnonzero(inside[1:] & ~inside[:-1])
        ends = np.flatnonzero(inside[:-1] & ~inside[1:])
        if not len(starts):
            return np.zeros(0, np.uint64)
        upto = self.upto(data.astype(np.uint64) + np.uint64(1), self.BYTE)
        return self.runs(upto, self.BYTE, starts, ends)

    def pieces(self, text: str, window: int) -> tuple[np.ndarray, ...] | None:
        """anchor hash, piece hash, first window, number of windows, of each piece."""
        words = self.words(text)
        n, k = len(words), min(GRAM, window)
        if n < window:
            return None
        upto = self.upto(words, self.WORD)
        at = np.arange(n - k + 1)
        grams = self.runs(upto, self.WORD, at, at + k)
        key = (grams & ~LOW) | (LOW - at.astype(np.uint64))  # least: smallest hash, then rightmost
        w, step = window - k + 1, 1
        while 2 * step <= w:
            key = np.minimum(key[:-step], key[step:])
            step *= 2
        if step < w:
            key = np.minimum(key[:step - w], key[w - step:])
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        many = np.diff(np.append(first, len(key)))
        # longer pieces (of windows above 22) are cut, so that their number of windows has its bits in at_of
        cut = (many + MOST_WINDOWS - 1) // MOST_WINDOWS
        if cut.max() > 1:
            part = np.arange(cut.sum()) - np.repeat(np.cumsum(cut) - cut, cut)
            first, many = np.repeat(first, cut) + part * MOST_WINDOWS, np.repeat(many, cut) - part * MOST_WINDOWS
            many = np.minimum(many, MOST_WINDOWS)
        anchor = (LOW - (key[first] & LOW)).astype(np.int64)
        return grams[anchor], self.runs(upto, self.WORD, first, first + many + window - 1), first, many


class SuffixAutomaton:
    """Suffix automaton of several pieces over words."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def state(self, length: int, following: dict, link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def split(self, p: int, q: int, word) -> int:
        """A copy of q for the runs that are one longer than those of p."""
        copy = self.state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def add(self, words: Sequence) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self.split(last, q, word)
                continue
            new, p = self.state(self.length[last] + 1, {}, 0), last
            while p != -1 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p != -1:
                q = self.next[p][word]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self.split(p, q, word)
            last = new

    def statistics(self, words: Sequence) -> list[int]:
        """For each word, the length of the longest known run that ends there."""
        out, v, n = [], 0, 0
        for word in words:
            while v and word not in self.next[v]:
                v = self.link[v]
                n = self.length[v]
            if word in self.next[v]:
                v = self.next[v][word]
                n += 1
            else:
                n = 0
            out.append(n)
        return out


def keyed(docs: DataFrame, doc_id: str, text: str, carry: Sequence[str]) -> DataFrame:
    """c0, c1, ... (carried), t, and the document: okey (the id, nulls last), th (the text's hash) and
    size (its characters)."""
    t = F.coalesce(col(text).cast("string"), F.lit(""))
    return docs.select(*[col(c).alias(f"c{i}") for i, c in enumerate(carry)], t.alias("t"),
                       F.coalesce(col(doc_id).cast("long"), F.lit(LAST_ID)).alias("okey"),
                       F.xxhash64(t).alias("th"), F.length(t).cast("long").alias("size"))


def at_of(size, first, many=0):
    """size, first window and number of windows in one long; sorts by size, then by window."""
    return (size << 32) | (first << 4) | many


def size_of(at):
    return F.shiftright(at, 32)


def anchored(docs: DataFrame, window: int) -> DataFrame:
    """(h, ph, okey, th, at) of every piece of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Hasher()
        for b in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for t, okey, th, size in zip(*(c.to_pylist() for c in b.columns), strict=True):
                found = tool.pieces(t, window)
                if found:
                    h, ph, first, many = found
                    for x, v in zip(out, (h.view(np.int64), ph.view(np.int64), np.full(len(h), okey, np.int64),
                                          np.full(len(h), th, np.int64), at_of(size, first, many)), strict=True):
                        x.append(v)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out],
                                                 names=["h", "ph", "okey", "th", "at"])

    return docs.select("t", *DOCUMENT).mapInArrow(run, "h long, ph long, okey long, th long, at long")


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()  # bytes split at ASCII white space only


def cut_pieces(docs: DataFrame, needed: DataFrame, window: int, split: bool) -> DataFrame:
    """The needed pieces (okey, th, size, pieces: array of {h, at}) with their words, or split into hashed windows.
    Repeated rows of a document are one."""
    once = docs.select("t", *DOCUMENT).dropDuplicates(DOCUMENT)
    joined = once.join(needed, DOCUMENT).select("t", "okey", "th", "pieces")
    schema = "h long, okey long, th long, at long" + ("" if split else ", words string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Hasher()
        for b in batches:
            rows = []
            for t, okey, th, pieces in zip(*(c.to_pylist() for c in b.columns), strict=True):
                words = [] if split else words_of(t)
                upto = tool.upto(tool.words(t), tool.WORD) if split else None
                for p in pieces:
                    at = p["at"]
                    first, many = (at >> 4) & ((1 << 28) - 1), at & 15
                    if split:
                        s = np.arange(first, first + many)
                        for k, h in zip(s.tolist(), tool.runs(upto, tool.WORD, s, s + window).view(np.int64).tolist(),
                                        strict=True):
                            rows.append((h, okey, th, at_of(at >> 32, k, 1)))
                    else:
                        rows.append((p["h"], okey, th, at, b" ".join(words[first:first + many + window - 1]).decode(
                            "utf-8", "surrogatepass")))
            if rows:
                types = [pa.int64()] * 4 + ([] if split else [pa.string()])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, a) for v, a in zip(zip(*rows, strict=True), types, strict=True)],
                    names=["h", "okey", "th", "at", "words"][:len(types)])

    return joined.mapInArrow(run, schema)


def matched(pieces: DataFrame, window: int) -> DataFrame:
    """(okey, th, at, mask): the repeats among each anchor's pieces; bit k stands for window first + k."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, known = None, SuffixAutomaton()
        for b in batches:
            rows = []
            for h, okey, th, at, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if h != anchor:
                    anchor, known = h, SuffixAutomaton()
                words = text.split(" ")
                reach = known.statistics(words)[window - 1:]
                mask = sum(1 << k for k, n in enumerate(reach) if n >= window)
                if mask:
                    rows.append((okey, th, at, mask))
                known.add(words)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*rows, strict=True)],
                                                 names=["okey", "th", "at", "mask"])

    shard = pieces.repartition("h").sortWithinPartitions("h", "okey", "th", "at")
    return shard.mapInArrow(run, "okey long, th long, at long, mask long")


def per_document(pieces: DataFrame, *columns: str) -> DataFrame:
    # a set: repeated rows of a document have equal pieces
    return pieces.select("okey", "th", size_of(F.col("at")).alias("size"), F.struct(*columns).alias("p")).groupBy(
        *DOCUMENT).agg(F.collect_set("p").alias("pieces"))


def repeats(docs: DataFrame, window: int) -> DataFrame:
    """(okey, th, size, pieces: array of {at, mask}): the repeated windows of each document."""
    anchors = anchored(docs, window)
    # written tables under the joins: a side that is reduced in the join's own stage keeps Spark
    # from splitting the rows of a frequent anchor over tasks
    often = staged(anchors.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "often")
    shared = staged(anchors.join(often, "h", "left_semi"), "repeated-anchors")
    earliest = staged(shared.groupBy("h", "ph").agg(F.min(F.struct("okey", "th", "at")).alias("own")), "earliest")
    several = earliest.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    variants = earliest.join(several, "h").select("h", "own.*", (F.col("n") > MOST_PIECES).alias("many"))
    later = shared.join(earliest, ["h", "ph"]).where(
        F.struct("okey", "th", "at") != F.col("own")).select(
        "okey", "th", "at", F.lit((1 << MOST_WINDOWS) - 1).cast("long").alias("mask"))
    by_automaton = matched(cut_pieces(docs, per_document(variants.where("not many"), "h", "at"), window, False), window)
    windows = cut_pieces(docs, per_document(variants.where("many"), "h", "at"), window, True)
    first = windows.groupBy("h").agg(F.min(F.struct("okey", "th", "at")).alias("own"))
    by_window = windows.join(first, "h").where(
        F.struct("okey", "th", "at") != F.col("own")).select(
        "okey", "th", "at", F.lit(1).cast("long").alias("mask"))
    return per_document(later.unionByName(by_automaton).unionByName(by_window), "at", "mask")


def remove_repeats(docs: DataFrame, window: int = 20, doc_id: str = "doc_id", text: str = "text",
                   carry: Sequence[str] | None = None) -> DataFrame:
    """Per row: the carried columns (default the id) as c0, c1, ..., and r_n_words, r_n_removed,
    r_spans (removed word spans), r_kept (the other words, joined by one space)."""
    carry = list(carry or [doc_id])
    source = keyed(docs, doc_id, text, carry)
    joined = source.join(repeats(source, window), DOCUMENT, "left").select(
        *[f"c{i}" for i in range(len(carry))], "t", "pieces")
    n = len(carry)
    schema = T.StructType([joined.schema[f"c{i}"] for i in range(n)]
                          + T._parse_datatype_string("r_n_words long, r_n_removed long, r_kept string, "
                                                     "r_spans array<struct<start:int,end:int>>").fields)
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: tuple[list, ...] = [], [], [], []
            for t, pieces in zip(b.column(n).to_pylist(), b.column(n + 1).to_pylist(), strict=True):
                words = words_of(t)
                gone = removed_spans(pieces or (), window)
                kept, at = [], 0
                for s, e in gone:
                    kept += words[at:s]
                    at = e
                kept += words[at:]
                for x, v in zip(out, (len(words), len(words) - len(kept), b" ".join(kept).decode(
                        "utf-8", "surrogatepass"), [{"start": s, "end": e} for s, e in gone]), strict=True):
                    x.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(n)] + [pa.array(v, a) for v, a in zip(
                    out, (pa.int64(), pa.int64(), pa.string(), spans_type), strict=True)], names=schema.names)

    return joined.mapInArrow(run, schema)


def removed_spans(pieces: Sequence[dict], window: int) -> list[tuple[int, int]]:
    """Maximal spans of words that repeated windows cover."""
    starts = sorted(((p["at"] >> 4) & ((1 << 28) - 1)) + k for p in pieces for k in range(p["at"] & 15)
                    if p["mask"] >> k & 1)
    out: list[tuple[int, int]] = []
    for s in starts:
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], s + window)
        else:
            out.append((s, s + window))
    return out


def rewrite(docs: DataFrame, window: int = 20, doc_id: str = "doc_id", text: str = "text",
            n_chars: str = "n_chars") -> DataFrame:
    """All documents, with their columns; those that lose words have the others, joined by one space, as
    text, and its length in ``n_chars`` where there is such a column."""
    names = docs.columns
    done = remove_repeats(docs, window, doc_id, text, names)
    cut = F.col("r_n_removed") > 0
    columns = dict(zip(names, restore(done, names), strict=True))
    place = {c: f"c{i}" for i, c in enumerate(names)}
    columns[text] = F.when(cut, F.col("r_kept")).otherwise(F.col(place[text])).alias(text)
    if n_chars in columns:
        columns[n_chars] = F.when(cut, F.length("r_kept")).otherwise(F.col(place[n_chars])).cast(
            docs.schema[n_chars].dataType).alias(n_chars)
    return done.select(*columns.values())


def brute_force(docs: Sequence[tuple[int, str]], window: int = 20) -> dict[int, list[str]]:
    """The kept words of each document (unique ids), by looking every window up among all earlier ones."""
    import re

    seen: set[tuple] = set()
    out = {}
    for i, t in sorted(docs):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone: set[int] = set()
        for k in range(len(words) - window + 1):
            w = tuple(words[k:k + window])
            if w in seen:
                gone.update(range(k, k + window))
            seen.add(w)
        out[i] = [w for k, w in enumerate(words) if k not in gone]
    return out
