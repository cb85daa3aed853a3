"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A word is a run of characters other than ASCII non-alphanumerics, ASCII letters in
lower case.  The patterns are all windows of ``window`` consecutive words of the
benchmark items (an item of fewer words, but not none, is one shorter pattern).  The
patterns of one length form a machine: SHIFT says for each block of two words how far
the search may jump when that block stands at the end of the search window; blocks in
no pattern allow the largest jump.  Where the shift is zero, the patterns that end in
the block (suffix bucket) and begin with the text's first block are compared with the
text directly.  Patterns of one word are their own block.

Cases: a null text has no words and is clean; an empty benchmark leaves all documents
clean; rows repeat independently; rows of a benchmark item id count as one item, and a
null id as one item whose name is empty; other columns are ignored.

The benchmark is broadcast.  Its size is measured first; beyond ``max_shard_bytes`` it
is split by rows into shards within that size, and the documents pass the shards' scans
one after the other, in the same narrow stage (no shuffle, no row key needed).
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.llm.common import col, map_text, restore

#: bytes that separate words become spaces, A-Z become a-z; bytes from 0x80 up are word bytes
WORD_BYTES = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A
                   else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()),
                                                    T.StructField("end", T.IntegerType())]))),
    T.StructField("items", T.ArrayType(T.StringType()))])


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


class WuManber:
    """All patterns of one length m (in words)."""

    def __init__(self, patterns: dict[tuple, set[str]], m: int):
        self.m, self.patterns, self.block = m, patterns, min(2, m)
        self.far = m - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = defaultdict(lambda: defaultdict(list))
        b = self.block
        for p in patterns:
            for end in range(b, m + 1):
                block = p[end - b:end]
                self.shift[block] = min(self.shift.get(block, self.far), m - end)
            self.buckets[p[m - b:]][p[:b]].append(p)
        self.buckets = {k: dict(v) for k, v in self.buckets.items()}

    def search(self, words: list[bytes], hits: list[tuple[int, int]], items: set[str]) -> None:
        m, b, far, shift = self.m, self.block, self.far, self.shift
        end, n = m, len(words)
        while end <= n:
            block = (words[end - 2], words[end - 1]) if b == 2 else (words[end - 1],)
            jump = shift.get(block, far)
            if jump:
                end += jump
                continue
            start = end - m
            for p in self.buckets[block].get(tuple(words[start:start + b]), ()):
                if all(words[start + k] == p[k] for k in range(b, m - b)):
                    hits.append((start, end))
                    items |= self.patterns[p]
            end += 1


def machines(items: Sequence[tuple[str, str]], window: int) -> list[WuManber]:
    by_len: dict[int, dict[tuple, set[str]]] = defaultdict(lambda: defaultdict(set))
    for name, text in items:
        w = words_of(text)
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            by_len[m][tuple(w[i:i + m])].add(name)
    return [WuManber(dict(p), m) for m, p in sorted(by_len.items())]


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def benchmark_shards(benchmark: DataFrame, item_id: str, text: str, max_shard_bytes: int) -> list[list[tuple]]:
    """The benchmark as lists of (name, text) within the stated size (one item at least)."""
    rows = benchmark.select(F.coalesce(col(item_id).cast("string"), F.lit("")).alias("k"),
                            col(text).cast("string").alias("t")).where("t is not null")
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-2 * int(total) // max_shard_bytes)) if total > max_shard_bytes else 1
    part = F.pmod(F.xxhash64("k", "t"), F.lit(n))
    return [[(r.k, r.t) for r in rows.where(part == i).collect()] for i in range(n)]


def find_contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       item_id: str = "item_id", item_text: str = "text", window: int = 13,
                       share: int = 20, max_shard_bytes: int = 64 << 20,
                       carry: Sequence[str] | None = None) -> DataFrame:
    """Per document row: the carried columns (default the id) as c0, c1, ... and
    r_n_words, r_spans (merged word spans that are hit), r_items (sorted names), r_n_hit and
    r_contaminated (n_hit > 0 and share * n_hit >= n_words)."""
    carry = list(carry or [doc_id])
    spark = docs.sparkSession
    shards = benchmark_shards(benchmark, item_id, item_text, max_shard_bytes)
    kept = carry if len(shards) == 1 or text in carry else [*carry, text]  # later shards read the text again
    out = None
    for shard in shards:
        sent = spark.sparkContext.broadcast(shard)

        def start(sent=sent):
            found = machines(sent.value, window)

            def scan(texts: list):
                n_words, spans, names = [], [], []
                for t in texts:
                    w = words_of(t)
                    hits: list[tuple[int, int]] = []
                    items: set[str] = set()
                    for machine in found:
                        machine.search(w, hits, items)
                    n_words.append(len(w))
                    spans.append([{"start": s, "end": e} for s, e in merge_spans(hits)])
                    names.append(sorted(items))
                return n_words, spans, names
            return scan

        if out is None:
            out = map_text(docs, text, RESULT, start, kept)
        else:
            done = out.columns
            again = map_text(out, f"c{kept.index(text)}", RESULT, start, done)
            k = {c: F.col(f"c{i}") for i, c in enumerate(done)}
            out = again.select(*[k[c].alias(c) for c in done[:len(kept)]], F.col("r_n_words"),
                               F.concat(k["r_spans"], "r_spans").alias("r_spans"),
                               F.array_sort(F.array_distinct(F.concat(k["r_items"], "r_items"))).alias("r_items"))
    out = out.select(*[c for c in out.columns if c != f"c{len(carry)}"])
    # shards find spans apart; a word hit twice counts once
    covered = F.aggregate(
        F.array_sort("r_spans"), F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["to"]))).alias("n"),
                              F.greatest(a["to"], s["end"]).alias("to")))["n"]
    return out.withColumn("r_n_hit", covered.cast("long")).withColumn(
        "r_contaminated", (F.col("r_n_hit") > 0) & (share * F.col("r_n_hit") >= F.col("r_n_words")))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of ``find_contamination`` with the document id carried first."""
    return found.select(
        F.col("c0").alias("doc_id"), F.col("r_n_words").alias("n_words"), F.col("r_n_hit").alias("n_hit"),
        F.size("r_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "r_items"), 256).alias("items_sha256"),
        F.col("r_contaminated").alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    names = docs.columns
    found = find_contamination(docs, benchmark, carry=names, **options)
    return found.where(~F.col("r_contaminated")).select(*restore(found, names))


def brute_force(text: str | None, items: Sequence[tuple[str, str | None]], window: int = 13, share: int = 20):
    """(n_words, n_hit, sorted names, contaminated) by comparing every position with every window."""
    def words(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    w, hit, names = words(text), set(), set()
    for name, t in items:
        v = words(t)
        m = min(window, len(v))
        for i in range(len(v) - m + 1 if m else 0):
            for j in range(len(w) - m + 1):
                if w[j:j + m] == v[i:i + m]:
                    hit.update(range(j, j + m))
                    names.add(name)
    return len(w), len(hit), sorted(names), bool(hit) and share * len(hit) >= len(w)
