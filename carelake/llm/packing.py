"""Best-fit packing with large-item matching, solved on the histogram of lengths.

Documents are tokenized, closed with an end id and, if longer than the capacity, cut
into pieces of the capacity.  Which pieces share a sequence depends on their lengths
only, and there are at most ``capacity`` lengths: the plan is made from the counts per
length (a table whose size does not depend on the data), the pieces only look up their
places in it.

Plan: lengths above a third of the capacity, of which at most two fit a sequence, are
matched greedily - each length, longest first, opens its sequences and takes as partner
the longest remaining large piece that fits.  Smaller lengths then go, longest first,
to the fullest sequences that still have room (best fit), and open sequences of their
own when none has.  Equal sequences are kept as one group with a count.

Places: the pieces of a length are numbered without gaps, by counts per (length, salt)
and a row number within the salt, so that a length shared by a third of the rows is
numbered by many tasks.  The number decides the sequence and the offset.

Cases: a null text is empty and gives one piece that holds the end id only; texts of
any length are tokenized whole; repeated rows are packed apiece; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import sys
import types
import zlib
from collections import defaultdict
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from carelake.llm.common import map_text, staged

PIECES = T.StructType([T.StructField("pieces", T.ArrayType(T.StructType([
    T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])))])
SLOTS = T.StructType([T.StructField(n, T.LongType()) for n in
                      ("length", "from_rank", "to_rank", "per_seq", "first_seq", "first_offset")])


class WordCache:
    """Token ids of whole texts, word by word.

    The tokenizer never joins what white space separates, nor letters and a closing mark,
    and lower-cases: the ids of a text are those of its space- and newline-separated words
    in order, and ``Word,`` has those of ``word`` and ``,``.  What words give is kept, in two
    generations: a full one becomes the older one, and words that are met again move to the
    younger, so that frequent words are never encoded anew.  New words are encoded together,
    with a special token between them.
    """

    #: letters whose lower case is one letter, and a closing mark
    PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]?)").fullmatch

    def __init__(self, path: str, most: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok, self.most, self.known, self.older = Tokenizer.from_file(path), most, {"": b""}, {}
        self.special = next((t.content for t in self.tok.get_added_tokens_decoder().values() if t.special), None)
        self.mark = self.tok.token_to_id(self.special) if self.special else None

    @classmethod
    def of_worker(cls, path: str) -> WordCache:
        """The cache of this Python worker, which Spark lets run many tasks."""
        kept = sys.modules.setdefault("carelake_worker_caches", types.ModuleType("carelake_worker_caches"))
        if path not in kept.__dict__:
            kept.__dict__[path] = cls(path)
        return kept.__dict__[path]

    def ids_of(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def encode(self, words: list[str]) -> None:
        plain = [w for w in words if self.special and "<" not in w]
        for i in range(0, len(plain), 250):
            part = plain[i:i + 250]
            ids = self.ids_of(self.special.join(part))
            cuts = (4 * np.flatnonzero(ids == self.mark)).tolist()
            data = ids.tobytes()
            for w, start, end in zip(part, [0, *[c + 4 for c in cuts]], [*cuts, len(data)], strict=True):
                self.known[w] = data[start:end]
        if len(plain) < len(words):
            for w in words:
                if w not in self.known:
                    self.known[w] = self.ids_of(w).tobytes()

    def learn(self, words: list[str]) -> None:
        """Put ``words`` into the younger generation."""
        known, older, plain = self.known, self.older, self.PLAIN
        forms, new = [], {}
        for w in words:
            if (ids := older.get(w)) is not None:
                known[w] = ids
                continue
            m = plain(w)
            core, tail = (m[1].lower(), m[2]) if m else (w, "")
            if core != w:
                forms.append((w, core, tail))
            for x in (core, tail):
                if x not in known:
                    if (ids := older.get(x)) is not None:
                        known[x] = ids
                    else:
                        new[x] = None
        self.encode(list(new))
        for w, core, tail in forms:
            known[w] = known[core] + known[tail]

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        words = text.replace("\n", " ").split(" ")
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            if len(self.known) + len(new) > self.most:
                self.known, self.older = {"": b""}, self.known
                new = [w for w in dict.fromkeys(words) if w]
            self.learn(new)
        return b"".join(map(self.known.__getitem__, words))


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids cut to the capacity."""
    end, width = np.array([end_id], dtype="<u4").tobytes(), 4 * capacity

    def start():
        cache = WordCache.of_worker(tokenizer)

        def cut(texts: list):
            out = []
            for t in texts:
                ids = cache.ids(t or "") + end
                out.append([{"piece": k, "start": i // 4, "length": len(ids[i:i + width]) // 4,
                             "ids_crc32": zlib.crc32(ids[i:i + width])}
                            for k, i in enumerate(range(0, len(ids), width))])
            return (out,)
        return cut

    cut = map_text(docs, text, PIECES, start, [doc_id])
    return cut.select(F.col("c0").alias("doc_id"), F.explode("r_pieces").alias("p")).select("doc_id", "p.*")


def plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple], int]:
    """Slots (length, from_rank, to_rank, per_seq, first_seq, first_offset) and the number of sequences.

    Ranks [from, to) of a length fill sequences first_seq, first_seq + 1, ..., with
    per_seq pieces each, from first_offset on.  A group is (sequences, gap, contents).
    """
    left = {n: c for n, c in counts.items() if c}
    groups: dict[int, list] = defaultdict(list)  # gap -> [(sequences, [(length, per sequence)])]
    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:  # at most two large pieces to a sequence
        while left.get(n):
            fits = [m for m in large if left.get(m) and m <= capacity - n and (m != n or left[n] > 1)]
            if not fits:
                groups[capacity - n].append((left.pop(n), [(n, 1)]))
                break
            m = max(fits)
            k = left[n] // 2 if m == n else min(left[n], left[m])
            groups[capacity - n - m].append((k, [(n, 2)] if m == n else [(n, 1), (m, 1)]))
            for x in (n, m):
                left[x] -= k
    for n in sorted((n for n in left if left[n] and 3 * n <= capacity), reverse=True):
        need = left[n]
        for gap in sorted(g for g in groups if g >= n and groups[g]):
            while need and groups[gap]:
                sequences, contents = groups[gap].pop()
                each = min(gap // n, need)
                used = min(sequences, need // each)
                if used < sequences:
                    groups[gap].append((sequences - used, contents))
                groups[gap - each * n].append((used, [*contents, (n, each)]))
                need -= used * each
            if not need:
                break
        while need:
            each = min(capacity // n, need)
            used = need // each
            groups[capacity - each * n].append((used, [(n, each)]))
            need -= used * each
    slots, ranks, total = [], defaultdict(int), 0
    for gap in sorted(groups):
        for sequences, contents in groups[gap]:
            offset = 0
            for n, each in contents:
                slots.append((n, ranks[n], ranks[n] + sequences * each, each, total, offset))
                ranks[n] += sequences * each
                offset += n * each
            total += sequences
    return slots, total


def numbered(pieces: DataFrame, rows_per_salt: int = 2000) -> DataFrame:
    """``pieces`` with a gapless number from 0 within each length."""
    salts = max(1, -(-pieces.count() // rows_per_salt))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    return salted.withColumn("rn", F.row_number().over(within) - 1).join(base, ["length", "salt"]).withColumn(
        "rank", F.col("base") + F.col("rn")).drop("salt", "rn", "base")


def best_fit_pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32, within the capacity) with sequence_id and offset."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # <= capacity rows
    slots, _ = plan(counts, capacity)
    table = spark.createDataFrame(slots, SLOTS)
    on = [numbered_col("length") == F.col("s.length"), F.col("p.rank") >= F.col("s.from_rank"),
          F.col("p.rank") < F.col("s.to_rank")]
    place = F.col("p.rank") - F.col("s.from_rank")
    joined = numbered(pieces).alias("p").join(F.broadcast(table.alias("s")), on)
    return joined.select(
        *[numbered_col(c).alias(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")],
        (F.col("s.first_seq") + F.floor(place / F.col("s.per_seq"))).cast("long").alias("sequence_id"),
        (F.col("s.first_offset") + (place % F.col("s.per_seq")) * F.col("s.length")).cast("long").alias("offset"))


def numbered_col(name: str):
    return F.col(f"p.{name}")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, **columns) -> DataFrame:
    """Tokenize, cut and pack ``docs``; see the module."""
    pieces = staged(token_pieces(docs, tokenizer, capacity, end_id, **columns), "pieces")
    return best_fit_pack(pieces, capacity)


def brute_force_lower_bound(lengths: Sequence[int], capacity: int) -> int:
    """No packing needs fewer sequences than this."""
    half = sum(1 for n in lengths if 2 * n > capacity)
    return max(half, -(-sum(lengths) // capacity))
