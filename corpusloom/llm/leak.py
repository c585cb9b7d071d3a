"""Passages of held-out items inside documents, found by an FM-index per shard.

A shard is a batch of documents.  Its words become numbers of the items'
vocabulary; only runs of at least ``SPAN`` known words can hold a passage, so
the index is built over these runs alone.  The windows of ``SPAN`` words of all
items are searched backwards at once through the ranks of a wavelet tree, the
occurrences are located by walking to sampled suffix positions, and overlapping
windows of one item are merged into the spans to remove.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table, spread

SPAN = 12
#: known words of a shard's index at most (but for one document that has more), and the distance of sampled positions
SHARD, SAMPLE = 2_000_000, 8
#: bytes of held-out items that one pass over the documents searches for; more items take more passes
MOST_BYTES = 32_000_000

_WORD = re.compile(r"[^\W_]+")
# Characters that don't show: soft hyphen, zero-width characters, word joiner, byte order mark.
_UNSEEN = re.compile("[­​‌‍⁠﻿᠎]")


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits in small letters, invisible characters left out."""
    if not text:
        return []
    if not text.isascii():
        text = _UNSEEN.sub("", text)
    return _WORD.findall(text.lower())


class WaveletTree:
    """Ranks over numbers below 2 ** levels: a bit vector with running counts on each level."""

    def __init__(self, seq: np.ndarray, levels: int):
        self.levels, self.n = levels, len(seq)
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in range(levels - 1, -1, -1):
            bit = (seq >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int(len(seq) - bit.sum()))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])  # a wavelet matrix: all zeros first

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of c before position i, for arrays of both."""
        lo, hi = np.zeros_like(i), i
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            one = ((c >> level) & 1).astype(bool)
            a, b = self.ones[k][lo], self.ones[k][hi]
            lo = np.where(one, self.zeros[k] + a, lo - a)
            hi = np.where(one, self.zeros[k] + b, hi - b)
        return hi - lo


class FmIndex:
    """Over runs of numbers from 1 on; each run ends with a separator of its own."""

    def __init__(self, runs: list[np.ndarray], vocabulary: int):
        self.starts = np.concatenate([[0], np.cumsum([len(r) + 1 for r in runs])]).astype(np.int64)
        n = int(self.starts[-1])
        text = np.zeros(n, dtype=np.int64)
        for s, r in zip(self.starts, runs):
            text[s : s + len(r)] = r
        sa = self._suffixes(text)
        before = text[sa - 1]
        before[sa == 0] = 0
        self.before = before
        self.levels = max(1, int(vocabulary).bit_length())
        self.tree = WaveletTree(before, self.levels)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=vocabulary + 1))]).astype(np.int64)
        inside = np.zeros(n + 1, dtype=bool)
        inside[self.starts] = True
        self.sampled = (sa % SAMPLE == 0) | inside[sa]
        self.slot = np.cumsum(self.sampled) - 1
        self.positions = sa[self.sampled]

    @staticmethod
    def _suffixes(text: np.ndarray) -> np.ndarray:
        """Suffix array by prefix doubling; separators rank by position, so no suffix ties beyond its run."""
        n = len(text)
        seps = np.flatnonzero(text == 0)
        rank = text + len(seps)
        rank[seps] = np.arange(len(seps))
        h, base = 1, int(rank.max(initial=0)) + 2
        while True:
            key = rank * base
            key[: max(n - h, 0)] += rank[h:] + 1
            sa = np.argsort(key, kind="stable")
            step = np.diff(key[sa]) != 0
            rank = np.empty(n, dtype=np.int64)
            rank[sa] = np.concatenate([[0], np.cumsum(step)]) if n else step
            if step.all() or h >= n:
                return sa
            h, base = 2 * h, n + 1

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that begin with each pattern (rows of equal length), searched from the last word on."""
        lo = self.first[patterns[:, -1]].copy()
        hi = self.first[patterns[:, -1] + 1].copy()
        for k in range(patterns.shape[1] - 2, -1, -1):
            live = np.flatnonzero(lo < hi)
            if not len(live):
                break
            c = patterns[live, k]
            lo[live] = self.first[c] + self.tree.rank(c, lo[live])
            hi[live] = self.first[c] + self.tree.rank(c, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, by steps back to the nearest sampled one."""
        out = np.full(len(rows), -1, dtype=np.int64)
        at, todo = rows.copy(), np.arange(len(rows))
        for step in range(SAMPLE + 1):
            known = self.sampled[at]
            out[todo[known]] = self.positions[self.slot[at[known]]] + step
            todo, at = todo[~known], at[~known]
            if not len(todo):
                break
            c = self.before[at]
            at = self.first[c] + self.tree.rank(c, at)
        return out


class Items:
    """The windows of SPAN words of the held-out items, in numbers of their vocabulary.

    Only the words and each item's numbers travel to the workers; the windows
    are laid over them there.
    """

    def __init__(self, items: list[tuple[int, str | None]]):
        self.vocabulary: dict[str, int] = {}
        each, self.ids = [], []
        for item, text in items:
            words = words_of(text)
            if len(words) >= SPAN:
                each.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], dtype=np.int32))
                self.ids.append(item)
        self.sizes = [len(x) for x in each]
        self.words = np.concatenate(each) if each else np.zeros(0, np.int32)
        self._laid: tuple[np.ndarray, np.ndarray] | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_laid": None}

    def _lay(self) -> tuple[np.ndarray, np.ndarray]:
        if self._laid is None:
            starts = np.concatenate([[0], np.cumsum(self.sizes)])[:-1].astype(np.int64)
            first = np.concatenate([s + np.arange(n - SPAN + 1) for s, n in zip(starts, self.sizes)]) if self.sizes else np.zeros(0, np.int64)
            of = np.repeat(np.array(self.ids, dtype=np.int64), [n - SPAN + 1 for n in self.sizes]) if self.sizes else np.zeros(0, np.int64)
            self._laid = self.words[first[:, None] + np.arange(SPAN)].astype(np.int64).reshape(len(first), SPAN), of
        return self._laid

    @property
    def patterns(self) -> np.ndarray:
        return self._lay()[0]

    @property
    def item(self) -> np.ndarray:
        return self._lay()[1]


def search_shard(items: Items, docs: list[tuple[int, int, np.ndarray]]) -> list[tuple[int, int, int, int]]:
    """(doc_id, item_id, first word, last word) of the merged spans; docs are (doc_id, word number, run)."""
    if not docs or not len(items.patterns):
        return []
    index = FmIndex([d[2] for d in docs], len(items.vocabulary))
    lo, hi = index.search(items.patterns)
    hits = np.flatnonzero(lo < hi)
    if not len(hits):
        return []
    counts = (hi - lo)[hits]
    pattern = np.repeat(hits, counts)
    rows = np.repeat(lo[hits], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    pos = index.locate(rows)
    run = np.searchsorted(index.starts, pos, side="right") - 1
    found: dict[tuple[int, int], list[int]] = {}
    for p, r, x in zip(items.item[pattern].tolist(), run.tolist(), pos.tolist()):
        found.setdefault((docs[r][0], p), []).append(docs[r][1] + x - int(index.starts[r]))
    out = []
    for (doc, item), firsts in found.items():
        firsts = sorted(set(firsts))
        a, b = firsts[0], firsts[0] + SPAN - 1
        for f in firsts[1:]:
            if f > b + 1:
                out.append((doc, item, a, b))
                a = f
            b = max(b, f + SPAN - 1)
        out.append((doc, item, a, b))
    return out


def leaked_spans(docs: DataFrame, items: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """(doc_id, item_id, first_word, last_word) of every passage of at least SPAN words of an item.

    Words of a document are numbered from 0.  NULL and empty texts, and items of
    fewer words, give no rows.  The bytes of the items are summed first; items
    of up to ``most_bytes`` are gathered and broadcast for one pass over the
    documents, and more items take more passes.  Nothing is shuffled.
    """
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    passes = max(1, -(-total // most_bytes))
    docs = spread(docs.select("doc_id", "text"))
    out: DataFrame | None = None
    for k in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k) if passes > 1 else items
        found = _search(docs, Items([(r.item_id, r.text) for r in part.select("item_id", "text").collect()]))
        out = found if out is None else out.unionByName(found)
    return out


def _search(docs: DataFrame, items: Items) -> DataFrame:
    """One pass over the documents for items of bounded size."""
    sent = docs.sparkSession.sparkContext.broadcast(items)
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("first_word", pa.int32()), ("last_word", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        get = held.vocabulary.get
        shard: list[tuple[int, int, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            got = search_shard(held, shard)
            cols = list(zip(*got)) if got else [[], [], [], []]
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)

        for b in batches:
            for doc, text in zip(b.column(0), b.column(1)):
                words = words_of(text.as_py())
                if len(words) < SPAN:
                    continue
                ids = np.fromiter((get(w, 0) for w in words), dtype=np.int64, count=len(words))
                edges = np.flatnonzero(np.diff(np.concatenate([[0], (ids > 0).astype(np.int8), [0]])))
                for s, e in zip(edges[::2], edges[1::2]):
                    if e - s >= SPAN:
                        shard.append((doc.as_py(), int(s), ids[s:e]))
                        size += e - s + 1
                if size >= SHARD:
                    yield flush()
                    shard, size = [], 0
        yield flush()

    return docs.mapInArrow(run, "doc_id long, item_id long, first_word int, last_word int")


def p9_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans of words to remove from each document, by item."""
    return leaked_spans(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "eval_items"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id) of each item of which a document holds at least 12 consecutive words."""
    return p9_spans(spark, sf_dir).select("doc_id", "item_id").distinct()


def p9_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, spans and longest span by leaked item."""
    return p9_spans(spark, sf_dir).groupBy("item_id").agg(F.count_distinct("doc_id").alias("docs"), F.count("*").alias("spans"), F.max(F.col("last_word") - F.col("first_word") + 1).alias("longest"))


SQL = {
    "p9_found": r"""WITH w AS (SELECT item_id AS id, regexp_extract_all(lower(regexp_replace(text, '[\x{00AD}\x{200B}-\x{200D}\x{2060}\x{FEFF}\x{180E}]', '', 'g')), '[\p{L}\p{N}]+') AS w FROM eval_items WHERE text IS NOT NULL),
d AS (SELECT doc_id AS id, regexp_extract_all(lower(regexp_replace(text, '[\x{00AD}\x{200B}-\x{200D}\x{2060}\x{FEFF}\x{180E}]', '', 'g')), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT DISTINCT id, array_to_string(list_slice(w, k, k + 11), ' ') AS g FROM (SELECT id, w, unnest(range(1, len(w) - 10)) AS k FROM w WHERE len(w) >= 12)),
j AS (SELECT DISTINCT id, array_to_string(list_slice(w, k, k + 11), ' ') AS g FROM (SELECT id, w, unnest(range(1, len(w) - 10)) AS k FROM d WHERE len(w) >= 12))
SELECT DISTINCT j.id AS doc_id, i.id AS item_id FROM j JOIN i ON i.g = j.g""",
}
_SPANS = SQL["p9_found"].split("j AS (")[0] + """x AS (SELECT id, w, unnest(range(1, len(w) - 10)) AS k FROM d WHERE len(w) >= 12),
p AS (SELECT DISTINCT x.id AS doc_id, i.id AS item_id, k - 1 AS pos FROM x JOIN i ON i.g = array_to_string(list_slice(w, k, k + 11), ' ')),
r AS (SELECT *, coalesce(pos > lag(pos) OVER (PARTITION BY doc_id, item_id ORDER BY pos) + 12, false)::INT AS new FROM p), s AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, item_id ORDER BY pos) AS part FROM r),
spans AS (SELECT doc_id, item_id, min(pos)::INT AS first_word, (max(pos) + 11)::INT AS last_word FROM s GROUP BY doc_id, item_id, part)"""
SQL["p9_spans"] = _SPANS + " SELECT * FROM spans"
SQL["p9_items"] = _SPANS + " SELECT item_id, count(DISTINCT doc_id) AS docs, count(*) AS spans, max(last_word - first_word + 1)::INT AS longest FROM spans GROUP BY item_id"
