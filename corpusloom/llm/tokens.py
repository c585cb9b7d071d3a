"""Token ids of whole texts by a public byte-level BPE vocabulary.

Short texts are encoded as they come.  A long text is cut into pieces that are
encoded wherever they land, and the pieces are joined in a tree: around each
join a window of growing size is encoded again until both sides agree, so the
ids are those of the undivided text.  Inside one unsplit run (a word of the
pattern longer than ``RUN`` bytes) halves are joined the same way on bytes.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table, spread
from . import pieces as cuts

#: characters of a piece, pieces that one merge takes, bytes of a run that is encoded in halves
PIECE, FAN_IN, RUN = 65_536, 16, 4096


def default_path() -> str:
    """The vocabulary of byte_bpe_50k as ranks, where the public tokenizers are installed."""
    return os.environ.get("CORPUSLOOM_TOKENIZERS", "/opt/tokenizers") + "/byte_bpe_50k.tiktoken"


# Fixed value: the pattern that splits a text before byte pairs are merged.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Codec:
    """Encodes texts and joins encodings of neighbouring texts."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(PATTERN)

    def encode(self, text: str) -> list[int]:
        return self.bpe.encode_ordinary(text)

    def _one(self, raw: bytes) -> list[int]:
        return self.bpe._core_bpe.encode_single_piece(raw)

    def run(self, raw: bytes, leaf: int = RUN) -> list[int]:
        """One unsplit run: halves encoded apart, then joined where a window gives the same tokens at both ends."""
        if len(raw) <= leaf:
            return self._one(raw)
        mid = len(raw) // 2
        left, right = self.run(raw[:mid], leaf), self.run(raw[mid:], leaf)
        k = 4
        while k < max(len(left), len(right)):
            a, b = left[-k:], right[:k]
            window = self._one(self.bpe.decode_bytes(a + b))
            if len(a) < len(left) and len(b) < len(right):
                if window[0] == a[0] and window[-1] == b[-1]:
                    return left[:-k] + window + right[k:]
            k *= 2
        return self._one(raw)

    def pieces(self, text: str) -> tuple[list[int], list[int]]:
        """(ids, numbers of the tokens that begin a word of the pattern)."""
        ids: list[int] = []
        starts: list[int] = []
        for m in self.pattern.finditer(text):
            starts.append(len(ids))
            raw = m[0].encode()
            ids += self.run(raw) if len(raw) > RUN else self._one(raw)
        return ids, starts

    def join(self, left: tuple[list[int], list[int]], right: tuple[list[int], list[int]]) -> tuple[list[int], list[int]]:
        """The encoding of two neighbouring texts from their own.

        The window begins at a word of the left text that its end can't have
        changed, and ends in the right text; from the first word on that the
        window and the right text both begin, they agree for good, as the
        pattern never looks back.
        """
        (li, ls), (ri, rs) = left, right
        if not li or not ri:
            return (li or ri, ls or rs)
        n = 4
        while True:
            a = ls[-n] if n < len(ls) else 0
            b = rs[n] if n < len(rs) else len(ri)
            head, tail = self.bpe.decode_bytes(li[a:]), self.bpe.decode_bytes(ri[:b])
            wi, ws = self.pieces((head + tail).decode("utf-8"))
            whole = a == 0 and b == len(ri)
            if b < len(ri):
                # offsets of the words of the window and of the right text, without the last one of each
                at, have = len(head), {}
                k = 0
                for s in [s for s in rs if s < b][:-1]:
                    at += sum(len(self.bpe.decode_single_token_bytes(t)) for t in ri[k:s])
                    k = s
                    have[at] = s
                at, k = 0, 0
                for s in ws[:-1]:
                    at += sum(len(self.bpe.decode_single_token_bytes(t)) for t in wi[k:s])
                    k = s
                    if at > len(head) and at in have and (a > 0 or n >= len(ls)):
                        r = have[at]
                        ids = li[:a] + wi[:s] + ri[r:]
                        starts = [x for x in ls if x < a] + [x + a for x in ws if x < s] + [x - r + a + s for x in rs if x >= r]
                        return ids, starts
            if whole or (b == len(ri) and (a == 0 or n < len(ls))):
                starts = [x for x in ls if x < a] + [x + a for x in ws]
                return li[:a] + wi, starts
            n *= 2

    def tree(self, parts: list[tuple[list[int], list[int]]]) -> tuple[list[int], list[int]]:
        while len(parts) > 1:
            parts = [self.join(parts[i], parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0]


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec per worker process, kept over its tasks."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


_PART = "doc_id long, h long, piece int, ids array<int>, starts array<int>"
_PART_ARROW = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("piece", pa.int32()), ("ids", pa.list_(pa.int32())), ("starts", pa.list_(pa.int32()))])


def encode_texts(df: DataFrame, path: str | None = None, piece: int = PIECE, fan_in: int = FAN_IN) -> DataFrame:
    """(doc_id, text) to (doc_id, ids), one row for each row.

    NULL and empty texts get an empty list, never NULL.  Strings that look like
    special tokens are ordinary text.  Texts up to ``piece`` characters never
    leave their task; longer ones are cut, encoded in parallel and joined over a
    fixed number of rounds with at most ``fan_in`` pieces in a group.  Repeated
    and NULL doc_ids keep their rows.
    """
    path = path or default_path()

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            ids = [c.encode(t.as_py() or "") for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            got = [c.pieces(t.as_py()) for t in b.column(3)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array([g[0] for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.list_(pa.int32()))], schema=_PART_ARROW)

    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["piece"])
        ids, starts = codec(path).tree([(r["ids"], r["starts"]) for r in rows])
        return pa.Table.from_pylist([{"doc_id": rows[0]["doc_id"], "h": rows[0]["h"], "piece": rows[0]["piece"] // fan_in, "ids": ids, "starts": starts}], schema=_PART_ARROW)

    n = F.length("text")
    few = df.where(F.coalesce(n, F.lit(0)) <= piece).select("doc_id", "text").mapInArrow(short, "doc_id long, ids array<int>")
    long, copies = cuts.cut(df, "doc_id", "text", piece)
    parts = long.mapInArrow(part, _PART)
    # four rounds of 16 hold 16 ** 4 pieces, more than one string can have
    for _ in range(4):
        parts = parts.groupBy("doc_id", "h", F.floor(F.col("piece") / fan_in).alias("g")).applyInArrow(merge, _PART)
    return few.unionByName(cuts.repeat(parts.select("doc_id", "h", "ids"), copies, "doc_id").select("doc_id", "ids"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, ids) of each document by byte_bpe_50k without special tokens."""
    return encode_texts(spread(read_table(spark, sf_dir, "documents").select("doc_id", "text")))


def p8_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, tokens and characters by source; a NULL source is a source of its own."""
    ids = p8_ids(spark, sf_dir).select("doc_id", F.size("ids").alias("n"))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", F.coalesce(F.length("text"), F.lit(0)).alias("chars"))
    return docs.join(ids, "doc_id").groupBy("source").agg(F.count("*").alias("docs"), F.sum("n").alias("tokens"), F.sum("chars").alias("chars"))
