"""Per-document text statistics that stay exact when huge documents are cut into chunks.

A chunk becomes a ``Partial``: counts over its complete lines, the two open
pieces at its ends, and the state of the list of other pages that a chunk may
begin or end in.  Merging two neighbours closes the line between them and takes
the titles of such a list out of the body, so any cutting gives the counts of
the whole text; merging is associative, and the chunks of a document are merged
in a tree.  Ratios of the merged counts decide what is no natural prose.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable, read_table, spread
from . import blocks as B
from . import mojibake, pages
from . import pieces as cuts

#: characters of a chunk, and chunks that one merge takes
CHUNK, FAN_IN = 65_536, 64
COUNTS = ("chars", "words", "word_chars", "symbols", "lines", "ended", "common", "letters", "digits", "bullets", "body", "body_words", "body_common", "body_ended", "prose", "item", "row", "junk", "link", "short")
_BODY = COUNTS.index("body")
_NO_SYMBOLS = str.maketrans("", "", "#{}[]<>|\\/*_=~^+@$%&…")
_LETTERS, _DIGITS = re.compile(r"[^\W\d_]+"), re.compile(r"\d+")


def line_counts(a: B.Analyzer, line: str) -> tuple[list[int], int, int]:
    """(counts, furniture code, shape) of one complete line; a blank one counts only its characters."""
    c = [0] * len(COUNTS)
    c[0] = len(line)
    got = a.line(line)
    x, furn, kind, _, _, _ = got
    if furn < 0:
        return c, furn, kind
    words = B._WORD.findall(x)
    c[1] = len(words)
    c[2] = sum(map(len, words))
    c[3] = len(line) - len(line.translate(_NO_SYMBOLS)) + line.count("...")
    c[4] = 1
    c[5] = int(B._STOP_END.search(x) is not None)
    c[6] = sum(map(a.common.__contains__, words))
    c[7] = sum(map(len, _LETTERS.findall(line)))
    c[8] = sum(map(len, _DIGITS.findall(line)))
    c[9] = int(B._BULLET_ONLY.match(line.strip()) is not None)
    c[_BODY:] = body_counts(got)
    return c, furn, kind


def body_counts(got: tuple) -> list[int]:
    """The counts from ``body`` on of a line that the analyzer has read."""
    c = [0] * (len(COUNTS) - _BODY)
    x, furn, kind, words, stops, ends = got
    if not furn:
        c[:4] = 1, words, stops, int(ends)
        c[3 + kind] = len(x)
    return c


#: state of the list of other pages: none, right under its heading; in a run of titles the state is their shape
NONE, HEADED = 0, -1


@dataclass
class Span:
    """Counts of complete lines one after the other, whatever stands before them.

    ``lead`` is the shape of the alike short lines that the span begins with and
    ``lead_counts`` what they count: they are titles if the span follows on a
    list of other pages.  ``open`` says that the span has nothing else; then
    ``end``, the state after it, depends on what stands before.
    """

    counts: list[int] = field(default_factory=lambda: [0] * len(COUNTS))
    lead: int = 0
    lead_counts: list[int] = field(default_factory=lambda: [0] * (len(COUNTS) - _BODY))
    open: bool = True
    end: int = NONE

    @classmethod
    def of_line(cls, counts: list[int], furn: int, kind: int) -> "Span":
        if furn < 0:
            return cls(counts)
        if not furn and kind in (B.SHORT, B.ITEM):
            return cls(counts, kind, counts[_BODY:])
        return cls(counts, open=False, end=HEADED if furn == 2 else NONE)

    def after(self, state: int) -> int:
        """The state at the end of the span if it begins in ``state``."""
        if not self.open:
            return self.end
        return state if not self.lead or state == self.lead else self.lead if state == HEADED else NONE

    def then(self, other: "Span") -> "Span":
        counts = list(map(int.__add__, self.counts, other.counts))
        if not self.open:
            # what stands before is known: the other's first lines are titles or not
            if other.lead and self.end in (HEADED, other.lead):
                counts[_BODY:] = map(int.__sub__, counts[_BODY:], other.lead_counts)
            return Span(counts, self.lead, self.lead_counts, False, other.after(self.end))
        if not self.lead or not other.lead or self.lead == other.lead:
            lead = list(map(int.__add__, self.lead_counts, other.lead_counts))
            return Span(counts, self.lead or other.lead, lead, other.open, other.end)
        return Span(counts, self.lead, self.lead_counts, False, other.after(NONE))

    def closed(self) -> list[int]:
        """The counts if nothing stands before."""
        return self.counts

    def to_list(self) -> list[int]:
        return [*self.counts, *self.lead_counts, self.lead, int(self.open), self.end]

    @classmethod
    def from_list(cls, x: list[int]) -> "Span":
        x, n = list(x), len(COUNTS)
        return cls(x[:n], x[-3], x[n:-3], bool(x[-2]), x[-1])


@dataclass
class Partial:
    """The complete lines between two open pieces; ``whole`` is False while no line end was seen."""

    span: Span
    head: str
    tail: str
    whole: bool

    @classmethod
    def of(cls, a: B.Analyzer, chunk: str) -> "Partial":
        first, *rest = chunk.split("\n")
        if not rest:
            return cls(Span(), first, "", False)
        *middle, last = rest
        return cls(lines_span([line_counts(a, line) for line in middle]), first, last, True)

    def merge(self, a: B.Analyzer, other: "Partial") -> "Partial":
        """This piece followed by another."""
        if not self.whole and not other.whole:
            return Partial(self.span, self.head + other.head, "", False)
        if not self.whole:
            return Partial(other.span, self.head + other.head, other.tail, True)
        if not other.whole:
            return Partial(self.span, self.head, self.tail + other.head, True)
        between = Span.of_line(*line_counts(a, self.tail + other.head))
        return Partial(self.span.then(between).then(other.span), self.head, other.tail, True)

    def close(self, a: B.Analyzer) -> list[int]:
        """The counts of a document whose both ends are reached."""
        span = Span.of_line(*line_counts(a, self.head))
        if self.whole:
            span = span.then(self.span).then(Span.of_line(*line_counts(a, self.tail)))
        return span.closed()


def lines_span(lines: list[tuple[list[int], int, int]]) -> Span:
    """One span over lines in order, in a single pass."""
    out = Span()
    total, lead, n = out.counts, out.lead_counts, len(COUNTS)
    state, open_ = NONE, True
    for c, furn, kind in lines:
        short = furn == 0 and kind in (B.SHORT, B.ITEM)
        titles = False
        if furn >= 0:
            if open_ and short and out.lead in (0, kind):
                out.lead = kind
                for i in range(_BODY, n):
                    lead[i - _BODY] += c[i]
            elif open_:
                open_ = False
                state = HEADED if furn == 2 else NONE
            elif short and state in (HEADED, kind):
                titles, state = True, kind
            else:
                state = HEADED if furn == 2 else NONE
        for i in range(_BODY if titles else n):
            total[i] += c[i]
    out.open, out.end = open_, NONE if open_ else state
    return out


def page_counts(page: B.Page) -> list[int]:
    """The counts from ``body`` on of a page that was read whole; the same as its merged chunks give."""
    c = [0] * (len(COUNTS) - _BODY)
    state, short, item = NONE, B.SHORT, B.ITEM
    for x, furn, kind, words, stops, ends in page.got:
        if furn > 0:
            state = HEADED if furn == 2 else NONE
        elif furn == 0:
            if state and (kind == short or kind == item) and (state == HEADED or state == kind):
                state = kind
                continue
            state = NONE
            c[0] += 1
            c[1] += words
            c[2] += stops
            c[3] += ends
            c[3 + kind] += len(x)
    return c


def tree(a: B.Analyzer, parts: list[Partial]) -> Partial:
    """Merges neighbours pairwise until one is left."""
    while len(parts) > 1:
        parts = [parts[i].merge(a, parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


_PART = "id long, h long, piece int, counts array<int>, head string, tail string, whole boolean"
_PART_ARROW = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("piece", pa.int32()), ("counts", pa.list_(pa.int32())), ("head", pa.string()), ("tail", pa.string()), ("whole", pa.bool_())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in _PART_ARROW]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, _PART_ARROW)], schema=_PART_ARROW)


def text_counts(df: DataFrame, words: list[str], chunk: int = CHUNK, fan_in: int = FAN_IN, restore: bool = False) -> DataFrame:
    """(id, text) to (id, counts) for every row with a non-NULL text; with ``restore`` wrongly decoded text is restored first.

    Texts of one chunk are counted in place without a shuffle.  Longer ones are
    cut, their chunks counted wherever they land, and merged over as many rounds
    as the longest text needs, at most ``fan_in`` pieces in one group.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = pages.analyzer(words)
        for b in batches:
            rows = []
            for i, h, piece, single, text in zip(*(b.column(k) for k in range(5))):
                t, one = text.as_py(), single.as_py()
                p = Partial.of(a, mojibake.repair(t)[0] if one and restore else t)
                rows.append((i.as_py(), h.as_py(), piece.as_py(), p.close(a) if one else p.span.to_list(), p.head if not one else "", p.tail if not one else "", p.whole))
            yield _batch(rows)

    def merge(table: pa.Table) -> pa.Table:
        a = pages.analyzer(words)
        rows = sorted(table.to_pylist(), key=lambda r: r["piece"])
        p = tree(a, [Partial(Span.from_list(r["counts"]), r["head"], r["tail"], r["whole"]) for r in rows])
        return pa.Table.from_batches([_batch([(rows[0]["id"], rows[0]["h"], rows[0]["piece"] // fan_in, p.span.to_list(), p.head, p.tail, p.whole)])])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = pages.analyzer(words)
        for b in batches:
            rows = []
            for r in b.to_pylist():
                p = Partial(Span.from_list(r["counts"]), r["head"], r["tail"], r["whole"])
                rows.append((r["id"], r["h"], 0, p.close(a), "", "", True))
            yield _batch(rows)

    df = df.where("text is not null")
    n = F.length("text")
    short = df.where(n <= chunk).select("id", F.lit(0).cast("long").alias("h"), F.lit(0).alias("piece"), F.lit(True).alias("single"), "text").mapInArrow(count, _PART).select("id", "counts")
    long, copies = cuts.cut(df, "id", "text", chunk, (lambda t: mojibake.repair(t)[0]) if restore else None)
    parts = long.select("id", "h", "piece", F.lit(False).alias("single"), "text").mapInArrow(count, _PART)
    # three rounds of 64 hold 64 ** 3 * 65,536 characters, more than one string can have
    for _ in range(3):
        parts = parts.groupBy("id", "h", (F.floor(F.col("piece") / fan_in)).alias("g")).applyInArrow(merge, _PART)
    return short.unionByName(cuts.repeat(parts.mapInArrow(close, _PART).select("id", "h", "counts"), copies, "id").select("id", "counts"))


#: a body of so many characters is judged; less prose, fewer sentence ends or common words than these make it no prose
LEAST_BODY, LEAST_PROSE, LEAST_ENDED, LEAST_COMMON = 60, 0.4, 0.6, 0.45


def not_prose(c: list[int]) -> bool:
    """The outcome of the rules for counts from ``body`` on: a list, a table or junk.

    Prose is told by any of three signs: its share of the characters, the share
    of lines that end like sentences, or the share of common words.
    """
    body, words, common, ended, prose, *others = c
    shaped = prose + sum(others)
    return shaped >= LEAST_BODY and prose < LEAST_PROSE * shaped and ended < LEAST_ENDED * body and common < LEAST_COMMON * max(words, 1)


def ratios(counts: DataFrame, key: str = "id") -> DataFrame:
    """The statistics of the counts and the outcomes of the rules (few_sentences, few_common, little_prose, not_prose); zero denominators give 0."""
    c = {n: F.col("counts")[i] for i, n in enumerate(COUNTS)}
    div = lambda x, y: F.when(y > 0, F.round(x / y, 4)).otherwise(F.lit(0.0))
    shaped = c["prose"] + c["item"] + c["row"] + c["junk"] + c["link"] + c["short"]
    little = c["prose"] < LEAST_PROSE * shaped
    few_ended = c["body_ended"] < LEAST_ENDED * c["body"]
    few_common = c["body_common"] < LEAST_COMMON * F.greatest(c["body_words"], F.lit(1))
    return counts.select(
        key,
        c["words"].cast("long").alias("words"),
        div(c["word_chars"], c["words"]).alias("mean_word_length"),
        div(c["symbols"], c["words"]).alias("symbol_ratio"),
        div(c["ended"], c["lines"]).alias("ended_share"),
        div(c["common"], c["words"]).alias("common_share"),
        div(c["letters"], c["chars"]).alias("letter_share"),
        div(c["digits"], c["chars"]).alias("digit_share"),
        div(c["bullets"], c["lines"]).alias("bullet_share"),
        div(c["prose"], shaped).alias("prose_share"),
        few_ended.alias("few_sentences"),
        few_common.alias("few_common"),
        little.alias("little_prose"),
        ((shaped >= LEAST_BODY) & little & few_ended & few_common).alias("not_prose"),
    )


def p7_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and rule outcomes of every text, stored as it is; NULL texts have none, empty ones zeros.  The stored text_length is not used."""
    df = read_table(spark, sf_dir, "extracted_text").select(F.col("seq").alias("id"), "text")
    return ratios(text_counts(spread(df), pages.words_of(spark, sf_dir))).withColumnRenamed("id", "seq")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq of the pages whose body is a list, a table or junk, and of all spam pages.

    Decided by the rules on the merged counts of each text, wrong decoding
    restored first.  Dead, blank and NULL texts are no cases.
    """
    words = pages.words_of(spark, sf_dir)
    prof = durable(pages.profile(pages.pages(spark, sf_dir), words, frozenset({"dead", "spam", "counts"})))
    # texts of one chunk were counted while they were at hand, longer ones are cut and merged
    one = prof.where("counts is not null").select("seq", F.concat(F.array_repeat(F.lit(0), _BODY), "counts").alias("counts"))
    long = read_table(spark, sf_dir, "extracted_text").where(F.length("text") > CHUNK).select(F.col("seq").alias("id"), "text")
    merged = text_counts(long, words, restore=True).withColumnRenamed("id", "seq").join(prof.where("not dead").select("seq"), "seq", "left_semi")
    stats = ratios(one.unionByName(merged), "seq").where("not_prose").select("seq")
    return stats.unionByName(pages.with_spam(prof).where("spam").select("seq")).distinct()
