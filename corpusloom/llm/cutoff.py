"""Texts cut off by a field limit or a broken transfer.

A stack automaton reads the whole text: what is still open at its end (quotes,
brackets, markup, code), whether a multibyte sequence or an escape breaks off,
and whether the last block ends the way its shape ends.  What one text can't
tell, its source does: what is left open or without a terminator says nothing
where complete texts of the source are like that too, lengths at which open
ends pile up are limits, and last words that only begin a frequent word were
cut.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import durable, read_table, spread
from . import blocks as B
from . import dead, mojibake, pages

WHOLE, OPEN, CUT, SENTENCE, MARKED, UNENDED = 0, 1, 2, 3, 4, 5
#: share of a source's complete texts that leave something open from which that is no sign there; share of its running text that lacks a terminator, likewise; texts such a share is taken over
SLOPPY, LOOSE, BASE_TEXTS = 0.05, 0.6, 10
#: a length is a limit of a source if so many of its different texts end open there, and so many times the spread above what its neighbours lead to expect
LIMIT_ROWS, LIMIT_OUT, LIMIT_NEAR, LIMIT_LEAST = 3, 12.0, 12, 100
#: lengths on either side that count as neighbours, without the nearest LIMIT_NEAR
LIMIT_AROUND = 64
#: a last word is a cut one if a longer word of this start is so much more frequent
CUT_FACTOR, CUT_LEAST = 8, 6
#: letters up to which all starts of a frequent word are listed
LONG = 48
#: a last line is usual if so many different texts end in it, and it has such a share of its source's open ends, or of all of them on as many sources
USUAL_TEXTS, USUAL_OWN, USUAL_ALL = 3, 0.02, 0.002

_MARK = re.compile(r"\s*(?:\[\s?(?:\.\.\.|…)\s?\]|(?:…|\.\.\.)(?:\s*(?:read more|continue reading|weiterlesen|lire la suite|leer más|leia mais|czytaj dalej|читать далее|続きを読む|阅读更多|더 보기))?|\((?:truncated|continued)\)|\[(?:truncated|cut)\])\s*$", re.I)
_ENTITY = re.compile(r"&(?:#x?[0-9a-f]*|[a-z]{1,8})?$|\\(?:u[0-9a-f]{0,3}|x[0-9a-f]?)?$|<[/!]?[a-z][^<>]*$|<!?-{0,2}$", re.I)
_PERCENT = re.compile(r"%[0-9a-f]?$", re.I)
# Closing words before an ellipsis that belong to a complete text.
_CONTINUED = frozenset("to be continued|fortsetzung folgt|à suivre|continuará|continua|ciąg dalszy nastąpi|продолжение следует|つづく|続く|未完待续|待续|다음에 계속|계속".split("|"))
_CLOSERS = {")": "(", "]": "[", "}": "{", "»": "«", "”": "“", "」": "「", "』": "『", "）": "（", "】": "【"}
_OPENERS = frozenset(_CLOSERS.values()) | {"„"}
# Tags that have an end.
_TAGS = "html|head|body|main|nav|header|footer|section|article|aside|div|span|table|tbody|thead|ul|ol|dl|pre|code|blockquote|form|button|select|script|style|svg|figure|h[1-6]|strong|em|b|i|u|a"
#: what the stack automaton reads: fences of code, tags, brackets, directed and plain quotes
_SIGNS = re.compile("```|</?(?:" + _TAGS + ")(?:\\s+[a-z-]+\\s*=[^<>]*)?/?>|[()\\[\\]{}«»“”„\"「」『』（）【】]", re.I)
_RULE = re.compile(r"^[\s*\-_=~·•#.]+$")
_ID = re.compile(r"^\w+(?: id)?:? [0-9a-f]{6,}$")
_CHOICE = re.compile(r"cookie|partners store|クッキー|쿠키|datenschutz|privacy|privacidad|confidential")
#: words before the last one from which a line of furniture is a phrase
PHRASE_WORDS = 4
_SIGNED = re.compile(r"^\s*(?:--|—|–|-)\s?[^\W\d_]")
def unclosed(text: str) -> list[str]:
    """Openers that a text leaves open at its end, outermost first: fences, tags, brackets, quotes.

    A closer takes what was opened after its opener with it; one without an
    opener is passed over, as in lists numbered a) and in breadcrumbs.
    """
    stack: list[str] = []
    for m in _SIGNS.finditer(text):
        c = m[0]
        if c[0] == "<":
            name = c.strip("</> ").split()[0].lower()
            if c.endswith("/>"):
                continue
            closes, c = (f"<{name}>", "") if c[1] == "/" else ("", f"<{name}>")
        elif c in ('"', "```"):
            closes, c = (c, "") if c in stack else ("", c)
        elif c == "“" and "„" in stack:
            closes, c = "„", ""
        elif c in _OPENERS:
            closes = ""
        else:
            closes, c = _CLOSERS[c], ""
        if c:
            stack.append(c)
        elif closes in stack:
            while stack.pop() != closes:
                pass
    return stack


def _cells(line: str) -> tuple[str, int]:
    s = line.strip()
    return max(((d, s.count(d)) for d in (" | ", "|", "\t", ";", ", ", "   ")), key=lambda x: x[1])


def ending(a: B.Analyzer, text: str) -> tuple[int, str, str, bool]:
    """(state, last word in small letters, folded last block, whether something is left open) of a non-blank text."""
    raw = text.rstrip()
    if raw.endswith("�"):
        return CUT, "", "", False
    mark = _MARK.search(raw[-60:])
    body = raw[: max(0, len(raw) - 60) + mark.start()].rstrip() if mark else raw
    body = mojibake.repair(body)[0].rstrip()
    left = bool(unclosed(body))
    # the last block by itself
    line = body.rsplit("\n", 1)[-1]
    x, furn, kind, _, _, _ = a.line(line)
    word = m[0] if (m := re.search(r"[^\W\d_]+$", x)) else ""
    ends = bool(B._STOP_END.search(line))
    if mark:
        if x in _CONTINUED:
            return WHOLE, word, x, False
        return (MARKED if ends or not x else CUT), word, x, left
    if furn in (1, 3) and not ends and (x in B._MENU or B.is_menu(line, x) or _CHOICE.search(x)):
        return WHOLE, word, x, left
    if _ENTITY.search(line) or (kind == B.LINK and _PERCENT.search(line)):
        return CUT, word, x, left
    if _RULE.match(line) or _ID.match(x) or _SIGNED.match(line) and len(x) < 60:
        return WHOLE, word, x, left
    if kind == B.FIXED:
        if ends or not word:
            return WHOLE, word, x, left
        # a phrase of some length doesn't end in a common word
        return (UNENDED if len(word) > 1 and word in a.common and x.count(" ") >= PHRASE_WORDS else OPEN), word, x, left
    if ends and kind in (B.PROSE, B.SHORT):
        return SENTENCE, word, x, left
    covered, rest = dead.left_over(x)
    if covered and rest <= max(0.5 * covered, 12):
        return WHOLE, word, x, left
    if kind == B.PROSE:
        return (WHOLE if x.endswith(":") else UNENDED), word, x, left
    # the blocks before it
    page = a.page(body, "")
    i = len(page.lines) - 1
    prev = next((k for k in range(i - 1, -1, -1) if page.label[k] != B.BLANK), None)
    before = page.kind[prev] if prev is not None else 0
    apart = before == B.FIXED  # after furniture, a short line may be furniture too
    rows = [page.lines[k] for k in range(max(0, i - 6), i) if page.kind[k] == B.ROW]
    d, n = _cells(rows[-1]) if rows else ("", 0)
    if kind == B.ROW or before == B.ROW and n and d in line:
        if len(rows) >= 2 and n and _cells(rows[-2]) == (d, n):
            closed = rows[-1].strip().endswith("|") and not line.strip().endswith("|")
            return (CUT if line.count(d) < n or closed else OPEN), word, x, left
        return OPEN, word, x, left
    if kind == B.SHORT and word:
        words = B._WORD.findall(x)
        stops = sum(w in a.common for w in words)
        if len(words) > 12 and len(set(words)) < 0.6 * len(words):
            return OPEN, "", x, left  # keywords over and over
        prose = before == B.PROSE
        if len(words) >= 12 and stops >= 0.15 * len(words) and not apart:
            return UNENDED, word, x, left  # longer than any heading
        if x.endswith(",") or len(words) >= 2 and words[-1] in a.common and not apart or len(words) >= 2 and words[-1] in a.common and len(words) > 4:
            return CUT, word, x, left
        if prose and (stops >= 1 and len(words) >= 4 or B._CJK.search(x) and len(x) > 14):
            return UNENDED, word, x, left
        if prose and (stops >= 1 or any(map(str.isdigit, x))):
            return OPEN, word + "\n" * (len(words) <= 7), x, left  # a heading or the start of a sentence: the corpus knows
    if kind == B.SHORT and x.endswith(","):
        return CUT, word, x, left
    if before == kind and kind == B.JUNK and prev is not None and _tail(page.lines[prev]) and not _tail(line) and line.strip()[-1:] != page.lines[prev].strip()[-1:]:
        return CUT, word, x, left
    return OPEN, word, x, left


def _tail(line: str) -> bool:
    """Whether a line of code or data ends with a closer."""
    return line.rstrip()[-1:] in "})];>"


_SCHEMA = "kind int, doc_id long, source string, n long, bytes long, state int, word string, line long, same_text long, left boolean, count long"
_ARROW = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("source", pa.string()), ("n", pa.int64()), ("bytes", pa.int64()), ("state", pa.int32()), ("word", pa.string()), ("line", pa.int64()), ("same_text", pa.int64()), ("left", pa.bool_()), ("count", pa.int64())])
_TOKEN = re.compile(r"[^\W\d_]+")


def endings(df: DataFrame, words: list[str]) -> DataFrame:
    """One pass over (doc_id, source, text): a row of kind 0 for each non-blank text, and the words of each batch with their counts as rows of kind 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = pages.analyzer(words)
        seen: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            got = [(1, None, None, None, None, None, w, None, None, None, c) for w, c in seen.items() if c > 0]
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*got) if got else [[]] * len(_ARROW), _ARROW)], schema=_ARROW)

        for b in batches:
            rows = []
            for doc, source, text in zip(*(b.column(k) for k in range(3))):
                t = text.as_py()
                if pages.is_blank(t):
                    continue
                state, word, x, left = ending(a, t)
                seen.update(_TOKEN.findall(t.lower()))
                if word:
                    seen[word] -= 1  # what may be cut is no evidence of a word
                raw = t.encode("utf-8", "surrogatepass")
                rows.append((0, doc.as_py(), source.as_py(), len(t), len(raw), state, word, hash_line(x), xxhash.xxh64_intdigest(raw) - (1 << 63), left, None))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(_ARROW), _ARROW)], schema=_ARROW)
            if len(seen) > 200_000:
                yield flush()
        yield flush()

    return spread(df.select("doc_id", "source", "text")).mapInArrow(run, _SCHEMA)


def hash_line(x: str) -> int:
    return xxhash.xxh64_intdigest(re.sub(r"\d+", "0", x)) - (1 << 63)


def _limits(ends: DataFrame, size: str) -> DataFrame:
    """(source, length, pile): the lengths whose pile of open ends stands out against those around it, as many as there are."""
    piles = ends.where(F.col(size) >= LIMIT_LEAST).groupBy("source", F.col(size).alias("length")).agg(F.countDistinct("same_text").alias("pile"))
    w = Window.partitionBy("source").orderBy("length")
    around = F.sum("pile").over(w.rangeBetween(-LIMIT_AROUND, LIMIT_AROUND)) - F.sum("pile").over(w.rangeBetween(-LIMIT_NEAR, LIMIT_NEAR))
    usual = (around + 1) / (2 * (LIMIT_AROUND - LIMIT_NEAR))
    return piles.withColumn("usual", usual).where((F.col("pile") >= LIMIT_ROWS) & (F.col("pile") >= F.col("usual") + LIMIT_OUT * F.sqrt("usual"))).drop("usual")


def judge(found: DataFrame) -> DataFrame:
    """(doc_id, source, n, cut, at_limit) of each non-blank text from the rows of ``endings``."""
    docs = found.where("kind = 0")
    # sources whose complete texts leave things open, or whose running text goes without terminators: by different texts
    ended, unended = F.col("state").isin(SENTENCE, WHOLE), F.col("state") == UNENDED
    texts = docs.select("source", "same_text", "state", "left").distinct()
    usage = texts.groupBy("source").agg(F.count_if(ended).alias("complete"), F.count_if(ended & F.col("left")).alias("complete_left"), F.count_if(F.col("state") == SENTENCE).alias("stopped"), F.count_if(unended).alias("unended"))
    sloppy = (F.col("complete") >= BASE_TEXTS) & (F.col("complete_left") > SLOPPY * F.col("complete"))
    loose = (F.col("stopped") + F.col("unended") >= BASE_TEXTS) & (F.col("unended") > LOOSE * (F.col("stopped") + F.col("unended")))
    usage = usage.select(F.col("source").alias("_usage"), sloppy.alias("sloppy"), loose.alias("loose"))
    docs = docs.join(usage, F.col("source").eqNullSafe(F.col("_usage")), "left").drop("_usage")
    docs = durable(docs.withColumn("state", F.when(unended, F.when(F.col("loose"), OPEN).otherwise(CUT)).otherwise(F.col("state"))).withColumn("left", F.col("left") & ~F.col("sloppy")).drop("sloppy", "loose"))
    # words and the most frequent longer word of each start, by equal keys only: starts of up to LONG letters, and for longer last words those of LONG
    counts = found.where("kind = 1").groupBy("word").agg(F.sum("count").alias("c"))
    frequent = counts.where((F.length("word") > 3) & (F.col("c") >= CUT_LEAST))
    starts = frequent.select(F.explode(F.transform(F.sequence(F.lit(3), F.least(F.length("word") - 1, F.lit(LONG))), lambda k: F.col("word").substr(F.lit(1), k))).alias("word"), "c").groupBy("word").agg(F.max("c").alias("longer"))
    asked = docs.where((F.col("state") == OPEN) & (F.length("word") > LONG)).select(F.rtrim(F.regexp_replace("word", "\n", "")).alias("w")).distinct()
    head = lambda x: F.substring(x, 1, LONG)
    far = asked.join(frequent.where(F.length("word") > LONG), head("w") == head("word")).where(F.startswith("word", "w") & (F.length("word") > F.length("w"))).groupBy(F.col("w").alias("word")).agg(F.max("c").alias("longer"))
    known = starts.unionByName(far).groupBy("word").agg(F.max("longer").alias("longer")).join(counts, "word", "left").select("word", "longer", F.coalesce("c", F.lit(0)).alias("own"))
    open_docs = docs.where(F.col("state") == OPEN).withColumn("start", F.col("word").endswith("\n")).withColumn("word", F.rtrim(F.regexp_replace("word", "\n", "")))
    # different texts, not rows: copies of one cut text don't vouch for each other; shares, so that a larger corpus doesn't make chance meetings usual
    texts = open_docs.select("line", "source", "same_text").distinct()
    own = texts.groupBy("line", "source").agg(F.count("*").alias("own_texts"))
    of_source = texts.groupBy("source").agg(F.countDistinct("same_text").alias("of_source"))
    of_line = texts.groupBy("line").agg(F.countDistinct("same_text").alias("all_texts"), F.countDistinct("source").alias("sources"))
    of_all = texts.agg(F.countDistinct("same_text").alias("of_all"))
    here = own.join(of_source.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).join(of_line, "line").crossJoin(F.broadcast(of_all))
    usual = F.col("source").isNotNull() & (F.col("own_texts") >= USUAL_TEXTS) & (F.col("own_texts") >= USUAL_OWN * F.col("of_source")) | (F.col("all_texts") >= USUAL_TEXTS) & (F.col("sources") >= USUAL_TEXTS) & (F.col("all_texts") >= USUAL_ALL * F.col("of_all"))
    usual_lines = here.where(usual).select(F.col("line").alias("_line"), F.col("source").alias("_source"), F.lit(True).alias("usual"))
    checked = open_docs.join(usual_lines, (F.col("line") == F.col("_line")) & F.col("source").eqNullSafe(F.col("_source")), "left").join(known, "word", "left").withColumn("usual", F.coalesce("usual", F.lit(False)))
    half = (F.length("word") >= 3) & (F.col("longer") >= CUT_FACTOR * (F.coalesce("own", F.lit(0)) + 1)) & (F.col("longer") >= CUT_LEAST)
    by_word = checked.select("doc_id", "same_text", (F.coalesce(half, F.lit(False)) | F.col("start") & ~F.col("usual")).alias("half"), "usual").distinct()
    # lengths at which open ends pile up: in characters or bytes, whichever a source's largest pile is in, then in the other among the texts that are at no such limit
    ends = docs.where(F.col("state").isin(OPEN, CUT) & F.col("source").isNotNull()).select("source", "n", "bytes", "same_text").distinct()
    both = [_limits(ends, size) for size in ("n", "bytes")]
    most = [x.groupBy("source").agg(F.max("pile").alias(name)) for x, name in zip(both, ("c", "b"))]
    by_bytes = most[1].join(most[0], "source", "left").where(F.col("b") > F.coalesce("c", F.lit(0))).select("source")
    first = (both[0].join(by_bytes, "source", "left_anti"), both[1].join(by_bytes, "source", "left_semi"))
    rest = ends.join(first[0].select("source", F.col("length").alias("n")), ["source", "n"], "left_anti").join(first[1].select("source", F.col("length").alias("bytes")), ["source", "bytes"], "left_anti")
    in_chars = first[0].unionByName(_limits(rest.join(by_bytes, "source", "left_semi"), "n"))
    in_bytes = first[1].unionByName(_limits(rest.join(by_bytes, "source", "left_anti"), "bytes"))
    top = in_chars.unionByName(in_bytes).groupBy("source").agg(F.max_by("length", F.struct("pile", "length")).alias("limit"))
    lists = [found.groupBy("source").agg(F.sort_array(F.collect_set("length")).alias(name)) for found, name in ((in_chars, "char_limits"), (in_bytes, "byte_limits"))]
    j = docs.join(by_word, ["doc_id", "same_text"], "left").join(top, "source", "left").join(lists[0], "source", "left").join(lists[1], "source", "left")

    def at(below: int):
        hit = lambda limits, size: F.coalesce(F.exists(limits, lambda x: (F.col(size) <= x) & (F.col(size) >= x - below)), F.lit(False))
        return hit("char_limits", "n") | hit("byte_limits", "bytes")

    near, exact = at(LIMIT_NEAR), at(0)
    cut = (F.col("state") == CUT) | F.coalesce("left", F.lit(False)) | ((F.col("state") == MARKED) & near) | ((F.col("state") == OPEN) & (F.col("half") | exact | (near & ~F.coalesce("usual", F.lit(False)))))
    return j.select("doc_id", "source", "n", F.coalesce(cut, F.lit(False)).alias("cut"), F.coalesce(near, F.lit(False)).alias("at_limit"), "limit", "char_limits", "byte_limits")


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_table(spark, sf_dir, "documents")
    return judge(durable(endings(df, pages.words_of(spark, sf_dir))))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id of the documents whose text was cut in mid-word, mid-sentence or mid-item.

    NULL, empty and blank texts are no cases; a NULL source has no limit of its own.
    """
    return judged(spark, sf_dir).where("cut").select("doc_id").distinct()


def p10_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By source: non-blank texts, cut ones, their share, the limit with the most open ends, and all limits in characters and in bytes; NULL is a source of its own."""
    return judged(spark, sf_dir).groupBy("source").agg(F.count("*").alias("docs"), F.sum(F.col("cut").cast("long")).alias("cut"), F.round(F.avg(F.col("cut").cast("double")), 4).alias("share"), F.max("limit").alias("limit"), F.max("char_limits").alias("char_limits"), F.max("byte_limits").alias("byte_limits"))
