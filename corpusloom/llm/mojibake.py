"""Text decoded with the wrong encoding: find the spans, restore what can be restored.

For every pair (written in A, read as B) the garbled forms of the characters A
can write are computed beforehand and put into one multi-pattern automaton.  A
field is scanned once; adjacent matches that one pair explains form a run, and
only accepted runs are replaced, so correct text beside them stays as it is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table, spread

#: (written in, read as, kind): "seq" one character became several, "multi" a
#: two-byte character became two, "letter" each letter became another letter
PAIRS = (
    ("utf-8", "cp1252", "seq"),
    ("utf-8", "latin-1", "seq"),
    ("utf-8", "cp437", "seq"),
    ("utf-8", "cp1251", "seq"),
    ("utf-8", "mac_roman", "seq"),
    ("utf-8", "cp1250", "seq"),
    ("utf-8", "cp850", "seq"),
    ("utf-8", "koi8-r", "seq"),
    ("gbk", "cp1252", "multi"),
    ("shift_jis", "cp1252", "multi"),
    ("euc-kr", "cp1252", "multi"),
    ("big5", "cp1252", "multi"),
    ("cp1251", "cp1252", "letter"),
    ("koi8-r", "cp1252", "letter"),
    ("koi8-r", "cp1251", "letter"),
    ("cp1251", "koi8-r", "letter"),
)
_CYRILLIC = "абвгдежзийклмнопрстуфхцчшщъыьэюяё"


def misread(raw: bytes, wrong: str) -> str:
    """The bytes read in the wrong encoding; bytes it lacks become C1 controls, as in browsers."""
    out = []
    for b in raw:
        try:
            out.append(bytes([b]).decode(wrong))
        except UnicodeDecodeError:
            out.append(chr(b))
    return "".join(out)


def _western() -> str:
    """Letters and punctuation of the scripts that single bytes can't write in UTF-8."""
    return "".join(map(chr, [*range(0xA1, 0x180), *range(0x2010, 0x2027), 0x2030, 0x2039, 0x203A, 0x20AC, 0x2122, 0xA0]))


def _rows(encoding: str, leads: range, trails: range) -> str:
    """The characters of a two-byte encoding in the given rows."""
    out = []
    for a in leads:
        for b in trails:
            try:
                c = bytes([a, b]).decode(encoding)
            except UnicodeDecodeError:
                continue
            if len(c) == 1:
                out.append(c)
    return "".join(out)


@lru_cache(1)
def _repertoires() -> dict[str, str]:
    kana = "".join(map(chr, [*range(0x3041, 0x3097), *range(0x30A1, 0x30FD)]))
    punct = "、。「」『』・：；，！？（）“”‘’—…"
    hanzi = _rows("gbk", range(0xB0, 0xF8), range(0xA1, 0xFF)) + _rows("gbk", range(0xA1, 0xA4), range(0xA1, 0xFF))
    kanji = _rows("shift_jis", range(0x88, 0x98), range(0x40, 0xFD))
    big5 = _rows("big5", range(0xA1, 0xC7), [*range(0x40, 0x7F), *range(0xA1, 0xFF)])
    hangul = _rows("euc-kr", range(0xB0, 0xC9), range(0xA1, 0xFF))
    cyr = _CYRILLIC + _CYRILLIC.upper()
    every = "".join(dict.fromkeys(_western() + cyr + kana + punct + hanzi + kanji + hangul))
    return {"utf-8": every, "gbk": hanzi + kana + "–—‘’“”…·é×÷°", "shift_jis": kana + punct + kanji, "euc-kr": hangul + "、。「」", "big5": big5, "letter": cyr}


@lru_cache(1)
def automaton() -> tuple[ahocorasick.Automaton, list[dict[str, str]]]:
    """The automaton, its values being bit sets of pairs; and by pair the originals of the garbled forms."""
    masks: dict[str, int] = {}
    back: list[dict[str, str]] = []
    reps = _repertoires()
    for k, (a, b, kind) in enumerate(PAIRS):
        forms: dict[str, str] = {}
        if kind == "letter":
            low = {c: misread(c.encode(a), b) for c in reps["letter"]}
            for x in _CYRILLIC:
                for y in _CYRILLIC:
                    for u, v in ((x, y), (x.upper(), y), (x.upper(), y.upper())):
                        forms.setdefault(low[u] + low[v], u + v)
            back.append({low[c]: c for c in low})
        else:
            for c in reps[a]:
                try:
                    g = misread(c.encode(a), b)
                except UnicodeEncodeError:
                    continue
                if len(g) > 1 and not g.isascii():
                    forms.setdefault(g, c)
            back.append(forms)
        for g in forms:
            masks[g] = masks.get(g, 0) | 1 << k
    auto = ahocorasick.Automaton()
    for g, m in masks.items():
        auto.add_word(g, (len(g), m))
    auto.make_automaton()
    return auto, back


_SEQ = sum(1 << k for k, p in enumerate(PAIRS) if p[2] == "seq")
_MULTI = sum(1 << k for k, p in enumerate(PAIRS) if p[2] == "multi")
_LETTER = sum(1 << k for k, p in enumerate(PAIRS) if p[2] == "letter")
#: characters that garbled text always has: without one of them a field is clean
_OTHER = re.compile("[\u0080-ÿŒ-ƒˆ-˝ΐ-ωЂ-ґ€™←-◿ﬁﬂ�]")
_HINT = re.compile("[\u0080-ÿŒ-ƒˆ-˝ΐ-ωЂ-ґ€™←-◿ﬁﬂ�぀-ヿ一-鿿가-힯｡-ﾟ]")
_EAST = re.compile("[぀-ヿ一-鿿가-힯｡-ﾟ]")
_QUOTES = "”’»“‘«–—…·"
_LATIN_RUN = re.compile("[¨¸À-ÿ]{3,}")


def _decode(run: str, k: int, back: dict[str, str]) -> str:
    if PAIRS[k][2] == "letter":
        return "".join(back.get(c, c) for c in run)
    out, i = [], 0
    while i < len(run):
        for n in (4, 3, 2):
            c = back.get(run[i : i + n])
            if c is not None:
                out.append(c)
                i += n
                break
        else:
            out.append(run[i])
            i += 1
    return "".join(out)


def _runs(s: str) -> list[tuple[int, int, int, int]]:
    """(from, to, pairs that explain all of it, number of forms) of each run of adjacent forms."""
    auto, _ = automaton()
    runs: list[list[int]] = []
    for end, (n, mask) in auto.iter_long(s):
        a = end - n + 1
        if runs and runs[-1][1] == a and runs[-1][2] & mask:
            r = runs[-1]
            r[1], r[2], r[3] = a + n, r[2] & mask, r[3] + 1
        else:
            runs.append([a, a + n, mask, 1])
    return [tuple(r) for r in runs]


def _once(s: str) -> tuple[str, bool]:
    _, back = automaton()
    out, at, hit = [], 0, False
    letters = [0] * len(PAIRS)
    found = _runs(s)
    # pairs that a form of more than two characters, or a chain of forms, shows beyond doubt in this line
    sure = 0
    for a, b, mask, count in found:
        if mask & _SEQ and (count > 1 or b - a > 2):
            sure |= mask & _SEQ
    for a, b, mask, count in found:
        run = s[a:b]
        k = -1
        for i in range(len(PAIRS)):
            if mask & _LETTER & 1 << i:
                letters[i] += b - a
        if mask & _SEQ:
            m = mask & _SEQ
            k = (m & -m).bit_length() - 1
            if count == 1 and b - a == 2 and not (m & sure and PAIRS[k][1] == "cp1251") and not _plausible(s, a, b, PAIRS[k][1]):
                k = -1
        elif mask & _MULTI and count >= 2 and b - a >= 4 and not (mask & _LETTER and _russian("".join(_LATIN_RUN.findall(s)), back)):
            m = mask & _MULTI
            k = max((i for i in range(len(PAIRS)) if m >> i & 1), key=lambda i: (_common(run, i, back[i]), -i))
            if not _common(run, k, back[k]):
                k = -1
        if k >= 0:
            out += [s[at:a], _decode(run, k, back[k])]
            at, hit = b, True
    if hit:
        return "".join(out) + s[at:], True
    # letters read as other letters: long runs without any plain letter among them
    if any(letters):
        m = "".join(_LATIN_RUN.findall(s))
        if len(m) >= 3 and (g := _russian(m, back)):
            return re.sub("[¨¸À-ÿ]+", lambda x: _decode(x[0], g[1], back[g[1]]), s), True
        m, mixed = "".join(_CAPITALS.findall(s)), bool(_MIXED.search(s))
        if (len(m) >= 5 or mixed) and (k := _swapped(m, back, mixed)) is not None:
            return re.sub("[Ѐ-ӿ╦╠№]+", lambda x: _decode(x[0], k, back[k]), s), True
    return s, False


#: Russian letters under the wrong one of its single-byte encodings: small letters become capitals
_CAPITALS = re.compile("[А-ЯЁ╦╠ЈЃЂЄІЇЎҐ]{2,}|(?<=[а-яё])[╦Ј][А-ЯЁ]+")

_MIXED = re.compile("(?<![Ѐ-ӿ])[а-яё][А-ЯЁ╦Ј]{2,}")


def _latin(s: str) -> bool:
    """Whether a line is written in plain letters but for a few others."""
    return sum(c.isascii() and c.isalpha() for c in s) > 3 * sum(c > "\u02ff" for c in s)


def _plausible(s: str, a: int, b: int, wrong: str) -> bool:
    """Whether a single two-character form is garbled text and not a capital beside a quotation mark."""
    first, second = s[a], s[a + 1]
    before, after = s[a - 1] if a else " ", s[b] if b < len(s) else " "
    if wrong == "cp1251":
        latin = before.isascii() and before.isalpha() or after.isascii() and after.isalpha() or _latin(s)
        return latin or not (second.isalpha() or second in _QUOTES)
    if second in _QUOTES:
        return not (before.isalpha() and before.isupper()) and first in "ÃÂÅÄÐÑÎÏâ├┬Γ╨╤√¬"
    return first in "ÃÂÅÄÆÇÐÑÎÏ├┬┼─╨╤√¬ƒ≈∆–—ÐпяΓ" or not first.isalpha()


#: what a lone East Asian character may stand for
_WEST = frozenset(_western() + _CYRILLIC + _CYRILLIC.upper())
_CJK_RUN = re.compile("[぀-ヿ一-鿿가-힯｡-ﾟ㐀-䶿ㄅ-ㄩ豈-﫿\ue000-\uf8ff！-～、。・ゞ々〆〇]+[!-~]?")


def _as_utf8(s: str) -> tuple[str, bool]:
    """UTF-8 read in an East Asian encoding: runs whose bytes are valid UTF-8 again."""
    hit = False

    def one(m: re.Match) -> str:
        nonlocal hit
        run = m[0]
        for wrong in ("gb18030", "shift_jis", "cp949", "big5"):
            try:  # most runs fail at their first character
                head = run[:2].encode(wrong)
                if not (0xC2 <= head[0] < 0xF5 and 0x80 <= head[1] < 0xC0):
                    continue
            except (UnicodeError, IndexError):
                continue
            for cut in (0, 1):
                part = run[: len(run) - cut] if cut else run
                try:
                    text = part.encode(wrong).decode("utf-8")
                except UnicodeError:
                    continue
                if text.isascii() or len(text) >= len(part.encode(wrong)):
                    continue
                east = sum(c > "\u2e7f" for c in part)
                before, after = s[m.start() - 1 : m.start()], s[m.end() : m.end() + 1]
                near = (before.isascii() and before.isalpha()) or (after.isascii() and after.isalpha()) or (part[-1:].isascii() and part[-1:].isalpha())
                if east >= 3 or (near or _latin(s)) and all(c.isascii() or c in _WEST for c in text):
                    hit = True
                    return text + run[len(part) :]
        return run

    return _CJK_RUN.sub(one, s), hit


def _common(run: str, k: int, back: dict[str, str]) -> int:
    """How much of a run of a two-byte encoding becomes frequent characters: kana, hangul, or the first level of the hanzi."""
    text = _decode(run, k, back)
    a = PAIRS[k][0]
    n = 0
    for c in text:
        if a == "shift_jis":
            n += 2 * ("぀" <= c <= "ヿ") + ("一" <= c <= "鿿") + (c in "、。「」・")
        elif a == "euc-kr":
            n += 2 * ("가" <= c <= "힯")
        elif a == "gbk":
            try:
                n += 2 * (0xB0 <= c.encode("gb2312")[0] <= 0xD7 and c > "一") + (c in "，。“”：、")
            except UnicodeEncodeError:
                pass
        elif "一" <= c <= "鿿":
            n += 1
    return n


_VOWELS = frozenset("аеиоуыэюяё")


def _russian(run: str, back: list[dict[str, str]]) -> tuple[int, int] | None:
    """The pair under which accented letters become Russian ones, by the share of vowels and of frequent consonants."""
    best = None
    for k, (_, b, kind) in enumerate(PAIRS):
        if kind != "letter" or b != "cp1252":
            continue
        text = _decode(run, k, back[k])
        low = sum(c.islower() for c in text)
        v = sum(c in _VOWELS for c in text.lower())
        f = sum(c in "оеаинтсрвл" for c in text.lower())
        if text and 0.25 <= v / len(text) <= 0.62 and f > 0.45 * len(text) and low > 0.5 * len(text) and (best is None or f > best[0]):
            best = (f, k)
    return best


def _likely(text: str) -> float:
    """How much a run of Cyrillic letters looks like Russian: frequent letters less rare ones, by length."""
    t = text.lower()
    return (sum(c in "оеаинтсрвлк" for c in t) - 1.2 * sum(c in "щъфцэюхшчжѓђљњјћџґєіїў╦╠" for c in t)) / max(len(t), 1)


def _swapped(run: str, back: list[dict[str, str]], mixed: bool) -> int | None:
    """The Cyrillic pair that makes likely Russian in small letters of an unlikely run, or of words that begin small and go on in capitals."""
    best = None
    for k, (_, b, kind) in enumerate(PAIRS):
        if kind == "letter" and b != "cp1252":
            text = _decode(run, k, back[k])
            v = sum(c in _VOWELS for c in text.lower())
            if 0.2 * len(text) <= v <= 0.65 * len(text) and sum(map(str.islower, text)) >= 0.6 * len(text):
                f = _likely(text)
                if (mixed or f >= 0.2 and f > _likely(run) + 0.25) and (best is None or f > best[0]):
                    best = (f, k)
    return best[1] if best else None


def repair(s: str | None) -> tuple[str | None, bool]:
    """(text with garbled spans restored, whether any was found).

    NULL and empty texts are clean; U+FFFD marks a loss that nothing restores,
    and counts as found.
    """
    if not s or s.isascii() or not _HINT.search(s):
        return s, False
    hit = "�" in s
    out = []
    for line in s.split("\n"):
        if not line.isascii() and _HINT.search(line):
            for _ in range(3):
                line, again = _once(line) if _OTHER.search(line) else (line, False)
                if not again and _EAST.search(line):
                    line, again = _as_utf8(line)
                if not again:
                    break
                hit = True
        out.append(line)
    return "\n".join(out), hit


def repaired(df: DataFrame) -> DataFrame:
    """(seq, title, text) to (seq, field, fixed) for each field that was found garbled; ``fixed`` has the spans restored that can be.

    NULL and empty fields are clean.  Only affected fields leave the pass.
    """
    schema = pa.schema([("seq", pa.int64()), ("field", pa.string()), ("fixed", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for seq, title, text in zip(*(b.column(k) for k in range(3))):
                for name, value in (("title", title), ("text", text)):
                    fixed, hit = repair(value.as_py())
                    if hit:
                        rows.append((seq.as_py(), name, fixed))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows) if rows else [[]] * 3, schema)], schema=schema)

    return spread(df.select("seq", "title", "text")).mapInArrow(run, "seq long, field string, fixed string")


def p4_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, field and restored value of each garbled title or text."""
    return repaired(read_table(spark, sf_dir, "extracted_text"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, field) of each title or text that was, wholly or in part, decoded wrongly."""
    return p4_fixed(spark, sf_dir).select("seq", "field").distinct()


def p4_lossy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Affected fields by whether something stays lost (U+FFFD) after repair."""
    return p4_fixed(spark, sf_dir).groupBy("field", F.contains("fixed", F.lit("\ufffd")).alias("lossy")).agg(F.count("*").alias("n"))
