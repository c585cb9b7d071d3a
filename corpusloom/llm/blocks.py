"""Line ("block") analysis of a crawled page, shared by the page operators.

Every block has a length in words, a stop-word density and a link density (the
share of it that entries of menus take up).  Pass one decides the blocks that
speak for themselves: page furniture by link density; body by length and
stop-word density, or as a row of a table.  Where these leave a short block
ambiguous, a known wording of furniture breaks the tie.  Pass two lets what is
still ambiguous inherit: between a page's edge and its body from furniture
around it, elsewhere from the nearest decided neighbours.

Plain Python on one page at a time, called from Arrow batches; nothing here
touches Spark.
"""

from __future__ import annotations

import re
import unicodedata

#: labels of a block
FURNITURE, BODY, AMBIGUOUS, BLANK = 1, 2, 0, 3
#: shapes of a block: what a body block looks like
PROSE, ITEM, ROW, JUNK, LINK, SHORT, FIXED = 1, 2, 3, 4, 5, 6, 7

# Entries of site menus, lower case, by language.
MENU = {
    "en": "home|about us|contact|contact us|news|events|shop|search|sitemap|archive|forum|faq|help|press|careers|gallery|guides|projects|members|downloads|reviews|register|sign in|sign up|log in|login|my account|opening hours|basket (0)|cart|menu|privacy|imprint|terms of use",
    "de": "startseite|über uns|kontakt|aktuelles|termine|galerie|suche|archiv|anmelden|warenkorb (0)|häufige fragen|übersicht|impressum|datenschutz|agb|hilfe|presse",
    "fr": "accueil|à propos|contact|actualités|événements|galerie|rechercher|connexion|boutique|plan du site|panier (0)|mentions légales|confidentialité|archives|aide",
    "es": "inicio|quiénes somos|contacto|noticias|eventos|galería|buscar|iniciar sesión|tienda|mapa del sitio|aviso legal|política de privacidad|ayuda",
    "pt": "início|quem somos|contato|notícias|eventos|galeria|pesquisar|entrar|loja|mapa do site|termos de uso|privacidade|ajuda",
    "pl": "strona główna|o nas|kontakt|aktualności|wydarzenia|galeria|szukaj|zaloguj się|sklep|mapa strony|mapa witryny|regulamin|prywatność|polityka prywatności",
    "ru": "главная|о нас|контакты|новости|события|галерея|поиск|войти|магазин|карта сайта|условия использования|конфиденциальность",
    "ja": "ホーム|会社概要|お問い合わせ|お知らせ|イベント|検索|ログイン|サイトマップ|利用規約|プライバシー|ギャラリー",
    "zh": "首页|关于我们|联系我们|新闻|活动|搜索|登录|网站地图|使用条款|隐私政策|商店",
    "ko": "홈|회사 소개|문의하기|소식|행사|검색|로그인|사이트맵|이용약관|개인정보처리방침|갤러리",
}
# Headings above lists of other pages.
RELATED = (
    "recent posts|related articles|related posts|readers also viewed|more from this section|you might also like|most read this week|most read|"
    "mehr zum thema|à lire aussi|también te puede interesar|leia também|zobacz także|читайте также|関連記事|相关文章|관련 기사"
)
# Wordings of page furniture (patterns over the folded block; they cover it whole).
WORDINGS = (
    # menus, paging, page tools
    r"back to top", r"skip to \w+", r"text size.{0,12}", r"language: .{0,80}", r"sort by: .{0,60}", r"[\d ]+\.{3} ?\d+ next page", r"next page", r"previous: .{1,140}", r"next: .{1,140}",
    r"you are here: .{1,160}", r"filed under .{1,160}", r"tags: .{1,160}", r"categories: .{1,160}", r"posted in .{1,160}", r"click here to print.{0,40}", r"report a problem with this page.?", r"popular topics", r"home ?[»›>/] .{1,160}",
    r"nach oben", r"haut de page", r"volver arriba", r"voltar ao topo", r"do góry", r"наверх", r"ページの先頭へ|トップへ戻る", r"返回顶部|回到顶部", r"맨 위로|위로",
    # consent
    r"we use cookies .{0,160}", r"this site stores small files .{0,120}", r"cookie preferences", r"necessary cookies are always on\.?", r"save my choices", r"your privacy matters to .{0,160}", r".{0,60}and \d+ partners store and read .{0,120}",
    r"wir verwenden cookies.{0,160}", r"datenschutzeinstellungen.{0,120}", r".{1,60}utilise des cookies .{0,120}", r"gérer mes préférences de confidentialité", r"continuer sans accepter", r"utilizamos cookies .{0,160}", r"configuración de privacidad.{0,120}",
    r"usamos cookies .{0,160}", r"gerenciar preferências de privacidade", r"strona .{1,60} używa plików cookie.{0,80}", r"ustawienia prywatności", r"сайт .{1,60} использует файлы cookie.{0,80}", r"настройки конфиденциальности",
    r".{0,40}(?:クッキー|cookie ?)を使用.{0,40}", r".{0,30}使用 ?cookie.{0,40}", r".{0,30}쿠키를 사용.{0,40}",
    # bylines and dates
    r"posted by .{1,50} on \d.{4,24}", r"written by .{1,50}, .{1,70} staff", r"by .{1,50} \| \d+ min read", r"words and pictures: .{1,50}", r"[^\W\d][\w' .-]{2,40}, editor", r"updated \d.{3,24}", r"published (?:on )?\d.{3,24}",
    r"von .{1,50}, redaktion .{1,70}", r"par .{1,50}, rédaction d.{1,70}", r"por .{1,50}, redacción d.{1,70}", r"por .{1,50}, redação d.{1,70}", r"autor: .{1,50}, redakcja .{1,70}", r"автор: .{1,50}, редакция .{1,70}", r"(?:文|作者|글) ?[:：] ?.{1,50}",
    # share and sign-up prompts, comments
    r"share this:?.{0,40}", r"share this page.{0,60}", r"tell a friend about .{1,70}", r"follow .{1,70} for more stories.{0,40}", r"subscribe to .{1,120}", r"enter your email address.{0,80}", r"support .{1,70} with a small donation\.?",
    r"did you like this article\?.{0,60}", r"leave a comment below.{0,80}", r"\d+ comments?", r"log in to reply.{0,80}",
    r"diesen artikel teilen", r"newsletter von .{1,70} abonnieren", r"folgen sie .{1,70}", r"partager cet article", r"s'abonner à la lettre de .{1,70}", r"suivez .{1,70}", r"compartir este artículo", r"suscríbete al boletín de .{1,70}", r"siga a .{1,70}", r"sigue a .{1,70}",
    r"compartilhar este artigo", r"assine o boletim de .{1,70}", r"udostępnij ten artykuł", r"zapisz się do newslettera .{1,70}", r"obserwuj .{1,70}", r"поделиться статьёй", r"подпишитесь на рассылку .{1,70}", r"この記事を共有する", r"分享这篇文章", r"이 기사 공유하기",
    # author, site and legal notes
    r"about the author: .{1,200}", r"read also: .{1,140}", r"powered by .{1,120}", r"©.{1,140}", r"\(c\) \d{4}.{1,140}", r"copyright (?:©? ?\d{4}|©).{1,140}", r"registered office: .{1,140}", r"no part of these pages may be reproduced .{1,140}", r"prices include tax .{0,100}",
    r".{1,70} accepts no liability for .{1,80}", r"the views in this column are those of .{1,140}", r"this article first appeared in .{1,140}", r".{1,70} is run by volunteers, and every page was checked .{1,120}", r"if you have found a mistake in this text, .{1,160}",
    r"notice: .{1,70} office is closed .{1,60}", r".{1,70} übernimmt keine haftung .{1,80}", r".{1,70} décline toute responsabilité .{1,80}", r".{0,70}(?:無断転載|版权所有|무단 ?전재).{0,40}",
    # widgets
    r"advertisement", r"story continues below", r"weather in .{1,40}", r"-?\d+ degrees, .{1,40}", r"upcoming: .{1,100}", r"you have \d+ unread messages?", r"mo tu we th fr sa su", r"mon-fri \d.{1,20}", r"saturday by appointment",
)

#: words from which a block of running text is body whatever it says, and its least stop-word density
DENSE_WORDS, DENSE_STOPS = 40, 0.12
#: link density from which a block is furniture
LINKED = 0.6
#: sentences in a row that may stand between pieces of furniture at the end of a page
EDGE_SENTENCES = 1
_MENU = frozenset(x for words in MENU.values() for x in words.split("|"))
_MENU_FIRST = frozenset(x.split(" ")[0] for x in _MENU)
_RELATED = frozenset(RELATED.split("|"))


def _by_head(patterns: tuple[str, ...]) -> tuple[dict[str, re.Pattern], re.Pattern]:
    """Patterns with a literal first character, by that character; and the others, as one pattern each way."""
    heads: dict[str, list[str]] = {}
    rest = []
    for p in patterns:
        for alt in [p] if not re.match(r"[^\\(\[]+\|[^\\(\[]+$", p) else p.split("|"):
            (rest if alt[0] in "\\([.-" else heads.setdefault(alt[0], [])).append(alt)
    return {h: re.compile("(?:" + "|".join(ps) + r")\Z") for h, ps in heads.items()}, re.compile("(?:" + "|".join(rest) + r")\Z")


_HEADS, _REST = _by_head(WORDINGS)
#: what a block has that a pattern without a literal beginning may cover
_REST_HINTS = ("cookie", "クッキー", "쿠키", "partners store", ", editor", "... ", "comment", "accepts no", "run by volunteers", "haftung", "responsabilité", "無断", "版权", "무단", "degrees", "文", "作者", "글", "(c)")

_BEYOND = re.compile("[^\\x00-\\x7f]+")
_LOSSY_MENU = frozenset(_BEYOND.sub("�", x) for x in _MENU)
_LOSSY_RELATED = frozenset(_BEYOND.sub("�", x) for x in _RELATED if x.isascii() or len(_BEYOND.sub("", x)) > 4)
_LOSSY = re.compile("(?:" + "|".join(_BEYOND.sub("�", p) for p in WORDINGS if len(_BEYOND.sub("", p)) > 8) + r")\Z")

_SPACES = re.compile(r"[\s\u00a0\u3000]+")
_BULLET = re.compile(r"^(?:[*•·‣▪–—-]|\d{1,3}[.)]|[a-z]\))\s+")
_BULLET_ONLY = re.compile(r"^[*•·‣▪–—-]\s+")
_SPLIT = re.compile(r"\s*(?:\||»|›|·|•| / | > | - |  +|\t|\u3000)\s*")
_MANY = re.compile(r"\||»|›|·|•| / | > | - |  |\u3000")
_END = re.compile(r"[.!?…。！？︒]['\"”’»」』)\]]*\Z|[:;]\Z")
_STOP_END = re.compile(r"[.!?…。！？]['\"”’»」』)\]]*\s*\Z")
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_CHAIN = re.compile(r" [|»›·•>] ")
#: a line of talk: quoted from end to end
_SPOKEN = re.compile("[\"“”„«「『].*[\"“”»」』]\\s*\\Z")
_INNER_END = re.compile(r"[.!?…] ")
_CJK = re.compile(r"[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]")
_URL = re.compile(r"https?://|www\.|\]\(")
_CELL = re.compile(r"(?<![\w.])(?:n/a|-|–|\d[\d.,:]*%?)(?![\w])", re.I)
_CODE = re.compile(
    r"^\s*(?:at [\w.$]+\(|file \"/|#\w+ /|\{.*\}$|\[[^\]]*\]$|</?\w+[^>]*>|[.#]?[\w-]+\s*\{[^}]*\}|(?:def|class|import|return|var|let|const|function|public|private|static|select|insert|update)\b.*[({;=].*[)};:]|[\w.\[\]]+ ?[+*-]?= ?[^ ]|\d{4}-\d\d-\d\d[t ]\d\d:\d\d)",
    re.I,
)


def folded(line: str) -> str:
    """The block in small letters, single spaces, without a bullet."""
    x = " ".join(line.split()).lower()
    if "’" in x:
        x = x.replace("’", "'")
    return x if x[:1].isalnum() else _BULLET_ONLY.sub("", x)


def pieces(line: str) -> list[str]:
    return [p for p in _SPLIT.split(line.strip().lower()) if p]


def link_density(line: str, x: str) -> float:
    """The share of a block that entries of menus take up: as pieces between separators, or as words in a row; 1 for a breadcrumb."""
    if x in _MENU:
        return 1.0
    best = 0.0
    for form in (x, line.strip()) if _MANY.search(line.strip()) else ():
        parts = [_SPACES.sub(" ", p) for p in pieces(form)]
        if len(parts) >= 2 and parts[0] in _HEAD and _CRUMB.search(line):
            return 1.0
        best = max(best, sum(p in _MENU for p in parts) / max(len(parts), 1))
    if best < LINKED and x[-1] not in ".!?" and x.count(" ") > 1:
        # entries of a menu without separators: cover the words greedily
        words, i, covered = x.split(" "), 0, 0
        if words[0] not in _MENU_FIRST and words[1] not in _MENU_FIRST:
            return best
        while i < len(words):
            for k in (3, 2, 1):
                if " ".join(words[i : i + k]) in _MENU and i + k <= len(words):
                    covered += k
                    i += k
                    break
            else:
                i += 1
        if covered >= 0.8 * len(words):
            best = max(best, covered / len(words))
    return best


def is_menu(line: str, x: str) -> bool:
    return link_density(line, x) >= LINKED


#: first piece of a breadcrumb
_HEAD = frozenset("home|startseite|accueil|inicio|início|strona główna|главная|ホーム|首页|홈|start|docs|articles|notes|reviews|guide|guides|wiki|news|blog|archive|shop|forum".split("|"))
_CRUMB = re.compile("\\s[»›>/]\\s")


def furniture(line: str, x: str) -> int:
    """0: not known as furniture; 1: by link density; 2: a heading above a list of other pages; 3: by wording."""
    if x in _RELATED or x.rstrip(":") in _RELATED:
        return 2
    if link_density(line, x) >= LINKED:
        return 1
    p = _HEADS.get(x[:1])
    if p is not None and p.match(x):
        return 3
    if "�" in x:
        # letters were lost: compare without telling letters beyond ASCII apart
        y = _BEYOND.sub("�", x)
        if y in _LOSSY_RELATED:
            return 2
        if y in _LOSSY_MENU or all(p in _LOSSY_MENU for p in pieces(y)):
            return 1
        return 3 if _LOSSY.match(y) else 0
    if any(h in x for h in _REST_HINTS) or x[:1].isdigit() or x[:4] == "home" or x[:5] == "start":
        return 3 if _REST.match(x) else 0
    return 0


def shape(line: str, x: str, common: frozenset[str]) -> tuple[int, int, int, bool]:
    """(shape, words, common words, ends like a sentence) of a block that is not furniture by wording."""
    if len(x) > 50 and x[-1] in ".!?" and "http" not in x and "|" not in x and ";" not in x and "\t" not in line and x[0] not in "#<{[.@*-" and x[:1].isalpha():
        # a plain sentence needs no closer look
        parts = x.split(" ")
        stop = sum(map(common.__contains__, parts))
        if len(parts) >= 8 and stop >= 0.15 * len(parts):
            return PROSE, len(parts), stop, True
    words = _WORD.findall(x)
    n = len(words)
    cjk = len(_CJK.findall(x)) if x[-1:] > "\u2e00" or any(c > "\u2e00" for c in x[:40:4]) else 0
    stop = sum(w in common for w in words)
    ends = bool(_STOP_END.search(x))
    s = line.strip()
    if _URL.search(x):
        # a sentence that cites an address stays prose
        return (PROSE if n >= 9 and stop >= 0.15 * n and ends and x.count("http") <= 2 and "](" not in x else LINK), n, stop, ends
    if _CODE.match(s):
        return JUNK, n, stop, ends
    cells = len(_CELL.findall(x))
    if cells >= 2 and cells + 1 >= 0.4 * (x.count(" ") + 1) and not (ends and stop >= 0.2 * n and n > 6):
        return ROW, n, stop, ends
    if len(_CHAIN.findall(s)) >= 3 and not any(c.isdigit() for c in s):
        return LINK, n, stop, ends  # anchors in a row
    if s.count("\t") >= 2 or s.count(" | ") >= 2 or (s.count(";") >= 3 and stop < 0.15 * max(n, 1)):
        return ROW, n, stop, ends
    if cjk >= 8 and cjk >= 0.5 * len(x):
        if ends or x.endswith(("。」", "、")) or cjk > 60 or "。" in x:
            return PROSE, max(n, cjk // 2), stop, ends
    elif n >= 4 and (ends or n >= 14 and _INNER_END.search(x)) and stop >= 0.12 * n:
        return PROSE, n, stop, ends
    elif n >= 3 and _SPOKEN.match(s):
        return PROSE, n, stop, ends
    elif ends and n >= 5 and sum(c.isalpha() or c == " " for c in x) > 0.85 * len(x):
        return PROSE, n, stop, ends
    if _BULLET.match(s):
        return ITEM, n, stop, ends
    if n == 0 or (len(x) > 6 and sum(c.isalpha() or c == " " for c in x) < 0.55 * len(x)):
        return JUNK, n, stop, ends
    return SHORT, n, stop, ends


def is_dense(x: str, shaped: tuple[int, int, int, bool]) -> bool:
    """Whether a block of this shape is body by length and stop-word density; scripts without spaces have no stop words to count."""
    kind, words, stops, _ = shaped
    return kind == PROSE and words >= DENSE_WORDS and (stops >= DENSE_STOPS * words or _CJK.search(x) is not None)


class Page:
    """The blocks of one text with labels and shapes."""

    __slots__ = ("lines", "got", "folded", "label", "kind", "words", "stops", "ends")

    def body(self) -> list[int]:
        return [i for i, v in enumerate(self.label) if v == BODY]


class Analyzer:
    """Analyses pages; keeps what it learnt of short lines it met before (bounded, only to save time)."""

    def __init__(self, common_words: list[str]):
        self.common = frozenset(common_words)
        self.known: dict[str, tuple] = {}

    def line(self, line: str) -> tuple:
        got = self.known.get(line)
        if got is None:
            x = folded(line)
            if not x:
                got = (x, -1, 0, 0, 0, False)
            else:
                shaped = shape(line, x, self.common)
                # running text of some length is body by its density; shorter blocks may be furniture
                f = 0 if is_dense(x, shaped) else furniture(line, x)
                got = (x, f, FIXED, 0, 0, False) if f else (x, 0, *shaped)
            if len(line) < 100:
                if len(self.known) > 60_000:
                    self.known.clear()
                self.known[line] = got
        return got

    def page(self, text: str, title: str | None) -> Page:
        p = Page()
        p.lines = text.split("\n")
        got = p.got = [self.line(x) for x in p.lines]
        p.folded = [g[0] for g in got]
        p.kind = [g[2] for g in got]
        p.words = [g[3] for g in got]
        p.stops = [g[4] for g in got]
        p.ends = [g[5] for g in got]
        p.label = self._labels(got, folded(title) if title else "")
        return p

    def _labels(self, got: list[tuple], title: str) -> list[int]:
        label = [BLANK if g[1] < 0 else FURNITURE if g[1] else AMBIGUOUS for g in got]
        n = len(got)
        # pass one: what the blocks say by themselves
        for i, g in enumerate(got):
            if label[i] == AMBIGUOUS:
                if g[2] in (PROSE, ROW, LINK, JUNK):
                    label[i] = BODY
                elif title and g[0] == title:
                    label[i] = BODY
        # lists of other pages: title-like blocks right under their heading, to where they stop being alike
        for i, g in enumerate(got):
            if g[1] == 2:
                run = []
                for j in range(i + 1, n):
                    if label[j] == BLANK:
                        continue
                    if label[j] != AMBIGUOUS or run and got[j][2] != got[run[0]][2]:
                        break
                    run.append(j)
                for j in _titles(run, got, label, title):
                    label[j] = FURNITURE
        _edge(got, label, range(n - 1, -1, -1))
        _edge(got, label, range(n))
        # rows of a list: several ambiguous blocks in a row are the list of the page
        i = 0
        while i < n:
            if label[i] != AMBIGUOUS:
                i += 1
                continue
            j, count = i, 0
            while j < n and label[j] in (AMBIGUOUS, BLANK):
                count += label[j] == AMBIGUOUS
                j += 1
            if count >= 4:
                for k in range(i, j):
                    if label[k] == AMBIGUOUS:
                        label[k] = BODY
            i = j
        # pass two: short blocks inherit from the nearest decided neighbours
        decided = [i for i in range(n) if label[i] in (FURNITURE, BODY)]
        first = next((i for i in decided if label[i] == BODY), n)
        before: list[tuple[int, int]] = []
        dist, lab = 1 << 30, 0
        out = label[:]
        for i in range(n):
            if label[i] in (FURNITURE, BODY):
                dist, lab = 0, label[i]
            elif label[i] == AMBIGUOUS:
                dist += 1
            before.append((dist, lab))
        dist, lab = 1 << 30, 0
        for i in range(n - 1, -1, -1):
            if label[i] in (FURNITURE, BODY):
                dist, lab = 0, label[i]
            elif label[i] == AMBIGUOUS:
                dist += 1
                (db, lb), (da, la) = before[i], (dist, lab)
                near = {v for d, v in ((db, lb), (da, la)) if v and d == min(db, da)}
                if not near or BODY in near:
                    out[i] = BODY
                elif i < first and (got[i][3] >= 3 or len(got[i][0]) >= 12):
                    out[i] = BODY  # a headline over a body that is still to come
                else:
                    out[i] = FURNITURE
        return out


def _titles(run: list[int], got: list[tuple], label: list[int], title: str) -> list[int]:
    """The blocks of a run under the heading of a list of other pages that are its titles."""
    # the last one may be the headline of the page itself
    if len(run) > 3 and not title and BODY not in label[: run[0]]:
        after = next((k for k in range(run[-1] + 1, len(got)) if label[k] != BLANK), None)
        if after is not None and label[after] == BODY:
            return run[:-1]
    return run


def _edge(got: list[tuple], label: list[int], way: range) -> None:
    """Labels what stands among furniture at one edge of a page, from the edge inwards as far as furniture reaches.

    ``way`` goes from the edge inwards.  Short pieces without a sentence end
    carry furniture on at the end of a page of running text; up to
    EDGE_SENTENCES short sentences in a row may stand between its pieces.
    """
    footer = way.step < 0
    text = [i for i, g in enumerate(got) if label[i] == BODY and g[2] == PROSE]
    if not text:
        return  # a list or a table has no running text that its edges could stand apart from
    last = text[0] if footer else text[-1]  # all of the running text can't be an edge
    pending: list[int] = []
    sentences, after = 0, None
    for i in way:
        if label[i] == BLANK:
            continue
        if i == last:
            return
        _, _, kind, words, stops, ends = got[i]
        if label[i] == FURNITURE:
            for k in pending:
                label[k] = FURNITURE
            pending, sentences = [], 0
        elif kind == SHORT and not ends and words <= 11 and label[i] == AMBIGUOUS:
            if footer and after != PROSE and after != ITEM:
                for k in pending:
                    label[k] = FURNITURE
                pending, sentences = [], 0
                label[i] = FURNITURE
            else:
                pending.append(i)
        elif footer and kind == PROSE and words < DENSE_WORDS and sentences < EDGE_SENTENCES:
            sentences += 1
            pending.append(i)
        else:
            return
        after = kind if label[i] != FURNITURE else None


def fold_words(s: str) -> str:
    return unicodedata.normalize("NFKC", s).lower()
