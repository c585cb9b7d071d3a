"""Pages that offer error messages, notices, filler or unfilled templates in place of content."""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick

from . import blocks as B

# Wordings of errors, checks, notices and demands for scripts, lower case, by kind.
PHRASES = {
    "error": "404 not found|page not found|not found|403 forbidden|410 gone|502 bad gateway|503 service unavailable|500 internal server error|internal server error|service unavailable|bad gateway|gateway timeout|access denied|error 404|"
    "sorry, we could not find what you were looking for|oops! that page can't be found|that page can't be found|this listing is no longer available|the upstream server at|returned an invalid response|too many connections|retry in|"
    "error establishing a database connection|the server encountered an error and could not complete your request|something went wrong on our side|something went wrong|your request was blocked|the requested url|was not found on this server|"
    "try searching instead|return to the homepage|contact the administrator of|request id|you don't have permission to access|on this server|has been removed|the page|scripts are disabled, so|cannot be shown|incident|reference|if you are not redirected, reload|undefined|unsupported browser|warning: undefined variable on line|java.lang.nullpointerexception|"
    "traceback (most recent call last)|fatal error: uncaught exception in|seite nicht gefunden|die angeforderte seite wurde nicht gefunden|page introuvable|la page demandée n'existe pas|erreur 404|página no encontrada|página não encontrada|"
    "strona nie została znaleziona|страница не найдена|ページが見つかりません|页面不存在|페이지를 찾을 수 없습니다",
    "check": "verify you are human by completing the action below|one more step: please complete the security check|checking your browser before accessing|please complete the security check|ray id|please wait while the page loads|loading",
    "script": "this site requires javascript and cookies to be enabled in your browser settings|noscript: turn on scripting to continue|please enable javascript to view this page|please enable javascript|javascript is required|"
    "this application does not work without it|you need to enable javascript to run this app|your browser has scripts turned off|switch them on and reload|bitte aktivieren sie javascript|veuillez activer javascript|por favor, active javascript|"
    "habilite javascript|ative o javascript|włącz javascript|для работы сайта включите javascript|включите javascript|javascriptを有効にしてください|请启用 javascript|请启用javascript|javascript를 활성화|자바스크립트를",
    "notice": "the site is down for scheduled maintenance|please try again later|back in a little while|thank you for your patience|nothing to see at the moment|thanks for stopping by|hold on, we will be right with you|"
    "we are making some improvements, see you soon|dear readers,|is taking a short break|under construction|coming soon",
    "filler": "placeholder paragraph number|to be written by the client|todo: copy for block|text text text text text text|this is some sample text|replace it with your own words|write something about yourself here|description coming soon|"
    "add your text here|click to edit|your heading here|sample page|just another site title|untitled|lorem ipsum",
}
# Words of the usual Latin filler.
LATIN_FILLER = frozenset(
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in "
    "reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum massa quam rutrum tellus ligula porta donec morbi mauris fusce justo "
    "turpis urna nunc augue nibh vestibulum praesent pellentesque vivamus nullam integer curabitur aenean phasellus maecenas suspendisse".split()
)
#: unfilled places of a template: {{x}}, ${x}, <%= x %>, [[x]], [INSERT X HERE], <X goes here>, %x%, @@x@@, __x__, {x}
PLACE = re.compile(r"\{\{\{?[^{}\n]{1,40}\}?\}\}|\$\{[^{}\n]{1,40}\}|<%=?[^%\n]{1,40}%>|\[\[[^\[\]\n]{1,40}\]\]|\[insert [^\]\n]{1,40}\]|<[^<>\n]{1,40} goes here>|%[a-z0-9_.]{3,40}%|@@[a-z0-9_.]{3,40}@@|__[a-z0-9_.]{3,40}__|\{[a-z0-9_.]{3,40}\}", re.I)
#: what stands around the places
_FRAME = re.compile(r"welcome to|read more about|call us on|published|\bby\b|item:|hello|thank you for visiting|our\b|is available in|all rights reserved|contact|about")
_TRACE = re.compile(r"""^\s*(?:at [\w.$]+\([\w.]+:\d+\).*|file "[^"]+", line \d+.*|#\w+ /\S+\(\d+\): .*|fatal error: .*|warning: undefined .*|traceback .*|[\w.]+(?:exception|error)(?::.*)?)\s*$""", re.I)
_LEFT = re.compile(r"[^\W_]+")
_CODE = re.compile(r"\b[0-9a-f]{6,}\b|\b\d+\b|[\w-]+(?:\.[\w-]+)+|/\S+")
_TITLES = re.compile(r"^(?:error|404|untitled|undefined|oops|{{.*)", re.I)


@lru_cache(1)
def automaton() -> ahocorasick.Automaton:
    auto = ahocorasick.Automaton()
    for kind, words in PHRASES.items():
        for w in words.split("|"):
            auto.add_word(w, (len(w), kind))
    auto.make_automaton()
    return auto


def left_over(x: str) -> tuple[int, int]:
    """(characters of a folded line that phrases, places and traces cover, characters of words they leave)."""
    if _TRACE.match(x):
        return len(x), 0
    if len(x) > 11 and (w := _LEFT.findall(x)) and len(w) >= 4 and sum(c in LATIN_FILLER for c in w) >= 0.6 * len(w):
        return len(x), 0
    rest, covered = [], 0
    at = 0
    for end, (n, _) in automaton().iter_long(x):
        a = end - n + 1
        if (a and x[a - 1].isalnum() and x[a].isascii()) or (end + 1 < len(x) and x[end + 1].isalnum() and x[end].isascii()):
            continue
        rest.append(x[at:a])
        covered += n
        at = end + 1
    rest.append(x[at:])
    y = " ".join(rest)
    placed = sum(len(m) for m in PLACE.findall(y))
    if placed:
        y = _FRAME.sub(" ", PLACE.sub(" ", y))
    covered += placed
    if covered:
        y = _CODE.sub(" ", y)
    return covered, sum(map(len, _LEFT.findall(y)))


#: lines of numbers and addresses alone that a notice may have besides its text
NEUTRAL = 3


def is_dead(page: B.Page, title: str) -> tuple[bool, float]:
    """(whether a page with a non-blank text has nothing else to offer, share of its body that phrases cover).

    The page's own title and the furniture around it don't count as an offer.
    All lines count, in whatever order they stand; reading ends early only when
    no line still to come could change the verdict.
    """
    covered = left = size = 0
    neutral: list[tuple[int, int]] = []
    find = automaton().iter
    ahead = sum(map(len, page.folded))
    for i, x in enumerate(page.folded):
        ahead -= len(x)
        lab = page.label[i]
        if lab == B.BLANK or (page.kind[i] == B.FIXED):
            continue
        if page.kind[i] == B.PROSE and page.words[i] >= 8 and page.stops[i] >= 0.2 * page.words[i] and "{" not in x and next(find(x), None) is None:
            size, left = size + len(x), left + len(x)  # plain sentences without any of the phrases
        else:
            c, rest = left_over(x)
            if not c and (lab == B.FURNITURE or title and (x == title or x.endswith(title))):
                continue
            if not c and len(x) < 90 and _CODE.sub("", x).strip(" .#:") == "":
                neutral.append((len(x), rest))  # an address or a number
                continue
            size += len(x)
            covered += len(x) if c and rest <= 0.6 * c + 3 else min(c, len(x))
            left += 0 if c and rest <= 0.6 * c + 3 else rest
        if left > max(28, 0.25 * (covered + ahead)):
            return False, covered / size
    for n, rest in sorted(neutral, reverse=True)[NEUTRAL:]:
        size, left = size + n, left + rest
    if not covered or covered <= 8 and left:
        return False, 0.0
    share = covered / size
    return share >= 0.6 and left <= max(28, 0.25 * covered), share
