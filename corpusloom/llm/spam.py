"""Spam pages of keywords, links or product tags: features, weak labels, bagged trees, host smoothing."""

from __future__ import annotations

import json
import re
from collections import Counter

import numpy as np

from . import blocks as B

# Words of commerce that stuffed pages and their addresses repeat, by language.
COMMERCE = {
    "en": "buy cheap best price deals online reviews top wholesale discount outlet coupon free sale original shop offers",
    "de": "kaufen billig günstig rabatt angebot preis bester test bestellen",
    "fr": "acheter cher prix promo soldes livraison meilleur avis boutique",
    "es": "comprar barato precio descuento oferta mejor tienda opiniones",
    "pt": "comprar barato preço desconto oferta melhor loja promoção",
    "pl": "kupić tanio tani cena sklep promocja najlepszy opinie",
    "ru": "купить дешево недорого цена магазин онлайн доставка скидка отзывы",
    "ja": "通販 激安 最安値 価格 送料無料 人気 おすすめ",
    "zh": "购买 便宜 价格 优惠 折扣 包邮 批发",
    "ko": "구매 최저가 할인 가격 무료배송 추천 쇼핑",
}
_COMMERCE = frozenset(w for ws in COMMERCE.values() for w in ws.split())
#: words of commerce that are telling in an address, where plain adjectives stand too
_SLUG = frozenset(w for k in ("en", "de", "fr", "es", "pt", "pl") for w in COMMERCE[k].split()) - {"cheap", "best", "test", "shop", "cher", "avis", "top", "free", "boutique", "günstig", "original", "sale"}
NAMES = ("distinct", "top_word", "top_pair", "common", "prose", "urls", "tags", "arrows", "titles_in_row", "goods", "commerce", "line_words", "digits", "numbered", "same_start", "symbols", "cells", "list_pairs", "shouted", "near_words", "vowels", "long_words")
_WORDS = re.compile(r"[^\W\d_]+")
_TAG = re.compile(r"(?:#|tag:|<|\[)[^\W\d_][\w-]*[>\]]?(?![\w(])")
_ARROW = re.compile(r"(?:→|»|\(more\)|\[more\]|read more|\.\.\.|…)\s*$", re.I)
_LINE_URL = re.compile(r"https?://|www\.|\]\(")
_GOODS = re.compile(r"\bsku\b|in stock|add to cart|free shipping|\bsale\b|-\d\d ?%|[€$£¥]\s?\d|\bwas \d", re.I)
_NUMBERED = re.compile(r"^\s*(?:\d{1,3}[.)]\s|v?\d+(?:\.\d+)+\s|[-*•]?\s*\d+(?:\.\d+)? (?:x|g|kg|ml|l|cm|mm|m|pcs|st)\b|[-*•] \d+ )|\.{4,} ?\d+\s*$")
_PERSON = re.compile(r"^\s*[A-ZÀ-Ý][\w'’-]+(?: [A-ZÀ-Ý][\w'’-]+){1,2}(?:, [A-ZÀ-Ý]\w+| \(\d{4}\))?\s*$")
_DIGIT = re.compile(r"\d")
_SIGN = re.compile(r"[^\w\s]|_")
_PLAIN = re.compile("[a-z]")
_COUNTED = re.compile(r"[^\W\d_] \d{1,3}(?:,|$|;)")


def slug_words(url: str | None) -> list[str]:
    """The words of the last step of an address."""
    s = re.sub(r"^[a-z]+://[^/]*", "", (url or "").lower()).split("?")[0].split("#")[0].rstrip("/")
    return _WORDS.findall(s.rsplit("/", 1)[-1])


def commercial(url: str | None, title: str | None) -> bool:
    """Whether the address or the title of a page names goods the way shops bait search engines."""
    s, t = slug_words(url), _WORDS.findall((title or "").lower())
    if any(w in _SLUG for w in s) or sum(w in _COMMERCE for w in s) >= 2 or "near-me" in (url or "").lower():
        return True
    return len(t) <= 9 and (sum(w in _COMMERCE for w in t) >= 2 or any(w in _SLUG for w in t))


def features(page: B.Page, common: frozenset[str]) -> list[float]:
    """Content and link features of the body of a page; of all its lines if nothing is left as body."""
    body = page.body() or [i for i, v in enumerate(page.label) if v != B.BLANK]
    xs = [page.folded[i] for i in body]
    text = " ".join(xs)
    chars = max(len(text), 1)
    ws = _WORDS.findall(text)
    n = max(len(ws), 1)
    if n < 3 * len(text) / 100:  # scripts without spaces: pairs of characters stand for words
        ws = [text[i : i + 2] for i in range(0, len(text) - 1, 2)]
        n = max(len(ws), 1)
        pairs = Counter(zip(ws, ws[1:], ws[2:]))
    else:
        pairs = Counter(zip(ws, ws[1:]))
    words = Counter(ws)
    top3 = sum(sorted(pairs.values(), reverse=True)[:3])
    lines = max(len(body), 1)
    prose = sum(len(page.folded[i]) for i in body if page.kind[i] == B.PROSE) / chars
    f = [0.0] * len(NAMES)
    f[0] = len(words) / n if n < 400 else len(words) / (n**0.5 * 20)
    f[1] = max(words.values()) / n if words else 0.0
    f[2] = max(0, top3 - 3) / n  # pairs that stand once say nothing
    f[3] = sum(words[w] for w in words.keys() & common) / n
    f[4] = prose
    f[20] = 0.4
    f[10] = sum(words[w] for w in words.keys() & _COMMERCE) / n
    f[11] = min(n / lines, 200.0)
    f[19] = (words.get("near", 0) + words.get("in", 0)) / n
    if prose > 0.8:
        return f  # sentences: what the lines look like says no more
    raw = [page.lines[i] for i in body]
    starts = Counter(tuple(x.split(" ")[:3]) for x in xs)
    bars = sum(r.count(" | ") for r in raw if r.count(" | ") >= 3 and not any(c.isdigit() for c in r))
    f[5] = sum(bool(_LINE_URL.search(r)) for r in raw) / lines
    f[6] = sum(len(m) for m in _TAG.findall(text)) / chars
    f[7] = sum(bool(_ARROW.search(r)) for r in raw) / lines
    f[8] = min(bars / (2 * lines), 3.0)
    f[9] = sum(bool(_GOODS.search(r)) for r in raw) / lines
    f[12] = len(_DIGIT.findall(text)) / chars
    f[13] = sum(bool(_NUMBERED.search(r)) or bool(_PERSON.match(r)) for r in raw) / lines
    f[14] = starts.most_common(1)[0][1] / lines if lines > 3 else 0.0
    f[15] = len(_SIGN.findall(text)) / chars
    f[16] = sum(page.kind[i] in (B.ROW, B.JUNK) for i in body) / lines
    f[17] = len(_COUNTED.findall(text)) / min(lines, 40)
    f[18] = sum(r.isupper() for r in raw) / lines
    plain = len(_PLAIN.findall(text))
    if plain > 0.3 * chars:
        f[20] = sum(map(text.count, "aeiouy")) / plain
    f[21] = min(len(text) / max(text.count(" ") + lines, 1), 100.0)
    return f


_F = {n: i for i, n in enumerate(NAMES)}


def weak_label(f: list[float], shop: bool) -> int:
    """1: surely spam, 0: surely not, -1: unknown; only signs that leave no doubt are used, the rest is left to the trees and the hosts.

    A page that signs of both kinds speak for is unknown.
    """
    g = lambda k: f[_F[k]]
    ordered = g("cells") > 0.1 or g("numbered") > 0.1
    spam = (
        g("tags") > 0.6  # tags and little else
        or g("goods") > 0.6 and g("prose") < 0.2  # goods line by line
        or g("urls") > 0.8 and g("prose") < 0.1  # addresses line by line
        or g("commerce") > 0.2 and g("distinct") < 0.45  # a fifth of the words sell something
        or g("arrows") > 0.5 and g("prose") < 0.1 and not ordered and g("digits") < 0.05  # teasers of other pages
        or g("top_pair") > 0.22 and g("distinct") < 0.25 and not ordered and g("vowels") > 0.25 and g("line_words") > 12  # the same few words over and over
        or shop and g("prose") < 0.05 and not ordered and g("vowels") > 0.25  # an address that baits searches, and no sentence
    )
    fair = g("prose") > 0.85 and g("commerce") < 0.03 and g("top_pair") < 0.06  # sentences in words of their own
    fair = fair or not shop and (g("numbered") > 0.7 or g("cells") > 0.7 or g("vowels") < 0.2 or g("list_pairs") > 3)  # an ordered list, a table, or no words
    return -1 if spam == fair else int(spam)


class BaggedTrees:
    """Decision trees on bootstrap samples, each split on the best of quantile thresholds by Gini impurity."""

    def __init__(self, trees: int = 15, depth: int = 6, least: int = 5, cuts: int = 24, seed: int = 7):
        self.trees, self.depth, self.least, self.cuts, self.seed = trees, depth, least, cuts, seed
        self.forest: list[list[tuple]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> "BaggedTrees":
        rng = np.random.default_rng(self.seed)
        n, m = x.shape if len(x) else (0, len(NAMES))
        if n == 0 or len(set(y.tolist())) < 2:
            self.forest = [[(-1, 0.0, -1, -1, float(y.mean()) if n else 0.0)]]
            return self
        # spam, prose and other text that is no spam: thresholds from each, and a share of each in every bootstrap sample
        prose = x[:, _F["prose"]] > 0.7
        sides = [k for k in (np.flatnonzero(y > 0.5), np.flatnonzero((y <= 0.5) & prose), np.flatnonzero((y <= 0.5) & ~prose)) if len(k)]
        cuts = [np.unique(np.concatenate([np.quantile(x[k, j], np.linspace(0.02, 0.98, self.cuts)) for k in sides])) for j in range(m)]
        self.forest = []
        for _ in range(self.trees):
            rows = np.concatenate([k[rng.integers(0, len(k), n // len(sides) + 1)] for k in sides])
            cols = rng.permutation(m)[: max(4, m * 2 // 3)]
            nodes: list[tuple] = []
            self._grow(x[rows], y[rows], 0, cols, cuts, nodes)
            self.forest.append(nodes)
        return self

    def _grow(self, x, y, depth, cols, cuts, nodes) -> int:
        at = len(nodes)
        p = float(y.mean())
        nodes.append((-1, 0.0, -1, -1, p))
        if depth >= self.depth or len(y) < 2 * self.least or p in (0.0, 1.0):
            return at
        best = (p * (1 - p) * len(y) - 1e-9, -1, 0.0)
        for j in cols:
            order = np.argsort(x[:, j], kind="stable")
            xs, ones = x[order, j], np.concatenate([[0], np.cumsum(y[order])])
            for c in cuts[j]:
                k = int(np.searchsorted(xs, c, side="right"))
                if k < self.least or len(y) - k < self.least:
                    continue
                a, b = ones[k] / k, (ones[-1] - ones[k]) / (len(y) - k)
                gini = a * (1 - a) * k + b * (1 - b) * (len(y) - k)
                if gini < best[0]:
                    best = (gini, int(j), float(c))
        if best[1] < 0:
            return at
        left = x[:, best[1]] <= best[2]
        a = self._grow(x[left], y[left], depth + 1, cols, cuts, nodes)
        b = self._grow(x[~left], y[~left], depth + 1, cols, cuts, nodes)
        nodes[at] = (best[1], best[2], a, b, p)
        return at

    def dumps(self) -> str:
        """The fitted trees as text."""
        return json.dumps({"depth": self.depth, "forest": self.forest})

    @classmethod
    def loads(cls, text: str) -> "BaggedTrees":
        got = json.loads(text)
        out = cls(depth=got["depth"])
        out.forest = got["forest"]
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        for nodes in self.forest:
            col, cut, a, b, p = (np.array(v) for v in zip(*nodes))
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth + 1):
                inner = col[at] >= 0
                if not inner.any():
                    break
                go = x[np.arange(len(x)), np.maximum(col[at], 0)] <= cut[at]
                at = np.where(inner, np.where(go, a[at], b[at]), at)
            out += p[at]
        return out / max(len(self.forest), 1)
