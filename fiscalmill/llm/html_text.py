"""Main text of web pages by a linear-chain conditional random field over the leaf blocks of the DOM.

A page is cut into leaf blocks: runs of text between the starts and ends of block elements. Each block has features of
its ancestors (tags, and groups of words in class and id) and of its text (length, share of link text, sentence ends,
place). A linear-chain CRF with two states, main text and rest, is trained by exact likelihood (forward-backward) on
labelled pages of a seeded page grammar, once and on the driver: the training set has TRAINING_PAGES pages whatever the
corpus is. Pages are then decoded by Viterbi, page by page, in the tasks that read them; nothing is shuffled.

Text comes out whole: character references decoded, white space in a block turned into one space, blocks trimmed and
joined by an empty line. Scripts, styles, comments, the title, buttons, templates and drawings (svg) are no blocks; a
head has no text but theirs, so it needs no end. Formulas (math) and the content of objects are text.

Defined cases: a null or empty html gives an empty text; markup that is never closed is taken as the browser does for
paragraphs and list items, and to the end of the page for scripts and comments; a button, template or drawing whose end
does not come before its parent's is left at the next start or end of a block, and an end without a start is passed over;
pages repeat as in the input; null ids
and addresses are passed through; an empty table gives an empty result; further columns are passed over.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from fiscalmill.llm.common import own_columns

TRAINING_PAGES = 400
ITERATIONS = 200
PENALTY = 0.05

# Element names of HTML and words that sites use in class and id.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul option select".split()
)
SKIPPED_TAGS = frozenset("svg template button".split())
"""Skipped with all that is inside. Elements whose content is no markup are skipped by TOKEN."""
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
GROUPS = {
    "menu": "nav menu breadcrumb breadcrumbs navbar navigation toolbar toc pagination pager menubar skip",
    "header": "header masthead topbar banner logo branding hero",
    "footer": "footer copyright legal colophon bottom imprint",
    "side": "sidebar side aside widget widgets related recommended rail trending popular tags tag more recirc teaser",
    "advert": "ad ads adv advert adverts advertisement sponsor sponsored promo promotion promoted affiliate adsense adslot outbrain taboola",
    "notice": "cookie cookies consent notice notices alert gdpr popup modal overlay newsletter subscribe signup paywall disclaimer warning",
    "form": "form search login register contact signin feedback",
    "comment": "comment comments reply replies disqus discussion respond commentlist reader responses",
    "share": "share sharing social follow byline author meta date timestamp credits",
    "main": "article content main post entry body story text",
}
WORD_GROUP = {word: group for group, words in GROUPS.items() for word in words.split()}
TAG_GROUPS = frozenset("nav header footer aside form article main section".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|iframe)\b.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>|<[!?][^>]*>",
    re.S | re.I,
)
SELF_CLOSED = re.compile(r"<[a-zA-Z]+((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table article section div main aside nav footer header form body html".split())


@dataclass
class Block:
    text: str
    path: tuple[tuple[str, frozenset[str]], ...]
    linked: int


def name_groups(attributes: str) -> frozenset[str]:
    found = set()
    for quoted, single, bare in NAMES.findall(attributes):
        for word in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", quoted or single or bare).lower()):
            if word in WORD_GROUP:
                found.add(WORD_GROUP[word])
    return frozenset(found)


@dataclass
class Token:
    """A tag or a part without text (no name) from `start` to `end` of the page."""

    start: int
    end: int
    name: str
    closing: bool
    attributes: str


def tokens_of(page: str) -> tuple[list[Token], dict[int, int | None]]:
    """Tokens of a page, and for each that starts a skipped element its end tag, or nothing if that does not come in time."""
    found: list[Token] = []
    ends: dict[int, int | None] = {}
    blocks: list[str] = []
    depth_of: dict[str, list[int]] = {}
    inside: list[tuple[str, int, int]] = []  # skipped elements and foreignObject: name, token, blocks around it
    at = 0

    def leave(depth: int) -> None:
        while len(blocks) > depth:
            depth_of[blocks.pop()].pop()

    while token := TOKEN.search(page, at):
        at = token.end()
        name, closing, attributes = (token[3] or token[6] or "").lower(), bool(token[2] or token[5]), token[4] or token[7] or ""
        if token[1] and any(x[0] == "svg" for x in inside):
            own = SELF_CLOSED.match(page, token.start())
            if own and own[1].endswith("/"):
                at = own.end()
        i = len(found)
        found.append(Token(token.start(), at, name, closing, attributes))
        if name in SKIPPED_TAGS or name == "foreignobject":
            if closing:
                if any(x[0] == name for x in inside):
                    while inside[-1][0] != name:
                        inside.pop()
                    _, start, depth = inside.pop()
                    ends[start] = i
                    leave(depth)
            elif not attributes.endswith("/"):
                if name == "button" and any(x[0] == name for x in inside):  # buttons do not nest
                    while inside.pop()[0] != name:
                        pass
                inside.append((name, i, len(blocks)))
                ends[i] = None
        elif name in BLOCK_TAGS:
            while inside and inside[-1][0] == "svg":  # no block stands in a drawing
                inside.pop()
            if not closing:
                if name not in VOID_TAGS:
                    depth_of.setdefault(name, []).append(len(blocks))
                    blocks.append(name)
            elif depth_of.get(name):
                depth = depth_of[name][-1]
                while inside and inside[-1][2] > depth:
                    inside.pop()
                leave(depth)
    return found, ends


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks with text, in page order."""
    blocks: list[Block] = []
    path: list[tuple[str, frozenset[str]]] = []
    pieces: list[str] = []
    linked, in_link, at, next_ = 0, 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                blocks.append(Block(text, tuple(path), linked))
            pieces.clear()
        linked = 0

    def take(text: str) -> None:
        nonlocal linked
        if text:
            pieces.append(text)
            if in_link:
                linked += len(text)

    tokens, skipped = tokens_of(page)
    while next_ < len(tokens):
        token = tokens[next_]
        take(page[at : token.start])
        at, name, closing = token.end, token.name, token.closing
        if name in SKIPPED_TAGS and next_ in skipped:
            end = skipped[next_]
            if end is not None:
                next_, at = end + 1, tokens[end].end
            else:
                next_ += 1
                while next_ < len(tokens) and tokens[next_].name not in BLOCK_TAGS:
                    next_ += 1
                at = tokens[next_].start if next_ < len(tokens) else len(page)
            continue
        next_ += 1
        if not name:
            continue
        if name == "a":
            in_link = 0 if closing else 1
        elif name == "br" or name == "img":
            take(" ")
        elif name in BLOCK_TAGS:
            flush()
            if closing:
                for i in range(len(path) - 1, -1, -1):
                    if path[i][0] == name:
                        del path[i:]
                        break
            elif name not in VOID_TAGS:
                ends = CLOSES.get(name, {"p"})
                for i in range(len(path) - 1, -1, -1):
                    if path[i][0] in ends:
                        del path[i:]
                        break
                    if path[i][0] in SCOPES:
                        break
                path.append((name, name_groups(token.attributes) if "=" in token.attributes else frozenset()))
            in_link = 0 if name in ("body", "p", "div", "article", "section", "footer") else in_link
    take(page[at:])
    flush()
    return blocks


def _step(value: float, steps: tuple[float, ...]) -> int:
    return sum(value > s for s in steps)


def block_features(block: Block, place: float) -> list[str]:
    """Names of the features that hold for a block."""
    words = block.text.count(" ") + 1
    found = {f"words{_step(words, (2, 6, 15, 40))}", f"links{_step(block.linked / len(block.text), (0, 0.3, 0.8))}", f"place{_step(place, (0.1, 0.5, 0.9))}"}
    if block.text[-1] in ".!?:\"”»":
        found.add("sentence")
    if "©" in block.text or "(c)" in block.text:
        found.add("copyright")
    near = None
    for tag, groups in block.path:
        if tag in TAG_GROUPS:
            found.add(f"in_{tag}")
            near = f"near_{tag}"
        for group in groups:
            found.add(f"named_{group}")
            near = f"near_named_{group}"
    if near:
        found.add(near)
    own = block.path[-1][0] if block.path else "none"
    found.add(f"tag_{own}")
    if own[0] == "h" and own[1:].isdigit() and {"in_article", "in_header"} <= found:
        found.add("heading_of_article")
    return list(found)


class PageGrammar:
    """Random pages whose blocks are known to be main text or not."""

    def __init__(self, seed: int) -> None:
        self.random = random.Random(seed)
        self.labels: list[int] = []

    def words(self, low: int, high: int) -> str:
        r = self.random
        return " ".join("".join(r.choice("bdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(r.randint(low, high)))

    def put(self, label: int, tag: str, text: str, attributes: str = "") -> str:
        self.labels.append(label)
        return f"<{tag}{attributes}>{text}</{tag}>"

    def sentence(self, low: int, high: int) -> str:
        return self.words(low, high).capitalize() + self.random.choice([".", ".", ".", "!", "?", ""])

    def links(self, n: int) -> str:
        return "<ul>" + "".join(self.put(0, "li", f'<a href="/x">{self.words(1, 3)}</a>') for _ in range(n)) + "</ul>"

    def named(self, group: str) -> str:
        word = self.random.choice(GROUPS[group].split())
        prefix = self.random.choice(["", "", "site-", "js-", "page_", "block-"])
        return f' {self.random.choice(["class", "class", "id"])}="{prefix}{word}"'

    def rest(self, kind: str) -> str:
        """A part of the page that is not main text."""
        r = self.random
        tag = {"menu": "nav", "header": "header", "footer": "footer", "side": "aside", "form": "form"}.get(kind, r.choice(["div", "section", "div"]))
        plain = tag != "div" and tag != "section" and r.random() < 0.7
        if r.random() < 0.3:
            tag, plain = "div", False
        inner = {
            "menu": lambda: self.links(r.randint(2, 7)),
            "header": lambda: self.put(0, r.choice(["h1", "div", "p"]), self.words(1, 4)) + (self.links(r.randint(2, 5)) if r.random() < 0.5 else ""),
            "footer": lambda: self.put(0, r.choice(["p", "div"]), r.choice(["© ", "&copy; ", ""]) + self.sentence(3, 20)) + (self.links(3) if r.random() < 0.3 else ""),
            "form": lambda: self.put(0, "p", self.sentence(2, 12)) + self.put(0, "div", f"<label>{self.words(1, 2)}</label>"),
        }.get(kind, lambda: "".join(self.put(0, r.choice(["p", "p", "li", "h3", "div"]), self.sentence(1, 45)) for _ in range(r.randint(1, 5))))
        if kind in ("advert", "footer", "notice") and r.random() < 0.4:  # text directly inside
            self.labels.append(0)
            text = self.sentence(3, 25)
            return f"<{tag}{'' if plain else self.named(kind)}>{text}</{tag}>"
        return f"<{tag}{'' if plain else self.named(kind)}>{inner()}</{tag}>"

    def main(self) -> str:
        r = self.random
        body = [self.put(1, "h1", self.words(2, 9))] if r.random() < 0.8 else []
        if body and r.random() < 0.2:
            body = [f"<header>{body[0]}" + (self.put(0, "p", self.words(2, 6), self.named("share")) if r.random() < 0.6 else "") + "</header>"]
        elif r.random() < 0.2:
            body.append(self.rest("share"))
        for _ in range(r.randint(0, 12)):
            x = r.random()
            if x < 0.7:
                body.append(self.put(1, "p", self.sentence(1, r.choice([2, 10, 80]))))
            elif x < 0.77:
                body.append(self.put(1, r.choice(["h2", "h3"]), self.words(1, 6)))
            elif x < 0.83:
                body.append("<ul>" + "".join(self.put(1, "li", self.sentence(1, 14)) for _ in range(r.randint(1, 4))) + "</ul>")
            elif x < 0.88:
                body.append(self.put(1, r.choice(["blockquote", "pre", "td", "figcaption"]), self.sentence(3, 25)))
            else:
                body.append(self.rest(r.choice(["advert", "side", "side", "notice", "share", "form", "menu"])))
        if r.random() < 0.2:
            body.append(self.rest("comment"))
        tag = r.choice(["article", "article", "main", "div", "section"])
        return f"<{tag}{self.named('main') if tag in ('div', 'section') and r.random() < 0.8 else ''}>{''.join(body)}</{tag}>"

    def page(self) -> tuple[str, list[int]]:
        self.labels, r = [], self.random
        parts = [self.rest("notice") if r.random() < 0.3 else "", self.rest("header") if r.random() < 0.6 else "", self.rest("menu") if r.random() < 0.8 else ""]
        parts += [self.rest("advert") if r.random() < 0.5 else "", self.rest("side") if r.random() < 0.25 else "", self.main()]
        parts += [self.rest(k) if r.random() < p else "" for k, p in (("share", 0.2), ("comment", 0.35), ("side", 0.35), ("form", 0.2), ("footer", 0.85), ("notice", 0.15))]
        return f"<html><head><title>{self.words(2, 5)}</title></head><body>{''.join(parts)}</body></html>", self.labels


@dataclass(frozen=True)
class Model:
    """Weights of main text against the rest by feature, and scores of the transitions."""

    weights: dict[str, float]
    transitions: tuple[tuple[float, float], tuple[float, float]]
    start: tuple[float, float]

    def decode(self, blocks: list[Block]) -> list[bool]:
        """Viterbi: the most probable sequence of states; true for main text."""
        best, back = [self.start[0], self.start[1]], []
        (t00, t01), (t10, t11) = self.transitions
        for i, block in enumerate(blocks):
            score = sum(self.weights.get(f, 0.0) for f in block_features(block, i / len(blocks)))
            if i:
                to_rest, to_main = (best[0] + t00, best[1] + t10), (best[0] + t01, best[1] + t11)
                back.append((to_rest[1] > to_rest[0], to_main[1] > to_main[0]))
                best = [max(to_rest), max(to_main)]
            best[1] += score
        if not blocks:
            return []
        states = [best[1] > best[0]]
        for choice in reversed(back):
            states.append(choice[states[-1]])
        return states[::-1]


def train(pages: int = TRAINING_PAGES, iterations: int = ITERATIONS, penalty: float = PENALTY, seed: int = 11) -> Model:
    """Maximum likelihood with an L2 penalty, by Adam over the whole training set."""
    grammar = PageGrammar(seed)
    samples = []
    while len(samples) < pages:
        page, labels = grammar.page()
        blocks = blocks_of(page)
        if blocks and len(blocks) == len(labels):
            samples.append(([block_features(b, i / len(blocks)) for i, b in enumerate(blocks)], labels))
    names = sorted({f for found, _ in samples for block in found for f in block})
    number = {f: i for i, f in enumerate(names)}
    longest = max(len(labels) for _, labels in samples)
    x, y, real = np.zeros((pages, longest, len(names))), np.zeros((pages, longest), int), np.zeros((pages, longest), bool)
    for p, (found, labels) in enumerate(samples):
        real[p, : len(labels)], y[p, : len(labels)] = True, labels
        for t, block in enumerate(found):
            x[p, t, [number[f] for f in block]] = 1
    size = len(names)
    theta, first, second = np.zeros(size + 6), np.zeros(size + 6), np.zeros(size + 6)
    pairs = (real[:, 1:, None, None] & (y[:, :-1, None, None] == np.arange(2)[:, None]) & (y[:, 1:, None, None] == np.arange(2))).sum(axis=(0, 1))
    seen = np.concatenate([(x * (y * real)[:, :, None]).sum(axis=(0, 1)), pairs.ravel(), np.bincount(y[:, 0], minlength=2)])
    add = np.logaddexp.reduce
    for step in range(1, iterations + 1):
        emission = np.stack([np.zeros((pages, longest)), x @ theta[:size]], axis=2)
        trans, start = theta[size : size + 4].reshape(2, 2), theta[size + 4 :]
        alpha, beta = np.zeros((pages, longest, 2)), np.zeros((pages, longest, 2))
        alpha[:, 0] = start + emission[:, 0]
        for t in range(1, longest):
            ahead = add(alpha[:, t - 1, :, None] + trans, axis=1) + emission[:, t]
            alpha[:, t] = np.where(real[:, t, None], ahead, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            behind = add(trans + (emission[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(real[:, t + 1, None], behind, 0)
        total = add(alpha[:, -1], axis=1)
        state = np.exp(alpha + beta - total[:, None, None]) * real[:, :, None]
        ahead = alpha[:, :-1, :, None] + trans + (emission[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None]
        both = (np.exp(np.minimum(ahead, 0)) * real[:, 1:, None, None]).sum(axis=(0, 1))
        expected = np.concatenate([np.einsum("pt,ptf->f", state[:, :, 1], x), both.ravel(), state[:, 0].sum(axis=0)])
        gradient = seen - expected - penalty * theta
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        theta += 0.15 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    t00, t01, t10, t11, s0, s1 = map(float, theta[size:])
    return Model(dict(zip(names, map(float, theta[:size]), strict=True)), ((t00, t01), (t10, t11)), (s0, s1))


def main_text(page: str | None, model: Model) -> str:
    blocks = blocks_of(page or "")
    return "\n\n".join(b.text for b, kept in zip(blocks, model.decode(blocks), strict=True) if kept)


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    model = model or train()

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            texts = [main_text(page, model) for page in part["html"]]
            yield pd.DataFrame({"page_id": part["page_id"], "url": part["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    return own_columns(pages, "page_id", "url", "html").mapInPandas(read, "page_id long, url string, text string, n_chars long")
