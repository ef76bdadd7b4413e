"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks: the text between two block-level tags, with the tags, class and
id words of its ancestors. Blocks get features of their ancestors and of their text, the chain
gets features of neighbouring blocks (same parent or not), and Viterbi decoding decides for the
whole page which blocks are main text and which are menus, headers, footers, sidebars, notices,
adverts, forms or comments. Scripts, styles and the head are no blocks at all.

The field is trained on labelled pages that a generator lays out in many ways (``labelled_page``),
with the blocks' labels known from the layout; PAGES of them is the bound. Maximum likelihood with
forward-backward, no sampling: the same weights at every run.

Null and empty pages and pages without main text give an empty text. Malformed markup (open tags,
stray end tags, cut pages) is read as far as it goes. Pages are read whole. Repeated rows are
extracted each, extra columns are not read, an empty table gives no rows.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PAGES = 400
EPOCHS = 120
RATE = 0.25
DECAY = 1e-3

# Fixed values of HTML: elements inside a line, without content, and without text of the page.
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("script style head title noscript template svg math iframe object canvas audio video select textarea button".split())
# What may stand in a head; any other start tag, and text, ends it.
HEAD = set("base basefont bgsound head link meta noscript script style template title".split())
# A start tag on the left ends open elements on the right, up to the nearest element of SCOPE.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"},
}
SCOPE = set("html body article section main nav aside header footer div table ul ol dl form blockquote figure td th li".split())

# Ancestors of a block that give it features, the nearest ones.
DEPTH = 64

WORDS_IN_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Blocks(HTMLParser):
    """Collects (text, path, parent, share of linked characters); a path lists (tag, name words).

    A path has the DEPTH nearest ancestors that are no inline elements, so a block costs the same
    however many elements a page leaves open.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, tuple, int, float]] = []
        self.open: list[str] = []
        self.count: Counter[str] = Counter()
        # The open elements that are not inline, with name words and a number each.
        self.outer: list[tuple[str, tuple[str, ...], int]] = []
        self.held: list[str] = []
        self.linked = 0
        self.links = 0
        self.silent = 0
        self.serial = 0

    def flush(self) -> None:
        if self.held:
            text = " ".join("".join(self.held).split())
            if text:
                path = tuple((tag, names) for tag, names, _ in self.outer[-DEPTH:])
                parent = self.outer[-2][2] if len(self.outer) > 1 else 0
                self.found.append((text, path, parent, min(1.0, self.linked / len(text))))
            self.held, self.linked = [], 0

    def end_head(self, anywhere: bool) -> None:
        """The end tag of a head may be missing."""
        for at in range(len(self.open) - 1, -1 if anywhere else max(-1, len(self.open) - 2), -1):
            if self.open[at] == "head":
                self.leave(at)
                return

    def handle_starttag(self, tag, attrs):
        if self.silent and tag not in HEAD:
            self.end_head(tag in ("body", "frameset"))
        if tag not in INLINE:
            self.flush()
            ended = CLOSES.get(tag, set()) | {"p"}
            left = sum(self.count[e] for e in ended)
            at = len(self.open)
            while left and (at := at - 1) >= 0:
                if self.open[at] in ended:
                    self.leave(at)
                    left -= 1
                elif self.open[at] in SCOPE:
                    break
        elif tag == "br":
            self.held.append(" ")
        if tag in VOID:
            return
        names: tuple[str, ...] = ()
        for key, value in attrs:
            if key in ("class", "id", "role") and value:
                names += tuple(w.lower() for w in WORDS_IN_NAMES.findall(value))
            elif key == "hidden" or key == "style" and value and "display:none" in value.replace(" ", "").lower():
                names += ("hidden",)
        self.serial += 1
        self.open.append(tag)
        self.count[tag] += 1
        if tag not in INLINE:
            self.outer.append((tag, names, self.serial))
        self.links += tag == "a"
        self.silent += tag in SILENT

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.flush()
        if not self.count[tag]:
            return
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at] == tag:
                self.leave(at)
                return
            # The end of a phrase never ends a section around it.
            if tag in INLINE and self.open[at] in SCOPE:
                return

    def leave(self, at: int) -> None:
        for tag in self.open[at:]:
            self.count[tag] -= 1
            self.links -= tag == "a"
            self.silent -= tag in SILENT
            if tag not in INLINE:
                self.outer.pop()
        del self.open[at:]

    def handle_data(self, data):
        if self.silent and not data.isspace():
            self.end_head(False)
        if not self.silent:
            self.held.append(data)
            if self.links:
                self.linked += len(data)


def blocks_of(html: str) -> list[tuple[str, tuple, int, float]]:
    reader = Blocks()
    reader.feed(html)
    # A comment without an end hides the rest of the page.
    if reader.rawdata.startswith("<!--"):
        reader.rawdata = ""
    reader.close()
    reader.flush()
    return reader.found


def path_features(path: tuple) -> tuple[str, ...]:
    """Features of a block's ancestors: tags and name words anywhere above, and the nearest of each."""
    found = {f"in {tag}" for tag, _ in path} | {f"named {w}" for _, names in path for w in names}
    if path:
        found.add(f"is {path[-1][0]}")
    nearest = [names for _, names in path if names]
    if nearest:
        found |= {f"near {w}" for w in nearest[-1]}
    landmarks = [tag for tag, _ in path if tag in ("article", "main", "nav", "aside", "header", "footer", "form", "section")]
    found.add("landmark " + (landmarks[-1] if landmarks else "none"))
    return tuple(sorted(found))


def text_features(text: str, linked: float) -> tuple[str, ...]:
    words = text.count(" ") + 1
    size = "1" if words == 1 else "2-4" if words < 5 else "5-14" if words < 15 else "15-49" if words < 50 else "50+"
    return (
        f"words {size}",
        f"linked {'all' if linked > 0.9 else 'part' if linked > 0.3 else 'little' if linked > 0 else 'none'}",
        f"ends {'sentence' if text[-1] in '.!?…”\"»' else 'open'}",
        f"sign {'yes' if any(c in text for c in '©®|›»→') else 'no'}",
    )


Sequence = tuple[list[tuple[str, ...]], list[bool]]


def sequence_of(blocks: list[tuple[str, tuple, int, float]], cache: dict) -> Sequence:
    """Features of each block, and whether each block but the first shares its parent with the one before."""
    features = []
    for text, path, _, linked in blocks:
        if path not in cache:
            cache[path] = path_features(path)
        features.append(cache[path] + text_features(text, linked))
    same = [a[2] == b[2] for a, b in zip(blocks, blocks[1:])]
    return features, same


# --- labelled pages -------------------------------------------------------------------------

# Name words of page parts; a page draws its own.
MAIN_NAMES = "content main article post entry story body text page".split()
PART_NAMES = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs toc pagination pager tabs".split(),
    "header": "header masthead branding topbar logo site title".split(),
    "footer": "footer copyright legal colophon credits bottom".split(),
    "aside": "sidebar aside widget rail related recommended trending popular teaser tags".split(),
    "notice": "notice cookie consent banner alert gdpr popup modal overlay disclaimer newsletter subscribe paywall message".split(),
    "ad": "ad ads advert advertisement adsbox sponsored sponsor promo promoted promotion".split(),
    "form": "form search login signup contact register poll".split(),
    "comments": "comment comments commentlist reply replies respond discussion disqus reader responses".split(),
    "share": "share social sharing follow author byline meta".split(),
}
PART_TAGS = {
    "nav": ["nav", "div", "ul", "td"], "header": ["header", "div"], "footer": ["footer", "div"], "aside": ["aside", "div", "section"],
    "notice": ["div", "section", "aside", "p"], "ad": ["div", "aside", "section", "p"], "form": ["form"],
    "comments": ["section", "div", "ol", "ul", "aside"], "share": ["div", "ul"],
}


def labelled_page(number: int, seed: int = 11) -> tuple[str, list[str]]:
    """The html of a generated page and its main blocks in order."""
    rng = random.Random(seed * 1_000_003 + number)
    main: list[str] = []
    serial = iter(range(10**9))

    def word() -> str:
        return "".join(rng.choice("abcdefghilmnoprstuvz") for _ in range(rng.choice([2, 3, 4, 5, 7, 9])))

    def phrase(low: int, high: int, stop: str | None = None) -> str:
        n = rng.randint(low, high)
        # A number of its own keeps blocks apart, so labels can be told by text.
        spelt = " ".join([word() for _ in range(n)] + [f"x{next(serial)}"])
        return spelt.capitalize() + (rng.choice([".", ".", ".", "!", "?", ""]) if stop is None else stop)

    def named(part: str, tag: str) -> str:
        names = PART_NAMES[part]
        if tag in ("nav", "header", "footer", "aside", "form") and rng.random() < 0.5:
            return f"<{tag}>"
        value = rng.choice(names)
        if tag in ("div", "section", "ul") and part in ("nav", "header", "footer", "form") and rng.random() < 0.15:
            return f'<{tag} role="{dict(nav="navigation", header="banner", footer="contentinfo", form="search")[part]}">'
        if rng.random() < 0.3:
            value += rng.choice(["-", "_", " "]) + rng.choice(["box", "content", "inner", "wrapper", "list", "text", "area"])
        return f'<{tag} {rng.choice(["class", "class", "id"])}="{value}">'

    def boiler(part: str) -> str:
        tag = rng.choice(PART_TAGS[part])
        inside = []
        for _ in range(rng.randint(1, 5) if part in ("nav", "aside", "comments", "footer") else rng.randint(1, 2)):
            if part == "nav" or part in ("aside", "footer", "share") and rng.random() < 0.5:
                link = f'<a href="/{word()}">{phrase(0, 3, "")}</a>'
                inside.append(f"<li>{link}</li>" if rng.random() < 0.7 or tag == "ul" else link)
            elif part == "comments":
                item = f"<p>{phrase(2, 60)}</p>"
                if rng.random() < 0.4:
                    item = f'<div class="{rng.choice(["author", "user", "meta"])}">{phrase(0, 2, "")}</div>' + item
                if tag not in ("ol", "ul") and rng.random() < 0.3:
                    item = f'<{(own := rng.choice(["article", "div"]))} class="{rng.choice(["comment", "reply", "response"])}">{item}</{own}>'
                inside.append(f"<li>{item}</li>" if tag in ("ol", "ul") else item)
            elif part == "form":
                inside.append(f"<label>{phrase(0, 3, '')}</label><input name='q'><button>{word()}</button>")
            else:
                sign = "&copy; " if part == "footer" and rng.random() < 0.6 else ""
                body = sign + phrase(1, 30)
                if part == "header" and tag != "p" and rng.random() < 0.5:
                    inside.append(f"<{(own := rng.choice(['h1', 'h1', 'h2', 'p']))}>{phrase(0, 6, '')}</{own}>")
                    continue
                inside.append(body if tag == "p" else rng.choice([f"<p>{body}</p>", body, f"<h3>{body}</h3>", f"<span>{body}</span>"]))
        body = "".join(inside) if tag != "p" else inside[0]
        if part == "nav" and tag != "ul" and rng.random() < 0.6:
            body = f"<ul>{body}</ul>"
        return f"{named(part, tag)}{body}</{tag}>"

    def content() -> str:
        kind = rng.random()
        if kind < 0.72:
            text = phrase(0, 6) if rng.random() < 0.25 else phrase(8, 120)
            main.append(text)
            if rng.random() < 0.15:
                a, _, b = text.partition(" ")
                return f'<p>{a} <a href="/x">{b}</a></p>' if rng.random() < 0.3 and len(b) < 40 else f"<p>{a} <em>{b}</em></p>"
            return f"<p>{text}</p>" if rng.random() < 0.9 else f"<p><b>{text}<br>"
        if kind < 0.82:
            text = phrase(1, 8, "")
            main.append(text)
            tag = rng.choice(["h1", "h2", "h3"])
            return f"<{tag}>{text}</{tag}>"
        if kind < 0.9:
            items = [phrase(1, 20) for _ in range(rng.randint(2, 4))]
            main.extend(items)
            tag = rng.choice(["ul", "ol"])
            return f"<{tag}>" + "".join(f"<li>{t}</li>" for t in items) + f"</{tag}>"
        text = phrase(5, 40)
        main.append(text)
        return rng.choice(["<blockquote><p>{}</p></blockquote>", "<pre>{}</pre>", "<table><tr><td>{}</td></tr></table>", "<figure><figcaption>{}</figcaption></figure>", "<div>{}</div>"]).format(text)

    dark = random.Random(f"hidden {seed} {number}")

    def hidden() -> str:
        text = " ".join("".join(dark.choices("abcdefghilmnoprstuvz", k=dark.randint(2, 9))) for _ in range(dark.randint(4, 60)))
        tag, how = dark.choice(["p", "div", "span"]), dark.choice(["hidden", 'style="display:none"', 'style="color:red; display: none;"'])
        return f"<div {how}><p>{text}.</p></div>" if tag == "span" else f"<{tag} {how}>{text}.</{tag}>"

    before = [boiler(p) for p in rng.sample(["nav", "header", "notice", "ad", "aside", "form", "share"], rng.randint(1, 5))]
    after_kinds = rng.sample(["footer", "aside", "ad", "notice", "form", "nav", "share"], rng.randint(1, 4))
    body = []
    if rng.random() < 0.75:
        title = phrase(1, 10, "")
        main.append(title)
        body.append(f"<h1>{title}</h1>")
    for _ in range(rng.randint(1, 14)):
        body.append(content())
        if dark.random() < 0.06:
            body.append(hidden())
        if rng.random() < 0.16:
            body.append(boiler(rng.choice(["ad", "ad", "notice", "notice", "aside", "share", "form", "nav"])))
    if rng.random() < 0.35:
        body.append(boiler("comments"))
    inner = "".join(body)
    style = rng.random()
    if style < 0.45:
        inner = f"<article>{inner}</article>" if rng.random() < 0.7 else f'<article class="{rng.choice(MAIN_NAMES)}">{inner}</article>'
    elif style < 0.65:
        inner = f"<main>{inner}</main>"
    elif style < 0.95:
        inner = f'<{(tag := rng.choice(["div", "section"]))} {rng.choice(["class", "id"])}="{rng.choice(MAIN_NAMES)}">{inner}</{tag}>'
    if rng.random() < 0.25:
        inner = f"<main>{inner}</main>"
    if rng.random() < 0.2:
        inner = f'<div class="{rng.choice(["wrapper", "container", "page", "layout", "row"])}">{inner}</div>'
    after = [boiler("comments")] if rng.random() < 0.35 else []
    after += [boiler(p) for p in after_kinds]
    return "<html><head><title>t</title></head><body>" + "".join(before) + inner + "".join(after) + "</body></html>", main


def training_set(pages: int) -> list[tuple[Sequence, list[int]]]:
    out, cache = [], {}
    for number in range(pages):
        html, main = labelled_page(number)
        wanted = {" ".join(t.split()) for t in main}
        blocks = blocks_of(html)
        out.append((sequence_of(blocks, cache), [int(b[0] in wanted) for b in blocks]))
    return out


# --- the field ------------------------------------------------------------------------------


class Field:
    """``emit`` has two weights for each feature, ``pairs`` a 2x2 table for each kind of neighbour."""

    def __init__(self, emit: dict[str, tuple[float, float]], pairs: list[list[list[float]]]):
        self.emit, self.pairs = emit, pairs

    def decode(self, features: list[tuple[str, ...]], same: list[bool]) -> list[int]:
        """The likeliest labels (1: main text), by Viterbi."""
        if not features:
            return []
        none = (0.0, 0.0)
        scores = []
        for names in features:
            got = [self.emit.get(n, none) for n in names]
            scores.append((sum(g[0] for g in got), sum(g[1] for g in got)))
        a, b = scores[0]
        back = []
        for (x, y), joined in zip(scores[1:], same):
            t = self.pairs[int(joined)]
            from_a, from_b = (a + t[0][0] >= b + t[1][0]), (a + t[0][1] >= b + t[1][1])
            a, b = (
                (a + t[0][0] if from_a else b + t[1][0]) + x,
                (a + t[0][1] if from_b else b + t[1][1]) + y,
            )
            back.append((0 if from_a else 1, 0 if from_b else 1))
        label = int(b > a)
        labels = [label]
        for choice in reversed(back):
            label = choice[label]
            labels.append(label)
        return labels[::-1]


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(pages: list[tuple[Sequence, list[int]]], epochs: int = EPOCHS) -> Field:
    """Maximum likelihood by forward-backward over all pages at once, with Adam and weight decay."""
    pages = [p for p in pages if p[1]]
    names = sorted({n for (features, _), _ in pages for block in features for n in block})
    number = {n: i for i, n in enumerate(names)}
    longest = max(len(y) for _, y in pages)
    ids = [number[n] for (features, _), _ in pages for block in features for n in block]
    ids = np.array(ids)
    counts = np.array([len(block) for (features, _), _ in pages for block in features])
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    page = np.concatenate([[i] * len(y) for i, (_, y) in enumerate(pages)])
    place = np.concatenate([range(len(y)) for _, y in pages])
    gold = np.concatenate([y for _, y in pages])
    sizes = np.array([len(y) for _, y in pages])
    kind = np.zeros((len(pages), longest), int)
    for i, ((_, same), _) in enumerate(pages):
        kind[i, 1 : len(same) + 1] = same
    weights, pairs = np.zeros((len(names), 2)), np.zeros((2, 2, 2))
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (weights, pairs)]
    rows = np.arange(len(pages))
    gold_pairs = np.zeros((2, 2, 2))
    inner = place > 0
    np.add.at(gold_pairs, (kind[page[inner], place[inner]], gold[np.flatnonzero(inner) - 1], gold[inner]), 1)
    gold_one = np.eye(2)[gold]
    for step in range(1, epochs + 1):
        score = np.zeros((len(pages), longest, 2))
        score[page, place] = np.add.reduceat(weights[ids], starts, axis=0)
        forward, backward = score.copy(), np.zeros_like(score)
        for t in range(1, longest):
            live = (sizes > t)[:, None]
            moved = _logsum(forward[:, t - 1, :, None] + pairs[kind[:, t]], 1) + score[:, t]
            forward[:, t] = np.where(live, moved, forward[:, t - 1])
        total = _logsum(forward[rows, sizes - 1], 1)
        for t in range(longest - 2, -1, -1):
            live = (sizes > t + 1)[:, None]
            moved = _logsum(pairs[kind[:, t + 1]] + (score[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(live, moved, 0.0)
        chance = np.exp(forward + backward - total[:, None, None])[page, place]
        slope = np.zeros_like(weights)
        error = np.repeat(chance - gold_one, counts, axis=0)
        for k in range(2):
            slope[:, k] = np.bincount(ids, weights=error[:, k], minlength=len(names))
        pair_slope = -gold_pairs.copy()
        for t in range(1, longest):
            live = sizes > t
            joint = np.exp(
                forward[live, t - 1, :, None] + pairs[kind[live, t]] + (score[live, t] + backward[live, t])[:, None, :]
                - total[live, None, None]
            )
            for k in range(2):
                pair_slope[k] += joint[kind[live, t] == k].sum(axis=0)
        for p, g, (m, v) in zip((weights, pairs), (slope, pair_slope), state):
            g = g / len(pages) + DECAY * p
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Field({n: (float(weights[i, 0]), float(weights[i, 1])) for n, i in number.items()}, pairs.tolist())


@lru_cache(maxsize=1)
def trained(pages: int = PAGES) -> Field:
    return fit(training_set(pages))


def main_text(html: str | None, field: Field, cache: dict) -> tuple[str, int, int]:
    """Main text, number of blocks, number of main blocks."""
    blocks = blocks_of(html or "")
    labels = field.decode(*sequence_of(blocks, cache))
    kept = [b[0] for b, label in zip(blocks, labels) if label]
    return "\n".join(kept), len(blocks), len(kept)


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """page_id, url, text, n_chars and block counts of every page."""
    field = field or trained()
    shared = pages.sparkSession.sparkContext.broadcast((field.emit, field.pairs))

    def batches(arriving: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, cache = Field(*shared.value), {}
        for batch in arriving:
            found = []
            for html in batch.column("html"):
                if len(cache) > 100_000:
                    cache.clear()
                found.append(main_text(html.as_py(), fitted, cache))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array([f[0] for f in found], pa.string()),
                    *[pa.array(x, pa.int64()) for x in ([len(f[0]) for f in found], [f[1] for f in found], [f[2] for f in found])],
                ],
                ["page_id", "url", "text", "n_chars", "n_blocks", "n_main"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", "html").mapInArrow(
        batches,
        f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long, n_blocks long, n_main long",
    )
