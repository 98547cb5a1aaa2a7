"""Main text of HTML pages by a linear-chain conditional random field over DOM leaf blocks, decoded by Viterbi.

Each block has binary features of its ancestors (tags; words of class, id and role, by what they usually name) and of its text (length, links, sentence
ends, place in the page). Two labels, main and other. The model is trained by gradient ascent on the conditional log-likelihood (forward and backward over
whole pages, those of similar length at once) on labelled pages of two kinds: pages of the table that mark their article themselves (<article>, <main> or itemprop articleBody; blocks of
menus, forms and the like inside are other), of about TRAIN_PAGES (2 * TRAIN_PAGES at most) picked by hash of the page, and MADE_PAGES laid out here in many ways with the label of every block. Pages are read where they are: only
numbers of features and labels reach the driver, of whole pages, however long.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import lean, ready, slices, table
from .html_blocks import Block, blocks

TRAIN_PAGES, MADE_PAGES = 200, 500

#: What words of class, id and role usually name.
ROLES = {
    "nav": "nav navigation navbar menu menubar topbar toolbar breadcrumb breadcrumbs pagination pager sitemap toc skip tabs",
    "head": "header masthead branding logo site-title tagline banner hero-nav",
    "foot": "footer foot copyright colophon legal bottom imprint",
    "side": "sidebar side aside rail complementary widget widgets column-right secondary tagcloud",
    "ad": "ad ads adv advert advertisement adslot adbox sponsor sponsored sponsoring promo promotion promoted banner-ad dfp taboola outbrain",
    "note": "cookie cookies consent gdpr notice alert warning popup modal dialog overlay toast paywall subscribe subscription newsletter signup disclaimer announcement",
    "comment": "comment comments commentlist reply replies respond response responses discussion disqus thread reviews feedback",
    "share": "share sharing social follow like tweet facebook related recommended recommendations more popular trending teaser read-more tags tag meta byline author-bio prev next print",
    "form": "form search searchbox login register contact-form input field",
    "main": "article articlebody article-body content main-content post post-content entry entry-content story story-body body text maintext page-content prose rich-text main",
}
_ROLE_OF = {w: r for r, ws in ROLES.items() for w in ws.split()}
_NAME = re.compile(r"[a-z0-9]+(?:[-_][a-z0-9]+)*")
_TAGS = frozenset("article main nav header footer aside form ul ol li table td th h1 h2 h3 h4 p blockquote pre figure figcaption button label address section div dl dt dd details".split())
_END = re.compile(r"[.!?…。][\"'”’»)\]]*$")
_SENTENCE = re.compile(r"[.!?,;:](?:\s|$)")


def roles(names: list[str]) -> set[str]:
    """Roles named by class, id and role words, whole or by parts."""
    out = set()
    for s in names:
        for w in _NAME.findall(s):
            r = _ROLE_OF.get(w)
            if r is None:
                for part in re.split(r"[-_]", w) if "-" in w or "_" in w else ():
                    if part in _ROLE_OF:
                        out.add(_ROLE_OF[part])
            else:
                out.add(r)
    return out


#: Every feature a block can have.
FEATURES = [
    "bias", "ends", "first", "last", "rights", "long", "role:none", "leaf:none", *(f"{k}:{t}" for t in sorted(_TAGS) for k in ("in", "leaf")), *(f"role:{r}" for r in ROLES),
    *(f"{k}:{i}" for k, n in (("words", 5), ("links", 4), ("marks", 4), ("place", 5), ("deep", 4)) for i in range(n)),
]
_NUMBER = {f: i for i, f in enumerate(FEATURES)}


def features(page: list[Block]) -> list[list[str]]:
    """Binary features of every block of a page."""
    out, n = [], len(page)
    seen: dict[tuple, set[str]] = {}
    longest = max((len(b.text) for b in page), default=1)
    for i, b in enumerate(page):
        key = tuple(b.names)
        if key not in seen:
            seen[key] = roles(b.names)
        own = seen[key]
        tags = set(b.tags)
        words = b.text.count(" ") + 1
        f = ["bias"]
        f += [f"in:{t}" for t in tags & _TAGS]
        f += [f"role:{r}" for r in own]
        if not own:
            f.append("role:none")
        f.append(f"leaf:{next((t for t in reversed(b.tags) if t in _TAGS), 'none')}")
        f.append(f"words:{0 if words < 3 else 1 if words < 7 else 2 if words < 15 else 3 if words < 40 else 4}")
        share = b.linked / len(b.text)
        f.append(f"links:{0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.8 else 3}")
        if _END.search(b.text):
            f.append("ends")
        marks = len(_SENTENCE.findall(b.text))
        f.append(f"marks:{min(3, marks)}")
        f.append(f"place:{min(4, 5 * i // n)}")
        if i == 0:
            f.append("first")
        if i == n - 1:
            f.append("last")
        if "©" in b.text[:40]:
            f.append("rights")
        if 2 * len(b.text) > longest:
            f.append("long")
        f.append(f"deep:{min(3, len(b.tags) // 3)}")
        out.append(f)
    return out


class Crf:
    """Two-label linear chain: weights of features for label 1 against 0, transitions, and start."""

    def __init__(self, names: dict[str, int], w: np.ndarray, step: np.ndarray, start: np.ndarray):
        self.names, self.w, self.step, self.start = names, w, step, start

    def scores(self, feats: list[list[str]]) -> np.ndarray:
        w, names = self.w, self.names
        return np.array([sum(w[names[f]] for f in fs if f in names) for fs in feats])

    def decode(self, feats: list[list[str]]) -> list[int]:
        """The most probable labels (Viterbi); label 0 at ties."""
        if not feats:
            return []
        s = self.scores(feats).tolist()
        (a00, a01), (a10, a11) = self.step.tolist()
        v0, v1 = self.start[0], self.start[1] + s[0]
        back = []
        for x in s[1:]:
            from0, from1 = v1 + a10 > v0 + a00, v1 + a11 > v0 + a01
            back.append((from0, from1))
            v0, v1 = (v1 + a10 if from0 else v0 + a00), (v1 + a11 if from1 else v0 + a01) + x
        y = [int(v1 > v0)]
        for b in reversed(back):
            y.append(int(b[y[-1]]))
        return y[::-1]


def train(pages: list[tuple[list[list[str]], list[int]]], rounds: int = 150, ridge: float = 0.02) -> Crf:
    """Maximum conditional likelihood with a ridge, by Adam, on whole pages."""
    return _train([(np.array([_NUMBER[k] for f in fs for k in f], np.int64), np.array([len(f) for f in fs], np.int64), np.array(ys, np.int64)) for fs, ys in pages if fs], rounds, ridge)


def _train(pages: list[tuple[np.ndarray, np.ndarray, np.ndarray]], rounds: int = 150, ridge: float = 0.02) -> Crf:
    """pages: features of all blocks, how many each block has, and labels. Pages whose lengths are within a power of two go through forward and backward side by side."""
    pages = sorted(pages, key=lambda p: len(p[1]))
    n, used = len(pages), np.unique(np.concatenate([np.zeros(0, np.int64), *(f for f, *_ in pages)]))
    column = np.zeros(len(FEATURES), np.int64)
    column[used] = np.arange(len(used))
    size = np.array([len(k) for _, k, _ in pages], np.int64)
    flat = np.zeros((size.sum(), len(used)), np.float32)
    flat[np.repeat(np.arange(size.sum()), np.concatenate([np.zeros(0, np.int64), *(k for _, k, _ in pages)])), column[np.concatenate([np.zeros(0, np.int64), *(f for f, *_ in pages)])]] = 1
    label = np.concatenate([np.zeros(0, np.int64), *(y for *_, y in pages)])
    at = np.cumsum(size) - size
    groups = []
    for g in np.split(np.arange(n), np.flatnonzero(np.diff(np.log2(np.maximum(size, 1)).astype(int))) + 1) if n else ():
        t = int(size[g].max())
        mask = np.arange(t)[None, :] < size[g][:, None]
        place = np.where(mask, at[g][:, None] + np.arange(t), 0)
        hot = np.stack([label[place] == 0, label[place] == 1], 2) & mask[:, :, None]
        pair = (hot[:, :-1, :, None] & hot[:, 1:, None, :]).sum((0, 1))
        groups.append((mask, place, hot[:, 0].sum(0), pair))
    theta = np.zeros(len(used) + 6)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, rounds + 1 if n else 0):
        w, step, start = theta[:-6], theta[-6:-2].reshape(2, 2), theta[-2:]
        score = flat @ w
        p, edge, begin = np.zeros(len(flat)), np.zeros((2, 2)), np.zeros(2)
        for mask, place, hot, pair in groups:
            s = np.zeros((*mask.shape, 2))
            s[..., 1] = np.where(mask, score[place], 0)
            fwd, bwd, t = np.zeros_like(s), np.zeros_like(s), mask.shape[1]
            fwd[:, 0] = start + s[:, 0]
            for j in range(1, t):
                fwd[:, j] = np.where(mask[:, j, None], np.logaddexp.reduce(fwd[:, j - 1, :, None] + step, axis=1) + s[:, j], fwd[:, j - 1])
            for j in range(t - 2, -1, -1):
                bwd[:, j] = np.where(mask[:, j + 1, None], np.logaddexp.reduce(step[None] + (s[:, j + 1] + bwd[:, j + 1])[:, None, :], axis=2), 0)
            total = np.logaddexp.reduce(fwd[:, -1], axis=1)
            own = np.exp(fwd + bwd - total[:, None, None])
            p[place[mask]] = own[..., 1][mask]
            both = np.exp(fwd[:, :-1, :, None] + step + (s[:, 1:] + bwd[:, 1:])[:, :, None, :] - total[:, None, None, None]) * mask[:, 1:, None, None]
            edge += pair - both.sum((0, 1))
            begin += hot - own[:, 0].sum(0)
        g = np.concatenate([flat.T @ (label - p), edge.ravel(), begin]) / n - ridge * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta + 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return Crf({FEATURES[i]: k for k, i in enumerate(used.tolist())}, theta[:-6], theta[-6:-2].reshape(2, 2), theta[-2:])


_OUT = frozenset("nav aside form footer button label".split())


def own_labels(page: list[Block]) -> list[int] | None:
    """Labels of a page that marks its article itself; None if it doesn't."""
    inside = [bool({"article", "main"} & set(b.tags)) or any("articlebody" in n for n in b.names) for b in page]
    if not any(inside):
        return None
    other = {"nav", "foot", "side", "ad", "note", "comment", "share", "form"}
    return [int(i and not (_OUT & set(b.tags)) and not (roles(b.names) & other)) for i, b in zip(inside, page, strict=True)]


def made_pages(count: int = MADE_PAGES, seed: int = 11, unnamed: float = 0.2) -> Iterator[str]:
    """Pages of many layouts whose elements carry data-mark: 1 for main text, 0 for anything else. In a share `unnamed` of pages, names of class and id say nothing: they are made-up words."""
    rng = random.Random(seed)
    syllable = [a + b for a in "bdfgklmnprstvz" for b in ("a", "e", "i", "o", "u", "an", "er", "in", "ol")]
    word = lambda: "".join(rng.choice(syllable) for _ in range(rng.randint(1, 3)))
    phrase = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b))).capitalize()
    sentence = lambda: phrase(4, 22).replace(" ", ", ", rng.randint(0, 1)) + rng.choice("....!?")
    para = lambda a=1, b=6: " ".join(sentence() for _ in range(rng.randint(a, b)))
    telling = [True]
    pick = lambda role: rng.choice(ROLES[role].split()) if telling[0] else word()

    def tag(name: str, inner: str, mark: int | None = None, **attrs: str) -> str:
        extra = "".join(f' {k.rstrip("_")}="{v}"' for k, v in attrs.items() if v)
        return f"<{name}{extra}{'' if mark is None else f' data-mark="{mark}"'}>{inner}</{name}>"

    def named(role: str, inner: str, mark: int = 0, names: tuple[str, ...] = ("div", "section", "div")) -> str:
        k = rng.random()
        return tag(rng.choice(names), inner, mark, **({"class_": pick(role)} if k < 0.6 else {"id": pick(role)} if k < 0.85 else {"class_": f"{word()} {pick(role)}"}))

    links = lambda a, b: tag(rng.choice(["ul", "ol", "div"]), "".join(tag("li", tag("a", phrase(1, 3), href="/" + word())) for _ in range(rng.randint(a, b))))

    def nav() -> str:
        return tag("nav", links(3, 9), 0) if rng.random() < 0.6 else named("nav", links(3, 9))

    def head() -> str:
        inner = tag(rng.choice(["h1", "p", "div"]), phrase(1, 4)) + (tag("p", phrase(3, 8)) if rng.random() < 0.5 else "")
        return tag("header", inner, 0) if rng.random() < 0.5 else named("head", inner)

    def side() -> str:
        inner = "".join(tag("h3", phrase(1, 3)) + rng.choice([links(3, 6), tag("p", para(1, 2))]) for _ in range(rng.randint(1, 3)))
        return tag("aside", inner, 0) if rng.random() < 0.5 else named("side", inner)

    def ad() -> str:
        return named("ad", rng.choice([para(1, 2), tag("p", para(1, 3)), tag("a", phrase(3, 8), href="/" + word())]), 0, ("div", "aside", "section"))

    def note() -> str:
        return named("note", tag("p", para(1, 3)) + (tag("button", phrase(1, 2)) if rng.random() < 0.6 else ""), 0, ("div", "section", "dialog"))

    def comments() -> str:
        one = lambda: tag(rng.choice(["div", "li"]), tag("p", phrase(1, 2)) + tag("p", para(1, 4)), class_=rng.choice([pick("comment"), ""]))
        return named("comment", tag("h3", phrase(1, 2)) + "".join(one() for _ in range(rng.randint(1, 5))), 0, ("div", "section", "ol"))

    def form() -> str:
        return tag("form", tag("label", phrase(1, 3)) + "<input name=q>" + (tag("p", para(1, 2)) if rng.random() < 0.4 else "") + tag("button", phrase(1, 2)), 0)

    def share() -> str:
        return named("share", rng.choice([links(2, 6), tag("p", phrase(2, 6)), tag("h3", phrase(1, 3)) + links(2, 5)]))

    def foot() -> str:
        inner = rng.choice(["", links(2, 6)]) + rng.choice(["&copy; ", "&#169; ", ""]) + phrase(1, 4) + " &middot; " + para(1, 3)
        return tag("footer", inner, 0) if rng.random() < 0.7 else named("foot", inner)

    def article() -> str:
        body = []
        for _ in range(rng.choice([1, 2, 3, 5, 8, 14])):
            k = rng.random()
            if k < 0.08:
                body.append(tag(rng.choice(["h2", "h3"]), phrase(1, 6)))
            elif k < 0.13:
                body.append(tag(rng.choice(["ul", "ol"]), "".join(tag("li", rng.choice([sentence(), phrase(2, 8)])) for _ in range(rng.randint(2, 5)))))
            elif k < 0.17:
                body.append(tag("blockquote", rng.choice([para(1, 2), tag("p", para(1, 2))])))
            elif k < 0.20:
                body.append(tag(rng.choice(["pre", "figcaption", "td"]), phrase(3, 12)))
            elif k < 0.28:
                body.append(tag("p", phrase(1, 6) + rng.choice([".", "", ":"])))
            elif k < 0.40:
                body.append(tag("p", f"{para(1, 2)} {tag('a', phrase(1, 4), href='/' + word())} {para(1, 2)}"))
            else:
                body.append(tag(rng.choice(["p", "p", "p", "div"]), para()))
            if rng.random() < 0.06:
                body.append(rng.choice([ad, share, note, form])())
        top = tag("h1", phrase(2, 10)) if rng.random() < 0.8 else ""
        inner = top + "".join(body)
        if rng.random() < 0.15:
            inner += comments()
        k = rng.random()
        if k < 0.45:
            return tag("article", inner, 1)
        if k < 0.6:
            return tag("main", inner, 1)
        if k < 0.9:
            return named("main", inner, 1)
        return tag("div", inner, 1)

    for _ in range(count):
        telling[0] = rng.random() >= unnamed
        before = [f() for f in (nav, head, note, ad, form, share) if rng.random() < 0.45]
        after = [f() for f in (side, ad, share, comments, form, note, nav) if rng.random() < 0.4]
        rng.shuffle(before)
        rng.shuffle(after)
        if rng.random() < 0.2:
            before.append(side())
        body = "".join(before) + article() + "".join(after) + (foot() if rng.random() < 0.9 else "")
        yield f"<html><head><title>{phrase(2, 6)}</title></head><body>{body}</body></html>"


def _numbers(page: list[Block], y: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    fs = features(page)
    return np.array([_NUMBER[k] for f in fs for k in f], np.int16), np.array([len(f) for f in fs], np.int16), np.array(y, np.int16)


@lean
def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features and labels of the pages that mark their article."""
    for whole in batches:
        for b in slices(whole, "html"):
            rows = [_numbers(page, y) for page in map(blocks, b.column("html").to_pylist()) if page and (y := own_labels(page)) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([x[k].tobytes() for x in rows], pa.binary()) for k in range(3)], ["features", "counts", "labels"])


def fit(pages: list[str], data: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = ()) -> Crf:
    """Trained on given pages that mark their article, on data of _labelled, and on made pages."""
    own = [_numbers(b, y) for b in map(blocks, sorted(pages)) if b and (y := own_labels(b)) is not None]
    made = [_numbers(b, [int(x.mark == "1") for x in b]) for b in map(blocks, made_pages())]
    return _train([*own, *data, *made])


def main_text(page: str | None, model: Crf) -> tuple[str, int, int]:
    """Main text, blocks taken, all blocks."""
    if not page:
        return "", 0, 0
    b = blocks(page)
    y = model.decode(features(b))
    return " ".join(x.text for x, k in zip(b, y, strict=True) if k), sum(y), len(b)


def _extract(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "html"):
                got = [main_text(p, shared.value) for p in b.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), b.column("url"), pa.array([t for t, *_ in got], pa.string()), pa.array([len(t) for t, *_ in got], pa.int64()), pa.array([k for _, k, _ in got], pa.int32()), pa.array([n for *_, n in got], pa.int32())],
                    ["id", "url", "text", "n_chars", "n_main_blocks", "n_blocks"],
                )

    return lean(run)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", train_pages: int = TRAIN_PAGES) -> DataFrame:
    """(id_col, url, text, n_chars, n_main_blocks, n_blocks), one row per row of pages; text joins the main blocks in page order by one space.

    Null and empty pages, and pages without text, have the empty text; very long ones are read whole. Blocks whose labels tie are other. Null ids and urls stay null. Repeated rows each have their row. No rows, no result rows; the
    model is then trained on made pages alone. Further columns, whatever their names, are not read.
    """
    ready(pages.sparkSession)
    kind = pages.select(id_col).schema[0].dataType.simpleString()
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    hashed = base.where("html is not null").select(F.xxhash64("html").alias("h"), "html")
    total = hashed.agg(F.approx_count_distinct("h")).first()[0]
    some = hashed.where(F.pmod("h", F.lit(max(1, total // train_pages))) == 0)
    picked = [r["h"] for r in some.select("h").distinct().orderBy("h").limit(2 * train_pages).collect()]
    marked = some.where(F.col("h").isin(picked)).dropDuplicates(["h"]).select("h", "html").mapInArrow(_labelled, "features binary, counts binary, labels binary") if picked else None
    rows = sorted(tuple(bytes(x) for x in r) for r in marked.collect()) if picked else []
    model = fit([], [tuple(np.frombuffer(x, np.int16) for x in r) for r in rows])
    shared = pages.sparkSession.sparkContext.broadcast(model)
    out = base.mapInArrow(_extract(shared), f"id {kind}, url string, text string, n_chars long, n_main_blocks int, n_blocks int")
    return out.withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
