"""Main text of web pages: a linear-chain conditional random field over a page's leaf blocks.

A page is split into the blocks of text between block-level tags. Each block has features of its
ancestor tags, their class names, and its text; neighbours in the chain have transition weights.
Pages that mark their article themselves are the labelled pages. Weights are fitted by gradient
ascent on the chains' likelihood and decoded by Viterbi.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Labelled pages that the model is fitted on, at most: a sample by hash of their ids.
SAMPLE_PAGES = 300
#: Characters that a page of that sample has, at most. Pages of any length are extracted from.
SAMPLE_CHARS = 50_000
#: Pages fitted side by side: those of like length, so that little is padded.
SIDE_BY_SIDE = 128
STEPS = 120
#: Fixed values of the HTML standard: elements that begin and end a block; whose text is not shown as such.
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td"
    " tfoot th thead tr ul".split()
)
RAW = set("script style title textarea noscript iframe noembed noframes xmp".split())
VOID = set("area base br col embed hr img input link meta source track wbr".split())
#: What closes an open element of the same kind, up to which container.
SELF_CLOSING = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
ARTICLE = {"article", "main"}
ASIDE = set("nav header footer aside form menu button select option dialog template svg object head label search".split())
#: Words in class names and ids that mark what is not the article, and what is.
ASIDE_NAMES = set(
    "ad ads adv advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright"
    " disqus foot footer form gdpr header login masthead menu nav navbar navigation newsletter notice pagination pager"
    " popup promo promoted recommend recommended related reply replies search share sharing shoutbox sidebar signup"
    " skip social sponsor sponsored subscribe subscription tags toolbar tooltip trending widget".split()
)
ARTICLE_NAMES = set("article body content entry main post story text".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)>|<[!?/][^>]*>|<[a-zA-Z!?/][^>]*\Z", re.DOTALL
)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.IGNORECASE)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE) for tag in RAW}
_ALNUM = re.compile(r"[a-z0-9]+")


def blocks(html: str) -> list[tuple[str, str, float]]:
    """The page's blocks in order: path of ancestors, text, and the share of its characters in links.

    White space inside a block is one space, character references are decoded where no tag or comment
    divides them, comments, scripts and
    styles have no text. A path is ``tag`` or ``tag.name.name`` of each open element, by ``/``.
    """
    found: list[tuple[str, str, float]] = []
    stack: list[tuple[str, str]] = []
    text: list[str] = []
    linked = anchors = 0

    def flush() -> None:
        nonlocal linked
        if text:
            whole = " ".join("".join(text).split())
            if whole:
                found.append(("/".join(label for _, label in stack), whole, min(1.0, linked / len(whole))))
            text.clear()
        linked = 0

    def close_to(tags: set[str], until: set[str]) -> None:
        nonlocal anchors
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in until:
                return
            if stack[i][0] in tags:
                anchors -= sum(tag == "a" for tag, _ in stack[i:])
                del stack[i:]
                return

    at, n = 0, len(html)
    while at < n:
        match = _TOKEN.search(html, at)
        if match is None:
            text.append(unescape(html[at:]))
            break
        if match.start() > at:
            text.append(unescape(html[at : match.start()]))
            linked += anchors and match.start() - at
        at = match.end()
        if match.group(2) is None:
            continue
        tag, attributes = match.group(2).lower(), match.group(3)
        if match.group(1):
            if tag in BLOCK:
                flush()
            close_to({tag}, set())
            continue
        if tag in RAW:
            end = _RAW_END[tag].search(html, at)
            at = end.end() if end else n
            continue
        if tag in BLOCK:
            flush()
            close_to({"p"}, {"table", "button"})
            if tag in SELF_CLOSING:
                close_to(*SELF_CLOSING[tag])
        elif tag == "br":
            text.append(" ")
        if tag not in VOID:
            names = [x for m in _NAMES.findall(attributes) for x in _ALNUM.findall("".join(m).lower())] if attributes else []
            if attributes and _HIDDEN.search(attributes):
                names.append("hidden")
            stack.append((tag, ".".join([tag, *names])))
            anchors += tag == "a"
    flush()
    return found


def _path_features(path: str) -> list[str]:
    tags, names = set(), set()
    for label in path.split("/"):
        tag, *rest = label.split(".")
        tags.add(tag)
        names.update(rest)
    out = [f"in {tag}" for tag in sorted(tags & (ARTICLE | {"li", "table", "a", "blockquote", "pre", "p"}))]
    out += [f"name {name}" for name in sorted(names & ARTICLE_NAMES)]
    if tags & ARTICLE:
        out.append("marked article")
    if tags & ASIDE or names & (ASIDE_NAMES | {"hidden"}):
        out.append("marked aside")
    last = path.rpartition("/")[2].split(".")[0]
    return [*out, f"last {last if last in BLOCK else 'inline'}"]


def _text_features(text: str, linked: float) -> list[str]:
    n = len(text)
    out = ["any", f"size {min(6, n.bit_length() // 2)}"]
    if linked > 0.5:
        out.append("linked")
    if text[-1] in ".!?…”\"":
        out.append("sentence")
    if "©" in text or "All rights" in text:
        out.append("copyright")
    return out


def features(page: list[tuple[str, str, float]]) -> list[list[str]]:
    return [_path_features(path) + _text_features(text, linked) for path, text, linked in page]


def marked_labels(page: list[tuple[str, str, float]]) -> list[int] | None:
    """1 for the blocks inside the article that the page marks, less what it marks as aside; None if it marks none."""
    found = []
    for path, _, _ in page:
        has = set(_path_features(path))
        found.append(int("marked article" in has and "marked aside" not in has))
    return found if any(found) else None


def _augmented(page: list[tuple[str, str, float]], labels: list[int]) -> list[tuple[list[list[str]], list[int]]]:
    """A labelled page as it is; with its article not marked; and with its asides inside the article.

    The last two say what markup a page need not have, and that an aside is none of the article.
    """
    plain = features(page)
    article = {"marked article", "in article", "in main"}
    unmarked = [[f for f in each if f not in article] for each in plain]
    moved = [
        each if label else sorted({*each, "marked article", "in article", "marked aside"})
        for each, label in zip(plain, labels)
    ]
    return [(plain, labels), (unmarked, labels), (moved, labels)]


class Crf:
    """Two labels, a weight for each feature and label 1, and weights of label pairs."""

    def __init__(self, weights: dict[str, float], pairs: np.ndarray):
        self.weights, self.pairs = weights, pairs
        self.paths: dict[str, float] = {}

    def score(self, path: str, text: str, linked: float) -> float:
        if path not in self.paths:
            if len(self.paths) > 100_000:
                self.paths.clear()
            self.paths[path] = sum(self.weights.get(f, 0.0) for f in _path_features(path))
        get = self.weights.get
        return self.paths[path] + sum(get(f, 0.0) for f in _text_features(text, linked))

    def decode(self, scores: list[float]) -> list[int]:
        """The most likely labels, by Viterbi."""
        (p00, p01), (p10, p11) = self.pairs.tolist()
        a, b, back = 0.0, 0.0, []
        for i, s in enumerate(scores):
            if i:
                from0, from1 = b + p10 > a + p00, b + p11 > a + p01
                a, b = max(a + p00, b + p10), max(a + p01, b + p11)
                back.append((from0, from1))
            b += s
        label, out = int(b > a), []
        for step in reversed(back):
            out.append(label)
            label = int(step[label])
        return [*out, label][::-1] if scores else []

    def extract(self, html: str | None) -> str:
        page = blocks(html or "")
        labels = self.decode([self.score(*block) for block in page])
        return " ".join(text for (_, text, _), label in zip(page, labels) if label)


#: Weights before any page is seen, to which the fit is drawn.
PRIOR = {"marked article": 3.0, "marked aside": -6.0, "any": -0.5, "linked": -1.0, "sentence": 1.0, "copyright": -1.0}


def fit(pages: list[str]) -> Crf:
    """Weights that make the labels of the pages that mark their article most likely.

    Without such pages they are :data:`PRIOR`. Forward and backward sums run over all pages at once.
    """
    sequences = []
    for html in pages:
        page = blocks(html)
        labels = marked_labels(page)
        if labels:
            sequences += _augmented(page, labels)
    names = sorted({f for seq, _ in sequences for each in seq for f in each} | set(PRIOR))
    index = {f: i for i, f in enumerate(names)}
    prior = np.array([PRIOR.get(f, 0.0) for f in names])
    if not sequences:
        return Crf(dict(zip(names, prior.tolist())), np.zeros((2, 2)))
    sequences.sort(key=lambda pair: len(pair[1]))
    groups = [_padded(sequences[i : i + SIDE_BY_SIDE], index) for i in range(0, len(sequences), SIDE_BY_SIDE)]
    w, pairs = prior.copy(), np.zeros((2, 2))
    moments = [np.zeros(len(names) + 4), np.zeros(len(names) + 4)]
    for step in range(1, STEPS + 1):
        slope = np.concatenate([prior - w, -pairs.ravel()])
        for x, y in groups:
            slope += _slope(x, y, w, pairs)
        moments[0] = 0.9 * moments[0] + 0.1 * slope
        moments[1] = 0.99 * moments[1] + 0.01 * slope**2
        move = 0.1 * moments[0] / (1 - 0.9**step) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        w, pairs = w + move[:-4], pairs + move[-4:].reshape(2, 2)
    return Crf(dict(zip(names, w.tolist())), pairs)


def _padded(sequences: list[tuple[list[list[str]], list[int]]], index: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of each block (the rest: one beyond the last feature) and labels (the rest: -1)."""
    n, longest = len(sequences), max(len(labels) for _, labels in sequences)
    most = max(len(each) for seq, _ in sequences for each in seq)
    x, y = np.full((n, longest, most), len(index), np.int32), np.full((n, longest), -1)
    for i, (seq, labels) in enumerate(sequences):
        for j, each in enumerate(seq):
            x[i, j, : len(each)] = [index[f] for f in each]
        y[i, : len(labels)] = labels
    return x, y


def _slope(x: np.ndarray, y: np.ndarray, w: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Gradient of the likelihood of labels ``y``: what they hold of each feature and label pair, less what is expected."""
    n, longest = y.shape
    mask = y >= 0
    emit = np.stack([np.zeros((n, longest)), np.append(w, 0.0)[x].sum(axis=2)], axis=2)
    forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
    forward[:, 0] = emit[:, 0]
    for j in range(1, longest):
        reached = np.logaddexp.reduce(forward[:, j - 1, :, None] + pairs, axis=1) + emit[:, j]
        forward[:, j] = np.where(mask[:, j, None], reached, forward[:, j - 1])
    for j in range(longest - 2, -1, -1):
        ahead = np.logaddexp.reduce(pairs + (emit[:, j + 1] + backward[:, j + 1])[:, None, :], axis=2)
        backward[:, j] = np.where(mask[:, j + 1, None], ahead, 0)
    total = np.logaddexp.reduce(forward[:, -1], axis=1)
    here = np.exp(forward + backward - total[:, None, None])[:, :, 1] * mask
    joint = forward[:, :-1, :, None] + pairs + (emit + backward)[:, 1:, None, :] - total[:, None, None, None]
    expected = (np.exp(np.minimum(joint, 0)) * mask[:, 1:, None, None]).sum(axis=(0, 1))
    held = [[((y[:, :-1] == a) & (y[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)]
    over = np.repeat(((y == 1) - here).ravel(), x.shape[2])
    features = np.bincount(x.ravel(), weights=over, minlength=len(w) + 1)[:-1]
    return np.concatenate([features, (np.array(held) - expected).ravel()])


def train(
    pages: DataFrame, page_id: str = "page_id", html: str = "html", sample: int = SAMPLE_PAGES, most_chars: int = SAMPLE_CHARS
) -> Crf:
    """A model fitted on at most ``sample`` pages that mark their article, those of the smallest hash of their id.

    Pages of more than ``most_chars`` characters are not among them; null pages mark nothing. A count
    says below which hash about twice the sample lies, so tasks send the driver no more than that.
    """
    page = F.col(f"`{html}`")
    marked = pages.where(F.lower(page).rlike("<(article|main)[ >]") & (F.length(page) <= most_chars))
    marked = marked.select(F.shiftrightunsigned(F.xxhash64(f"`{page_id}`"), 1).alias("h"), page.alias("html"))
    n = marked.count()
    if n > 4 * sample:
        marked = marked.where(F.col("h") < 2 * sample * 2**63 // n)
    rows = marked.orderBy("h", "html").limit(sample).collect()
    return fit([r.html for r in rows])


def extract(pages: DataFrame, model: Crf, html: str = "html") -> DataFrame:
    """``pages`` without ``html``, with ``text``: the blocks of the article in page order, by one space.

    The whole page is read, whatever its length. Null and empty pages, and pages without an article,
    have an empty text. A column ``text`` is replaced; all other columns and rows are kept.
    """
    names = pages.columns
    kept = [c for c in names if c not in (html, "text")]
    place = names.index(html)
    schema = T.StructType([*(pages.schema[c] for c in kept), T.StructField("text", T.StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model.extract(h.as_py()) for h in batch.column(place)]
            columns = [batch.column(names.index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*kept, "text"])

    return pages.mapInArrow(run, schema)
