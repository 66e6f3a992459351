"""Operator 6: main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks. Each block is a vector of hashed words of its tag path (tags, classes,
ids), hashed words of its text and a few numbers; a bidirectional LSTM in numpy reads the whole sequence in both
directions and labels every block. It is fitted on a bounded sample of the given pages: their blocks are named by what
the tags around them say, and are also dealt into further layouts (sidebars, notices, forms, comments, and pages whose
markup says nothing), so that the labeller knows those too.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.llm.jobs import table
from quantloom.llm.text import arrow_rows

#: Fixed values of HTML: tags inside a line of text, tags without an end, and tags whose content is no text.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template noscript svg math iframe object canvas audio video head title textarea select option button".split())
_RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe", "template"))
#: What tags, classes, ids and roles say about a part of a page.
NOISE_TAGS = frozenset("nav header footer aside form menu dialog".split())
NOISE_WORDS = frozenset(
    "ad ads advert advertisement sponsor sponsored promo banner nav navbar navigation menu breadcrumb breadcrumbs header masthead footer foot sidebar side aside widget "
    "cookie cookies consent notice alert popup modal newsletter subscribe signup login search form comment comments discussion reply replies respond share social related "
    "recommended pagination pager tags meta byline toolbar skip copyright legal".split()
)
#: Parts of these tags and names hold nothing of the article, whatever stands in them.
CLOSED_TAGS = frozenset("nav footer aside form menu dialog".split())
CLOSED_WORDS = frozenset("comment comments discussion reply replies respond cookie cookies consent newsletter advert advertisement ad ads".split())
MAIN_TAGS = frozenset(("article", "main"))
MAIN_WORDS = frozenset("article content main post entry story body text".split())
#: A part around this share of a page's blocks is a wrapper, whose names (has-sidebar, with-header) say nothing of a block.
_WRAPPER = 0.8

_TAG = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)>", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[a-z]+")

PATH, WORDS, NUMBERS = 512, 48, 10
INPUT, HIDDEN_UNITS = PATH + WORDS + NUMBERS, 24


@dataclass(slots=True)
class Block:
    text: str
    path: tuple[str, ...]
    linked: int


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks with text, in page order; path holds the tags around a block, each followed by the words of its class, id and role, with a dot before them."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    linked = at = hidden = links = 0
    raw_end = None

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append(Block(text, tuple(x for tag, names in stack if tag not in INLINE for x in (tag, *names)), linked))
            pieces.clear()
        linked = 0

    def say(chunk: str) -> None:
        nonlocal linked
        if chunk and not hidden:
            text = html.unescape(chunk) if "&" in chunk else chunk
            pieces.append(text)
            if links:
                linked += len(text)

    for m in _TAG.finditer(page):
        tag = m[2].lower() if m[2] else None
        if raw_end:
            if tag != raw_end or not m[1]:
                continue
            at = m.start()
            raw_end = None
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        if not tag:
            continue
        if tag not in INLINE:
            flush()
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    for gone, _ in stack[k:]:
                        hidden -= gone in HIDDEN
                        links -= gone == "a"
                    del stack[k:]
                    break
        elif tag not in VOID and not m[3].endswith("/"):
            if tag in ("p", "li", "td", "tr", "dd", "dt", "option"):
                # A new one ends the open one before it, unless a container stands between.
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        for gone, _ in stack[k:]:
                            hidden -= gone in HIDDEN
                            links -= gone == "a"
                        del stack[k:]
                        break
                    if stack[k][0] not in INLINE:
                        break
            names = tuple(f".{w}" for n in _NAMES.findall(m[3]) for w in _PART.findall("".join(n).lower())) if "=" in m[3] else ()
            stack.append((tag, names))
            hidden += tag in HIDDEN
            links += tag == "a"
            if tag in _RAW:
                raw_end = tag
    if not raw_end:
        say(page[at:])
    flush()
    return out


def _parts(path: tuple[str, ...]) -> Iterator[tuple[str, frozenset[str], tuple[str, ...]]]:
    """The parts around a block from the outermost in: tag, names, and the path down to it."""
    starts = [i for i, x in enumerate(path) if x[0] != "."] + [len(path)]
    for a, b in zip(starts, starts[1:], strict=False):
        yield path[a], frozenset(x[1:] for x in path[a + 1 : b]), path[:b]


def named_main(path: tuple[str, ...], wrappers: frozenset = frozenset()) -> bool:
    """What the parts around a block say, the outermost first: inside a main part and not, within it, inside one of another kind.

    The tags html and body and the names of wrappers say nothing. An article's own header is part of it. A main tag makes
    up for the name of a part around it (`sidebar-page`), but not for a closed one.
    """
    main = noise = False
    for tag, names, down in _parts(path):
        if tag in ("html", "body"):
            continue
        names = frozenset() if down in wrappers else names
        if tag in CLOSED_TAGS or names & CLOSED_WORDS:
            return False
        if tag == "header":
            if not main or noise:
                return False
        elif names & NOISE_WORDS:
            noise = True
        elif tag in MAIN_TAGS:
            main, noise = True, False
        elif names & MAIN_WORDS:
            main = True
    return main and not noise


def named(blocks: list[Block]) -> list[bool]:
    """named_main of a page's blocks."""
    times: dict[tuple[str, ...], int] = {}
    for b in blocks:
        for _, names, down in _parts(b.path):
            if names:
                times[down] = times.get(down, 0) + 1
    wrappers = frozenset(down for down, n in times.items() if n >= _WRAPPER * len(blocks) and len(blocks) > 3)
    # A name like `content` around everything still says that the page has it; only what would silence the page is passed over.
    silent = frozenset(down for down in wrappers if any(down == d and names & NOISE_WORDS for _, names, d in _parts(down)))
    return [named_main(b.path, silent) for b in blocks]


@lru_cache(1 << 16)
def _slot(word: str, width: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % width


@lru_cache(4096)
def _path_vector(path: tuple[str, ...], known: frozenset[str] | None) -> np.ndarray:
    v = np.zeros(PATH, np.float32)
    for w in path:
        if known is None or w in known:
            v[_slot(w, PATH)] += 1
    return np.minimum(v, 2)


def vectors(blocks: list[Block], known: frozenset[str] | None = None) -> np.ndarray:
    """A row per block; tags and names outside known, if given, say nothing, so that a new one can't pass for another by its hash."""
    x = np.zeros((len(blocks), INPUT), np.float32)
    for i, b in enumerate(blocks):
        row, words = x[i], b.text.split()
        row[:PATH] = _path_vector(b.path, known)
        slots = np.bincount([_slot(w, WORDS) for w in words], minlength=WORDS)
        row[PATH : PATH + WORDS] = slots / np.float32(max(1.0, np.sqrt((slots * slots).sum())))
        n = len(b.text)
        row[-NUMBERS:] = (
            np.log1p(n) / 5, np.log1p(len(words)) / 4, b.linked / n, sum(map(b.text.count, ".,;:")) / len(words), n / len(words) / 10,
            b.text[-1] in ".!?:", b.text[0].isupper(), i / len(blocks), min(1.0, len(blocks) / 50), 1,
        )
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _flipped(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each sequence of a padded batch (time, batch, ...) in reverse, padding left at the end."""
    t = np.arange(len(x))[:, None]
    return x[np.where(t < sizes, sizes - 1 - t, t), np.arange(x.shape[1])]


class Labeller:
    """Bidirectional LSTM and a logistic output per block; parameters by name, _f forwards and _b backwards."""

    def __init__(self, seed: int = 5):
        rng, h = np.random.default_rng(seed), HIDDEN_UNITS
        self.known: frozenset[str] | None = None
        self.p: dict[str, np.ndarray] = {"o": rng.normal(0, 0.2, 2 * h), "c": np.zeros(1)}
        for d in "fb":
            self.p |= {f"w_{d}": rng.normal(0, 0.15, (INPUT, 4 * h)), f"u_{d}": rng.normal(0, 0.15, (h, 4 * h)), f"b_{d}": np.concatenate((np.zeros(h), np.ones(h), np.zeros(2 * h)))}
            # Words that no page has shown say nothing.
            self.p[f"w_{d}"][: PATH + WORDS] *= 0.05
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _run(self, x: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        h = HIDDEN_UNITS
        gates = x @ self.p[f"w_{d}"] + self.p[f"b_{d}"]
        state = cell = np.zeros((x.shape[1], h), np.float32)
        out, kept = np.empty((*x.shape[:2], h), np.float32), []
        for t in range(len(x)):
            z = gates[t] + state @ self.p[f"u_{d}"]
            s = _sigmoid(z[:, : 3 * h])
            i, f, o, g = s[:, :h], s[:, h : 2 * h], s[:, 2 * h :], np.tanh(z[:, 3 * h :])
            before, held = cell, state
            cell = f * cell + i * g
            c = np.tanh(cell)
            out[t] = state = o * c
            kept.append((i, f, o, g, c, before, held))
        return out, kept

    def _both(self, x: np.ndarray, sizes: np.ndarray):
        forth, kept_f = self._run(x, "f")
        back, kept_b = self._run(_flipped(x, sizes), "b")
        return np.concatenate((forth, _flipped(back, sizes)), axis=2), kept_f, kept_b

    def of_blocks(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """For each page the chance of each block to be main text."""
        return self.chances([vectors(b, self.known) for b in pages])

    def chances(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """For each page's vectors the chance of each block to be main text; pages of like length run together."""
        out: list = [np.zeros(0)] * len(pages)
        order = [i for i in sorted(range(len(pages)), key=lambda i: len(pages[i])) if len(pages[i])]
        for a in range(0, len(order), 64):
            part = order[a : a + 64]
            x, sizes = padded([pages[i] for i in part])
            y = _sigmoid(self._both(x, sizes)[0] @ self.p["o"] + self.p["c"])
            for j, i in enumerate(part):
                out[i] = y[: sizes[j], j]
        return out

    def _through(self, d: str, x: np.ndarray, kept: list, dout: np.ndarray, grads: dict) -> None:
        h = HIDDEN_UNITS
        ds = dc = np.zeros((x.shape[1], h), np.float32)
        dz = np.empty((*x.shape[:2], 4 * h), np.float32)
        du = np.zeros_like(self.p[f"u_{d}"])
        for t in range(len(x) - 1, -1, -1):
            i, f, o, g, c, before, held = kept[t]
            ds = ds + dout[t]
            dc = dc + ds * o * (1 - c * c)
            dz[t] = np.concatenate((dc * g * i * (1 - i), dc * before * f * (1 - f), ds * c * o * (1 - o), dc * i * (1 - g * g)), axis=1)
            du += held.T @ dz[t]
            ds, dc = dz[t] @ self.p[f"u_{d}"].T, dc * f
        flat = dz.reshape(-1, 4 * h)
        grads |= {f"w_{d}": x.reshape(-1, INPUT).T @ flat, f"u_{d}": du, f"b_{d}": flat.sum(axis=0)}

    def fit(self, pages: list[np.ndarray], wanted: list[np.ndarray], *, epochs: int = 10, batch: int = 24, rate: float = 0.008, seed: int = 6) -> Labeller:
        """Adam on the mean logistic loss of all blocks, at a rate that falls to a tenth."""
        rng, step = np.random.default_rng(seed), 0
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        by_size = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        batches = [by_size[a : a + batch] for a in range(0, len(by_size), batch)]
        for epoch in range(epochs):
            pace = rate * (1 - 0.9 * epoch / max(1, epochs - 1))
            for k in rng.permutation(len(batches)):
                x, sizes = padded([pages[i] for i in batches[k]])
                y, live = np.zeros(x.shape[:2], np.float32), np.arange(len(x))[:, None] < sizes
                for j, i in enumerate(batches[k]):
                    y[: sizes[j], j] = wanted[i]
                h, kept_f, kept_b = self._both(x, sizes)
                err = (_sigmoid(h @ self.p["o"] + self.p["c"]) - y) * live / live.sum()
                grads = {"o": np.einsum("tb,tbh->h", err, h), "c": err.sum(keepdims=True).ravel()}
                dh = err[:, :, None] * self.p["o"]
                self._through("f", x, kept_f, dh[:, :, :HIDDEN_UNITS], grads)
                self._through("b", _flipped(x, sizes), kept_b, _flipped(dh[:, :, HIDDEN_UNITS:], sizes), grads)
                step += 1
                for name, g in grads.items():
                    m[name] += 0.1 * (g - m[name])
                    v[name] += 0.001 * (g * g - v[name])
                    self.p[name] = (self.p[name] - pace * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(p) for p in pages])
    x = np.zeros((int(sizes.max()), len(pages), INPUT), np.float32)
    for j, p in enumerate(pages):
        x[: len(p), j] = p
    return x, sizes


#: Parts of the further layouts as they stand in a path: tag, then names.
_LAYOUT_NOISE = [("nav",), ("header",), ("footer",), ("aside",), ("form",), ("section", ".comments"), ("ul", ".breadcrumb")] * 5 + [("div", f".{w}") for w in sorted(NOISE_WORDS)]
_LAYOUT_MAIN = [("article",), ("main",), ("div", ".content"), ("div", ".article", ".body"), ("div", ".post", ".entry"), ("section", ".story", ".text")]
#: Names that say nothing; they stand anywhere, and so do made-up ones.
_NEUTRAL = "container wrapper wrap row col inner outer page grid box block clearfix layout site root section left right top center item group holder panel region".split()
_TEXT_TAGS = ("p", "p", "p", "h2", "h3", "li", "blockquote", "td", "pre")


def layouts(pages: list[list[Block]], seed: int = 4) -> Iterator[tuple[list[Block], list[bool]]]:
    """Each page's blocks as they are, three times dealt into a drawn layout, and three times into one without telling names, with what they are."""
    rng = np.random.default_rng(seed)
    for blocks in pages:
        told = named(blocks)
        main, noise = ([b for b, t in zip(blocks, told, strict=True) if t is kind] for kind in (True, False))
        yield blocks, told
        if main:
            for _ in range(3):
                yield _redealt(_pieces(main, rng), noise, rng)
            for _ in range(3):
                yield _unnamed(_pieces(main, rng), noise, rng)


def _pieces(main: list[Block], rng: np.random.Generator) -> list[Block]:
    """An article made of another one: a run of its blocks, some of them cut at the ends of sentences, so that articles of all lengths are seen."""
    a = int(rng.integers(0, len(main))) if rng.random() < 0.5 else 0
    b = int(rng.integers(a, len(main))) + 1 if rng.random() < 0.5 else len(main)
    out = []
    for x in main[a:b]:
        sentences = re.split(r"(?<=[.!?]) ", x.text) if rng.random() < 0.5 else [x.text]
        step = int(rng.integers(1, 4))
        out += [Block(t, x.path, 0) for i in range(0, len(sentences), step) if (t := " ".join(sentences[i : i + step]).strip())]
    return out


def _neutral(rng: np.random.Generator, n: int) -> tuple[str, ...]:
    made_up = lambda: "".join(map(chr, rng.integers(97, 123, size=rng.integers(2, 9))))
    return tuple(f".{made_up() if rng.random() < 0.3 else _NEUTRAL[rng.integers(len(_NEUTRAL))]}" for _ in range(n))


def _around(rng: np.random.Generator) -> tuple[str, ...]:
    """Wrappers of a whole page; now and then one is named after what the page has (with-sidebar)."""
    out = tuple(x for name in _neutral(rng, rng.integers(0, 3)) for x in ("div", name))
    if rng.random() < 0.2:
        out += ("div", *_neutral(rng, 1), f".{sorted(NOISE_WORDS)[rng.integers(len(NOISE_WORDS))]}")
    return ("html", "body", *out)


def _redealt(main: list[Block], noise: list[Block], rng: np.random.Generator) -> tuple[list[Block], list[bool]]:
    """The blocks of a page in a drawn layout of named parts."""
    dealt: list[tuple[Block, bool]] = []
    around = _around(rng)

    def part(is_main: bool) -> None:
        kinds = _LAYOUT_MAIN if is_main else _LAYOUT_NOISE
        outer = (*around, *kinds[rng.integers(len(kinds))], *_neutral(rng, rng.integers(0, 2)))
        pool = main if is_main or rng.random() < 0.4 else noise or main
        picked = pool if is_main else [pool[i] for i in rng.integers(len(pool), size=rng.integers(1, 7))]
        own_header = is_main and rng.random() < 0.2
        for i, b in enumerate(picked):
            inner = (_TEXT_TAGS[rng.integers(len(_TEXT_TAGS))],)
            # A notice or a comment may stand inside the article's own part, and its first block in a header of its own.
            if is_main and rng.random() < 0.15:
                other = _LAYOUT_NOISE[rng.integers(len(_LAYOUT_NOISE))]
                if other != ("header",):
                    dealt.append((Block(b.text, (*outer, *other, *inner), b.linked), False))
            dealt.append((Block(b.text, outer + (("header", "h1") if own_header and not i else inner), b.linked if not is_main else 0), is_main))

    for _ in range(rng.integers(0, 4)):
        part(False)
    part(True)
    for _ in range(rng.integers(0, 4)):
        part(False)
    return [b for b, _ in dealt], [w for _, w in dealt]


def _unnamed(main: list[Block], noise: list[Block], rng: np.random.Generator) -> tuple[list[Block], list[bool]]:
    """The blocks of a page where no name tells what a part is: only their form, their tags and their neighbours do.

    An advert that reads like the article can't be told from it without names, so such blocks are left out.
    """
    noise = [b for b in noise if b.linked or len(b.text.split()) < 6]
    around, dealt = tuple(x for x in _around(rng) if x[1:] not in NOISE_WORDS), []

    bare, plain, titled = rng.random() < 0.3, rng.random() < 0.3, rng.random() < 0.5

    def part(blocks: list[Block], is_main: bool) -> None:
        outer = (*around, "div", *_neutral(rng, rng.integers(0, 3)))
        for i, b in enumerate(blocks):
            tag = "div" if plain else ("h1" if titled and not i and len(b.text) < 120 else "p") if is_main else ("li", "span", "div", "td")[rng.integers(4)]
            dealt.append((Block(b.text, () if bare else (*outer, tag), b.linked), is_main))

    place = int(rng.integers(len(noise) + 1))
    part(noise[:place], False)
    part(main, True)
    part(noise[place:], False)
    return [b for b, _ in dealt], [w for _, w in dealt]


def _in_runs(blocks: list[Block], told: list[bool], known: frozenset[str], most: int = 400) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A long page's vectors in runs of bounded length, so that it is learnt from like any other."""
    x, y = vectors(blocks, known), np.array(told, np.float32)
    for a in range(0, len(x), most):
        yield x[a : a + most], y[a : a + most]


def fit(pages: list[list[Block]]) -> Labeller:
    """A labeller of the pages' blocks and of the layouts drawn from them; it knows the tags and names that stand in five of them."""
    dealt = [(b, w) for b, w in layouts(pages) if b]
    seen = Counter(w for b, _ in dealt for w in {w for x in b for w in x.path})
    model = Labeller()
    model.known = frozenset(w for w, n in seen.items() if n >= 5)
    sequences = [xy for b, w in dealt for xy in _in_runs(b, w, model.known)]
    _without_words([x for x, _ in sequences])
    return model.fit([x for x, _ in sequences], [w for _, w in sequences]) if sequences else model


def _without_words(sequences: list[np.ndarray], seed: int = 8) -> None:
    """Of three sequences one loses its words and one has them exchanged for others, so that no label hangs on these alone."""
    rng = np.random.default_rng(seed)
    for i, x in enumerate(sequences):
        if i % 3 < 2:
            x[:, PATH : PATH + WORDS] = x[:, PATH + rng.permutation(WORDS)] if i % 3 else 0


def train(pages: DataFrame, *, html_col: str = "html", fit_pages: int = 200) -> Labeller:
    """Fits on fit_pages pages at most, those whose html has the smallest hashes; equal pages count once."""
    picked = pages.select(F.col(html_col).cast("string").alias("html")).where("html <> ''").select("html", F.xxhash64(F.lit(9), "html").alias("h"))
    least = picked.select("h").distinct().orderBy("h").limit(fit_pages)
    # A hash stands for few different pages, so the sample is bounded.
    found = picked.join(F.broadcast(least), "h").groupBy("h").agg(F.min("html").alias("html")).collect()
    return fit([blocks_of(r.html) for r in sorted(found, key=lambda r: r.h)])


def _extract_batches(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            pages = [blocks_of(x) if x else [] for x in part.column("html").to_pylist()]
            chances = model.value.of_blocks(pages)
            texts = [" ".join(b.text for b, c in zip(blocks, cs, strict=True) if c >= 0.5) for blocks, cs in zip(pages, chances, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64()), pa.array(list(map(len, pages)), pa.int64())],
                ["page_id", "url", "text", "n_chars", "n_blocks"],
            )


def extract(pages: DataFrame, model: Labeller, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of each page.

    Returns a row per row of pages: page_id, url, text (blocks labelled main, in page order, joined by one space),
    n_chars (its code points) and n_blocks (all blocks with text). Null or empty html, and pages without a main block,
    give an empty text. Markup that doesn't close, nested or unknown tags are read as far as they go. Repeated rows and
    null ids give a row each; empty tables give none. Other columns are ignored.
    """
    arrow_rows(pages.sparkSession)
    sent = pages.sparkSession.sparkContext.broadcast(model)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(partial(_extract_batches, model=sent), "page_id long, url string, text string, n_chars long, n_blocks long")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages)).select("page_id", "url", "text", "n_chars")
