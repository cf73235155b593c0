"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks: the runs of text between the start and end tags of block
elements, with the path of elements around them.  Each block has features of its path (tags
and the words of class, id and role) and of its text; a two-state chain (article or not), trained
on labelled pages, is decoded by Viterbi, and the blocks of the article are the text.

Labelled pages are laid out from parameterised templates (``labelled_pages``), filled with the
text of at most ``max_pages`` given pages, so that names of classes, order of parts, and lengths
vary while the truth is known.  Every page is decoded whole.

Defined cases: a null or empty page, or one without article blocks, gives an empty text.  Scripts,
styles, comments in the markup and the page head never are blocks.  Unclosed and stray tags are
taken as browsers take them in the common cases (a block start ends an open paragraph).  Repeated
rows each get a row; other columns pass through; ``text`` and ``n_chars`` are replaced.
"""

import html as entities
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm.common import bounded_sample

# Fixed values of HTML: block elements, those whose content is not markup, those without content.
BLOCKS = set(
    "address article aside blockquote body button caption center dd details dialog div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label "
    "legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot "
    "th thead tr ul video audio canvas".split()
)
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math"}
RAW_END = {name: re.compile(f"</{name}", re.I) for name in RAW}
# Start tags that leave an open head open; any other one, or text, ends it.
IN_HEAD = set("html head title meta link base basefont bgsound style script noscript noframes template".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# An opening tag ends an open element of these names, up to the named boundary.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
NAMES = re.compile(
    r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I
)


@dataclass
class Block:
    path: tuple  # (tag, words of class, id and role), outermost first
    text: str
    linked: int  # characters inside links


def leaf_blocks(page) -> list[Block]:
    if not isinstance(page, str):
        return []
    stack: list[tuple[str, tuple]] = []
    found: list[Block] = []
    parts: list[str] = []
    linked, links = 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text and not any(tag == "head" for tag, _ in stack):
            path = tuple(e for e in stack if e[0] in BLOCKS)
            found.append(Block(path, text, linked))
        parts.clear()
        linked = 0

    def end_head() -> None:
        for k, (tag, _) in enumerate(stack):
            if tag == "head":
                close(k)
                break

    def close(upto: int) -> None:
        nonlocal links
        if any(tag in BLOCKS for tag, _ in stack[upto:]):
            flush()
        links -= sum(tag == "a" for tag, _ in stack[upto:])
        del stack[upto:]

    at, size = 0, len(page)
    while at < size:
        m = TOKEN.search(page, at)
        piece = page[at : m.start()] if m else page[at:]
        if piece:
            if piece.strip():
                end_head()
            # Each piece for itself: a reference does not go on behind a tag.
            parts.append(entities.unescape(piece) if "&" in piece else piece)
            if links:
                linked += len(piece.strip())
        if not m:
            break
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name, ending, attributes = name.lower(), m[1] or m[4], m[3] or m[6] or ""
        if ending:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    close(k)
                    break
            else:
                if name in BLOCKS:
                    flush()
            continue
        if name not in IN_HEAD:
            end_head()
        if name == "br":
            parts.append(" ")
            continue
        if name in RAW:
            end = RAW_END[name].search(page, at)
            at = end.start() if end else size
            continue
        if name in BLOCKS:
            flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] in ("td", "th", "li", "div", "section", "article", "button"):
                    break
            if name in ENDS:
                ends, bounds = ENDS[name]
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in bounds:
                        break
                    if stack[k][0] in ends:
                        close(k)
        if name in VOID:
            continue
        words: tuple = ()
        if attributes:
            named = " ".join(x for t in NAMES.findall(attributes) for x in t)
            spaced = re.sub(r"([a-z])([A-Z])", r"\1 \2", named).lower()
            words = tuple(dict.fromkeys(re.findall(r"[a-z]+", spaced)))
        links += name == "a"
        stack.append((name, words))
    close(0)
    flush()
    return found


def features(blocks: list[Block]) -> list[list[str]]:
    made = []
    n = len(blocks)
    for i, b in enumerate(blocks):
        tags = [tag for tag, _ in b.path]
        own = tags[-1] if tags else "none"
        out = {f"own={own}", *(f"in={t}" for t in tags if t not in ("html", "body"))}
        for tag, words in b.path:
            for w in words:
                out.add(f"name={w}")
                out.add(f"stem={w[:4]}")
        count = b.text.count(" ") + 1
        length = next((k for k in (2, 5, 10, 20, 40, 80) if count <= k), 999)
        density = b.linked / len(b.text)
        links = next((k for k in (0.0, 0.3, 0.7) if density <= k), 1.0)
        out |= {f"words<={length}", f"links<={links}", f"own={own}&words<={length}"}
        out |= {f"own={own}&links<={links}"}
        if b.text[-1] in ".!?…\"”»":
            out.add("sentence")
        if "," in b.text:
            out.add("comma")
        if any(c in b.text for c in "©®|»›·•"):
            out.add("sign")
        if sum(map(str.isdigit, b.text)) * 4 > len(b.text):
            out.add("digits")
        if i == 0:
            out.add("first")
        if i == n - 1:
            out.add("last")
        made.append(sorted(out))
    return made


@dataclass
class Model:
    places: dict[str, int]
    weights: np.ndarray  # features x 2 states; the last row is the bias
    moves: np.ndarray  # 2 x 2, from state to state
    start: np.ndarray

    def scores(self, rows: list[list[str]]) -> np.ndarray:
        get, w = self.places.get, self.weights
        return np.array(
            [w[[k for f in r if (k := get(f)) is not None]].sum(axis=0) + w[-1] for r in rows]
        )

    def decode(self, rows: list[list[str]]) -> list[int]:
        """The most likely states (1: article) by Viterbi."""
        if not rows:
            return []
        local, m = self.scores(rows).tolist(), self.moves.tolist()
        best = [self.start[s] + local[0][s] for s in (0, 1)]
        back = []
        for x in local[1:]:
            came, new = [], []
            for s in (0, 1):
                a, b = best[0] + m[0][s], best[1] + m[1][s]
                came.append(int(b > a))
                new.append(max(a, b) + x[s])
            back.append(came)
            best = new
        state = int(best[1] > best[0])
        states = [state]
        for came in reversed(back):
            state = came[state]
            states.append(state)
        return states[::-1]


def train(pages: list[tuple[list[list[str]], list[int]]], steps: int = 200, l2: float = 2e-4) -> Model:
    """Maximum likelihood by Adam; forward and backward run over all pages at once."""
    pages = [p for p in pages if p[0]]
    names = sorted({f for rows, _ in pages for r in rows for f in r})
    places = {f: i for i, f in enumerate(names)}
    n, longest, size = len(pages), max(len(p[0]) for p in pages), len(names) + 1
    x = np.zeros((n, longest, size), dtype=np.float32)
    y = np.zeros((n, longest), dtype=int)
    live = np.zeros((n, longest), dtype=bool)
    for i, (rows, labels) in enumerate(pages):
        for t, r in enumerate(rows):
            x[i, t, [places[f] for f in r]] = 1
            x[i, t, -1] = 1
        y[i, : len(rows)], live[i, : len(rows)] = labels, True
    flat = x.reshape(n * longest, size)
    wanted = np.eye(2)[y] * live[..., None]
    pairs = live[:, 1:]
    want_moves = np.einsum("nts,ntu->su", wanted[:, :-1] * pairs[..., None], wanted[:, 1:])
    n_blocks = live.sum()
    theta = np.zeros(size * 2 + 6)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)

    def parts(v):
        return v[: size * 2].reshape(size, 2), v[size * 2 : -2].reshape(2, 2), v[-2:]

    for step in range(1, steps + 1):
        w, moves, start = parts(theta)
        local = (flat @ w.astype(np.float32)).reshape(n, longest, 2).astype(float)
        forward = np.zeros((n, longest, 2))
        backward = np.zeros((n, longest, 2))
        forward[:, 0] = start + local[:, 0]
        for t in range(1, longest):
            new = np.logaddexp.reduce(forward[:, t - 1, :, None] + moves, axis=1) + local[:, t]
            forward[:, t] = np.where(live[:, t, None], new, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = np.logaddexp.reduce(
                moves + (local[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2
            )
            backward[:, t] = np.where(live[:, t + 1, None], new, 0)
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        chance = np.exp(forward + backward - total[:, None, None]) * live[..., None]
        joint = np.exp(
            forward[:, :-1, :, None]
            + moves
            + (local[:, 1:] + backward[:, 1:])[:, :, None, :]
            - total[:, None, None, None]
        ) * pairs[..., None, None]
        gap = (chance - wanted).reshape(n * longest, 2).astype(np.float32)
        gradient = np.concatenate(
            [
                (flat.T @ gap).ravel(),
                (joint.sum(axis=(0, 1)) - want_moves).ravel(),
                (chance[:, 0] - wanted[:, 0]).sum(axis=0),
            ]
        )
        gradient = gradient / n_blocks + l2 * theta
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta = theta - 0.05 * (mean / (1 - 0.9**step)) / (
            np.sqrt(square / (1 - 0.99**step)) + 1e-9
        )
    return Model(places, *parts(theta))


# Labelled pages.  Names in wide use for the parts of a page; fixed values, as text.
PARTS = {
    "header": "header masthead topbar banner site-header page-header branding logo",
    "nav": "nav navbar navigation menu main-menu breadcrumb breadcrumbs links toc pagination tabs",
    "aside": "sidebar side widget related recommended more-stories trending popular tags aside",
    "ad": "ad ads advert advertisement sponsored promo banner-ad ad-slot adsense sponsor promoted",
    "notice": "cookie cookies notice consent gdpr alert cookie-banner message popup subscribe warning",
    "form": "newsletter search search-form login signup subscribe contact-form form",
    "share": "share social share-buttons follow toolbar actions",
    "comments": "comments comment comment-list discussion responses replies reader-comments "
    "user-comments disqus feedback reviews reader-comment",
    "footer": "footer site-footer bottom copyright legal colophon page-footer credits",
}
ARTICLE = "content article post entry main story article-body post-content entry-content text body"
LABELS = "Home News Sports About Contact Login Share Tweet Next Previous More Menu Search Archive".split()


def labelled_pages(texts: list[str], count: int, seed: int = 11) -> list[tuple[str, list[int]]]:
    """Pages laid out at random, each with the state of every leaf block in page order."""
    r = random.Random(seed)
    texts = [t for t in texts if t.strip()] or ["One line of text.", "Another line, and more."]

    def prose(least: int, most: int) -> str:
        words = " ".join(r.choice(texts) for _ in range(3)).split()
        at = r.randrange(max(1, len(words) - least))
        out = " ".join(words[at : at + r.randint(least, most)])
        return entities.escape(out if r.random() < 0.5 else out.rstrip(".,") + ".")

    def link() -> str:
        text = r.choice(LABELS) if r.random() < 0.3 else prose(1, 6)
        return f'<a href="/{r.randrange(999)}">{text}</a>'

    def named(names: str) -> str:
        kind = r.random()
        name = r.choice(names.split())
        if kind < 0.1:
            return ""
        return f' class="{name}"' if kind < 0.6 else f' id="{name}"' if kind < 0.8 else (
            f' class="{r.choice(["box", "wrap", "inner", "row"])} {name}-{r.choice(["1", "top", "list", "area"])}"'
        )

    def chrome(kind: str, labels: list[int]) -> str:
        plain = {"header": "header", "nav": "nav", "aside": "aside", "footer": "footer", "form": "form"}
        tag = plain[kind] if kind in plain and r.random() < 0.6 else r.choice(["div", "div", "section"])
        names = "" if tag == plain.get(kind) and r.random() < 0.6 else named(PARTS[kind])
        if not names and tag in ("div", "section"):
            names = f' class="{r.choice(PARTS[kind].split())}"'
        inner = []
        if kind in ("nav", "aside", "share") and r.random() < 0.8:
            n = r.randint(2, 8)
            items = [f"<li>{link()}</li>" for _ in range(n)]
            if kind == "aside" and r.random() < 0.5:
                inner.append(f"<h3>{prose(1, 4)}</h3>")
                labels.append(0)
            inner.append(f"<ul>{''.join(items)}</ul>")
            labels.extend([0] * n)
        elif kind == "form":
            inner.append(f"<label>{prose(1, 4)}</label><input type=text><button>{r.choice(LABELS)}</button>")
            labels.extend([0, 0])
        elif kind == "comments":
            inner.append(f"<h3>{r.randint(1, 90)} {r.choice(['Comments', 'Replies', 'Responses'])}</h3>")
            labels.append(0)
            cell = r.choice(["div", "li", "article", "p"])
            for _ in range(r.randint(1, 6)):
                own = named("comment reply comment-body response") if r.random() < 0.6 else ""
                if cell == "p":
                    inner.append(f"<p{own}>{prose(3, 60)}</p>")
                    labels.append(0)
                else:
                    inner.append(f"<{cell}{own}><span>{prose(1, 2)}</span><p>{prose(3, 60)}</p></{cell}>")
                    labels.extend([0, 0])
        elif kind in ("footer", "header"):
            for _ in range(r.randint(1, 3)):
                sign = "&copy; 2020 " if kind == "footer" and r.random() < 0.6 else ""
                cell = r.choice(["p", "div", "h2"]) if r.random() < 0.7 or inner else ""
                text = sign + (link() if r.random() < 0.3 else prose(2, 14))
                inner.append(f"<{cell}>{text}</{cell}>" if cell else text)
                labels.append(0)
                if not cell:
                    break
        else:
            cell = r.choice(["p", "span", "div", ""])
            text = prose(3, 40) + (link() if r.random() < 0.3 else "")
            inner.append(f"<{cell}>{text}</{cell}>" if cell else text)
            labels.append(0)
        return f"<{tag}{names}>{''.join(inner)}</{tag}>"

    def article(labels: list[int]) -> str:
        tag = r.choice(["article", "article", "article", "main", "div", "div", "section"])
        names = named(ARTICLE)
        if tag in ("div", "section") and not names:
            names = f' class="{r.choice(ARTICLE.split())}"'
        if tag == "article" and r.random() < 0.5:
            names = ""
        inner = [f"<h1>{prose(2, 12)}</h1>"]
        labels.append(1)
        for _ in range(r.choice([1, 1, 2, 3, 5, 8, 14])):
            kind = r.random()
            if kind < 0.72:
                inner.append(f"<p>{prose(1, 120)}</p>")
                labels.append(1)
            elif kind < 0.8:
                inner.append(f"<p><b>{prose(1, 80)}<br>")
                labels.append(1)
            elif kind < 0.85:
                inner.append(f"<h2>{prose(1, 8)}</h2>")
                labels.append(1)
            elif kind < 0.9:
                n = r.randint(1, 5)
                inner.append("<ul>" + "".join(f"<li>{prose(2, 20)}</li>" for _ in range(n)) + "</ul>")
                labels.extend([1] * n)
            elif kind < 0.94:
                inner.append(f"<blockquote>{prose(5, 50)}</blockquote>")
                labels.append(1)
            elif kind < 0.96:
                inner.append(f"<pre>{prose(3, 30)}</pre>")
                labels.append(1)
            else:
                inner.append(chrome(r.choice(["ad", "aside", "share", "form", "notice"]), labels))
        if r.random() < 0.15:
            inner.append(chrome("comments", labels))
        if r.random() < 0.1:
            return f"<{tag}{names}>" + "".join(inner)
        return f"<{tag}{names}>" + "".join(inner) + f"</{tag}>"

    made = []
    for _ in range(count):
        labels: list[int] = []
        before = [k for k in ("notice", "header", "nav", "ad", "form", "aside") if r.random() < 0.45]
        after = [k for k in ("share", "ad", "comments", "aside", "notice", "form", "footer") if r.random() < 0.45]
        if r.random() < 0.2:
            r.shuffle(before)
        body = [chrome(k, labels) for k in before]
        body.append(article(labels))
        body += [chrome(k, labels) for k in after]
        page = "".join(body) if r.random() < 0.6 else f'<div class="{r.choice(["page", "wrapper", "container"])}">{"".join(body)}</div>'
        made.append((f"<html><head><title>x</title><style>p</style></head><body>{page}</body></html>", labels))
    return made


def fit(pages: DataFrame, html_column: str = "html", max_pages: int = 200, count: int = 500) -> Model:
    """Trains on ``count`` labelled pages filled with the text of ``max_pages`` given ones."""
    # Chosen by hash and looked up, so that no more than the sample's pages leave their tasks.
    name = F.xxhash64(html_column).alias("name")
    given = pages.filter(F.col(html_column).isNotNull()).select(name, F.col(html_column).alias("html"))
    chosen = bounded_sample(given.select("name").distinct(), "name", max_pages, "pages")
    sample = given.join(F.broadcast(chosen), "name").dropDuplicates(["name"]).orderBy("name")
    texts = [b.text for row in sample.select("html").collect() for b in leaf_blocks(row[0])]
    known = []
    for page, labels in labelled_pages(texts, count):
        blocks = leaf_blocks(page)
        if len(blocks) == len(labels):  # else a page whose parts ran together; not a clean example
            known.append((features(blocks), labels))
    return train(known)


def main_text(page, model: Model) -> str:
    blocks = leaf_blocks(page)
    states = model.decode(features(blocks))
    return "\n\n".join(b.text for b, s in zip(blocks, states, strict=True) if s)


def extract(df: DataFrame, model: Model, html_column: str = "html") -> DataFrame:
    """``df`` with ``text`` and ``n_chars`` in place of the page."""
    gone = {html_column, "text", "n_chars"}
    kept = [f for f in df.schema.fields if f.name not in gone]
    made = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            texts = [main_text(page, model) for page in batch[html_column]]
            yield batch[[f.name for f in kept]].assign(text=texts, n_chars=[len(t) for t in texts])

    return df.mapInPandas(run, T.StructType([*kept, *made]))
