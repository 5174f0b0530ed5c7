"""Main text of web pages by a tree-structured graphical model.

A page is parsed into a tree of elements.  Every element is a binary node
(content or not) with a potential from its features (tag, names in class, id
and role, length and link share of its text) and a potential with its parent.
Sum-product messages go from the leaves up and from the root down; an
element's text is kept if its content marginal is above one half.

Weights are trained once per call, in the driver, on at most ``TRAIN_PAGES``
pages of at most ``TRAIN_CHARS`` characters (the pages with the smallest hash;
labelled by their ``article`` or ``main`` element) and on built-in labelled
pages that combine the usual furniture of pages; every page is then decoded
whole in parallel.

Text rules: character references decoded; white space inside a block becomes
one space and is trimmed; a line break element is white space; blocks are
joined in page order by one ``\\n``; empty blocks vanish.

Defined results: null or empty html gives an empty text; broken markup is
read as browsers do (implied ends, unclosed elements end with their parent);
very long pages are read whole; repeated rows give equal rows; null ids and
urls stay null; an empty table gives an empty table; other columns are not
read, so clashing names do not matter.
"""

from __future__ import annotations

import html as _html
import math
import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_PAGES, TRAIN_CHARS = 400, 50_000

_OPEN = re.compile(r"<(?:(!--)|(!\[CDATA\[)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
_STEP = re.compile(r"""[^>"'=]*+(>|=\s*+(["'])?|["'])""")
#: Any attribute by its full name, with its value.
_ATTR = re.compile(r"""([^\s"'/=>][^\s/=>]*)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s"'>][^\s>]*)))?""")
_READ = frozenset("class id role hidden style".split())
_HINT = re.compile("(?i)class|id|role|hidden|style")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements without readable text.
_SKIP = frozenset("script style textarea title xmp iframe noembed noframes head noscript template svg canvas object "
                  "select option datalist audio video map".split())
#: Elements that are never part of an article; a form around the page's text counts as a div.
_NEVER = frozenset("nav aside form footer dialog menu".split())
_BLOCK = frozenset("html body address article aside blockquote caption center dd details dialog div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section "
                   "summary table tbody td tfoot th thead tr ul".split())
_ENDS_P = _BLOCK - frozenset("html body caption td th tr tbody thead tfoot".split())
_BOX = frozenset("html body div section article main td th center".split())
_SIBLING = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
            "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
            "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"})}

#: Names in class, id and role, by what they tell.
_NAMES = {
    "ad": "ad ads adv advert adverts advertisement advertising adslot adbox sponsor sponsored promo promotion banner dfp",
    "nav": "nav navbar navigation menu menus breadcrumb breadcrumbs crumb pagination pager toc skip tabs topbar",
    "comment": "comment comments commentlist disqus reply replies respond discussion reactions reviews",
    "side": "sidebar side aside widget widgets rail related recommended recommendations more popular trending teaser",
    "foot": "footer foot copyright colophon legal credits",
    "head": "header masthead topnav logo branding site",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay paywall subscribe newsletter signup login toast disclaimer",
    "share": "share sharing social follow like tweet bookmark print tags tag meta byline author",
    "form": "form search input",
    "main": "article post entry content main story text",
}
_GROUP = {n: g for g, names in _NAMES.items() for n in names.split()}


def _attributes(source: str) -> list[tuple[str, str]]:
    """The attributes that are read, names in lower case."""
    if not _HINT.search(source):
        return []
    return [(k.lower(), a or b or c) for k, a, b, c in _ATTR.findall(source) if k.lower() in _READ]


def _tokens(source: str):
    """``(start, end, end tag, name, attributes)`` of the mark-up, in one pass;
    the name is empty for comments and declarations.  A tag that the page never
    ends stops at its first ``>``; without one the rest is text."""
    at, n, none = 0, len(source), {'"': len(source), "'": len(source)}  # from where on a quote is not closed
    while m := _OPEN.search(source, at):
        start, at = m.start(), m.end()
        if m[1] or m[2]:
            end = source.find("-->" if m[1] else "]]>", at)
            at = n if end < 0 else end + 3
            yield start, at, "", "", ""
            continue
        if m[3]:
            end = source.find(">", at)
            if end < 0:
                return
            at = end + 1
            yield start, at, "", "", ""
            continue
        here = at
        while step := _STEP.match(source, here):
            here = step.end()
            if step[1] == ">":
                break
            if (quote := step[2]) and here < none[quote]:
                end = source.find(quote, here)
                if end < 0:
                    none[quote] = here
                else:
                    here = end + 1
        else:
            end = source.find(">", at)
            if end < 0:
                return
            here = end + 1
        yield start, here, m[4], m[5].lower(), source[at:here - 1]
        at = here


class Page:
    """Tree of one page: per node its parent, tag and names; ``pieces`` are
    (block number, node, inside a link, text) in page order."""

    def __init__(self, source: str):
        self.parent, self.tag, self.names, self.hidden = [-1], ["html"], [()], [False]
        self.pieces: list[tuple[int, int, bool, str]] = []
        self._read(source)
        for i in self._wrappers():
            self.tag[i], self.names[i] = "div", tuple(w for w in self.names[i] if _GROUP.get(w) != "form")

    def _wrappers(self) -> list[int]:
        """Forms around the page's text: an article or main element stands in
        them, or most of the text outside other furniture does."""
        if "form" not in self.tag:
            return []
        n, off = len(self.tag), []
        for i, tag in enumerate(self.tag):
            off.append(tag in _NEVER and tag != "form" or self.hidden[i] or i > 0 and off[self.parent[i]])
        main, chars = [t in ("article", "main") and not o for t, o in zip(self.tag, off)], [0] * n
        for _, node, _, text in self.pieces:
            chars[node] += 0 if off[node] else len(text.strip())
        for i in range(n - 1, 0, -1):
            chars[self.parent[i]] += chars[i]
            main[self.parent[i]] |= main[i]
        return [i for i, t in enumerate(self.tag) if t == "form" and not off[i] and (main[i] or 2 * chars[i] > chars[0])]

    def _node(self, parent: int, tag: str, attrs: list[tuple[str, str]]) -> int:
        names, hidden = [], False
        for key, value in attrs:
            if key == "style":
                hidden = hidden or bool(re.search(r"display\s*:\s*none", value, re.I))
            elif key == "hidden":
                hidden = True
            else:
                names += [w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", value)]
        self.parent.append(parent)
        self.tag.append(tag)
        self.names.append(tuple(dict.fromkeys(names)))
        self.hidden.append(hidden)
        return len(self.parent) - 1

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("html", 0)]  # (tag, node that its text belongs to); a tag ended early is ""
        opened: dict[str, list[int]] = {}  # places of every open tag in the stack, ascending
        blocks: list[int] = []  # places of open blocks
        links = skip = block = 0
        at, n, lower = 0, len(source), None

        def leave(tag: str) -> None:
            nonlocal links, skip, block
            links -= tag == "a"
            skip -= tag in _SKIP
            block += tag in _BLOCK

        def close(upto: int) -> None:
            while len(stack) > upto or not stack[-1][0]:
                tag, _ = stack.pop()
                if tag:
                    opened[tag].pop()
                    if tag in _BLOCK:
                        blocks.pop()
                    leave(tag)

        def last(tags) -> int:
            return max((opened[t][-1] for t in tags if opened.get(t)), default=0)

        def resume(tokens):
            nonlocal at
            for start, end, ends, tag, attrs in tokens:
                if start < at:  # inside raw text
                    continue
                text, at = source[at:start], end
                yield text, ends, tag, attrs
            yield source[at:], "", None, ""

        for text, ends, tag, attrs in resume(_tokens(source)):
            if text and not skip:
                self.pieces.append((block, stack[-1][1], links > 0, text))
            if tag is None:
                break
            if not tag or tag in ("html", "body") and len(stack) > 1 and not ends:
                continue
            if ends:
                if tag in ("html", "body"):
                    continue
                where = last((tag,))
                if where and (tag in _BLOCK or not blocks or blocks[-1] < where):
                    close(where)
                elif where:  # an inline end inside a block that began later
                    stack[where] = ("", stack[where][1])
                    opened[tag].pop()
                    leave(tag)
                continue
            if tag in _ENDS_P:
                where = last(("p", "td", "th", "button"))
                if where and stack[where][0] == "p":
                    close(where)
            if tag in _SIBLING:
                mine, stop = _SIBLING[tag]
                stop = last(stop)
                where = [w[k] for t in mine if (w := opened.get(t)) and (k := bisect_right(w, stop)) < len(w)]
                if where:
                    close(min(where))
            if (tag == "body" or tag in _BLOCK and stack[-1][0] == "head") and opened.get("head"):
                close(opened["head"][0])
            if tag in _VOID or attrs.endswith("/") and tag in ("path", "circle", "use"):
                if tag == "br" and not skip:
                    self.pieces.append((block, stack[-1][1], links > 0, " "))
                block += tag == "hr"
                continue
            block += tag in _BLOCK
            if tag in _RAW:
                lower = source.lower() if lower is None or len(lower) != n else lower
                end = lower.find("</" + tag, at) if len(lower) == n else -1
                if len(lower) != n:  # lower-casing changed the length: search without it
                    e = re.compile("</" + tag, re.I).search(source, at)
                    end = e.start() if e else -1
                at = n if end < 0 else end
            own = stack[-1][1]
            read = _attributes(attrs) if tag not in _SKIP else []
            if tag not in _SKIP and (tag in _BLOCK or read):
                own = self._node(own, tag, read)
            opened.setdefault(tag, []).append(len(stack))
            if tag in _BLOCK:
                blocks.append(len(stack))
            stack.append((tag, own))
            links += tag == "a"
            skip += tag in _SKIP


def _features(page: Page) -> list[list[str]]:
    """Feature names per node."""
    n = len(page.tag)
    chars, linked, commas, own = [0] * n, [0] * n, [0] * n, [0] * n
    for _, node, link, text in page.pieces:
        size = len(text.strip())
        chars[node] += size
        own[node] += size
        linked[node] += size if link else 0
        commas[node] += text.count(",") + text.count(".")
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        chars[p] += chars[i]
        linked[p] += linked[i]
    out, within = [], []
    for i in range(n):
        if page.tag[i] in ("html", "body"):  # their parts alone speak for them
            out.append([])
            within.append(frozenset())
            continue
        f = ["bias", "tag=" + (page.tag[i] if page.tag[i] in _BLOCK else "inline")]
        groups = {_GROUP[w] for w in page.names[i] if w in _GROUP}
        f += ["name=" + g for g in sorted(groups)]
        above = within[page.parent[i]]
        f += ["in=" + g for g in sorted(above)]
        within.append(above | groups if page.tag[i] not in ("article", "main") else frozenset(groups))
        share = linked[i] / chars[i] if chars[i] else 0.0
        f.append("links=%d" % (0 if share < 0.1 else 1 if share < 0.4 else 2 if share < 0.8 else 3))
        if own[i]:
            f.append("own=%d" % (0 if own[i] < 25 else 1 if own[i] < 80 else 2))
            f.append("stops=%d" % min(2, commas[i]))
        if page.hidden[i]:
            f.append("hidden")
        out.append(f)
    return out


def _fixed(page: Page) -> list[bool]:
    """Nodes that are never content: themselves or an ancestor."""
    out: list[bool] = []
    inside: list[bool] = []
    for i, tag in enumerate(page.tag):
        p = page.parent[i]
        inside.append(tag in ("article", "main") or "main" in {_GROUP.get(w) for w in page.names[i]} or (p >= 0 and inside[p]))
        never = tag in _NEVER or page.hidden[i] or (tag == "header" and not inside[i])
        out.append(never or (p >= 0 and out[p]))
    return out


def marginals(page: Page, model: dict) -> list[float]:
    """Content marginal per node by two passes of sum-product messages."""
    weight, tables = model["weight"], model["ratio"]
    n = len(page.tag)
    fixed = _fixed(page)
    ratios = [tables[t in _BOX] for t in page.tag]
    local = []
    for f, never in zip(_features(page), fixed):
        z = max(-12.0, min(12.0, sum(weight.get(x, 0.0) for x in f)))
        p = 0.0 if never else 1.0 / (1.0 + math.exp(-z))
        local.append((1.0 - p, p))
    up = [[a, b] for a, b in local]  # local potential times messages from the children
    to = [(1.0, 1.0)] * n            # message of a node to its parent
    for i in range(n - 1, 0, -1):
        (a, b), ratio = up[i], ratios[i]
        m0, m1 = a * ratio[0][0] + b * ratio[0][1], a * ratio[1][0] + b * ratio[1][1]
        s = m0 + m1
        to[i] = (m0 / s, m1 / s)
        u = up[page.parent[i]]
        u[0] *= to[i][0]
        u[1] *= to[i][1]
        s = u[0] + u[1]
        if s < 1e-200:
            u[0], u[1] = (u[0] / s, u[1] / s) if s > 0 else (1.0, 0.0)
    belief = [(0.0, 0.0)] * n
    for i in range(n):
        (a, b), ratio = up[i], ratios[i]
        if i:
            q = belief[page.parent[i]]
            c0, c1 = q[0] / max(to[i][0], 1e-300), q[1] / max(to[i][1], 1e-300)
            a, b = a * (c0 * ratio[0][0] + c1 * ratio[1][0]), b * (c0 * ratio[0][1] + c1 * ratio[1][1])
        s = a + b
        belief[i] = (a / s, b / s) if s > 0 else (1.0, 0.0)
    return [b for _, b in belief]


_WS = re.compile(r"\s+")


def extract_text(source: str | None, model: dict) -> str:
    if not source:
        return ""
    page = Page(source)
    keep = [m > 0.5 for m in marginals(page, model)]
    blocks: list[str] = []
    last = None
    for block, node, _, text in page.pieces:
        if keep[node]:
            if block == last:
                blocks[-1] += text
            else:
                blocks.append(text)
            last = block
    out = (_WS.sub(" ", _html.unescape(b)).strip() for b in blocks)
    return "\n".join(b for b in out if b)


# --- training --------------------------------------------------------------

def _weak_labels(page: Page) -> list[int] | None:
    """Labels from the page's own main element, None without exactly one."""
    tops = [i for i, t in enumerate(page.tag) if t in ("article", "main")]
    if len(tops) != 1:
        return None
    fixed, out = _fixed(page), [0] * len(page.tag)
    bad = {"ad", "nav", "comment", "side", "notice", "share", "form"}
    for i in range(tops[0], len(page.tag)):
        p = page.parent[i]
        inside = i == tops[0] or (p >= 0 and out[p] == 1)
        out[i] = int(inside and not fixed[i] and not (bad & {_GROUP.get(w) for w in page.names[i]}))
    return out


def _labelled_pages() -> list[tuple[str, str]]:
    """Built-in labelled pages: article texts say ``ok``, all others do not.
    Furniture of many kinds stands before, inside and after the article."""
    prose = "<p>ok one sentence, with a comma, that goes on for a while. ok another, longer sentence follows it, here.</p>"
    heads = ("<h1>ok title</h1>", "<header><h1>ok title</h1></header>", "<h2>ok title</h2>")
    bodies = (prose * 3, prose + "<ul><li>ok item one</li><li>ok item, two.</li></ul>" + prose,
              prose + "<blockquote><p>ok quoted words, said so.</p></blockquote><h2>ok part</h2>" + prose,
              prose + "<pre>ok code</pre><figure><figcaption>ok caption</figcaption></figure><p>ok.</p>",
              prose + "<table><tr><th>ok a</th><td>ok b</td></tr></table><div>ok loose words, in a box.</div>",
              "<div><p>ok nested words, two deep.</p></div><section><h3>ok s</h3>" + prose + "</section>")
    shells = ("<article>%s</article>", "<main>%s</main>", "<main><article>%s</article></main>",
              '<div class="post-content">%s</div>', '<div id="content">%s</div>', '<div class="entry article-body">%s</div>',
              '<div id="main"><div class="story">%s</div></div>', '<article class="post">%s</article>')
    no = prose.replace("ok", "no")
    short = "<p>no sentence, but brief.</p>"
    links = '<ul><li><a href="/a">home</a></li><li><a href="/b">news</a></li></ul>'
    furniture = (
        "<nav>%s</nav>" % links, '<div class="menu">%s</div>' % links, '<div class="ad">buy this now.</div>',
        '<div class="advert banner">%s</div>' % no, '<div class="sidebar">%s%s</div>' % (no, links),
        '<aside>%s</aside>' % no, '<div class="cookie-notice">%s</div>' % no, '<div id="comments">%s%s</div>' % (no, no),
        '<section class="comments"><h2>two replies</h2><div class="comment">%s</div><div class="comment">%s</div></section>' % (no, no),
        '<ol class="commentlist"><li>%s</li></ol>' % no, '<div class="related"><h3>see more</h3>%s</div>' % links,
        '<div class="share">%s</div>' % links, '<div class="newsletter">%s</div>' % no, '<div id="footer">&copy; us, all rights.</div>',
        '<div id="header"><h1>the site</h1>%s</div>' % links, "<footer>&copy; us, all rights.</footer>",
        "<header><h1>the site</h1></header>", '<p class="ad">buy this, now.</p>', '<span class="sponsored">paid for.</span>',
        '<div class="breadcrumbs">%s</div>' % links, '<div class="popup"><div>%s</div></div>' % no, '<form>%s</form>' % no,
        '<div role="navigation">%s</div>' % links, '<div role="alert">%s</div>' % no, '<div>%s</div>' % links,
        '<div class="notice">%s</div>' % no, '<div class="cookie-banner">%s</div>' % short, '<div class="reviews">%s</div>' % short,
        '<ul class="comments"><li>%s</li></ul>' % no[3:-4], '<section id="replies">%s%s</section>' % (no, short), '<div id="sidebar">%s</div>' % (no * 3), '<div class="pagination">%s</div>' % links)
    out = [("<html><body>%s</body></html>" % (heads[k % 3] + b), "ok") for k, b in enumerate(bodies)]
    out += [("<p>ok short words</p>" + b, "ok") for b in bodies]
    for k, f in enumerate(furniture):
        for j in range(8):
            shell, body, head = shells[(k + 2 * j) % 8], bodies[(k + j) % 6], heads[(k + j) % 3]
            g, h = furniture[(k + 7 * j + 3) % len(furniture)], furniture[(5 * k + j) % len(furniture)]
            inner = head + body + (f if j % 2 else "") + (body if j > 5 else "")
            page = f + shell % inner + g if j % 4 < 2 else "<div>%s</div>" % (g + shell % inner + h)
            if j % 4 == 3:
                page = '<div id="wrapper" class="page">%s</div>' % (h + page)
            out.append(("<html><body>%s</body></html>" % page, "ok"))
    return out


def _true_labels(page: Page, mark: str) -> list[int]:
    """A node is content if all its own text is marked (its parts' label where it has none)."""
    n = len(page.tag)
    good, bad = [0] * n, [0] * n
    for _, node, _, text in page.pieces:
        if text.strip():
            (good if text.strip().startswith(mark) else bad)[node] += 1
    for i in range(n - 1, 0, -1):
        good[page.parent[i]] += good[i]
        bad[page.parent[i]] += bad[i]
    main = [page.tag[i] in ("article", "main") or "main" in {_GROUP.get(w) for w in page.names[i]} for i in range(n)]
    return [int(good[i] > 0 and (bad[i] == 0 or main[i] and page.names[i][:1] != ("wrapper",))) for i in range(n)]


def train(pages: list[str]) -> dict:
    """Weights of the features (logistic regression by gradient steps) and the
    parent-child ratio table P(child | parent) / P(child)."""
    rows, labels, share, pair, alone = [], [], [], np.ones((2, 2, 2)), np.ones((2, 2))
    built = [(Page(s), mark) for s, mark in _labelled_pages()]
    given = [(page, None) for page in map(Page, pages) if _weak_labels(page) is not None]
    for sets in (built, given):  # both kinds of labelled pages weigh alike
        for page, mark in sets:
            y = _true_labels(page, mark) if mark else _weak_labels(page)
            fixed = _fixed(page)
            for i, f in enumerate(_features(page)):
                if i and not (fixed[i] and fixed[page.parent[i]]):
                    box = int(page.tag[i] in _BOX)
                    pair[box, y[page.parent[i]], y[i]] += 100 / len(sets)
                    alone[box, y[i]] += 100 / len(sets)
                if f and not fixed[i]:
                    rows.append(f)
                    labels.append(y[i])
                    share.append(1 / len(sets))
    names = sorted({x for f in rows for x in f})
    at = {x: k for k, x in enumerate(names)}
    data = np.zeros((len(rows), len(names)))
    for r, f in enumerate(rows):
        data[r, [at[x] for x in f]] = 1.0
    y, w, share = np.array(labels, dtype=float), np.zeros(len(names)), np.array(share) / sum(share)
    for _ in range(1500):
        p = 1.0 / (1.0 + np.exp(-data @ w))
        w += 4.0 * (data.T @ ((y - p) * share) - 2e-5 * w)
    child = pair / pair.sum(axis=2, keepdims=True)
    return {"weight": dict(zip(names, w.tolist())),
            "ratio": (child / (alone / alone.sum(axis=1, keepdims=True))[:, None, :]).tolist()}


def sample_pages(pages: DataFrame, html_col: str = "html", limit: int = TRAIN_PAGES) -> list[str]:
    """At most ``limit`` pages of at most ``TRAIN_CHARS`` characters."""
    src = pages.select(F.col(html_col).cast("string").alias("html")).where(F.length("html").between(1, TRAIN_CHARS))
    n = pages.count()
    if n > 8 * limit:  # about four times the limit by hash, so that tasks do not each send the limit to the driver
        src = src.where(F.pmod(F.xxhash64("html", F.lit(1)), F.lit(1 << 40)) < int((1 << 40) * 4 * limit / n))
    return [r.html for r in src.orderBy(F.xxhash64("html"), "html").limit(limit).collect()]


def extract(pages: DataFrame, model: dict | None = None, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """``(page_id, url, text)`` for every page."""
    model = model or train(sample_pages(pages, html_col))

    def run(batches):
        for batch in batches:
            for n in range(0, batch.num_rows, 256):
                part = batch.slice(n, 256)
                text = [extract_text(h, model) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, pa.string())],
                                                 names=["page_id", "url", "text"])

    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                       F.col(html_col).cast("string").alias("html"))
    return src.mapInArrow(run, "page_id long, url string, text string")
