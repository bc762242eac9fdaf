"""Main text of web pages by wrapper inference.

A wrapper is a union-free regular expression over the tags of the pages of a host, held as a tree: every node
has a label (tag with class and id words) and may be optional or repeated, and every run of text is a slot
with either one fixed value or many. It is inferred by aligning pages one after another:

* within a page, neighbouring subtrees with equal labels fold into a repeated group;
* between wrapper and page, the children of matching nodes are aligned; a child that one side lacks
  becomes optional, neighbours that alignment leaves side by side with one label become repeated;
* text slots that differ become open; a slot holds a 64-bit digest of its whole value, whatever its length.

Trees have any depth: functions over them go down by Python calls, for which each tree raises the limit as it needs,
and wrappers are stored flat.

Alignment is over all pages: each task aligns the pages of a host that it reads, then wrappers are aligned with
wrappers, in two steps, so that a host with a third of all pages is no hot spot.

Pages of a host with an article, those with a main region instead, and those with neither have a wrapper each, so none
makes parts of the others optional; pages without text aren't aligned. The inferred wrapper assigns each path of labels a
role: main region, dropped region, fixed texts, or none. Pages are then read through the wrapper of their host and kind, and
through nothing else: a page's own tags and classes drop no text. Tags and class names are a prior on the nodes of the wrapper, and
the slots decide against it: a node that holds the main region stays whatever its classes say, and of several main regions
those go whose slots hold little text.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
import sys
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import cut, released

BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "iframe", "noscript", "template", "xmp", "noframes")
RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
DROPPED_TAGS = frozenset("nav header footer aside form script style noscript template iframe button select option optgroup textarea input svg object embed head title dialog menu fieldset legend canvas audio video map noframes".split())
#: Names of class, id and role, or their last words, that mark what is not the article.
DROPPED_WORDS = frozenset("ad ads adv advert adverts advertisement advertisements adsense adslot adbox adsbox adsbygoogle paywall sponsor sponsored sponsors promo promos promotion banner banners cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login sidebar sidebars aside menu menus nav navbar navigation navlinks breadcrumb breadcrumbs topbar toolbar masthead header footer copyright colophon comment comments commentlist disqus respond replies reply share sharing social related recommended recommendations widget widgets pagination pager skip toc search form complementary contentinfo alert".split())
#: Words after a marking one that leave its sense, and words before it that turn it.
PLAIN_ENDS = frozenset("list box bar wrap wrapper container area block section item items link links button buttons inner outer top bottom left right main text content body slot unit thread post posts stories articles dialog x".split())
INNER = frozenset("main text content body".split())
TURNING = frozenset("has with without no not is non by hide show".split())
#: Names by which an article is a remark on another.
REMARKS = frozenset("comment comments reply replies related recommended".split())
ADVERT_KEY = re.compile(r"data-(?:ads?|google-query)(?:-|$)")
MAIN_TAGS = ("article", "main")
#: How far a class speaks: tags that never hold article text, names that may be wrong, and names of headers, which an article has too.
HARD, SOFT, HEADING = 2, 1, 3
LEAST_SHARE = 0.1
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
LIMITS = frozenset("ul ol dl table body html div section article main aside nav".split())
TOKEN = re.compile(r"<!--|<!\[CDATA\[|<[!?]|<(/?)([a-zA-Z][^\s/>]*)")
STOP = re.compile(r">|=\s*[\"']")
ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
SEVERAL = "\x00"
MOST_TRIED = 400
FIXED_FROM = 3


def _words(name: str) -> list[str]:
    return re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())


def _named(name: str) -> int:
    """What one class, id or role says: 0 nothing, else SOFT or HEADING.

    The word that counts is the last one before those that leave its sense, also if it is written as two. What is inside of
    something may be what it stands beside (a sidebar's content), so there the first word must be the marking one.
    """
    words = _words(name)
    if not words or not TURNING.isdisjoint(words):
        return 0
    plain = [*words]
    while plain and plain[-1] in PLAIN_ENDS and plain[-1] not in INNER:
        plain.pop()
    ends = [words[-1], *plain[-1:], "".join(words[-2:]), *(words[:1] if words[-1] in PLAIN_ENDS else [])]
    mark = next((w for w in ends if w in DROPPED_WORDS), "")
    return 0 if not mark else HEADING if mark in ("header", "masthead") else SOFT


def _label(tag: str, attributes: str) -> tuple[str, int]:
    """(label, prior): the tag with its class, id and role words; what they say against the node.

    A page's regions (body, article, main) and headings aren't judged by names, but an article may be a reader's comment.
    """
    prior, words = HARD if tag in DROPPED_TAGS else 0, []
    if attributes.strip(" /\n\t"):
        found = {k.lower(): (v or "").strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
        names = [name for key in ("class", "id", "role") for name in found.get(key, "").split()]
        for name in names:
            words += _words(name)
        if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
            prior = HARD
            words.append("hidden")
        elif tag == "article":
            prior = SOFT if any(_named(name) == SOFT and not REMARKS.isdisjoint(_words(name)) for name in names) or _remark(found) else prior
        elif not prior and not re.fullmatch("h[1-6]|html|body|main", tag):
            said = [*map(_named, names)]
            prior = SOFT if SOFT in said or _remark(found) or _advert(found) else HEADING if HEADING in said else 0
        words += ["soft"] * (prior == SOFT) + ["heading"] * (prior == HEADING)
    return ".".join([tag, *sorted(set(words))]), prior


def _remark(found: dict[str, str]) -> bool:
    """Whether attributes say that a node is a reader's comment."""
    return found.get("itemtype", "").rstrip("/").endswith("/Comment") or found.get("itemprop", "").lower() == "comment"


def _advert(found: dict[str, str]) -> bool:
    return any(ADVERT_KEY.match(k) for k in found) or not {"advertisement", "sponsored"}.isdisjoint(_words(found.get("aria-label", "")))


def parse(page: str | None) -> list:
    """The tree of a page: node = [label, prior, children]; a text is a str. Time and memory grow with the page's length.

    A quote opens a value only after an equals sign; one that is never closed ends with its tag.
    """
    page = page or ""
    root: list = ["", 0, []]
    stack, tags, at = [root], [""], 0
    open_: dict[str, int] = {}
    last = {q: page.rfind(q) for q in "\"'"}

    def end_of(spot: int) -> int:
        while m := STOP.search(page, spot):
            if m[0] == ">":
                return m.start()
            if m.end() > last[m[0][-1]]:
                gone = page.find(">", m.end())
                return gone if gone >= 0 else len(page)
            spot = page.find(m[0][-1], m.end()) + 1
        return len(page)

    def close(names: set[str], limits: frozenset[str] = LIMITS) -> None:
        if not any(open_.get(n) for n in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            if tags[k] in names:
                for t in tags[k:]:
                    open_[t] -= 1
                del stack[k:], tags[k:]
                return
            if tags[k] in limits:
                return

    def add(text: str) -> None:
        if text:
            stack[-1][2].append(entities.unescape(text))

    while m := TOKEN.search(page, at):
        add(page[at : m.start()])
        if not m[2]:
            ends = {"<!--": "-->", "<![CDATA[": "]]>"}.get(m[0], ">")
            found = page.find(ends, m.end())
            if m[0] == "<![CDATA[":
                stack[-1][2].append(page[m.end() : found if found >= 0 else len(page)])
            at = found + len(ends) if found >= 0 else len(page)
            continue
        gt = end_of(m.end())
        attributes, at, tag = page[m.end() : gt], gt + 1, m[2].lower()
        if m[1]:
            close({tag}, frozenset())
            continue
        if tag in BLOCKS:
            close({"p"})
        if tag in CLOSED_BY:
            close(CLOSED_BY[tag], frozenset({"ul", "ol", "dl", "table", "select"}))
        label, prior = _label(tag, attributes)
        node: list = [label, prior, []]
        stack[-1][2].append(node)
        if tag in RAW:
            end = RAW_END[tag].search(page, at)
            if tag in ("title", "textarea"):
                node[2].append(entities.unescape(page[at : end.start() if end else len(page)]))
            at = end.end() if end else len(page)
        elif tag not in VOID and not attributes.endswith("/"):
            stack.append(node)
            tags.append(tag)
            open_[tag] = open_.get(tag, 0) + 1
    add(page[at:])
    return root


def _squeezed(text: str) -> str:
    return " ".join(text.split())


def _digest(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


@lru_cache(maxsize=1 << 16)
def _path(above: str, label: str) -> str:
    """A path of labels, as a digest: its length doesn't grow with the depth."""
    return _digest(f"{above}/{label}")


def _go_down(depth: int) -> None:
    """Allows calls as deep as functions over a tree of ``depth`` need."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 4 * depth + 1000))


def _depth(tree: list) -> int:
    deepest, stack = 0, [(tree, 1)]
    while stack:
        node, depth = stack.pop()
        deepest = max(deepest, depth)
        stack += [(c, depth + 1) for c in node[2] if not isinstance(c, str)]
    return deepest


def _slots(node: list, below: bool = False) -> Iterator[str | list]:
    """Texts between the children of a node, squeezed, and the children; ``below``: texts alone, also of children that aren't dropped."""
    stack = [node]
    while stack:
        run: list[str] = []
        for c in [*stack.pop()[2], None]:
            if isinstance(c, str):
                run.append(c)
                continue
            if value := _squeezed("".join(run)):
                yield value
            run.clear()
            if c is not None and not below:
                yield c
            elif c is not None and c[1] != HARD:
                stack.append(c)


def _main_kind(label: str) -> str:
    tag, *words = label.split(".")
    return "article" if tag == "article" else "main" if tag == "main" or ("main" in words and tag in ("div", "section")) else ""


def kind_of(tree: list) -> str:
    """What main region a page has: article, else main, else none. One below names that speak against it counts if it holds half of the text."""
    found: dict[tuple[bool, str], int] = {}
    total, stack = 0, [(tree, False, "")]
    while stack:
        node, against, within = stack.pop()
        if node[1] == HARD:
            continue
        against = against or node[1] == SOFT
        kind = within or _main_kind(node[0])
        if kind:
            found.setdefault((against, kind), 0)
        for c in node[2]:
            if isinstance(c, str):
                size = len(_squeezed(c))
                total += size
                if kind:
                    found[against, kind] += size
            else:
                stack.append((c, against, kind))
    for against in (False, True):
        for kind in MAIN_TAGS:
            if (against, kind) in found and (not against or 2 * found[against, kind] >= total > 0):
                return kind
    return ""


def _slot(x: list, y: list) -> list:
    """One slot for two: its value if both have it, and the code points that it held on all pages."""
    return ["#", x[1] if x[1] == y[1] else SEVERAL, x[2] + y[2]]


def wrapper_of(node) -> list:
    """The wrapper of one page: [label, dropped, optional, repeated, children], a text slot ["#", digest, code points]."""
    children: list = []
    for child in _slots(node):
        if isinstance(child, str):
            children.append(["#", _digest(child), len(child)])
        else:
            children.append(wrapper_of(child))
    return [node[0], node[1], False, False, _folded(children)]


def _folded(children: list) -> list:
    """Neighbours with one label become one repeated child."""
    out: list = []
    for c in children:
        if out and out[-1][0] == c[0]:
            if c[0] == "#":
                out[-1] = _slot(out[-1], c)
            else:
                out[-1] = _merged(out[-1], c)
                out[-1][3] = True
        else:
            out.append(c)
    return _squared(out)


def _squared(children: list) -> list:
    """Runs that repeat, such as x y x y, fold: a child whose label returns after its neighbours joins them."""
    labels = [c[0] for c in children]
    size = 2
    while size * 2 <= len(labels):
        k = 0
        while k + 2 * size <= len(labels):
            if labels[k : k + size] == labels[k + size : k + 2 * size]:
                for o in range(size):
                    a, b = children[k + o], children[k + size + o]
                    if a[0] == "#":
                        children[k + o] = _slot(a, b)
                    else:
                        children[k + o] = _merged(a, b)
                        children[k + o][3] = True
                del children[k + size : k + 2 * size], labels[k + size : k + 2 * size]
            else:
                k += 1
        size += 1
        if size > 6:
            break
    return children


def _merged(a: list, b: list) -> list:
    """The wrapper that covers two with one label."""
    return [a[0], a[1], a[2] or b[2], a[3] or b[3], _aligned(a[4], b[4])]


def _aligned(xs: list, ys: list) -> list:
    """Align two lists of children by their longest common subsequence of labels."""
    lx, ly = [x[0] for x in xs], [y[0] for y in ys]
    if lx == ly:
        pairs = [(i, i) for i in range(len(xs))]
    else:
        if len(xs) * len(ys) > MOST_TRIED * MOST_TRIED:
            xs, ys = _by_label(xs), _by_label(ys)
            lx, ly = [x[0] for x in xs], [y[0] for y in ys]
        best = [[0] * (len(ly) + 1) for _ in range(len(lx) + 1)]
        for i in range(len(lx) - 1, -1, -1):
            for j in range(len(ly) - 1, -1, -1):
                best[i][j] = best[i + 1][j + 1] + 1 if lx[i] == ly[j] else max(best[i + 1][j], best[i][j + 1])
        pairs, i, j = [], 0, 0
        while i < len(lx) and j < len(ly):
            if lx[i] == ly[j]:
                pairs.append((i, j))
                i, j = i + 1, j + 1
            elif best[i + 1][j] >= best[i][j + 1]:
                i += 1
            else:
                j += 1
    out: list = []
    i = j = 0
    for p, q in [*pairs, (len(xs), len(ys))]:
        out += [_optional(c) for c in xs[i:p]] + [_optional(c) for c in ys[j:q]]
        if p < len(xs):
            x, y = xs[p], ys[q]
            out.append(_slot(x, y) if x[0] == "#" else _merged(x, y))
        i, j = p + 1, q + 1
    if len(out) == len(xs) == len(ys):
        return out
    # what alignment leaves side by side under one label is a repeated group
    folded: list = []
    for c in out:
        if folded and folded[-1][0] == c[0]:
            if c[0] == "#":
                folded[-1] = _slot(folded[-1], c)
            else:
                folded[-1] = _merged(folded[-1], c)
                folded[-1][3] = True
        else:
            folded.append(c)
    return _by_label(folded) if len(folded) > 64 else folded


def _by_label(children: list) -> list:
    """One repeated child for each label: the widest group, for lists that no alignment shortens."""
    found: dict[str, list] = {}
    for c in children:
        if c[0] not in found:
            found[c[0]] = c
        elif c[0] == "#":
            found["#"] = ["#", SEVERAL, found["#"][2] + c[2]]
        else:
            found[c[0]] = _merged(found[c[0]], c)
            found[c[0]][2:4] = [True, True]
    return list(found.values())


def _optional(child: list) -> list:
    return ["#", SEVERAL, child[2]] if child[0] == "#" else [child[0], child[1], True, *child[3:]]


def _mass(node: list) -> int:
    """Code points in the slots below, but for those of nodes that hold no article text."""
    total, stack = 0, [node]
    while stack:
        n = stack.pop()
        for c in n[4]:
            if c[0] == "#":
                total += c[2]
            elif c[1] != HARD:
                stack.append(c)
    return total


def _mains(wrapper: list) -> set[int]:
    """Nodes that are main regions: the outermost articles, else mains, that names speak least against and whose slots hold text."""
    found: list[tuple[bool, int, int, list]] = []
    stack = [(wrapper, False)]
    while stack:
        node, against = stack.pop()
        if node[0] == "#" or node[1] == HARD:
            continue
        against = against or node[1] == SOFT
        if kind := _main_kind(node[0]):
            found.append((against, MAIN_TAGS.index(kind), _mass(node), node))
            if kind == MAIN_TAGS[0]:
                continue
        stack += [(c, against) for c in node[4]]
    if not found:
        return set()
    best = min(x[:2] for x in found)
    own = [x for x in found if x[:2] == best and (not x[0] or 2 * x[2] >= _mass(wrapper))]
    if not own:
        return set()
    most = max(x[2] for x in own)
    return {id(x[3]) for x in own if x[2] >= LEAST_SHARE * most}


def roles(wrapper: list, pages: int) -> dict[str, str | list]:
    """Paths of labels of the main region (``m``), of dropped regions (``d``), and of fixed texts (their digests), from a wrapper.

    Main is the outermost article, else main; without either, everything that isn't dropped. Slots with one
    value on all of several pages are the host's own text: a block with no open slot that every page has gives
    its values, inside a main region too, if anything else of the region (or of the page, outside) is open.
    """
    out: dict[str, str | list] = {}
    mains = _mains(wrapper)
    open_nodes: set[int] = set()
    holders: set[int] = set()

    def holds(node: list) -> bool:
        """Whether a main region is the node or below it."""
        if id(node) in mains or any([holds(c) for c in node[4] if c[0] != "#"]):
            holders.add(id(node))
        return id(node) in holders

    holds(wrapper)

    def look(node: list, path: str, within: bool, above: list | None) -> bool:
        """Whether anything below is open."""
        here = _path(path, node[0])
        own_header = within and (node[1] == HEADING or (node[0] == "header" and above is not None and id(above) in mains))
        if node[1] and id(node) not in holders and not own_header:
            out[here] = "d"
            return False
        if id(node) in mains:
            out[here] = "m"
        within = within or id(node) in mains
        found = any([c[1] == SEVERAL if c[0] == "#" else look(c, here, within, node) for c in node[4]])
        if found:
            open_nodes.add(id(node))
        return found

    opened = look(wrapper, "", False, None)
    if opened and pages >= FIXED_FROM:

        def fixed(node: list, path: str, always: bool) -> list[str] | None:
            """Values of the slots below, or None if one is open."""
            here, always = _path(path, node[0]), always and not node[2]
            if out.get(here) == "d":
                return []
            if out.get(here) == "m" and id(node) not in open_nodes:
                return None
            below = [[c[1]] if c[0] == "#" and c[1] != SEVERAL else None if c[0] == "#" else fixed(c, here, always) for c in node[4]]
            if None in below:
                return None
            values = [v for vs in below for v in vs]
            if values and always and node[0].split(".")[0] in BLOCKS:
                out[here] = sorted({*out.get(here, []), *values})
            return values

        fixed(wrapper, "", True)
    return out


def main_text(page: str | None, known: dict[str, str | list]) -> str:
    """Blocks of a page that its host's roles leave, one a line."""
    return text_of(parse(page), known)


def text_of(tree: list, known: dict[str, str | list]) -> str:
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        if text := _squeezed("".join(run)):
            blocks.append(text)
        run.clear()

    def walk(root: list, inside: bool) -> None:
        stack = [(iter(root[2]), "", inside, "")]
        while stack:
            children, path, within, tag = stack[-1]
            for child in children:
                if isinstance(child, str):
                    if within:
                        run.append(child)
                    continue
                here = _path(path, child[0])
                name = child[0].split(".", 1)[0]
                if name in BLOCKS:
                    flush()
                elif name == "br":
                    run.append(" ")
                role = known.get(here)
                if role == "d":
                    continue
                if isinstance(role, list) and (own := {*map(_digest, _slots(child, below=True))}) and own <= set(role):
                    continue
                stack.append((iter(child[2]), here, within or role == "m", name))
                break
            else:
                if tag in BLOCKS:
                    flush()
                stack.pop()

    has_main = "m" in known.values()
    walk(["", 0, [tree]], not has_main)
    flush()
    if not blocks and has_main:  # a page without its host's main region
        walk(["", 0, [tree]], True)
        flush()
    return "\n".join(blocks)


def _host(url: str | None) -> str:
    m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", url or "")
    return m[1].lower().rpartition("@")[2] if m else ""


@released
def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wrappers for each host among the pages of the task, given out whenever many are held."""
    held: dict[str, dict[str, list]] = {}

    def out():
        counts = [sum(n for _, n in w.values()) for w in held.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array(counts, pa.int64()), pa.array([_packed(w) for w in held.values()])], names=["host", "pages", "wrapper"])

    for b in batches:
        for url, page in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            tree = parse(page.as_py())
            if next(_slots(tree, below=True), None) is None:
                continue
            _go_down(_depth(tree))
            _add(held.setdefault(_host(url), {}), kind_of(tree), wrapper_of(tree), 1)
            if len(held) >= 2000:
                yield out()
                held.clear()
    if held:
        yield out()


def _add(wrappers: dict[str, list], kind: str, new: list, pages: int) -> None:
    wrappers[kind] = [_merged(wrappers[kind][0], new), wrappers[kind][1] + pages] if kind in wrappers else [new, pages]


def _packed(wrappers: dict[str, list]) -> str:
    """Wrappers as JSON of one level: nodes in order of their starts, each with the number of its children."""
    flat: dict[str, list] = {}
    for kind, (wrapper, pages) in wrappers.items():
        nodes, stack = [], [wrapper]
        while stack:
            node = stack.pop()
            if node[0] == "#":
                nodes.append(node)
            else:
                nodes.append([*node[:4], len(node[4])])
                stack += reversed(node[4])
        flat[kind] = [nodes, pages]
    return json.dumps(flat)


def _unpacked(packed: str) -> dict[str, list]:
    """The reverse, with calls as deep as the wrappers allowed."""
    wrappers: dict[str, list] = {}
    for kind, (nodes, pages) in json.loads(packed).items():
        top: list = []
        stack, deepest = [(top, 1)], 0
        for node in nodes:
            while len(stack[-1][0]) == stack[-1][1]:
                stack.pop()
            stack[-1][0].append(node)
            if node[0] != "#":
                stack.append((children := [], node[4]))
                node[4] = children
                deepest = max(deepest, len(stack))
        _go_down(deepest)
        wrappers[kind] = [top[0], pages]
    return wrappers


def _join(table: pa.Table) -> pa.Table:
    """Align the wrappers of a host."""
    now: dict[str, list] = {}
    for packed in sorted(table.column("wrapper").to_pylist()):
        for kind, (new, n) in _unpacked(packed).items():
            _add(now, kind, new, n)
    pages = sum(table.column("pages").to_pylist())
    return pa.table({"host": [table.column("host")[0].as_py()], "pages": pa.array([pages], pa.int64()), "wrapper": [_packed(now)]})


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, pages, wrapper (JSON: wrapper and pages by kind) for every host with texts; pages without a host share the empty one."""
    learned = pages.select(F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")).mapInArrow(_learn, "host string, pages long, wrapper string")
    salted = learned.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(64)))
    some = salted.groupBy("host", "salt").applyInArrow(_join, "host string, pages long, wrapper string")
    return some.groupBy("host").applyInArrow(_join, "host string, pages long, wrapper string")


BROADCAST_BYTES = 8 << 20


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text for every row of ``pages``.

    A null html is an empty page with an empty text; a null url shares the wrapper of urls without a host.
    Repeated rows each get their text, and rows are aligned in an order that the result doesn't depend on but for ties in alignment;
    a page of any length or depth is read whole, in one task's memory; other columns aren't read. An empty table gives an empty result.
    Wrappers join pages by broadcast while all of them together take less than ``BROADCAST_BYTES``, and by
    a shuffle that can split a hot host beyond.
    """
    wrappers = cut(infer_wrappers(pages, url_col, html_col), "wrappers")
    by_host = wrappers.mapInArrow(_assign, "host string, roles string")
    size = wrappers.agg(F.sum(F.length("wrapper"))).first()[0] or 0
    host = F.lower(F.regexp_replace(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1), "^.*@", ""))
    plain = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"), host.alias("host"))
    joined = plain.join(F.broadcast(by_host) if size <= BROADCAST_BYTES else by_host, "host", "left")
    return joined.select("page_id", "url", "html", "roles").mapInArrow(_extract, "page_id long, url string, text string")


def _assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [json.dumps({kind: roles(w, n) for kind, (w, n) in _unpacked(packed).items()}) for packed in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.string())], names=["host", "roles"])


@released
def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: dict[str | None, dict[str, dict]] = {None: {}}
    for b in batches:
        texts = []
        for page, known in zip(b.column(2), b.column(3).to_pylist(), strict=True):
            if known not in kept:
                if len(kept) > 500:
                    kept = {None: {}}
                kept[known] = json.loads(known)
            tree = parse(page.as_py())
            texts.append(text_of(tree, kept[known].get(kind_of(tree), {})))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])
