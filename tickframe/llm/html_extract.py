"""Main text of web pages by inferring a wrapper per host from its pages' token streams.

1. Every page becomes a stream of block tags and text slots, and that a tree.  Equal neighbours among siblings
   are aligned with each other and become one repeated group; what one of them lacks is optional.  The result,
   a union-free regular expression of the page, is its form; a host has few distinct forms.
2. The forms of a host are aligned, one after the other, into its wrapper: tags that match stay, tags that only
   one side has become optional groups, differing texts are slots.  Hosts with many forms align them in rounds
   of bounded groups, so no task holds a host's forms at once.
3. Slots are judged per wrapper: by the tags around them, the class, id and role words of containers, the links in
   them, and, outside an article, by whether their text is the same on the host's pages (distinct contents count, not
   copies).  Inside an article a doubtful word (a section may be a "discussion") drops a container only if the
   wrapper agrees: links, the same text on the host's pages, or a repeated group.  Each form takes the best level (article, main,
   named, page) that its own slots hold.
4. Each page's blocks are kept or dropped by the slots they fall into.

Only forms (with per-slot figures) are shuffled for inference, summed in each task beforehand.

Defined cases: NULL and empty html gives an empty text; pages of NULL or odd urls share a wrapper only within their form; a page whose
blocks are all boilerplate gives an empty text; text outside tags is a block; unclosed tags end with their
parent or where HTML closes them; repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import html as html_lib
import json
import re
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import by_bytes, releasing, stage_table

BLOCK_BYTES = 8 << 20
FORMS_PER_GROUP = 100
FLUSH_FORMS = 20_000
FLUSH_PAGES = 500_000
CONSTANT_PAGES = 5
#: Deeper tags are siblings in the tree instead of children; their text is kept unless their own tag or name drops it.
MAX_DEPTH = 150

# ---- fixed values: HTML element classes and boilerplate names
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td
tfoot th thead title tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style noscript template iframe svg math textarea xmp noembed noframes object canvas audio video title select button".split())
#: Their content ends at the end of the page if they are not closed; other unclosed raw tags are read over.
SWALLOWING_TAGS = frozenset("script style textarea xmp title".split())
DROPPED_TAGS = frozenset("nav aside form footer menu dialog fieldset".split())
LAYOUT_WORDS = frozenset("with has no without is show hide".split())
MAIN_NAMES = frozenset("article content main post entry story body text".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "optgroup": {"option", "optgroup"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
          "tfoot": {"tr", "td", "th", "thead", "tbody"}, "thead": set()}
KEEPS_P_OPEN = frozenset("option optgroup legend caption summary td th tr tbody thead tfoot html body title".split())
# ---- end of fixed values

#: Class, id and role words of boilerplate that no part of an article is named after.
CLEAR_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promoted cookie cookies
consent gdpr popup modal overlay newsletter subscribe subscription signup sidebar widget widgets menu menus nav navbar navigation breadcrumb
breadcrumbs footer masthead topbar toolbar share sharing social comment comments disqus replies login pagination pager complementary
contentinfo""".split())
#: Words that name boilerplate and sections of articles alike: inside an article they need evidence from the wrapper.
DOUBTFUL_NAMES = frozenset("""notice notices alert side related recommended recommendations promotion reply respond response responses
discussion search skip legal copyright disclaimer""".split())
DROPPED_ARTICLES = frozenset("comment comments reply ad ads advert sponsored promo related".split())
#: Names count on tags that hold other blocks, outside an article also on paragraphs, never on headings; a <p> in an
#: article goes by a clear name only.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
PARAGRAPHS = frozenset("p li dd dt td th tr tbody thead tfoot caption figcaption blockquote pre summary".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^<>])*+)>", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?""")
_RAW_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I | re.A) for tag in RAW_TAGS}
_NAMES = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)")
TEXT, LINK = "#text", "#link"
#: Kinds of slots, best first.
LEVELS = ["article", "main", "named", "page"]


class Node:
    """A tag with its children, or a slot; ``optional`` and ``repeated`` mark groups of the expression."""

    __slots__ = ("label", "optional", "repeated", "children", "slot", "same")

    def __init__(self, label: str, children: list | None = None, optional: bool = False, repeated: bool = False):
        self.label, self.optional, self.repeated = label, optional, repeated
        self.children = children if children is not None else []
        self.slot = -1
        self.same: Node | None = None  # the node this one was aligned to

    def dump(self) -> list:
        return [self.label, int(self.optional), int(self.repeated), [c.dump() for c in self.children]]

    @staticmethod
    def load(form: list) -> Node:
        return Node(form[0], [Node.load(c) for c in form[3]], bool(form[1]), bool(form[2]))

    def slots(self) -> list[tuple[Node, tuple[Node, ...]]]:
        """Slots in order, with the nodes above them; numbers them."""
        out: list[tuple[Node, tuple[Node, ...]]] = []

        def walk(node: Node, above: tuple[Node, ...]) -> None:
            if node.label in (TEXT, LINK):
                node.slot = len(out)
                out.append((node, above))
            for c in node.children:
                walk(c, (*above, node))

        walk(self, ())
        return out


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def home_of(url: str | None, form: str) -> str:
    """The page's host; without one, its form stands alone (no host has a # in its name)."""
    return host_of(url) or f"#{key_of('', form)}"


def _label(tag: str, attributes: str) -> tuple[str, bool]:
    """A tag with the words of its class, id and role, and whether it is hidden."""
    if not attributes.strip():
        return tag, False
    found = {}
    for name, value in _ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), value.strip("\"'"))
    tokens = [_NAMES.findall(t) for a in ("class", "id", "role") for t in html_lib.unescape(found.get(a, "")).lower().split()]
    names = dict.fromkeys(w for t in tokens if t and t[0] not in LAYOUT_WORDS for w in t)
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(found.get("style", "")))
    return ".".join([tag, *names]), hidden


def parse(page: str) -> tuple[Node, list[tuple[Node, str]]]:
    """The page's tree of block tags and slots, and its blocks: (slot, text) in page order."""
    root = Node("#page")
    open_: list[tuple[str, Node, bool]] = [("#page", root, False)]  # tag, node, hidden
    blocks: list[tuple[Node, str]] = []
    buffer: list[str] = []
    linked = [0, 0]  # characters in links and in all
    links = 0
    unclosed: set[str] = set()  # raw tags without an end tag in the rest of the page

    def flush() -> None:
        nonlocal buffer
        if buffer:
            text = " ".join(html_lib.unescape("".join(buffer)).split())
            if text and not open_[-1][2]:
                slot = Node(LINK if linked[0] and linked[0] >= linked[1] else TEXT)
                open_[-1][1].children.append(slot)
                blocks.append((slot, text))
            buffer = []
            linked[:] = [0, 0]

    def close_to(depth: int) -> None:
        del open_[depth:]

    def say(text: str) -> None:
        if text:
            buffer.append(text)
            size = len(text.strip())
            linked[1] += size
            linked[0] += size if links else 0

    at = 0
    while m := _TOKEN.search(page, at):
        if m.start() > at:
            say(page[at:m.start()])
        at = m.end()
        tag = m[2]
        if not tag:
            if m[0].startswith("<![CDATA["):
                say(html_lib.escape(m[0][9:-3]))
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in BLOCK_TAGS:
                flush()
                for depth in range(len(open_) - 1, 0, -1):
                    if open_[depth][0] == tag:
                        close_to(depth)
                        break
        elif tag in RAW_TAGS:
            buffer.append(" ")
            if not m[3].endswith("/"):
                end = None if tag in unclosed else _RAW_ENDS[tag].search(page, at)
                if end:
                    at = end.end()
                elif tag in SWALLOWING_TAGS:
                    at = len(page)
                else:
                    unclosed.add(tag)
        elif tag == "br" or tag == "wbr":
            buffer.append(" " if tag == "br" else "")
        elif tag in BLOCK_TAGS:
            flush()
            links = 0
            if tag in VOID_TAGS:
                continue
            if tag not in KEEPS_P_OPEN and open_[-1][0] == "p":
                close_to(len(open_) - 1)
            ends = CLOSES.get(tag)
            if ends:
                depth = len(open_) - 1
                while depth > 0 and open_[depth][0] not in ("ul", "ol", "dl", "table", "select", "menu"):
                    if open_[depth][0] in ends:
                        close_to(depth)
                    depth -= 1
                    depth = min(depth, len(open_) - 1)
            label, hidden = _label(tag, m[3])
            node = Node(label)
            open_[-1][1].children.append(node)
            if not m[3].endswith("/"):
                deep = len(open_) >= MAX_DEPTH
                gone = hidden or open_[-1][2] or (deep and kind_of((node,)) == "drop")
                open_.append((tag, open_[-1][1] if deep else node, gone))
        elif tag == "a":
            links += 1
    if at < len(page):
        say(page[at:])
    flush()
    return root, blocks


def pairs(left: list[Node], right: list[Node]) -> list[tuple[int, int]]:
    """Indices of siblings that match, in order."""
    a, b = [n.label for n in left], [n.label for n in right]
    if a == b:
        return [(i, i) for i in range(len(a))]
    return [(i + k, j + k) for i, j, n in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() for k in range(n)]


def align(left: Node, right: Node) -> None:
    """Generalises ``left`` so that it also matches ``right``."""
    right.same = left
    left.optional |= right.optional
    left.repeated |= right.repeated
    matched = pairs(left.children, right.children)
    out: list[Node] = []
    i = j = 0
    for p, q in [*matched, (len(left.children), len(right.children))]:
        for n in left.children[i:p] + right.children[j:q]:
            n.optional = True
            out.append(n)
        if p < len(left.children):
            align(left.children[p], right.children[q])
            out.append(left.children[p])
        i, j = p + 1, q + 1
    left.children = fold(out)


def fold(children: list[Node]) -> list[Node]:
    """Neighbours of one label become one repeated group."""
    out: list[Node] = []
    for n in children:
        if out and out[-1].label == n.label:
            optional = out[-1].optional and n.optional
            align(out[-1], n)
            out[-1].optional, out[-1].repeated = optional, True
        else:
            out.append(n)
    return out


def form_of(root: Node) -> Node:
    """Folds the tree bottom-up, in place."""
    stack = [(root, False)]
    while stack:
        node, done = stack.pop()
        if done:
            node.children = fold([c for c in node.children if c.children or c.label in (TEXT, LINK)])
        else:
            stack.append((node, True))
            stack += [(c, False) for c in node.children]
    return root


def settle(node: Node) -> Node:
    while node.same is not None:
        node = node.same
    return node


def read_page(page: str | None) -> tuple[str, list[tuple[int, str]], int]:
    """(form as JSON, blocks as (slot number, text), number of slots)."""
    root, blocks = parse(page or "")
    form_of(root)
    count = len(root.slots())
    return json.dumps(root.dump(), separators=(",", ":")), [(settle(n).slot, text) for n, text in blocks], count


def key_of(host: str, form: str) -> int:
    from xxhash import xxh3_64_intdigest
    return xxh3_64_intdigest(f"{host}\n{form}".encode()) - (1 << 63)


def _figures(pages: DataFrame) -> DataFrame:
    """(host, form, form_key, slot, pages, chars, low, high): per host, form and slot; pages counts distinct contents,
    so copies of a page are one; low and high are the least and greatest hash of the slot's text on a page."""
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest
        held: dict[tuple[str, str], list] = {}
        contents = 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows = [(h, f, key_of(h, f), s, 0, *e[1][s]) for (h, f), e in held.items() for s in range(len(e[1]))]
            rows += [(None, None, key_of(h, f), -1, c, 0, 0, 0) for (h, f), e in held.items() if e[1] for c in e[0]]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (
                    pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))], names)
            held.clear()

        for block in by_bytes(batches, "html", BLOCK_BYTES):
            for url, page in zip(block.column("url").to_pylist(), block.column("html").to_pylist()):
                form, blocks, count = read_page(page)
                entry = held.setdefault((home_of(url, form), form), [set(), [[0, 1 << 62, -1] for _ in range(count)]])
                entry[0].add(xxh3_64_intdigest(json.dumps(blocks).encode()) >> 2)
                contents += 1
                texts: dict[int, list[str]] = {}
                for s, t in blocks:
                    texts.setdefault(s, []).append(t)
                for s, parts in texts.items():
                    text = "\n".join(parts)
                    h = xxh3_64_intdigest(text.encode()) >> 2
                    figure = entry[1][s]
                    figure[0] += len(text)
                    figure[1], figure[2] = min(figure[1], h), max(figure[2], h)
            if len(held) > FLUSH_FORMS or contents > FLUSH_PAGES:
                yield from flush()
                contents = 0
        yield from flush()

    names = ["host", "form", "form_key", "slot", "content", "chars", "low", "high"]
    sums = (F.sum("chars").alias("chars"), F.min("low").alias("low"), F.max("high").alias("high"))
    # a row per slot (content 0) and a row per distinct content (slot -1)
    found = stage_table(pages.select("url", "html").mapInArrow(releasing(read), "host string, form string, form_key long, slot int, content long, chars long, low long, high long")
                        .groupBy("host", "form", "form_key", "slot", "content").agg(*sums), "html-contents")
    counts = found.filter("slot < 0").groupBy("form_key").agg(F.count("*").alias("pages"))
    return found.filter("slot >= 0").join(counts, "form_key").select("host", "form", "form_key", "slot", "pages", "chars", "low", "high")


def merge_forms(forms: list[str]) -> str:
    """The wrapper of some forms, aligned one after the other in a fixed order."""
    wrapper: Node | None = None
    for form in sorted(set(forms), key=lambda f: (len(f), f)):
        node = Node.load(json.loads(form))
        if wrapper is None:
            wrapper = node
        else:
            align(wrapper, node)
    return json.dumps(wrapper.dump(), separators=(",", ":"))


def _wrappers(forms: DataFrame) -> DataFrame:
    """(host, wrapper) of (host, form): rounds of bounded groups until each host has one."""
    def merge(keys: tuple, table: pa.Table) -> pa.Table:
        return pa.table({"host": [keys[0].as_py()], "form": [merge_forms(table.column("form").to_pylist())]})

    while True:
        most = forms.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return forms.withColumnRenamed("form", "wrapper")
        groups = -(-most // FORMS_PER_GROUP)
        salted = forms.withColumn("salt", F.pmod(F.xxhash64("form"), F.lit(groups)) if groups > 1 else F.lit(0))
        forms = stage_table(salted.groupBy("host", "salt").applyInArrow(merge, "host string, form string"), "html-wrappers")


def locate(form: Node, wrapper: Node) -> dict[int, int]:
    """The wrapper's slot of each slot of a form that the wrapper matches."""
    form.slots()
    wrapper.slots()
    out: dict[int, int] = {}

    def walk(f: Node, w: Node) -> None:
        if f.slot >= 0:
            out[f.slot] = w.slot
        matched = dict(pairs(f.children, w.children))
        by_label = {c.label: c for c in reversed(w.children)}
        for i, c in enumerate(f.children):
            target = w.children[matched[i]] if i in matched else by_label.get(c.label)
            if target is not None:
                walk(c, target)

    walk(form, wrapper)
    return out


def kind_of(path: tuple[Node, ...]) -> str:
    """``article``, ``main``, ``named``, ``page``, ``drop`` or ``doubt`` for a slot under these nodes.

    ``doubt``: in an article, under a container with a doubtful name; the wrapper has to decide."""
    kind, doubt = "page", False
    for node in path:
        tag, *names = node.label.split(".")
        inside = kind in ("article", "main")
        if tag in DROPPED_TAGS or (tag == "header" and not inside):
            return "drop"
        if tag == "article":
            if DROPPED_ARTICLES.intersection(names):
                return "drop"
        elif tag not in ("html", "body", "main") and tag not in HEADINGS:
            if CLEAR_NAMES.intersection(names) and not (kind == "article" and tag in PARAGRAPHS and tag != "p"):
                return "drop"
            if DOUBTFUL_NAMES.intersection(names):
                if kind != "article":
                    return "drop"
                doubt |= tag not in PARAGRAPHS
        if tag == "article":
            kind = "article"
        elif kind != "article" and (tag == "main" or "main" in names):
            kind = "main"
        elif kind == "page" and tag not in ("html", "body", "p", "li") and MAIN_NAMES.intersection(names):
            kind = "named"
    return "doubt" if doubt else kind


def boilerplate(path: tuple[Node, ...], label: str, same: bool) -> bool:
    """Whether the wrapper speaks against a slot under a doubtful name: it is a link, its text is the same on the
    host's pages, or the named container or one inside it is a repeated group."""
    at = next(i for i, n in enumerate(path) if DOUBTFUL_NAMES.intersection(n.label.split(".")[1:]) and n.label.split(".")[0] not in HEADINGS | PARAGRAPHS)
    containers = [n for n in path[at:] if n.label.split(".")[0] not in HEADINGS | PARAGRAPHS | {"ul", "ol", "dl", "table"}]
    return label == LINK or same or any(n.repeated for n in containers)


def judge(slots: list[tuple[tuple[Node, ...], str, int, bool]], pages: int) -> list[tuple[str, bool]]:
    """(kind, holds text) of each slot of a wrapper.  A slot: (nodes above, label, pages, same on all pages)."""
    out = []
    for path, label, n, same in slots:
        kind, constant = kind_of(path), same and n >= CONSTANT_PAGES and 2 * n >= pages
        if kind == "doubt":
            kind = "drop" if boilerplate(path, label, constant) else "article"
        out.append(("drop" if kind == "page" and constant else kind, label == TEXT))
    return out


def _kept_slots(figures: DataFrame) -> DataFrame:
    """(form_key, kept): the numbers of the slots of each form that hold main text."""
    forms = stage_table(figures.select("host", "form", "form_key").distinct(), "html-forms")
    wrappers = _wrappers(forms.select("host", "form")).select(F.col("host").alias("site"), F.col("wrapper").alias("wrapper"))

    def place(keys: tuple, forms: pa.Table, wrappers: pa.Table) -> pa.Table:
        rows = []
        if forms.num_rows:
            wrapper = Node.load(json.loads(wrappers.column("wrapper")[0].as_py()))
            for key, form in zip(forms.column("form_key").to_pylist(), forms.column("form").to_pylist()):
                rows += [(key, s, w) for s, w in locate(Node.load(json.loads(form)), wrapper).items()]
        return pa.table([pa.array(x, t) for x, t in zip(zip(*rows) if rows else ((), (), ()), (pa.int64(), pa.int32(), pa.int32()))],
                        names=["form_key", "slot", "place"])

    def decide(keys: tuple, evidence: pa.Table, wrappers: pa.Table) -> pa.Table:
        wrapper = Node.load(json.loads(wrappers.column("wrapper")[0].as_py()))
        known = {p: (n, same) for p, n, same in zip(*(evidence.column(x).to_pylist() for x in ("place", "pages", "same")))}
        slots = [(path, node.label, *known.get(k, (0, False))) for k, (node, path) in enumerate(wrapper.slots())]
        judged = judge(slots, max((s[2] for s in slots), default=0))
        return pa.table({"host": pa.array([keys[0].as_py()] * len(judged), pa.string()), "place": pa.array(range(len(judged)), pa.int32()),
                         "kind": pa.array([k for k, _ in judged], pa.string()), "holds": pa.array([x for _, x in judged], pa.bool_())})

    # the forms of a host in groups of bounded size, each with one copy of its wrapper
    sizes = forms.groupBy("host").agg(F.ceil(F.count("*") / FORMS_PER_GROUP).cast("int").alias("groups"))
    dealt = forms.join(sizes, "host").select("host", F.pmod("form_key", "groups").cast("int").alias("salt"), "form_key", "form")
    copied = (wrappers.join(sizes.withColumnRenamed("host", "site"), "site").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
              .select("site", F.col("salt").alias("group"), "wrapper"))
    places = stage_table(dealt.groupBy("host", "salt").cogroup(copied.groupBy("site", "group"))
                         .applyInArrow(place, "form_key long, slot int, place int"), "html-places")
    evidence = (figures.join(places, ["form_key", "slot"]).groupBy("host", "place")
                .agg(F.sum("pages").alias("pages"), (F.min("low") == F.max("high")).alias("same")))
    judged = evidence.groupBy("host").cogroup(wrappers.groupBy("site")).applyInArrow(decide, "host string, place int, kind string, holds boolean")
    return (places.join(forms.select("form_key", "host"), "form_key").join(judged, ["host", "place"])
            .withColumn("level", F.array_position(F.lit(LEVELS), F.col("kind"))).filter("level > 0").groupBy("form_key")
            .agg(F.min(F.when(F.col("holds"), F.col("level"))).alias("best"), F.collect_list(F.struct("slot", "level", "holds")).alias("slots"))
            # the best level whose slots hold text in this form; main takes in the article's links, page only text
            .select("form_key", F.expr(f"""transform(filter(slots, s -> (s.level = best or (best = 2 and s.level = 1))
                                           and (best < {len(LEVELS)} or s.holds)), s -> s.slot)""").alias("kept")))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper): the inferred expression of every host of (url, html), as JSON."""
    return _wrappers(stage_table(_figures(pages), "html-figures").select("host", "form").distinct())


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of ``pages``."""
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    id_type = pages.schema["page_id"].dataType.simpleString()
    kept = stage_table(_kept_slots(stage_table(_figures(pages), "html-figures")), "html-kept")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in by_bytes(batches, "html", BLOCK_BYTES):
            keys, found = [], []
            for url, page in zip(block.column("url").to_pylist(), block.column("html").to_pylist()):
                form, blocks, _ = read_page(page)
                keys.append(key_of(home_of(url, form), form))
                found.append([{"slot": s, "text": t} for s, t in blocks])
            yield pa.RecordBatch.from_arrays([
                block.column("page_id").combine_chunks(), block.column("url").combine_chunks(), pa.array(keys, pa.int64()),
                pa.array(found, pa.list_(pa.struct([("slot", pa.int32()), ("text", pa.string())])))], ["page_id", "url", "form_key", "blocks"])

    split = pages.mapInArrow(releasing(read), f"page_id {id_type}, url string, form_key long, blocks array<struct<slot:int,text:string>>")
    main = F.filter("blocks", lambda b: F.array_contains(F.coalesce(F.col("kept"), F.array().cast("array<int>")), b["slot"]))
    return (split.join(kept, "form_key", "left")
            .select("page_id", "url", F.array_join(F.transform(main, lambda b: b["text"]), "\n\n").alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
