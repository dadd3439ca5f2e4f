"""Main text of web pages by wrappers inferred from the pages of a host."""

from __future__ import annotations

import html as entities
import json
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import stored, table

#: Hosts a task infers wrappers for at once, groups that a host's wrappers first meet in,
#: children of a wrapper's node from which on only their tag names are told apart.
HELD_HOSTS, MERGES, WIDE = 2_000, 64, 200
#: Pages that must show a text at one place before it counts as the host's own.
FIXED_PAGES = 4
#: Share of a host's changing text that its main region holds.
MAIN_SHARE = 0.7

# Element names and the words of class and id names that tell a part's role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp template svg math object select".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_PARAGRAPH = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
          "th": {"tr", "table"}, "option": {"select"}}
ASIDE = set("nav footer aside form script style head dialog menu button input".split()) | RAW
MAIN = {"article", "main"}
ASIDE_ROLES = set("navigation contentinfo complementary search form dialog alertdialog alert menu menubar".split())
ASIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion "
    "nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager footer sidebar aside "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay form login "
    "signup subscribe subscription newsletter search comment comments disqus respond reply replies "
    "share sharing social related recommended recommendations widget toolbar copyright disclaimer".split()
)
#: Words that set a part aside whatever is in it; the other words may also name a layout or a
#: topic, so an article in such a part, or all that an article holds, is not lost.
NEVER = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion "
    "cookie cookies consent gdpr comment comments disqus respond reply replies related recommended "
    "recommendations".split()
)
PROSE = set("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td th".split())
HEAD_WORDS = {"header", "masthead", "banner", "topbar"}

TAG = re.compile(
    r"<(?:(?P<close>/)?(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|!--(?:>|->|(?:(?!--!?>).)*+(?:--!?>|\Z))|[!?/][^>]*+(?:>|\Z))",
    re.S,
)
BROKEN = re.compile(r"<(?P<close>/)?(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>[^>]*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
WITH = re.compile(r"\b(?:with|has|no|without)[-_]?[a-z]+")


def role(name: str, rest: str) -> tuple[str, int]:
    """(signature, kind) of an element: kind 1 is set aside, 2 is a head, 3 is a main part, 4 is
    set aside by a class or id that may mean something else."""
    names, roles, prop = "", "", ""
    if "=" in rest:
        for key, a, b, c in ATTRIBUTE.findall(rest):
            value = a or b or c
            if key.lower() == "role":
                roles = value.lower().strip()
            elif key.lower() == "itemprop":
                prop = value.lower()
            else:
                names += " " + value
    plain = WITH.sub(" ", CAMEL.sub("-", names).lower())
    words = set(re.split(r"[^a-z]+", plain)) - {""} if names else set()
    signature = name + ("." + ".".join(sorted(words)) if words else "")
    if name in ASIDE or roles in ASIDE_ROLES or (words & NEVER and name not in ("html", "body", "main")):
        return signature, 1
    if name in MAIN or roles == "main" or prop == "articlebody":
        return signature, 3
    if words & ASIDE_WORDS and name not in ("html", "body"):
        return signature, 4
    if name == "header" or roles == "banner" or (words & HEAD_WORDS and name not in ("html", "body")):
        return signature, 2
    return signature, 0


def walk(page: str):
    """A page as balanced steps: (1, signature, kind, name), (-1, signature, kind, name) and
    (0, text, None, None). Scripts and the like are left out whole; what the page forgets to
    close is closed."""
    stack: list = []
    at, size = 0, len(page)
    roles: dict = {}
    while at < size:
        less = page.find("<", at)
        if less < 0:
            less = size
        if less > at:
            yield 0, page[at:less], None, None
        if less == size:
            break
        found = TAG.match(page, less) or BROKEN.match(page, less)
        if not found:
            yield 0, "<", None, None
            at = less + 1
            continue
        at = found.end()
        name = found["name"]
        if not name:
            continue
        name = name.lower()
        if found["close"]:
            if stack and stack[-1][3] == name:
                yield -1, *stack.pop()[1:]
            elif any([x[3] == name for x in stack]):
                while stack:
                    top = stack.pop()
                    yield -1, *top[1:]
                    if top[3] == name:
                        break
            elif name in ("p", "br"):
                yield 1, name, 0, name
                yield -1, name, 0, name
            continue
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>", re.I).search(page, at)
            if not found["rest"].endswith("/") or name not in ("svg", "math"):
                at = end.end() if end else size
            yield 1, name, 1, name
            yield -1, name, 1, name
            continue
        if name in CLOSES_PARAGRAPH:
            closing, stop = {"p"}, CLOSES_PARAGRAPH - {"p"}
        else:
            closing, stop = SIBLINGS.get(name, ()), SCOPES.get(name, ())
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][3] in closing:
                    while len(stack) > k:
                        yield -1, *stack.pop()[1:]
                    if name not in ("tr",):
                        break
                elif stack[k][3] in stop:
                    break
        rest = found["rest"]
        if name in INLINE and "class" not in rest and "id" not in rest and "ro" not in rest:
            told = (name, 0)
        else:
            key = (name, rest)
            told = roles.get(key)
            if told is None:
                told = roles[key] = role(name, rest)
        step = (1, *told, name)
        yield step
        if name in VOID:
            yield -1, *told, name
        else:
            stack.append(step)
    while stack:
        yield -1, *stack.pop()[1:]


class Node:
    """A part of a wrapper: present in ``pages`` of its host's, once or repeated; its text is
    none (None), the same wherever seen (a digest) or a slot (0); parts follow in order."""

    __slots__ = ("pages", "many", "text", "chars", "kids", "kind")

    def __init__(self, pages=1, many=False, text=None, chars=0, kids=None, kind=0):
        self.pages, self.many, self.text, self.chars, self.kind = pages, many, text, chars, kind
        self.kids = {} if kids is None else kids

    def plain(self):
        return [self.pages, self.many, self.text, self.chars, self.kind,
                [[s, k.plain()] for s, k in self.kids.items()]]

    @classmethod
    def read(cls, told):
        return cls(*told[:4], {s: cls.read(k) for s, k in told[5]}, told[4])

    def say(self, text):
        digest = zlib.crc32(text.encode("utf-8", "replace")) or 1
        self.chars += len(text)
        self.text = digest if self.text in (None, digest) else 0


def wrapper(page: str) -> Node:
    """The wrapper of one page: an element seen again among its siblings, alone or after
    others, makes a repeated part; texts that differ between repeats make a slot."""
    root = Node()
    nodes, texts = [root], [[]]
    for step, what, kind, name in walk(page):
        if step == 0:
            texts[-1].append(what)
        elif name in INLINE or name == "br":
            continue
        elif step == 1:
            kids = nodes[-1].kids
            node = kids.get(what)
            if node is None:
                node = kids[what] = Node(kind=kind)
            else:
                node.many = True
            nodes.append(node)
            texts.append([])
        else:
            text = " ".join("".join(texts.pop()).split())
            node = nodes.pop()
            if text:
                node.say(text)
    return root


def align(a: Node, b: Node) -> Node:
    """The wrapper of both, made in ``a``. Parts are aligned in order; a part that one side
    lacks becomes optional (it is seen in fewer pages), one that recurs becomes repeated, and
    texts that differ become a slot. No alternatives arise: the expression is union-free."""
    a.pages += b.pages
    a.many |= b.many
    a.chars += b.chars
    a.kind = max(a.kind, b.kind)
    if b.text is not None:
        a.text = b.text if a.text in (None, b.text) else 0
    if a.kids.keys() == b.kids.keys() or not b.kids:
        for s, k in b.kids.items():
            align(a.kids[s], k)
        return a
    merged, rest = {}, iter(a.kids.items())
    for s, k in b.kids.items():
        if s in merged:
            align(merged[s], k)
        elif s in a.kids:
            for t, mine in rest:
                merged[t] = mine
                if t == s:
                    break
            align(merged[s], k)
        else:
            merged[s] = k
    merged.update(rest)
    if len(merged) > WIDE:
        wide: dict = {}
        for s, k in merged.items():
            tag = s.split(".")[0]
            if tag in wide:
                align(wide[tag], k).many = True
            else:
                wide[tag] = k
        merged = wide
    a.kids = merged
    return a


def changing(node: Node) -> int:
    """Characters of slots in a part, without what its role sets aside."""
    if node.kind in (1, 4):
        return 0
    own = node.chars if node.text == 0 else 0
    return own + sum(changing(k) for k in node.kids.values())


def rules(root: Node) -> dict:
    """What a wrapper tells about its host's pages.

    ``main``: the path of the smallest part that holds most of the changing text, if no part
    says that it is the article. ``fixed``: paths of parts that show one text on all pages.
    """
    main, node = [], root
    total = changing(root)
    while total:
        name, kid = max(node.kids.items(), key=lambda x: changing(x[1]), default=(None, None))
        if kid is None or kid.many or changing(kid) < MAIN_SHARE * total:
            break
        main.append(name)
        node = kid
    fixed = []

    def look(part, path):
        for name, kid in part.kids.items():
            here = [*path, name]
            tag = name.split(".")[0]
            same = not kid.many and kid.text not in (None, 0) and not kid.kids
            if same and kid.pages >= max(FIXED_PAGES, 0.5 * root.pages) and tag not in PROSE:
                fixed.append(here)
            look(kid, here)

    if total:
        look(root, [])
    return {"main": main, "fixed": fixed}


def main_text(page: str, told: dict) -> str:
    """The article of a page, its blocks joined by spaces.

    Menus, footers, sidebars, notices, adverts, forms and comments are left out by role, and
    page heads outside the article. The article is what the page marks as such. If that leaves
    nothing: what it holds under names that set parts aside, then the longer of a marked article
    inside a part with such a name and of the part that the host's wrapper found to hold the
    changing text; else all that is left.
    """
    fixed = {tuple(x) for x in told.get("fixed", ())}
    main = tuple(told.get("main", ()))
    marked, placed, whole, softly, reopened = [], [], [], [], []
    path: list = []
    # Depth inside parts set aside, and inside parts set aside by a name only; open main parts
    # with the second depth around them, and how many of them lie in such a part.
    off, soft, article, inside, hidden = 0, 0, 0, 0, 0
    opened: list = []
    for step, what, kind, name in walk(page):
        if step == 0:
            if off:
                continue
            piece = entities.unescape(what) if "&" in what else what
            if soft:
                if article:
                    softly.append(piece)
            elif hidden:
                reopened.append(piece)
            else:
                whole.append(piece)
                if article:
                    marked.append(piece)
                    softly.append(piece)
                if inside:
                    placed.append(piece)
            continue
        if name not in INLINE:
            for out in (whole, marked, placed, softly, reopened):
                out.append(" ")
        elif kind == 0:
            continue
        if name not in INLINE and name != "br":
            if step == 1:
                path.append(what)
        here = tuple(path) if fixed or main else ()
        aside = kind == 1 or (kind == 2 and not article) or (here in fixed and name not in INLINE)
        if kind == 3 and not off:
            # An article inside a part that is set aside by name only is still an article.
            if step == 1:
                opened.append(soft)
                hidden, soft, article = (hidden + 1, 0, article) if soft else (hidden, 0, article + 1)
            else:
                around = opened.pop()
                hidden, soft, article = (hidden - 1, around, article) if around else (hidden, 0, article - 1)
        elif aside or off:
            off += step
        elif kind == 4 or soft:
            soft += step
        if main and here == main and name not in INLINE:
            inside += step
        if name not in INLINE and name != "br" and step == -1:
            path.pop()
    texts = [" ".join("".join(out).split()) for out in (marked, softly, reopened, placed, whole)]
    texts[2:4] = sorted(texts[2:4], key=len, reverse=True)
    return next((t for t in texts if t), "")


def folded(frames, key, finish):
    """Merge neighbouring rows of one host; rows come sorted by ``key``."""
    held, node = None, None
    for batch in frames:
        hosts, out = [], []
        for values in zip(*(batch.column(c).to_pylist() for c in (*key, "wrapper"))):
            where, told = values[:-1], Node.read(json.loads(values[-1]))
            if where == held:
                align(node, told)
                continue
            if held is not None:
                hosts.append(held[0])
                out.append(json.dumps(finish(node), separators=(",", ":")))
            held, node = where, told
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(out, pa.string())], names=["host", "wrapper"]
        )
    if held is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([held[0]]), pa.array([json.dumps(finish(node), separators=(",", ":"))])],
            names=["host", "wrapper"],
        )


def host_rules(pages: DataFrame) -> DataFrame:
    """(host, wrapper): a row for each host with the rules its wrapper gives, stored.

    Tasks align the pages they read, host by host; the tasks' wrappers then meet in two
    levels. A wrapper's size depends on the host's markup, not on the number of its pages.
    """

    def infer(batches):
        seen: dict = {}

        def told():
            hosts = list(seen)
            rows = [json.dumps(seen[h].plain(), separators=(",", ":")) for h in hosts]
            seen.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(rows, pa.string())], names=["host", "wrapper"]
            )

        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html")):
                one = wrapper(page.as_py())
                seen[host] = align(seen[host], one) if host in seen else one
                if len(seen) > HELD_HOSTS:
                    yield told()
        yield told()

    schema = "host string, wrapper string"
    parts = pages.select("host", "html").mapInArrow(infer, schema)
    salted = parts.withColumn("salt", F.spark_partition_id() % MERGES)
    met = salted.repartition("host", "salt").sortWithinPartitions("host", "salt").mapInArrow(
        lambda rows: folded(rows, ("host", "salt"), Node.plain), schema
    )
    whole = met.repartition("host").sortWithinPartitions("host").mapInArrow(
        lambda rows: folded(rows, ("host",), rules), schema
    )
    return stored(whole, "host-rules")


def page_texts(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    The whole page is read. A null page is empty and has an empty text; a null url, or one
    without a host, belongs to the host ''. Repeated rows are rows of their own; an empty table
    gives no rows; further columns are not read.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))
    joined = rows.join(host_rules(rows), "host", "left")
    schema = pages.select("page_id", "url", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema

    def run(batches):
        known: dict = {}
        for batch in batches:
            texts = []
            for page, told in zip(batch.column("html"), batch.column("wrapper").to_pylist()):
                if told not in known:
                    if len(known) > HELD_HOSTS:
                        known.clear()
                    known[told] = json.loads(told) if told else {}
                texts.append(main_text(page.as_py(), known[told]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array(list(map(len, texts)), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return joined.mapInArrow(run, schema)


def op9_html_wrappers(spark, sf_dir):
    return page_texts(table(spark, sf_dir, "pages"))
