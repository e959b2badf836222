"""Main text of web pages by inferred wrappers.

The pages of a host come from templates. Their token streams are aligned into a
wrapper, a union-free regular expression over tags and text: what some pages lack
becomes optional, what comes again or in another order becomes a repeated group, and
text that differs becomes a slot. Inline tags belong to the text about them. The
wrapper then tells template from article: it knows for each slot how much of its text
varies and how much is links, and the region that holds the article is chosen on it
once for the host.

An expression is kept per element as an ordered list of groups of child labels, each
label once. Two lists are aligned by joining their orders: labels that would have to
come both before and after each other fall into one repeated group. So a wrapper's size
is bounded by the labels (tag and class words) that occur under one another and not by
the pages or their length; beyond ``MOST_LABELS`` under one element, class words that
mean nothing here are left out.

Each task aligns the pages it reads and hands on one wrapper per host; these are sorted
and aligned in two rounds, first by host and a salt, so that a host with a third of all
pages meets in one task as a few dozen wrappers only. Pages are not shuffled for that.
The rules go back to the pages by broadcast for hosts that are frequent (bounded in
number and bytes) and by a join on the host for the others, none of which is frequent.

Defined results: a null or empty page has the empty text. Pages without a host in their
url share one wrapper. A page in which the host's rule finds nothing is read by the rule
of its own wrapper. Unclosed and stray tags, comments and references are read as
browsers do; what is nested deeper than ``DEEPEST`` counts as inline. Repeated rows are
read one by one; an empty table gives no rows; columns not named in ``keep`` do not
matter. A very long page costs some five times its size in its task.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabfold.llm.common import batches_by_bytes, settle
from tabfold.llm.url_filter import host_and_path

# Elements by what they mean for the text, as HTML defines them.
BLOCKS = frozenset(
    "html head body article section main div p h1 h2 h3 h4 h5 h6 header footer nav aside form fieldset ul ol li dl dt dd menu "
    "table caption thead tbody tfoot tr td th blockquote pre figure figcaption address details summary dialog hgroup center "
    "search legend".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their content is no text of the page, whatever it looks like.
RAW = "script|style|noscript|template|textarea|title|iframe|object|svg|canvas|audio|video|select|button|xmp|noembed|noframes"
CLOSES_P = BLOCKS - {"html", "head", "body", "td", "th", "tr", "thead", "tbody", "tfoot", "caption", "legend"}
# A start tag ends the open element of these kinds, unless one of the bounds is between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "body": ({"head"}, set()),
}
NOT_ARTICLE = frozenset("head nav header footer aside form menu dialog fieldset search".split())
# Words of class, id and role that mark what is no part of an article.
NOT_ARTICLE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar nav navbar navigation "
    "menu breadcrumb breadcrumbs header footer masthead toolbar cookie cookies consent gdpr notice notices alert popup modal "
    "overlay newsletter subscribe subscription signup login search share sharing social related recommended comment comments "
    "commentlist respond replies reply disqus widget pagination pager copyright complementary contentinfo dialog form".split()
)
ARTICLE_WORDS = frozenset("articlebody".split())

DEEPEST = 64
MOST_LABELS = 64
WORDS_OF_LABEL = 3
SALTS = 32
HOSTS_AT_ONCE = 2000
# Hosts with at least one in so many pages get their rule by broadcast.
FREQUENT = 2000
BROADCAST_BYTES = 16 << 20

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<raw>{RAW})\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)


@lru_cache(1 << 14)
def _label(tag: str, rest: str) -> str:
    """Tag and the first words of class, id and role; ``-`` marks what is no article by its words."""
    if not rest or tag in ("html", "body"):
        return tag
    values = " ".join(a or b or c for _, a, b, c in ATTRIBUTE.findall(rest))
    words = [w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", values)]
    marked = tag != "main" and not re.fullmatch("h[1-6]", tag) and not NOT_ARTICLE_WORDS.isdisjoint(words)
    kept = list(dict.fromkeys(words))[:WORDS_OF_LABEL]
    if not ARTICLE_WORDS.isdisjoint(words) or "main" in words and "role" in rest:
        kept = ["articlebody"]
    return ".".join([("-" if marked else "") + tag, *kept])


def _tag(label: str) -> str:
    return label.partition(".")[0].lstrip("-")


def _general(label: str) -> str:
    """The label without words that mean nothing here."""
    tag, _, words = label.partition(".")
    return tag if words != "articlebody" else label


class Reader:
    """Calls ``enter(label)``, ``leave()`` and ``text(string, in_link)`` for the token stream of a page.

    Elements that a browser would close by itself are closed; inline tags only
    separate nothing, and line breaks are white space.
    """

    def __init__(self, enter: Callable, leave: Callable, text: Callable):
        self.enter, self.leave, self.text = enter, leave, text

    def read(self, html: str) -> None:
        tags: list[str] = []
        links = 0
        spans: list[str] = []

        def close(down_to: int) -> None:
            while len(tags) > down_to:
                tags.pop()
                self.leave()

        def end(kinds, bounds) -> None:
            for at in range(len(tags) - 1, -1, -1):
                if tags[at] in kinds:
                    close(at)
                    return
                if tags[at] in bounds:
                    return

        for token in TOKEN.finditer(html):
            kind = token.lastgroup
            if kind == "text":
                text = token["text"]
                self.text(unescape(text) if "&" in text else text, links > 0)
                continue
            tag = token["tag"] or token["tag2"]
            if tag is None:
                if token["raw"] and token["raw"].lower() not in ("title",):
                    self.text(" ", False)
                continue
            tag = tag.lower()
            rest = token["rest"] or token["rest2"] or ""
            if token["end"] or token["end2"]:
                if tag == "a":
                    links = 0
                elif tag in tags and (tag in BLOCKS or tag in spans):
                    if tag in spans:
                        spans.remove(tag)
                    end({tag}, () if tag in ("html", "body", "article", "main") else {"article", "main", "body", "td", "th"} - {tag})
                continue
            if tag in VOID:
                if tag in ("br", "hr"):
                    self.text(" ", False)
                continue
            if tag == "a":
                links = 1
            label = _label(tag, rest.rstrip("/ ")) if tag in BLOCKS or ("class" in rest or "id=" in rest or "role" in rest) else tag
            if tag not in BLOCKS:
                # Inline, unless its words say that it is no part of an article.
                if label[0] != "-" or rest.endswith("/") or tag == "a":
                    continue
                spans.append(tag)
            if len(tags) >= DEEPEST:
                self.text(" ", False)
                continue
            if tag in CLOSES_P:
                end({"p"}, BLOCKS - {"p"})
                links = 0
            if tag in ENDS:
                end(*ENDS[tag])
            if tag in ("html", "body") and tag in tags:
                continue
            tags.append(tag)
            self.enter(label)
        close(0)


# A node of a wrapper: [instances, parents that have it, groups, children by label, open to any words].
# Groups are [repeated, labels]; the text slot "#" of an element is [instances, parents, characters, of them in links, crc32 of
# its text if that is the same everywhere].
N, PARENTS, GROUPS, CHILDREN, OPEN = range(5)
CHARS, LINKS, SAME = 2, 3, 4


def _condense(chains: list[list], repeated: set[str]) -> list:
    """The finest order of groups that all chains of groups keep: strongly connected labels share a group."""
    after: dict[str, dict[str, None]] = {}
    for chain in chains:
        for i, labels in enumerate(chain):
            following = chain[i + 1] if i + 1 < len(chain) else []
            for j, label in enumerate(labels):
                # A group is a cycle through its labels.
                reach = after.setdefault(label, {})
                reach.update(dict.fromkeys(following))
                if len(labels) > 1:
                    reach[labels[(j + 1) % len(labels)]] = None
    # Tarjan's components come out last first.
    order: dict[str, int] = {}
    low: dict[str, int] = {}
    stack: list[str] = []
    held: set[str] = set()
    groups = []
    for start in reversed(list(after)):
        if start in order:
            continue
        work = [(start, iter(after[start]))]
        order[start] = low[start] = len(order)
        stack.append(start)
        held.add(start)
        while work:
            label, reach = work[-1]
            for other in reach:
                if other not in order:
                    order[other] = low[other] = len(order)
                    stack.append(other)
                    held.add(other)
                    work.append((other, iter(after[other])))
                    break
                if other in held:
                    low[label] = min(low[label], order[other])
            else:
                work.pop()
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[label])
                if low[label] == order[label]:
                    group = []
                    while not group or group[-1] != label:
                        group.append(stack.pop())
                        held.discard(group[-1])
                    group.reverse()
                    groups.append([len(group) > 1 or label in repeated, sorted(group) if len(group) > 1 else group])
    groups.reverse()
    return groups


def _repeated(groups: list) -> set[str]:
    return {label for again, labels in groups if again for label in labels}


def _aligned(one: list, other: list) -> list:
    if one == other:
        return one
    return _condense([[g[1] for g in one], [g[1] for g in other]], _repeated(one) | _repeated(other))


def _merge_text(one: list, other: list) -> list:
    return [*(one[i] + other[i] for i in range(4)), one[SAME] if one[SAME] == other[SAME] else None]


def merge(one: list, other: list) -> list:
    """The wrapper that both match, with their counts added up."""
    if one[OPEN] != other[OPEN]:
        one, other = _opened(one), _opened(other)
    children = dict(one[CHILDREN])
    for label, child in other[CHILDREN].items():
        held = children.get(label)
        children[label] = child if held is None else (_merge_text if label == "#" else merge)(held, child)
    node = [one[N] + other[N], one[PARENTS] + other[PARENTS], _aligned(one[GROUPS], other[GROUPS]), children, one[OPEN]]
    return _opened(node) if len(children) > MOST_LABELS and not node[OPEN] else node


def _opened(node: list) -> list:
    """The node with children whose labels leave out words that mean nothing here."""
    if node[OPEN]:
        return node
    children: dict[str, list] = {}
    for label, child in node[CHILDREN].items():
        label = label if label == "#" else _general(label)
        held = children.get(label)
        if held is None:
            children[label] = child
        else:
            both = (_merge_text if label == "#" else merge)(held, child)
            both[PARENTS] = min(both[PARENTS], node[N])
            children[label] = both
    chain, repeated = [], set()
    for again, labels in node[GROUPS]:
        kept = list(dict.fromkeys(x if x == "#" else _general(x) for x in labels))
        chain.append(kept)
        if again or len(kept) < len(labels):
            repeated.update(kept)
    flat = [x for labels in chain for x in labels]
    repeated |= {x for x in flat if flat.count(x) > 1}
    return [node[N], node[PARENTS], _condense([chain], repeated), children, 1]


class _Builder:
    """The wrapper of one page: equal labels under one element are aligned with one another."""

    def __init__(self):
        self.stack = [["", [], {}, set()]]
        self.parts: list[str] = []
        self.in_links = 0

    def flush(self) -> None:
        if not self.parts:
            return
        words = "".join(self.parts).split()
        if words:
            chars = sum(map(len, words))
            # Characters count without white space, so that the share of links is one of characters too.
            self._add("#", [1, 1, chars, min(chars, self.in_links), zlib.crc32(" ".join(words).encode(errors="replace"))])
        self.parts, self.in_links = [], 0

    def _add(self, label: str, child: list) -> None:
        _, sequence, children, _ = self.stack[-1]
        held = children.get(label)
        if held is not None:
            child = (_merge_text if label == "#" else merge)(held, child)
            child[PARENTS] = 1
        children[label] = child
        if not sequence or sequence[-1] != label:
            sequence.append(label)
        else:
            self.stack[-1][3].add(label)

    def enter(self, label: str) -> None:
        self.flush()
        self.stack.append([label, [], {}, set()])

    def leave(self) -> None:
        self.flush()
        label, sequence, children, again = self.stack.pop()
        self._add(label, self._node(sequence, children, again))

    @staticmethod
    def _node(sequence: list[str], children: dict, again: set[str]) -> list:
        if len(sequence) == len(children):
            groups = [[label in again, [label]] for label in sequence]
        else:
            groups = _condense([[[label] for label in sequence]], again | {x for x in children if sequence.count(x) > 1})
        node = [1, 1, groups, children, 0]
        return _opened(node) if len(children) > MOST_LABELS else node

    def text(self, text: str, in_link: bool) -> None:
        self.parts.append(text)
        if in_link:
            self.in_links += len("".join(text.split()))


def page_wrapper(html: str) -> list:
    built = _Builder()
    Reader(built.enter, built.leave, built.text).read(html)
    built.flush()
    _, sequence, children, again = built.stack[0]
    return built._node(sequence, children, again)


def expression(node: list) -> str:
    """The wrapper as a regular expression: ``?`` optional, ``+`` repeated, ``#`` a text slot, ``'#'`` a fixed text."""

    def of(label: str) -> str:
        child = node[CHILDREN][label]
        if label == "#":
            inner = "'#'" if child[SAME] is not None and child[N] > 1 else "#"
        else:
            inner = f"<{label}>{expression(child)}</{_tag(label)}>"
        return inner + "?" if child[PARENTS] < node[N] else inner

    return "".join(f"({''.join(of(x) for x in labels)})+" if again else of(labels[0]) for again, labels in node[GROUPS])


def _masses(node: list) -> tuple[int, int]:
    """Characters of text that varies or is rare, and those in links, of all that may be article."""
    chars = links = 0
    for label, child in node[CHILDREN].items():
        if label == "#":
            if child[SAME] is None or child[N] < 3:
                chars, links = chars + child[CHARS], links + child[LINKS]
        elif not _is_template(label):
            more = _masses(child)
            chars, links = chars + more[0], links + more[1]
    return chars, links


def _is_template(label: str) -> bool:
    return label[0] == "-" or _tag(label) in NOT_ARTICLE


def _holds(node: list, wanted: Callable[[str], bool]) -> bool:
    return any(label != "#" and (wanted(label) or _holds(child, wanted)) for label, child in node[CHILDREN].items())


def _is_article(label: str) -> bool:
    return _tag(label) == "article" and label[0] != "-"


def _is_main(label: str) -> bool:
    return _tag(label) == "main" or label.endswith(".articlebody")


def choose(wrapper: list) -> dict[str, list[str]]:
    """Where the article is: paths of the regions to take, of parts of them to leave out, of
    elements that are to be taken in spite of their words, and of those open to any words."""
    rule: dict[str, list[str]] = {"take": [], "leave": [], "keep": [], "open": []}

    def survey(node: list, path: str, wanted: Callable[[str], bool]) -> None:
        if node[OPEN] and path not in rule["open"]:
            rule["open"].append(path)
        for label, child in node[CHILDREN].items():
            if label == "#":
                continue
            below = f"{path}/{label}"
            if wanted(label):
                rule["take"].append(below)
                survey(child, below, lambda _: False)
                continue
            if label[0] == "-" and _tag(label) not in NOT_ARTICLE and _holds(child, lambda x: _is_article(x) or _is_main(x)):
                # A word such as ``no-sidebar`` on what holds the article itself.
                if below not in rule["keep"]:
                    rule["keep"].append(below)
            elif _is_template(label):
                continue
            survey(child, below, wanted)

    for wanted in (_is_article, _is_main):
        survey(wrapper, "", wanted)
        if rule["take"]:
            return rule
    # No element says that it is the article: go down to where most of the text is.
    node, path = wrapper, ""
    while True:
        whole = sum(_weights(node))
        inner = {x: c for x, c in node[CHILDREN].items() if x != "#" and not _is_template(x)}
        best = max(inner, key=lambda x: sum(_weights(inner[x])), default=None)
        if best is None or _tag(best) in ("p", "table", "ul", "ol") or sum(_weights(inner[best])) < 0.6 * whole:
            break
        node, path = inner[best], f"{path}/{best}"
    rule["take"].append(path)

    def links(node: list, path: str) -> None:
        for label, child in node[CHILDREN].items():
            if label != "#" and not _is_template(label):
                chars, linked = _masses(child)
                if linked > 0.5 * chars:
                    rule["leave"].append(f"{path}/{label}")
                else:
                    links(child, f"{path}/{label}")

    links(node, path)
    return rule


def _weights(node: list) -> tuple[int, int]:
    chars, links = _masses(node)
    return chars, -links


class _Extractor:
    """The text of a page that a rule takes."""

    def __init__(self, rule: dict[str, frozenset[str]]):
        self.rule = rule
        self.stack = [("", "" in rule["take"], False, False)]
        self.parts: list[str] = []

    def enter(self, label: str) -> None:
        path, taken, left, in_article = self.stack[-1]
        if path in self.rule["open"]:
            label = _general(label)
        below = f"{path}/{label}"
        taken = taken or below in self.rule["take"]
        if below in self.rule["leave"]:
            left = True
        elif _is_template(label) and below not in self.rule["keep"]:
            # An article's own header has its title.
            left = left or not (in_article and _tag(label) == "header")
        self.parts.append(" ")
        self.stack.append((below, taken, left, in_article or _is_article(label)))

    def leave(self) -> None:
        self.parts.append(" ")
        self.stack.pop()

    def text(self, text: str, in_link: bool) -> None:
        _, taken, left, _ = self.stack[-1]
        if taken and not left:
            self.parts.append(text)


def extract(html: str, rule: dict[str, frozenset[str]]) -> str:
    found = _Extractor(rule)
    Reader(found.enter, found.leave, found.text).read(html)
    return " ".join("".join(found.parts).split())


def _as_sets(rule: dict[str, list[str]]) -> dict[str, frozenset[str]]:
    return {k: frozenset(v) for k, v in rule.items()}


def _dump(value) -> str:
    return json.dumps(value, separators=(",", ":"), ensure_ascii=False)


PARTIAL = "host string, n_pages long, wrapper string"


def _partial(rows: list[tuple[str, int, str]]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string())
    columns = list(zip(*rows)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["host", "n_pages", "wrapper"])


def _read_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper per host of what a task reads, handed on whenever there are many."""
    held: dict[str, list] = {}
    for batch in batches:
        for small in batches_by_bytes([batch], 1):
            for host, html in zip(small.column(0).to_pylist(), small.column(1).to_pylist()):
                one = page_wrapper(html or "")
                held[host] = merge(held[host], one) if host in held else one
        if len(held) >= HOSTS_AT_ONCE:
            yield _partial([(h, w[N], _dump(w)) for h, w in held.items()])
            held = {}
    yield _partial([(h, w[N], _dump(w)) for h, w in held.items()])


def _merge_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper per host from rows sorted by host; one is held at a time."""
    host, held, done = None, None, []
    for batch in batches:
        for at in range(batch.num_rows):
            name, wrapper = batch.column(0)[at].as_py(), json.loads(batch.column(2)[at].as_py())
            if held is not None and name == host:
                held = merge(held, wrapper)
                continue
            if held is not None:
                done.append((host, held[N], _dump(held)))
            host, held = name, wrapper
        yield _partial(done)
        done = []
    yield _partial([(host, held[N], _dump(held))] if held is not None else [])


def infer_wrappers(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """``host``, ``n_pages`` and ``wrapper`` (nested lists as JSON; see ``expression``) of every host."""
    host = host_and_path(F.col(f"`{url}`"))[0]
    found = pages.select(host.alias("host"), F.col(f"`{html}`").alias("html")).mapInArrow(_read_pages, PARTIAL)
    salt = F.pmod(F.crc32(F.col("wrapper").cast("binary")), F.lit(SALTS))
    found = found.withColumn("salt", salt).repartition("host", "salt").sortWithinPartitions("host", "salt", "wrapper")
    # Hosts and salts of a task come one after the other, and equal hosts of two salts may as well be joined here.
    found = found.select("host", "n_pages", "wrapper").mapInArrow(_merge_sorted, PARTIAL)
    return found.repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(_merge_sorted, PARTIAL)


def rules_of(wrappers: DataFrame) -> DataFrame:
    """``host``, ``n_pages``, ``expression`` and ``rule`` (JSON of ``choose``) per wrapper."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [json.loads(w) for w in batch.column("wrapper").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("host"),
                    batch.column("n_pages"),
                    pa.array([expression(w) for w in found], pa.string()),
                    pa.array([_dump(choose(w)) for w in found], pa.string()),
                ],
                ["host", "n_pages", "expression", "rule"],
            )

    return wrappers.mapInArrow(run, "host string, n_pages long, expression string, rule string")


def _with_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Pages with the rule of their host, in ``rule``."""
    rules = rules.select("host", "n_pages", "rule")
    total, n_hosts = rules.agg(F.sum("n_pages"), F.count("*")).first()
    if not n_hosts:
        return pages.withColumn("rule", F.lit(None).cast("string"))
    # At most FREQUENT hosts, whose names and sizes are collected.
    sizes = rules.where(F.col("n_pages") * FREQUENT >= total).select("host", (F.length("host") + F.length("rule")).alias("size")).collect()
    sent, bytes_ = [], 0
    for row in sorted(sizes, key=lambda r: (r["size"], r["host"])):
        bytes_ += 4 * row["size"]
        if bytes_ > BROADCAST_BYTES:
            break
        sent.append(row["host"])
    names = pages.sparkSession.createDataFrame([(h,) for h in sent], "host string")
    frequent = F.broadcast(rules.join(F.broadcast(names), "host", "left_semi").drop("n_pages"))
    if len(sent) == n_hosts:
        return pages.join(frequent, "host", "left")
    rest = pages.join(F.broadcast(names), "host", "left_anti")
    others = rules.join(F.broadcast(names), "host", "left_anti").drop("n_pages")
    return pages.join(frequent, "host").unionByName(rest.join(others.hint("shuffle_hash"), "host", "left"))


def main_text(
    pages: DataFrame, *, url: str = "url", html: str = "html", keep: Sequence[str] = (), rules: DataFrame | None = None
) -> DataFrame:
    """The ``keep`` columns of every page with its main ``text``.

    ``rules`` has host, n_pages and rule as ``rules_of`` gives them; by default they are
    inferred from the same pages.
    """
    if rules is None:
        rules = settle(rules_of(infer_wrappers(pages, url=url, html=html)), "wrapper-rules")
    host = host_and_path(F.col(f"`{url}`"))[0]
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    asked = _with_rules(pages.select(*kept, host.alias("host"), F.col(f"`{html}`").alias("html")), rules)
    asked = asked.select("html", "rule", *[f"k{i}" for i in range(len(keep))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule_of = lru_cache(1 << 12)(lambda rule: _as_sets(json.loads(rule)))
        for batch in batches_by_bytes(batches, 0):
            texts = []
            for page, rule in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = extract(page, rule_of(rule)) if page and rule else ""
                texts.append(text or (extract(page, _as_sets(choose(page_wrapper(page)))) if page else ""))
            columns = [*batch.columns[2:], pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[2:], "text"])

    types = [asked.schema[f"k{i}"].dataType.simpleString() for i in range(len(keep))]
    schema = ", ".join([*(f"k{i} {t}" for i, t in enumerate(types)), "text string"])
    return asked.mapInArrow(run, schema).toDF(*keep, "text")
