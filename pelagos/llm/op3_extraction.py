"""HTML extraction by union-free regular expressions (wrappers) inferred for each host.

The token stream of a page is read into nested elements. The content of an element becomes
an expression over labels (tag, classes, id, role): adjacent equal items fold into a
repetition, repeated runs of up to four labels into a repeated group. The expressions of a
host's pages are aligned one after the other: items that match are merged, mismatches become
optional, texts that differ become slots, equal texts stay part of the template, and every
text slot sums up how much of it stood in links.

The aligned expression says what goes: texts that never change where they stand, inside an
article too (a repetition of an article, its paragraphs, is content as a whole); outside an
article, items that are links for the most part (menus in plain elements); and items whose
label only hints at furniture (WORDS) if they are links or template for the most part. Labels
alone judge what HTML itself or the task names (DROP, NAMED: menus, headers, footers, notices,
adverts, forms, reader comments vary from page to page as articles do), and, by their hints,
what the wrapper has seen on fewer than three pages.

Wrappers are inferred from all different pages of a host, in PARTS parts that are aligned
afterwards; every page is extracted whole. Elements more than DEPTH deep count as children of
the element there. Wrappers of up to WRAPPERS characters in all are broadcast, more are joined.

Defined results: null html gives an empty text; a null url has the empty host; repeated rows
are extracted alike; without an article or main element the whole body counts, less the
furniture; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import json
import re
from difflib import SequenceMatcher
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagos.llm import bytehash as bh
from pelagos.session import long_rows, materialize, table

NAME = "op3_union_free_wrappers"
PARTS, WRAPPERS, PERIOD, DEPTH, LINKS = 64, 4_000_000, 4, 100, 0.6
SCHEMA = "page_id long, url string, text string, n_chars long"

#: HTML element names and the words that mark furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe title xmp noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul caption".split())
DROP = frozenset("head script style noscript template textarea iframe title nav header footer aside form button select option input label svg canvas object embed audio video dialog menu fieldset".split())
NAMED = frozenset("ad ads adv advert adverts advertisement advertisements adbox adsbygoogle sponsor sponsored sidebar aside menu nav navbar navigation breadcrumb breadcrumbs masthead cookie cookies consent gdpr notice notices newsletter subscribe signup login comment comments commentlist disqus respond reply replies".split())
WORDS = frozenset("banner promo promotion header footer alert popup modal overlay share sharing social related recommended recommendations widget toolbar pagination pager skip search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
HOLDS = frozenset("html body div section article main table ul ol dl form aside nav header footer blockquote td th li".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S)
LINK = re.compile(r"a(?![a-z0-9-])")
ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


@lru_cache(1 << 14)
def label_of(tag: str, attrs: str) -> str:
    marks = []
    if "=" in attrs:
        for name, a, b, c in ATTR.findall(attrs):
            for w in (a or b or c).lower().split():
                marks.append({"class": ".", "id": "#", "role": "@"}[name.lower()] + re.sub("[0-9]+", "0", w))
    return tag + "".join(sorted(marks))


@lru_cache(1 << 14)
def hints(label: str) -> int:
    """2: furniture by its label alone, 1: the label hints at it, 0: it doesn't."""
    tag, *marks = re.split(r"(?=[.#@])", label)
    if tag in DROP or any(m[0] == "@" and m[1:] in ROLES for m in marks):
        return 2
    words = {w for m in marks for w in re.split("[^a-z]+", m[1:])}
    if tag in ("html", "body", "article", "main"):
        return 2 if tag == "article" and words & {"comment", "comments"} else 0
    return 2 if words & NAMED else 1 if words & WORDS else 0


def region(label: str) -> bool:
    return bool(re.match(r"(article|main)(?![a-z])", label)) or "@main" in label


def tokens(page: str):
    """(kind, label or text): '<' opens, '/' closes, 't' is text, 'b' a break inside a block.
    Scripts and the like are skipped with their content; comments are dropped."""
    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            yield "t", page[at:]
            return
        if m.start() > at:
            yield "t", page[at:m.start()]
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(1):
            yield "/", tag
            continue
        if tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])[^>]*(?:>|\\Z)", re.I).search(page, at)
            at = end.end() if end else n
        elif tag in VOID:
            yield ("<", tag) if tag == "hr" else ("b", tag)
            if tag == "hr":
                yield "/", tag
        else:
            yield "<", label_of(tag, m.group(3))
            if m.group(3).endswith("/") and tag not in BLOCK:
                yield "/", tag


def nested(page: str):
    """tokens() with implied ends made explicit: every opened label is closed once."""
    stack: list[tuple[str, str]] = []
    for kind, x in tokens(page):
        if kind == "<":
            tag = re.split(r"[.#@]", x, maxsplit=1)[0]
            if tag in BLOCK:
                ends = CLOSES.get(tag, set()) | ({"p"} if tag != "p" else {"p", "h1", "h2", "h3", "h4", "h5", "h6"})
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in ends:
                        while len(stack) > i:
                            yield "/", stack.pop()[1]
                        if tag not in CLOSES:
                            break
                    elif stack[i][0] in HOLDS:
                        break
            stack.append((tag, x))
            yield "<", x
        elif kind == "/":
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == x:
                    while len(stack) > i:
                        yield "/", stack.pop()[1]
                    break
                if x not in BLOCK and stack[i][0] in BLOCK:
                    break  # an inline end tag doesn't close a block
        else:
            yield kind, x
    while stack:
        yield "/", stack.pop()[1]


# ---- inference. An item is [label, optional, many, content, text, pages, characters, of them in
# links]; '#' is text, '&' a group. The last two are summed up in texts.


def expression(page: str) -> list:
    top: list = []
    stack, links = [top], []
    for kind, x in nested(page):
        if kind == "<":
            item = [x, False, False, [], None, 1, 0, 0]
            stack[-1].append(item)
            stack.append(item[3] if len(stack) < DEPTH else stack[-1])
            links.append(bool(links and links[-1] or LINK.match(x)))
        elif kind == "/":
            links.pop()
            done = stack.pop()
            if stack[-1] is not done:
                stack[-1][-1][3] = fold(done)
        elif kind == "t" and (text := " ".join(x.split())):
            stack[-1].append(["#", False, False, [], text, 1, len(text), len(text) if links and links[-1] else 0])
    return fold(top)


def _key(item: list):
    return (item[0], tuple(i[0] for i in item[3])) if item[0] == "&" else item[0]


def _merge(a: list, b: list) -> list:
    return [a[0], a[1] or b[1], a[2] or b[2], align(a[3], b[3]), a[4] if a[4] == b[4] else None, a[5] + b[5], a[6] + b[6], a[7] + b[7]]


def fold(items: list) -> list:
    """Repetitions: of one item, then of runs of up to PERIOD items."""
    out: list = []
    for i in items:
        if out and out[-1][0] == i[0]:
            out[-1] = _merge(out[-1], i)
            out[-1][2] = True
        else:
            out.append(i)
    for p in range(2, PERIOD + 1):
        at = 0
        while at + 2 * p <= len(out):
            keys = [_key(i) for i in out[at:at + p]]
            n = 1
            while [_key(i) for i in out[at + n * p:at + (n + 1) * p]] == keys:
                n += 1
            if n > 1:
                body = out[at:at + p]
                for k in range(1, n):
                    body = [_merge(a, b) for a, b in zip(body, out[at + k * p:at + (k + 1) * p])]
                out[at:at + n * p] = [["&", False, True, body, None, 1, 0, 0]]
            at += 1
    return out


def align(a: list, b: list) -> list:
    """Two expressions of the same host: runs of equal labels are merged, the rest is optional."""
    if not a or not b:
        return [[i[0], True, *i[2:]] for i in a or b]
    ka, kb = [_key(i) for i in a], [_key(i) for i in b]
    if ka == kb:
        return [_merge(x, y) for x, y in zip(a, b)]
    out, i, j = [], 0, 0
    for x, y, n in SequenceMatcher(None, ka, kb, False).get_matching_blocks():
        out += [[i[0], True, *i[2:]] for i in a[i:x] + b[j:y]]
        out += [_merge(p, q) for p, q in zip(a[x:x + n], b[y:y + n])]
        i, j = x + n, y + n
    return out


def show(items: list) -> str:
    """The wrapper as a regular expression, for people."""
    def one(i):
        body = f"({show(i[3])})" if i[0] == "&" else (repr(i[4]) if i[4] else "#text") if i[0] == "#" else f"<{i[0]}>{show(i[3])}</>"
        return f"({body}){'*' if i[1] else '+'}" if i[2] else f"({body})?" if i[1] else body
    return " ".join(map(one, items))


def digest(text: str) -> str:
    """Stands for a text in expressions."""
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def tree(page: str) -> list:
    """expression() of one page, with digests for texts."""
    def once(items):
        for i in items:
            i[4], i[5] = i[4] and digest(i[4]), 1  # fold() adds up what repeats in the page
            once(i[3])
        return items

    return once(expression(page))


def merged(trees: list[list]) -> list:
    """Aligned in pairs, so that none meets all the others one by one."""
    while len(trees) > 1:
        trees = [align(*trees[i:i + 2]) if i + 1 < len(trees) else trees[i] for i in range(0, len(trees), 2)]
    return trees[0] if trees else []


def infer(pages: list[str]) -> dict:
    """The wrapper of different pages of one host, see marks()."""
    return marks(merged([tree(p) for p in pages]), len(pages))


def marks(whole: list, pages: int) -> dict:
    """An aligned expression of so many pages as {label: content of the same form, or None if it is
    dropped; '#': digests of fixed texts, which are dropped}. A text is fixed if it never changes
    where its item stands, on three pages and on half of them at least; inside an article a
    repetition (paragraphs, list items) is content as a whole."""
    def still(i, inside):
        return bool(i[4]) and i[5] >= 3 and 2 * i[5] >= pages and not inside

    def sums(items, out):
        """Characters, those in links, texts in links, characters of fixed texts."""
        for i in items:
            if i[0] == "#":
                out[0] += i[6]
                out[1] += i[7]
                out[2] += (2 if i[2] else 1) * (i[7] > 0)
                out[3] += i[6] * still(i, False)
            else:
                more = sums(i[3], [0, 0, 0, 0])
                more[2] *= 2 if i[2] else 1
                out[:] = map(sum, zip(out, more))
        return out

    def marked(items, main, many):
        out: dict = {}
        gone = []
        for i in items:
            if i[0] == "&":
                _join(out, marked(i[3], main, True))
                continue
            if i[0] == "#":
                if still(i, main and many):
                    _join(out, {"#": [i[4]]})
                continue
            hint, here = hints(i[0]), main or region(i[0])
            drop = hint == 2
            if not drop and (hint or not here):
                size, linked, links, fixed = sums(i[3], [0, 0, 0, 0])
                menu = size > 0 and linked >= LINKS * size and links > 1
                drop = hint and (pages < 3 or menu or 2 * fixed >= size) or menu and not here and not holds(i[3])
            if drop:
                gone.append(i)
            else:
                _join(out, {i[0]: marked(i[3], here, many or i[2])})
        for i in gone:
            if out.get(i[0]) is None:
                out[i[0]] = None
            else:  # a sibling of the same label stays: what the dropped one holds goes
                for below in labels(i[3]):
                    out[i[0]].setdefault(below, None)
        return out

    def labels(items):
        for i in items:
            if i[0] == "&":
                yield from labels(i[3])
            elif i[0] != "#":
                yield i[0]

    def holds(items):
        return any(region(i[0]) or holds(i[3]) for i in items)

    return marked(whole, False, False)


def _join(out: dict, more: dict) -> None:
    for k, v in more.items():
        if out.get(k) is None:  # content wins over what is dropped under the same label
            out[k] = v
        elif k == "#":
            out[k] = sorted({*out[k], *v})
        elif v:
            _join(out[k], v)


# ---- extraction


def extract(page: str, wrapper: dict) -> str:
    """Blocks of the article, along the wrapper."""
    inside: list[str] = []  # of an article or main element
    outside: list[str] = []
    buf: list[str] = []
    stack: list[tuple] = [(False, wrapper, False)]  # dropped, wrapper below, in a region
    seen = False

    def flush():
        text = " ".join("".join(buf).split())
        buf.clear()
        if text:
            (inside if stack[-1][2] else outside).append(text)

    for kind, x in nested(page):
        drop, items, main = stack[-1]
        if kind == "<":
            if x.split(".", 1)[0].split("#", 1)[0].split("@", 1)[0] in BLOCK and not drop:
                flush()
            below = items.get(x, False) if items else False
            if not drop:
                drop = below is None or (below is False and hints(x) > 0)
            if not drop and region(x):
                seen = main = True
            stack.append((drop, (below or {}) if len(stack) < DEPTH else items, main))
        elif kind == "/":
            if x.split(".", 1)[0].split("#", 1)[0].split("@", 1)[0] in BLOCK and not drop:
                flush()
            stack.pop()
        elif drop:
            continue
        elif kind == "b":
            if x == "br":
                buf.append(" ")
        else:
            text = entities.unescape(x)
            if not (items and "#" in items and digest(" ".join(x.split())) in items["#"]):
                buf.append(text)
    flush()
    return "\n\n".join(inside if seen else outside)


@lru_cache(4096)
def _loaded(text: str) -> dict:
    return json.loads(text)


def _hosted(pages: DataFrame) -> DataFrame:
    url = F.coalesce(F.col("url"), F.lit(""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), F.lower(F.regexp_extract(url, r"://([^/?#]*)", 1)).alias("host"))


def wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper (JSON) of all different pages of each host. A page travels as its tree; those
    of one host and part are aligned first, then the parts, so no task holds a large host."""

    def trees(batches):
        for b in batches:
            hosts, keys, found = [], [], []
            for host, page in sorted(set(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))):
                hosts.append(host)
                keys.append(blake2b(page.encode("utf-8", "surrogatepass"), digest_size=16).digest())
                found.append(json.dumps(tree(page), separators=(",", ":")))
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(keys, pa.binary()), pa.array(found, pa.string())], names=["host", "key", "tree"])

    def part(rows: pa.Table) -> pa.Table:
        different = dict(zip(rows.column("key").to_pylist(), rows.column("tree").to_pylist()))
        whole = merged([json.loads(different[k]) for k in sorted(different)])
        return pa.table({"host": [rows.column("host")[0].as_py()], "part": [rows.column("part")[0].as_py()], "n": [len(different)], "tree": [json.dumps(whole, separators=(",", ":"))]})

    def of(rows: pa.Table) -> pa.Table:
        parts = sorted(zip(rows.column("part").to_pylist(), rows.column("tree").to_pylist()))
        got = marks(merged([json.loads(t) for _, t in parts]), sum(rows.column("n").to_pylist()))
        return pa.table({"host": [rows.column("host")[0].as_py()], "wrapper": [json.dumps(got)]})

    each = pages.select("host", "html").mapInArrow(bh.lean(trees), "host string, key binary, tree string")
    some = each.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(PARTS)))
    few = some.groupBy("host", "part").applyInArrow(part, "host string, part long, n long, tree string")
    return few.groupBy("host").applyInArrow(of, "host string, wrapper string")


def extracted(pages: DataFrame) -> DataFrame:
    pages = _hosted(long_rows(pages))
    known = materialize(wrappers(pages), "wrappers")
    size = known.agg(F.coalesce(F.sum(F.length("host") + F.length("wrapper")), F.lit(0))).first()[0]
    joined = pages.join(F.broadcast(known) if size <= WRAPPERS else known, "host", "left").select("page_id", "url", "html", "wrapper")

    def task(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                texts = [extract(h, _loaded(w)) for h, w in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(bh.lean(task), SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


ORACLE_SQL = None  # tested against pages built from known articles
