"""Main text of web pages by wrapper induction.

Pages of one host share a template.  Every page's element tree is reduced to a *shape* (like
siblings folded into one); a host's shapes are aligned pair after pair by simple tree matching into
one wrapper, whose nodes are the host's slots.  Each page is then aligned to its host's wrapper, and
the text found in a slot is counted over the host's pages: text that is the same on nearly all of
them is template, slots whose text varies hold content.  A page's main text is what varies below the
node that carries most of it, page furniture (menus, footers, forms, ...) excepted.

All counts cover all pages.  Shapes are counted map-side and folded in salted groups, so no host is
gathered: a hot host is one row per different shape, and its wrapper holds only nodes seen on a
hundredth of its pages.
"""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import map_arrow, materialise, ship_package
from orderlake.llm.dom import Node, Run, parse
from orderlake.llm.url_filter import host_of

ALIKE = 0.5                 # siblings with one label and this share of matched nodes are one repeated slot
SALTS = 64                  # groups in which a host's shapes are folded before the last fold
SEEN = 0.01                 # share of a host's pages that a wrapper node is on
CONSTANT = 0.75             # share of a host's pages that certainly hold a template text
CONFIDENCE = 2.0            # standard errors by which that share is exceeded
MENU_LINKED, MENU_CHARS = 0.8, 60      # a slot of several short runs, mostly links, is a menu
BROADCAST_BYTES = 32 << 20  # hosts' models up to this many measured bytes travel to the pages
CACHED_CHARS = 2000         # longer shapes and wrappers are parsed anew for each page

Shape = tuple               # (label, children) of a page; (label, children, pages) in a wrapper


# -- simple tree matching -----------------------------------------------------------------------
def size(shape: Shape) -> int:
    return 1 + sum(size(k) for k in shape[1])


def alignment(a: tuple, b: tuple) -> tuple[int, list[tuple[int, int]]]:
    """Most nodes matched between two lists of subtrees in order, and the pairs of places that reach it."""
    gain = [[match(x, y) for y in b] for x in a]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + gain[i][j])
    pairs, i, j = [], len(a), len(b)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return best[-1][-1], pairs[::-1]


def match(a: Shape, b: Shape) -> int:
    """Nodes of the largest order-preserving matching of two trees with equal labels; 0 if the roots differ."""
    if a[0] != b[0]:
        return 0
    if a[1] == b[1]:
        return size(a)
    return 1 + alignment(a[1], b[1])[0]


def union(a: Shape, b: Shape) -> Shape:
    """Both trees over their matching: matched nodes once (pages added up), the others in order beside them."""
    pages = (a[2] + b[2],) if len(a) > 2 else ()
    if a[1] == b[1] and not pages:
        return a
    kids, i, j = [], 0, 0
    for x, y in [*alignment(a[1], b[1])[1], (len(a[1]), len(b[1]))]:
        kids += [*a[1][i:x], *b[1][j:y]]
        if x < len(a[1]):
            kids.append(union(a[1][x], b[1][y]))
        i, j = x + 1, y + 1
    return (a[0], tuple(kids), *pages)


def shape_of(node) -> Shape:
    """A page's tree without text: siblings with one label and like subtrees are folded into one."""
    kids: list[Shape] = []
    for kid in node.kids:
        s = shape_of(kid)
        for i, other in enumerate(kids):
            if other == s:
                break
            if other[0] == s[0] and 2 * match(other, s) >= ALIKE * (size(other) + size(s)):
                kids[i] = union(other, s)
                break
        else:
            kids.append(s)
    return node.label, tuple(kids)


def counted(shape: Shape, pages: int) -> Shape:
    return shape[0], tuple(counted(k, pages) for k in shape[1]), pages


def pruned(wrapper: Shape, least: float) -> Shape:
    return wrapper[0], tuple(pruned(k, least) for k in wrapper[1] if k[2] >= least), wrapper[2]


def fold(wrappers: list[Shape]) -> Shape:
    """One wrapper of many, aligned in the order given; rare nodes are dropped now and then and at the end."""
    out = wrappers[0]
    for k, w in enumerate(wrappers[1:], 1):
        out = union(out, w)
        if k % 256 == 0:
            out = pruned(out, SEEN * out[2] / 2)
    return pruned(out, SEEN * out[2])


def _read(text: str) -> Shape:
    def tupled(x):
        return (x[0], tuple(tupled(k) for k in x[1]), *x[2:])
    return tupled(json.loads(text))


# -- a host's slots -----------------------------------------------------------------------------
class Slot:
    """A wrapper node with its number (in preorder), its subtree's mean varying characters, and its children by label."""

    def __init__(self, shape: Shape, numbers):
        self.shape, self.number = shape, next(numbers)
        self.kids = defaultdict(list)
        self.weight, self.menu = 0.0, False
        for k in shape[1]:
            self.kids[k[0]].append(Slot(k, numbers))

    def find(self, node):
        """The child slot that a page's node matches best; none if no child has its label."""
        found = self.kids.get(node.label, ())
        if len(found) < 2:
            return found[0] if found else None
        s = shape_of(node)
        return max(found, key=lambda f: match(f.shape, s))

    def pages(self) -> dict:
        """Pages that have each slot of this subtree."""
        out = {self.number: self.shape[2]}
        for kids in self.kids.values():
            for k in kids:
                out |= k.pages()
        return out

    def weigh(self, weights: dict, menus: set) -> float:
        self.menu = self.number in menus
        own = 0.0 if self.menu else weights.get(self.number, 0.0)
        self.weight = own + sum(k.weigh(weights, menus) for kids in self.kids.values() for k in kids)
        return self.weight


def _slots(wrapper: str) -> Slot:
    return Slot(_read(wrapper), iter(range(1 << 62)))


_cached_slots = lru_cache(maxsize=64)(_slots)             # at most 64 times CACHED_CHARS


def align(node: Node, slot: Slot | None) -> None:
    """Give every node of a page its slot (none where the wrapper has no such node)."""
    node.slot = slot
    for kid in node.kids:
        align(kid, slot.find(kid) if slot else None)


def runs(node):
    """Runs below a node in page order, page furniture left out."""
    for kid in node.kids:
        if isinstance(kid, Run):
            yield kid
        elif not kid.furniture:
            yield from runs(kid)


def digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


# -- a page's main text -------------------------------------------------------------------------
def _weight(node) -> float:
    if node.furniture:
        return 0.0
    if node.slot is not None:
        return node.slot.weight
    return len(node.text) if isinstance(node, Run) else sum(_weight(k) for k in node.kids)


def main_region(root: Node) -> Node:
    """The lowest node that still carries most of the varying text; an article is not cut up."""
    node = root
    while node.tag != "article":
        groups = defaultdict(list)
        for kid in node.kids:
            if not kid.furniture:
                groups[id(kid.slot) if kid.slot else id(kid)].append(kid)
        weights = {k: _weight(kids[0]) for k, kids in groups.items()}
        total = sum(weights.values())
        heaviest = max(weights, key=weights.get, default=None)
        if not total or 2 * weights[heaviest] < total or len(groups[heaviest]) > 1:
            break
        below = groups[heaviest][0]
        if isinstance(below, Run) or below.tag != "article" and all(isinstance(k, Run) for k in below.kids):
            break
        node = below
    return node


def headline(root: Node, region: Node):
    """Runs of a first-level heading before the region, if the region has none of its own."""
    def headings(node, inside):
        for kid in node.kids:
            if isinstance(kid, Run) or kid.furniture:
                continue
            inside_kid = inside or kid is region
            if kid.tag == "h1":
                yield inside_kid, kid
            else:
                yield from headings(kid, inside_kid)
    found = list(headings(root, root is region))
    if not found or any(inside for inside, _ in found):
        return []
    return list(runs(found[0][1]))


def main_text(root: Node, constants: set) -> str:
    region = main_region(root)
    blocks = [r.text for r in [*headline(root, region), *runs(region)]
              if not (r.slot and (r.slot.menu or (r.slot.number, digest(r.text)) in constants))]
    return "\n\n".join(blocks)


# -- Spark jobs ---------------------------------------------------------------------------------
def _pages(batches, *columns):
    """One page at a time: (html, other columns' values)."""
    for batch in batches:
        others = [batch.column(c).to_pylist() for c in columns]
        for i, page in enumerate(batch.column("html")):
            yield page.as_py() or "", [o[i] for o in others]


def _in_batches(rows, schema: pa.Schema, most: int = 4096, chars: int = 8 << 20):
    """Record batches of tuples, bounded in rows and in characters of their strings."""
    held, length = [], 0
    for row in rows:
        held.append(row)
        length += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= most or length >= chars:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, length = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def site_of(url: Column) -> Column:
    """64-bit key of a page's host (NULL and host-less urls share the empty host)."""
    return F.xxhash64(host_of(url))


def _shapes(batches):
    schema = pa.schema([("site", pa.int64()), ("shape", pa.string())])
    return _in_batches(((site, json.dumps(shape_of(parse(page)), separators=(",", ":")))
                        for page, (site,) in _pages(batches, "site")), schema)


def _fold_group(table: pa.Table) -> pa.Table:
    rows = sorted(zip(table.column("pages").to_pylist(), table.column("shape").to_pylist()), key=lambda r: (-r[0], r[1]))
    shapes = [_read(s) for _, s in rows]
    wrapper = fold([s if len(s) > 2 else counted(s, n) for s, (n, _) in zip(shapes, rows)])
    return pa.table({"site": table.column("site").slice(0, 1), "shape": [json.dumps(wrapper, separators=(",", ":"))],
                     "pages": pa.array([wrapper[2]], pa.int64())})


def wrappers(pages: DataFrame) -> DataFrame:
    """(site, shape, pages): one wrapper for each host, folded from the host's counted shapes in two steps."""
    ship_package(pages.sparkSession)
    shapes = (map_arrow(pages, _shapes, "site long, shape string").groupBy("site", "shape").agg(F.count(F.lit(1)).alias("pages"))
              .withColumn("salt", F.pmod(F.xxhash64("shape"), F.lit(SALTS))))
    schema = "site long, shape string, pages long"
    return shapes.groupBy("site", "salt").applyInArrow(_salted(_fold_group), schema).groupBy("site").applyInArrow(_fold_group, schema)


def _salted(fn):
    def run(table: pa.Table) -> pa.Table:
        return fn(table.drop_columns(["salt"]))
    return run


def _slots_of(wrapper: str) -> Slot:
    return _cached_slots(wrapper) if len(wrapper) <= CACHED_CHARS else _slots(wrapper)


def _slot_texts(batches):
    """Per page and text of a slot: its digest, runs, characters and linked ones; slot -1 stands for the page."""
    schema = pa.schema([("site", pa.int64()), ("slot", pa.int32()), ("text", pa.int64()), ("page", pa.int64()),
                        ("runs", pa.int32()), ("chars", pa.int64()), ("linked", pa.int64())])

    def rows():
        for html, (site, wrapper) in _pages(batches, "site", "shape"):
            root = parse(html)
            align(root, _slots_of(wrapper))
            found = list(runs(root))
            # copies of one article are one witness: pages are told apart by their longest run
            page = digest(max((r.text for r in found), key=len, default=""))
            sums = defaultdict(lambda: [0, 0, 0])
            for r in found:
                if r.slot:
                    s = sums[r.slot.number, digest(r.text)]
                    s[0], s[1], s[2] = s[0] + 1, s[1] + len(r.text), s[2] + r.linked
            yield site, -1, page, page, 0, 0, 0
            for (slot, text), s in sums.items():
                yield site, slot, text, page, *s
    return _in_batches(rows(), schema)


def models(pages: DataFrame, found: DataFrame) -> DataFrame:
    """(site, shape, constants, weights): a host's wrapper, its template texts and its slots' mean varying text.

    A text is template in its slot if the share of the host's different pages that have it there
    exceeds ``CONSTANT`` by ``CONFIDENCE`` standard errors (Wilson's bound): one law for hosts of any size.
    """
    texts = map_arrow(_with_models(pages, found), _slot_texts,
                      "site long, slot int, text long, page long, runs int, chars long, linked long")
    sums = [F.sum(c).alias(c) for c in ("runs", "chars", "linked")]
    per_page = texts.groupBy("site", "slot", "text", "page").agg(*sums, F.count(F.lit(1)).alias("pages"))
    per_text = per_page.groupBy("site", "slot", "text").agg(*[F.sum(c).alias(c) for c in ("runs", "chars", "linked", "pages")],
                                                          F.count(F.lit(1)).alias("witnesses"))
    per_text = materialise(per_text, "slot-texts")
    total = per_text.where("slot = -1").groupBy("site").agg(F.count(F.lit(1)).alias("n"))
    k, n, z2 = F.col("witnesses"), F.col("n"), CONFIDENCE ** 2
    share = k / n
    bound = (share + z2 / (2 * n) - CONFIDENCE * F.sqrt(share * (1 - share) / n + z2 / (4 * n * n))) / (1 + z2 / n)
    # the bound needs this many witnesses on any host, so the texts of single pages never meet their host's total
    least = z2 * CONSTANT / (1 - CONSTANT)
    constant = (per_text.where((F.col("slot") >= 0) & (k > least)).join(total, "site").where(bound > CONSTANT)
                .select("site", "slot", "text", *[F.col(c).alias(f"same_{c}") for c in ("runs", "chars", "linked")]))
    fixed = [F.sum(f"same_{c}").alias(f"same_{c}") for c in ("runs", "chars", "linked")]
    # both lists are as long as the wrapper: a host's constant texts are each on most of its pages
    per_constant = constant.groupBy("site", "slot").agg(*fixed, F.collect_set(F.struct("slot", "text")).alias("constants"))
    per_slot = per_text.where("slot >= 0").groupBy("site", "slot").agg(*[F.sum(c).alias(c) for c in ("runs", "chars", "linked")])
    varying = [(F.col(c) - F.coalesce(F.col(f"same_{c}"), F.lit(0))).alias(c) for c in ("runs", "chars", "linked")]
    per_site = (per_slot.join(per_constant, ["site", "slot"], "left").groupBy("site").agg(
        F.flatten(F.collect_list("constants")).alias("constants"), F.collect_list(F.struct("slot", *varying)).alias("weights")))
    return found.join(per_site, "site", "left")


def _with_models(pages: DataFrame, found: DataFrame) -> DataFrame:
    """Pages beside their host's model: broadcast if its measured bytes allow, else joined by host.

    The models hold a few hundred bytes per host and the pages are the input itself, so the check saves
    a shuffle of all pages; both ways give the same rows.
    """
    length = F.octet_length("shape") + (16 * F.size("weights") + 16 * F.size("constants") if "weights" in found.columns else 0)
    measured = found.agg(F.sum(length.cast("long"))).first()[0] or 0
    return pages.join(F.broadcast(found) if measured <= BROADCAST_BYTES else found, "site")


def _menus(weights, pages: dict) -> set:
    return {w["slot"] for w in weights if w["runs"] >= 2 * pages[w["slot"]] and w["linked"] >= MENU_LINKED * w["chars"]
            and 0 < w["chars"] <= MENU_CHARS * w["runs"]}


def _model(wrapper: str, constants, weights) -> tuple[Slot, set]:
    """A host's weighed slots and its template texts as (slot, digest)."""
    slots = _slots(wrapper)
    pages = slots.pages()
    slots.weigh({w["slot"]: w["chars"] / pages[w["slot"]] for w in weights or ()}, _menus(weights or (), pages))
    return slots, {(c["slot"], c["text"]) for c in constants or ()}


def _texts(batches):
    known: dict = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = []
        for page, (site, *model) in _pages([batch], "site", "shape", "constants", "weights"):
            if site not in known:
                if len(known) >= 64:                          # hosts' models, each of bounded size
                    known.clear()
                known[site] = _model(*model)
            root = parse(page)
            align(root, known[site][0])
            texts.append(main_text(root, known[site][1]))
        yield pa.RecordBatch.from_pydict({
            "page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64())})


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page: its main text, blocks joined by an empty line.

    A NULL or empty page, and one without varying text, has the empty text.  NULL ids and urls stay;
    NULL and host-less urls are pages of one host.  Repeated rows each keep their row and count as one
    witness.  A host with one page has no template: all but furniture below its main node is content.
    An empty table gives an empty one; other columns are not read; pages may be of any length.
    """
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    rows = pages.select("page_id", "url", "html", site_of(F.col("url")).alias("site"))
    found = materialise(wrappers(rows.select("site", "html")), "page-wrappers")
    told = materialise(models(rows.select("site", "html"), found), "page-models")
    return map_arrow(_with_models(rows, told), _texts,
                     f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


#: The marked article of pages whose only article holds h1 and p blocks, with the entities that texts are written in.
EXTRACT_SQL = r"""
WITH blocks AS (
  SELECT page_id, url, list_transform(
    string_split_regex(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '</?(?:h1|p)>'),
    lambda b: trim(regexp_replace(regexp_replace(replace(replace(replace(
      regexp_replace(b, '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS found
  FROM pages),
joined AS (
  SELECT page_id, url, coalesce(array_to_string(list_filter(found, lambda b: b <> ''), chr(10) || chr(10)), '') AS text FROM blocks)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM joined
"""
