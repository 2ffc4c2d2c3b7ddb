"""The main body of a web page.

Pages are parsed by the layout-aware tree builder of ``pages``, whose blocks in
page order are the lines of the extracted text.  The main container is the
smallest element around the page's headline that also holds its prose; within it
linked pointers to other pages and prompts that recur over the corpus are
furniture too.  Everything is decided from one narrow row per page: hashes of
blocks travel, texts do not.  No words of any language and no names of classes
are known beforehand.  The body kept is rendered with its spacing, list marks and
aligned cells.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataform.llm.pages import HEADINGS, INLINE, Block, Element, Page, decode, parse, render
from strataform.llm.sitelines import clean_domain, url_host
from strataform.runtime import store

#: A prompt recurs on this share of all pages, but on no fewer pages than this.
PROMPT_SHARE, PROMPT_PAGES = 0.0005, 3
#: Or on this share of its own site's pages, and on no fewer of them than this.
SITE_SHARE, SITE_PAGES = 0.1, 5

#: Pages that are taken from a batch at once, which bounds what their trees hold.
PAGES_AT_ONCE = 256

#: Longer paragraphs are never prompts, however often a text is syndicated.
PROMPT_CHARS = 160

#: Elements that hold prose of their own.
_PROSE = frozenset("p li blockquote pre dd td th figcaption caption div section article main address".split())
_OUTER = frozenset("#root html body".split())
_FURNITURE_TAGS = frozenset("nav aside footer form menu dialog".split())

_DIGITS = re.compile(r"\d+")


def _outermost(page: Page, element: Element) -> list[Element]:
    """The block elements around and with ``element`` below the body, outermost first."""
    out = []
    while element is not None and element.tag not in _OUTER:
        if element.tag not in INLINE:
            out.append(element)
        element = element.parent
    return out[::-1]


def _is_furniture(element: Element) -> bool:
    return element.tag in _FURNITURE_TAGS


def main_blocks(page: Page) -> list[bool]:
    """For each block whether it lies in the main container.

    The container is the smallest block element around the first top heading
    that holds unlinked prose; a page whose headline stands alone, or without
    one, takes the outer element with most of its prose.
    Where nothing but the whole body qualifies, all blocks outside marked
    furniture are in.
    """
    chains = [_outermost(page, b.element) for b in page.blocks]
    prose: dict[int, int] = {}
    total = 0
    for block, chain in zip(page.blocks, chains, strict=True):
        free = len(block.text) - block.linked
        if block.heading or block.element.tag not in _PROSE or free < 40 or any(_is_furniture(e) for e in chain):
            continue
        total += free
        for e in chain:
            prose[e.number] = prose.get(e.number, 0) + free
    main: Element | None = None
    headline = next((i for i, b in enumerate(page.blocks) if b.heading == "h1"), None)
    if headline is not None:
        main = next((e for e in reversed(chains[headline]) if e.tag not in HEADINGS and e.tag not in ("header", "hgroup", "p") and prose.get(e.number, 0) > 0), None)
    if main is None and prose:
        outer = {c[0].number: c[0] for c in chains if c and c[0].tag not in ("p", "li")}
        main = max((e for k, e in outer.items() if prose.get(k, 0) * 2 >= total), key=lambda e: prose[e.number], default=None)
    if main is None:
        return [not any(_is_furniture(e) for e in c) for c in chains]
    # Furniture nested in the container stays out.
    inside = []
    for chain in chains:
        at = next((k for k, e in enumerate(chain) if e is main), None)
        inside.append(at is not None and not any(_is_furniture(e) for e in chain[at + 1 :]))
    return inside


def _pointer(block: Block) -> bool:
    return not block.heading and block.linked * 5 >= len(block.text) * 4


_PAGES = "artifact_id string, site long, blocks array<long>, outside array<boolean>, prompts array<long>"
_ALIGNED = "artifact_id string, site long, line_no long, outside boolean, prompt long, block int"


def _describe(data: bytes | None, content_type: str | None) -> tuple[list[int], list[bool], list[int]]:
    """Hash of each block, whether it is furniture, and the hash of a possible prompt or 0."""
    text = decode(data or b"", content_type)
    if "<" not in text:
        return [], [], []
    page = parse(text)
    headline = next((b.text for b in page.blocks if b.heading == "h1"), "")
    # The part of the title that is not the headline names the site.
    sites = [s for s in re.split(r"\s+[|–—-]\s+", " ".join(page.title.split())) if s and s != headline][-1:]
    outside, prompts = [], []
    for block, inside in zip(page.blocks, main_blocks(page), strict=True):
        out = not inside or _pointer(block)
        outside.append(out)
        prompt = 0
        if not out and block.element.tag == "p" and not block.heading and len(block.text) <= PROMPT_CHARS:
            form = _DIGITS.sub("0", block.text)
            for site in sites:
                form = form.replace(site, "@")
            prompt = _hash(form)
        prompts.append(prompt)
    return [_hash(b.text) for b in page.blocks], outside, prompts


def _hash(text: str) -> int:
    """The engine's own 64-bit hash of a string, as a signed number."""
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 42)
    return value - (1 << 64) if value >> 63 else value


def _few_at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, PAGES_AT_ONCE):
            yield batch.slice(at, PAGES_AT_ONCE)


def describe_pages(artifacts: DataFrame) -> DataFrame:
    """One narrow row per artifact; artifacts that hold no markup have no blocks.

    ``site`` is the hash of the host of the artifact's ``url``, null where there is none.
    """
    host = clean_domain(url_host(F.col("url"))) if "url" in artifacts.columns else F.lit(None).cast("string")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64())]
        for batch in _few_at_once(batches):
            rows = [_describe(data, kind) for data, kind in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            columns = [batch.column(0), batch.column(3), *([r[i] for r in rows] for i in range(3))]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in _PAGES.split(", ")])

    return artifacts.where("artifact_id is not null").select("artifact_id", "raw_data", "content_type", F.when(host.isNotNull(), F.xxhash64(host)).alias("site")).mapInArrow(describe, _PAGES)


def align(lines: list[int], blocks: list[int]) -> list[int]:
    """For each line the block it shows, or -1; both keep their order."""
    if lines == blocks:
        return list(range(len(lines)))
    out, at = [], 0
    places: dict[int, list[int]] = {}
    for i, b in enumerate(blocks):
        places.setdefault(b, []).append(i)
    for line in lines:
        found = next((i for i in places.get(line, ()) if i >= at), -1)
        out.append(found)
        if found >= 0:
            at = found + 1
    return out


def _align_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int32()]
    for batch in batches:
        rows: list[tuple] = []
        for key, site, lines, blocks, out, prompt in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not blocks:
                continue
            place = align(lines, blocks)
            for k, b in enumerate(place):
                if b >= 0:
                    rows.append((key, site, k + 1, out[b], prompt[b], b))
                    continue
                # A line no block shows sides with its neighbours.
                near = next((place[j] for d in range(1, len(place)) for j in (k - d, k + d) if 0 <= j < len(place) and place[j] >= 0), -1)
                if near >= 0:
                    rows.append((key, site, k + 1, out[near], 0, -1))
        columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in _ALIGNED.split(", ")])


def page_lines(artifacts: DataFrame, extractions: DataFrame) -> DataFrame:
    """``(artifact_id, line_no, outside, block)`` for every line of the extracted texts of pages.

    Lines are counted from 1; ``block`` is the place of the page's block that the
    line shows, or -1.  Of several results for an artifact the latest
    counts; null texts have no lines, and texts whose artifact is missing or
    holds no markup have no furniture and give no row.
    """
    lines = F.transform(F.split("canonical_text", "\n"), lambda x: F.xxhash64(F.trim(x)))
    latest = extractions.where("artifact_id is not null and canonical_text is not null").select("artifact_id", "created_at", lines.alias("lines"))
    latest = latest.groupBy("artifact_id").agg(F.max(F.struct("created_at", "lines")).alias("r")).select("artifact_id", "r.lines")
    pages = describe_pages(artifacts).groupBy("artifact_id").agg(F.min(F.struct("blocks", "outside", "prompts", "site")).alias("p")).select("artifact_id", "p.*")
    aligned = latest.join(pages, "artifact_id").select("artifact_id", "site", "lines", "blocks", "outside", "prompts").mapInArrow(_align_rows, _ALIGNED)
    stored = store(aligned, "page-lines").df
    n = stored.select("artifact_id").distinct().count()
    often = max(PROMPT_PAGES, PROMPT_SHARE * n)
    # Each recurs on a share of all pages, so they are at most the possible
    # prompts of an average page divided by PROMPT_SHARE.
    seen = stored.where("prompt <> 0").select("artifact_id", "prompt").distinct().groupBy("prompt").agg(F.count("*").alias("n"))
    recurring = seen.where(F.col("n") >= often).select("prompt", F.lit(True).alias("recurs"))
    # A site's own prompts are judged by its own pages, whatever the corpus holds.
    site_pages = stored.where("site is not null").groupBy("site").agg(F.countDistinct("artifact_id").alias("site_pages"))
    local = stored.where("prompt <> 0 and site is not null").groupBy("site", "prompt").agg(F.countDistinct("artifact_id").alias("n")).where(F.col("n") >= SITE_PAGES)
    local = local.join(site_pages, "site").where(F.col("n") / F.col("site_pages") >= SITE_SHARE).select("site", "prompt", F.lit(True).alias("recurs_here"))
    possible = stored.where("prompt <> 0").join(F.broadcast(recurring), "prompt", "left").join(local, ["site", "prompt"], "left")
    recurs = F.coalesce("recurs", "recurs_here", F.lit(False))
    judged = possible.select("artifact_id", "line_no", (F.col("outside") | recurs).alias("outside"), "block")
    return stored.where("prompt = 0").select("artifact_id", "line_no", "outside", "block").unionByName(judged)


BODIES = "artifact_id string, main_body string, body_lines int, furniture_lines int"


def _render_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int32()]
    for batch in _few_at_once(batches):
        rows = []
        for key, text, data, kind, kept, unplaced, cut in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            lines = text.split("\n")
            out = set(cut or ())
            plain = [x for k, x in enumerate(lines, 1) if k not in out]
            body = "\n".join(plain)
            if kept and not unplaced and data is not None:
                body = render(parse(decode(data, kind)), set(kept))
            rows.append((key, body, len(plain), len(lines) - len(plain)))
        columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in BODIES.split(", ")])


def main_bodies(artifacts: DataFrame, extractions: DataFrame) -> DataFrame:
    """``(artifact_id, main_body, body_lines, furniture_lines)``: each page's main body.

    One row for each artifact with a text.  The blocks of the body are rendered
    with blank lines between them, list marks and aligned table cells.  A text
    without markup is kept whole, and one with a kept line that no block of its
    page shows loses its furniture lines only.
    """
    block = F.when(~F.col("outside"), F.col("block"))
    # Bounded by the lines of one page.
    judged = page_lines(artifacts, extractions).groupBy("artifact_id").agg(
        F.collect_set(F.when(block >= 0, block)).alias("kept"), F.coalesce(F.bool_or(block < 0), F.lit(False)).alias("unplaced"), F.collect_set(F.when(F.col("outside"), F.col("line_no"))).alias("cut")
    )
    latest = extractions.where("artifact_id is not null and canonical_text is not null").groupBy("artifact_id").agg(F.max(F.struct("created_at", "canonical_text")).alias("r"))
    pages = artifacts.where("artifact_id is not null").groupBy("artifact_id").agg(F.min(F.struct("raw_data", "content_type")).alias("p"))
    joined = latest.select("artifact_id", "r.canonical_text").join(judged, "artifact_id", "left").join(pages, "artifact_id", "left")
    return joined.select("artifact_id", "canonical_text", "p.raw_data", "p.content_type", "kept", F.coalesce("unplaced", F.lit(True)).alias("unplaced"), "cut").mapInArrow(_render_rows, BODIES)
