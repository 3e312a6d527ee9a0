"""Records from result pages. Shapes that a regular expression can tell are native; nested ones use the standard parser."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


class _Blocks(HTMLParser):
    """Text blocks in order as (tag, class, text); scripts and styles are skipped."""

    SKIP = ("script", "style")
    BLOCKS = ("p", "div", "li", "h1", "h2", "h3", "td", "th", "dt", "dd", "label", "span", "title", "article", "a")

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[tuple[str, str, str]] = []
        self.open: list[list] = []
        self.quiet = 0

    def handle_starttag(self, tag, attrs):
        if tag in self.SKIP:
            self.quiet += 1
        if tag in self.BLOCKS:
            self.open.append([tag, dict(attrs).get("class") or "", ""])

    def handle_endtag(self, tag):
        if tag in self.SKIP:
            self.quiet = max(0, self.quiet - 1)
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                for t, c, body in self.open[k:]:
                    if " ".join(body.split()):
                        self.out.append((t, c, " ".join(body.split())))
                del self.open[k:]
                break

    def handle_data(self, data):
        if self.open and not self.quiet:
            self.open[-1][2] += data

    def close(self):
        super().close()
        self.out += [(t, c, " ".join(b.split())) for t, c, b in self.open if " ".join(b.split())]
        self.open = []


def html_blocks(html: str | None) -> list[tuple[str, str, str]]:
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()
    return parser.out


def blocks(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, pos, tag, cls, body) of every text block of every page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, k, *b) for i, h in zip(batch["id"], batch["html"], strict=True) for k, b in enumerate(html_blocks(h))]
            yield pd.DataFrame(rows, columns=["id", "pos", "tag", "cls", "body"])

    return pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).mapInPandas(run, "id bigint, pos int, tag string, cls string, body string")


def label_key(label: Column) -> Column:
    """Label of a card as a field name; the feminine form of the reporter is the same field."""
    key = F.regexp_replace(F.regexp_replace(T.fold(F.regexp_replace(label, r":\s*$", "")), "[^a-z0-9]+", "_"), "^_|_$", "")
    return F.when(key == "relatora", "relator").otherwise(key)


def label_values(html: Column) -> Column:
    """array<struct(label, value)> of <dt>/<dd>, <label>/<span> or <b>label:</b> value pairs."""
    pattern = r"(?is)<(?:dt|label|b)[^>]*>([^<]{1,60}?):?\s*</(?:dt|label|b)>\s*(?:<(?:dd|span)[^>]*>)?([^<]+)"
    return F.transform(
        F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)).alias("l"), F.regexp_extract_all(html, F.lit(pattern), F.lit(2)).alias("v")),
        lambda x: F.struct(label_key(x["l"]).alias("label"), T.collapse(T.unescape(x["v"])).alias("value")),
    )


def catalogue(html: Column) -> Column:
    """array<struct(url, title)> of the links of a list."""
    pattern = r'(?is)<li[^>]*>\s*<a href="([^"]*)"[^>]*>([^<]*)</a>'
    return F.transform(F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)).alias("u"), F.regexp_extract_all(html, F.lit(pattern), F.lit(2)).alias("t")), lambda x: F.struct(x["u"].alias("url"), T.collapse(T.unescape(x["t"])).alias("title")))


def form_fields(html: Column) -> Column:
    """map of name to value of a form's inputs; the last of a name wins."""
    pattern = r'(?is)name="([^"]*)"[^>]*value="([^"]*)"'
    pairs = F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)).alias("k"), F.regexp_extract_all(html, F.lit(pattern), F.lit(2)).alias("v"))
    return F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, x: F.map_concat(F.map_filter(m, lambda k, v: k != x["k"]), F.create_map(x["k"], x["v"])))


def status_of(body: Column) -> Column:
    """cancelled, revoked or current, by what a digest says of itself."""
    flat = T.fold(body)
    return F.when(flat.rlike(r"\bcancelad"), "cancelled").when(flat.rlike(r"\brevogad"), "revoked").otherwise("current")
