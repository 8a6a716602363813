"""Extraction rules compiled into projections, and one Arrow stage for rules on the document tree."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from .prices import take_first


@dataclass(frozen=True)
class Rule:
    """How a field is found: alternatives of (kind, text), tried in order, their results concatenated.

    Kinds: regex (group 1 of all matches in html), css (`tag.class tag[attr] ::text` or `::attr(x)`), sql
    (an expression over fields already found). input and output are processors: functions from
    Column to Column, or names of SQL functions (also registered ones) of one argument. Without an output processor the first non-empty value counts. A
    value is kept if it isn't empty, else the default stands. Fields of lower order come first; `skip`
    fields are dropped at the end.
    """

    field: str
    alternatives: tuple[tuple[str, str], ...]
    default: str = ""
    order: int = 0
    skip: bool = False
    input: str | Callable[[Column], Column] | None = None
    output: str | Callable[[Column], Column] | None = None


def _apply(processor, x: Column) -> Column:
    """A function from Column to Column, or the name of an SQL function of one argument."""
    return processor(x) if callable(processor) else F.call_function(processor, x)


class _Tree(HTMLParser):
    """Collects the results of compiled selectors while a page is read once; nothing is kept but the open elements."""

    VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

    def __init__(self, selectors: list[tuple[list[tuple], str]]):
        super().__init__(convert_charrefs=True)
        self.selectors, self.open, self.found = selectors, [], [[] for _ in selectors]

    @staticmethod
    def _fits(step: tuple, tag: str, attrs: dict) -> bool:
        name, classes, ident, has = step
        return (not name or name == tag) and (not ident or attrs.get("id") == ident) and set(classes) <= set((attrs.get("class") or "").split()) and all(k in attrs and (v is None or attrs[k] == v) for k, v in has)

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        texts = []
        for n, (steps, what) in enumerate(self.selectors):
            if self._fits(steps[-1], tag, attrs):
                rest = list(steps[:-1])
                for t, a, _ in reversed(self.open):
                    if rest and self._fits(rest[-1], t, a):
                        rest.pop()
                if not rest:
                    if what == "text":
                        texts.append((n, len(self.found[n])))
                        self.found[n].append([])
                    else:
                        self.found[n].append(attrs.get(what) or "")
        if tag not in self.VOID:
            self.open.append((tag, attrs, texts))

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        for tag, _, texts in self.open:
            for n, k in texts:
                if tag not in ("script", "style"):
                    self.found[n][k].append(data)


def compile_css(text: str) -> tuple[list[tuple], str]:
    """`div.box a[href]::attr(href)` as steps and what to take (`text` unless an attribute is named)."""
    m = re.fullmatch(r"(.*?)(?:::(text|attr\(([\w-]+)\)))?", text.strip())
    steps = []
    for part in m[1].split():
        name = re.match(r"^[\w*]*", part)[0].replace("*", "")
        has = [(k, v if v else None) for k, v in re.findall(r"\[([\w-]+)(?:=\"?([^\]\"]*)\"?)?\]", part)]
        bare = re.sub(r"\[[^\]]*\]", "", part)
        steps.append((name.lower(), re.findall(r"\.([\w-]+)", bare), (re.findall(r"#([\w-]+)", bare) or [""])[0], has))
    return steps, m[3] or "text"


def select_css(pages: DataFrame, selectors: dict[str, str]) -> DataFrame:
    """Add one array of texts for each selector: every page is read once, in one Arrow stage."""
    compiled = [compile_css(s) for s in selectors.values()]
    out = StructType([*pages.schema.fields, *[StructField(name, ArrayType(StringType())) for name in selectors]])

    def run(batches):
        for b in batches:
            columns = [[] for _ in compiled]
            for page in b.column("html").to_pylist():
                t = _Tree(compiled)
                t.feed(page or "")
                t.close()
                for c, found in zip(columns, t.found, strict=True):
                    c.append([" ".join("".join(x).split()) if isinstance(x, list) else x for x in found])
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(c, pa.list_(pa.string())) for c in columns]], names=[*b.schema.names, *selectors])

    return pages.mapInArrow(run, out)


def extract(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, url and one column a field; null and empty html give defaults."""
    css = {f"__{r.field}_{i}": text for r in rules for i, (kind, text) in enumerate(r.alternatives) if kind == "css"}
    out = select_css(pages, css) if css else pages
    for order in sorted({r.order for r in rules}):
        columns = {}
        for r in (r for r in rules if r.order == order):
            parts = []
            for i, (kind, text) in enumerate(r.alternatives):
                if kind == "regex":
                    parts.append(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(text), F.lit(1)))
                elif kind == "css":
                    parts.append(F.col(f"__{r.field}_{i}"))
                else:
                    parts.append(F.array(F.expr(text).cast("string")))
            values = F.concat(*parts)
            if r.input is not None:
                each = r.input
                values = F.transform(values, lambda x: _apply(each, x))
            found = take_first(values) if r.output is None else _apply(r.output, values)
            columns[r.field] = F.coalesce(F.nullif(found, F.lit("")), F.lit(r.default))
        out = out.withColumns(columns)
    return out.select("page_id", "url", *[r.field for r in rules if not r.skip])
