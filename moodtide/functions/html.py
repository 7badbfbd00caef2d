"""HTML bodies as columns.

``outline`` is the only Python step: an Arrow-batched helper that turns one body into its list of tags and text pieces.
Which tag counts, in what order, and what becomes of its text is written as Spark expressions over that list.

A tag knows the half-open range ``lo:hi`` of text pieces inside it and its end in the tag list, so "text of a node" is
a slice and "p inside article" is a range test. Unclosed tags stay open until an enclosing tag closes.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from moodtide.functions.text import strip

# The helper travels by value, so that workers need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOID_TAGS = frozenset(  # fixed values: tags that never have content
    "area base br col embed hr img input link meta param source track wbr".split())
SILENT_TAGS = frozenset(["script", "style", "template"])  # fixed values: text that is never shown

#: Bytes of bodies, and bodies, whose outlines are built at a time; a longer body is worked on alone.
RUN_BYTES, RUN_ROWS = 1 << 20, 1000

OUTLINE_TYPE = pa.struct([
    ("tags", pa.list_(pa.struct([
        ("tag", pa.string()), ("attrs", pa.map_(pa.string(), pa.string())),
        ("pos", pa.int32()), ("stop", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32())]))),
    ("texts", pa.list_(pa.string())), ("silent", pa.list_(pa.string()))])


class _Walker(HTMLParser):
    """Collects the tags and text pieces of one body after another."""

    def start(self):
        self.reset()
        self.tags, self.texts, self.silent, self.open_tags = [], [], [], []
        self.fresh = True  # the next data starts a new text piece

    def cut(self, *_):
        self.fresh = True

    handle_comment = handle_decl = handle_pi = unknown_decl = cut

    def handle_starttag(self, tag, attrs):
        self.fresh = True
        at, text = len(self.tags), len(self.texts)
        node = {"tag": tag, "attrs": list({k: v or "" for k, v in attrs}.items()), "pos": at, "stop": at + 1, "lo": text, "hi": text}
        self.tags.append(node)
        if tag not in VOID_TAGS:
            self.open_tags.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.fresh = True
        if any(node["tag"] == tag for node in self.open_tags):
            while self.shut()["tag"] != tag:
                pass

    def shut(self):
        node = self.open_tags.pop()
        node["stop"], node["hi"] = len(self.tags), len(self.texts)
        return node

    def handle_data(self, data):
        if self.fresh:
            self.texts.append("")
            self.silent.append("")
            self.fresh = False
        hidden = self.open_tags and self.open_tags[-1]["tag"] in SILENT_TAGS
        (self.silent if hidden else self.texts)[-1] += data


def outline_one(body: str, walker: _Walker | None = None) -> dict:
    walker = walker or _Walker(convert_charrefs=True)
    walker.start()
    walker.feed(body)
    walker.close()
    while walker.open_tags:
        walker.shut()
    return {"tags": walker.tags, "texts": walker.texts, "silent": walker.silent}


def outlines(bodies: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Outlines in runs of about ``RUN_BYTES`` of body each: tags as Python objects take many times the memory of their body, so only a run of them is held."""
    walker = _Walker(convert_charrefs=True)
    for batch in bodies:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(batch):
            before = int(ends[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + RUN_BYTES, "right")))
            end = min(end, start + RUN_ROWS)
            yield pa.array([None if b is None else outline_one(b, walker) for b in batch.slice(start, end - start).to_pylist()], type=OUTLINE_TYPE)
            start = end


@F.arrow_udf(from_arrow_type(OUTLINE_TYPE))
def _outline(bodies: Iterator[pa.Array]) -> Iterator[pa.Array]:
    yield from outlines(bodies)


def outline(body: Column) -> Column:
    return _outline(body)


# -- expressions over an outline column --------------------------------------------------------
class Page:
    """Extraction rules over the outline column ``name``."""

    def __init__(self, name: str = "doc"):
        self.tags, self.texts, self.silent = F.col(f"{name}.tags"), F.col(f"{name}.texts"), F.col(f"{name}.silent")

    def all(self, test: Callable[[Column], Column]) -> Column:
        return F.filter(self.tags, test)

    def first(self, test: Callable[[Column], Column]) -> Column:
        """First matching tag in document order, null when there is none."""
        return F.get(self.all(test), F.lit(0))

    def inside(self, node: Column, test: Callable[[Column], Column]) -> Column:
        """Matching tags below a node; the tag list is in document order, so they are one slice of it."""
        return F.filter(_bound(node, lambda n: F.slice(self.tags, n["pos"] + 2, n["stop"] - n["pos"] - 1)), test)

    def first_inside(self, node: Column, test: Callable[[Column], Column]) -> Column:
        return F.get(self.inside(node, test), F.lit(0))

    def pieces(self, node: Column) -> Column:
        return _bound(node, lambda n: F.slice(self.texts, n["lo"] + 1, n["hi"] - n["lo"]))

    def raw_text(self, node: Column) -> Column:
        return F.array_join(self.pieces(node), "")

    def text(self, node: Column, separator: str = "") -> Column:
        """Stripped text pieces, empty ones left out; null for a missing node."""
        return F.array_join(F.filter(F.transform(self.pieces(node), strip), lambda x: x != ""), separator)

    def paragraphs(self, nodes: Column) -> Column:
        """Texts of the given tags, one line each, empty ones left out."""
        return F.array_join(F.filter(F.transform(nodes, lambda t: self.text(t)), lambda x: x != ""), "\n")

    def script_text(self, node: Column) -> Column:
        return F.array_join(_bound(node, lambda n: F.slice(self.silent, n["lo"] + 1, n["hi"] - n["lo"])), "")

    def meta(self, attribute: str, value: str) -> Column:
        """Content of the first ``<meta attribute=value>``."""
        return self.first(lambda t: (t["tag"] == "meta") & (attr(t, attribute) == value))["attrs"]["content"]


def _bound(node: Column, rule: Callable[[Column], Column]) -> Column:
    """``rule`` of a node that is looked up once, although the rule mentions it several times."""
    return F.get(F.transform(F.array(node), lambda n: rule(n)), F.lit(0))


def attr(tag: Column, name: str) -> Column:
    return F.coalesce(F.try_element_at(tag["attrs"], F.lit(name)), F.lit(""))


def has_class(tag: Column, name: str) -> Column:
    """One of the blank-separated class names is exactly ``name``."""
    names = F.concat(F.lit(" "), F.translate(attr(tag, "class"), "\t\n\r\f", "    "), F.lit(" "))
    return names.contains(f" {name} ")


def is_tag(name: str) -> Callable[[Column], Column]:
    return lambda t: t["tag"] == name


def tag_with_class(tag: str, name: str) -> Callable[[Column], Column]:
    return lambda t: (t["tag"] == tag) & has_class(t, name)


def html_to_text(body: Column, separator: str = "\n") -> Column:
    """Text of an HTML fragment, its non-empty pieces joined by ``separator``; scripts and styles have none, references are read."""
    return strip(F.array_join(F.filter(outline(body)["texts"], lambda x: x != ""), separator))
