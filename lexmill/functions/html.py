"""Bytes to text: character sets and the main content of HTML, in Arrow batches."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .batches import mapped
from .text import col

_SKIP = {"script", "style", "noscript", "template", "svg", "head", "nav", "header", "footer", "aside", "form", "button", "select", "iframe"}
_BLOCK = {"p", "div", "section", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "table", "tr", "br", "hr", "pre", "blockquote", "figure", "dl", "dt", "dd", "body"}


def decode_bytes(data: bytes) -> str:
    """UTF-8 where valid; else by a byte order mark, the first declared character set anywhere, UTF-16 where every other byte of
    most is zero, or Windows-1252; without what that can't decode."""
    for mark, name in ((b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be")):
        if data.startswith(mark):
            return data[2:].decode(name, "ignore")
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        found = re.search(rb"charset\s*=\s*[\"']?([\w-]+)", data, re.I)
        if not found and len(data) > 1:
            for at, name in ((1, "utf-16-le"), (0, "utf-16-be")):
                if data[at::2].count(0) * 2 > len(data[at::2]):
                    return data.decode(name, "ignore")
        try:
            return data.decode(found[1].decode() if found else "cp1252", "ignore")
        except LookupError:
            return data.decode("cp1252", "ignore")


class _Extract(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.skipped = [], []

    def handle_starttag(self, tag, attrs):
        if tag in _SKIP:
            self.skipped.append(tag)
        elif tag in _BLOCK:
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag in _SKIP and tag in self.skipped:
            while self.skipped.pop() != tag:
                pass
        elif tag in _BLOCK:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.skipped:
            self.out.append(re.sub(r"\s+", " ", data))


def main_text(html: str) -> str:
    """Text of the page's content by block, without scripts, navigation, forms and the like."""
    parser = _Extract()
    parser.feed(html)
    parser.close()
    lines = (re.sub(r" +", " ", x).strip() for x in "".join(parser.out).split("\n"))
    return "\n".join(x for x in lines if x)


def decoded(data: Column | str) -> Column:
    """Native for valid UTF-8; Python sees only the rest."""

    @F.arrow_udf("string")
    def run(s: pa.Array) -> pa.Array:
        return mapped(s, decode_bytes, pa.string())

    as_text = col(data).cast("string")
    return F.when(F.is_valid_utf8(as_text), as_text).otherwise(run(F.when(~F.is_valid_utf8(as_text), col(data))))


def plain_text(html: Column | str) -> Column:
    @F.arrow_udf("string")
    def run(s: pa.Array) -> pa.Array:
        return mapped(s, main_text, pa.string())

    return run(col(html))
