"""Elements of captured pages by simple selectors, for pages that are not well-formed XML.

A selector is tags with optional classes or an id, joined by spaces: ``div.gallery table.desc td``.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

# Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


def parse_selector(selector: str) -> list[tuple[str, frozenset[str], str]]:
    """(tag or empty, classes, id or empty) of each step."""
    steps = []
    for part in selector.split():
        head, _, name = part.partition("#")
        tag, *classes = head.split(".")
        steps.append((tag.lower(), frozenset(classes), name))
    return steps


def _fits(step: tuple[str, frozenset[str], str], node: tuple[str, frozenset[str], str]) -> bool:
    return (not step[0] or step[0] == node[0]) and step[1] <= node[1] and (not step[2] or step[2] == node[2])


class _Collector(HTMLParser):
    """Matches against what is open. Beside each open element stands how many steps of the selector it and those
    around it fulfil, so an element is judged by the one around it, and a stray end tag by the number of its kind."""

    def __init__(self, steps: list[tuple[str, frozenset[str], str]]) -> None:
        super().__init__(convert_charrefs=True)
        self.steps, self.found = steps, []
        self.open: list[tuple[str, int, int | None]] = []  # tag, steps fulfilled (the last one but for), number of the element
        self.count: dict[str, int] = {}
        self.matched: list[int] = []  # numbers of the open elements that match

    def handle_starttag(self, tag: str, attrs: list) -> None:
        held = dict(attrs)
        node = (tag, frozenset((held.get("class") or "").split()), held.get("id") or "")
        done = self.open[-1][1] if self.open else 0
        number = None
        if done == len(self.steps) - 1 and _fits(self.steps[-1], node):
            number = len(self.found)
            self.found.append([held.get("href"), []])
        if tag in VOID:
            return
        if done < len(self.steps) - 1 and _fits(self.steps[done], node):
            done += 1
        self.open.append((tag, done, number))
        self.count[tag] = self.count.get(tag, 0) + 1
        if number is not None:
            self.matched.append(number)

    def handle_endtag(self, tag: str) -> None:
        if not self.count.get(tag):
            return
        while True:
            last, _, number = self.open.pop()
            self.count[last] -= 1
            if number is not None:
                self.matched.pop()
            if last == tag:
                return

    def handle_data(self, data: str) -> None:
        for number in self.matched:
            self.found[number][1].append(data)


def elements_of(page: str | None, selector: str) -> list[tuple[str | None, str]]:
    """(href, stripped text) of each matching element, in page order."""
    collector = _Collector(parse_selector(selector))
    collector.feed(page or "")
    collector.close()
    return [(href, "".join(parts).strip()) for href, parts in collector.found]


def select_elements(pages: DataFrame, key: str, html: str, selector: str) -> DataFrame:
    """(key, pos, href, text) of matching elements; narrow, one pass over the pages, page by page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                found = elements_of(batch.column(html)[k].as_py(), selector)
                if found:
                    own = pa.array([k] * len(found))
                    yield pa.RecordBatch.from_arrays([batch.column(key).take(own), pa.array(range(len(found)), pa.int64()), *(pa.array(c, pa.string()) for c in zip(*found, strict=True))], names=[key, "pos", "href", "text"])

    return pages.select(key, html).mapInArrow(run, f"{key} {dict(pages.dtypes)[key]}, pos long, href string, text string")
