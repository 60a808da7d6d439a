"""Captured pages in landings, each of which is parsed once.

A landing is one committed version of the store. What a parse of it found is committed beside
it with the numbers of the landings and a mark of the rules, so that the log of the results says
what is still to be read. Results are a few columns a page, and only they meet other tables: html
is read once, by a narrow pass, and is neither joined nor shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from shelfloom import schemas
from shelfloom.rules import SiteRule
from shelfloom.sources.tables import Built, _captures, append_rows, commit, log_entries, read_versions


@dataclass(frozen=True)
class CaptureStore:
    """Landings of captures under ``root``/``name``."""

    spark: SparkSession
    root: str
    name: str

    def land(self, pages: DataFrame, site: Column | None = None) -> int:
        """Store pages (page_id, url, html and, without ``site``, site) as a landing; its number."""
        return append_rows(_captures(pages, site), self.root, self.name)[0]

    def landings(self) -> list[int]:
        return list(log_entries(self.spark, self.root, self.name))

    def read(self, landings: list[int] | None = None) -> DataFrame:
        """Captures of these landings, or of all."""
        chosen = self.landings() if landings is None else landings
        return read_versions(self.spark, self.root, self.name, schemas.CAPTURES, chosen)


def rules_mark(rules: Mapping[str, SiteRule]) -> int:
    """Changes when any rule does: results of other rules are not taken for these."""
    return zlib.crc32(repr(sorted(rules.items())).encode())


def unparsed(store: CaptureStore, root: str, table: str, mark: int) -> list[int]:
    """Landings without a result in ``table``."""
    done = {n for e in log_entries(store.spark, root, table).values() if e.get("mark") == mark for n in e["landings"]}
    return [n for n in store.landings() if n not in done]


def parse_new(store: CaptureStore, root: str, table: str, mark: int, parse: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Parse the landings that have no result yet, and return the results of all.

    Of two runs at a time one commits first; the other looks again for what is left, so that a
    landing is in one version of the results only.
    """

    def build() -> Built | None:
        new = unparsed(store, root, table, mark)
        return (parse(store.read(new)), {"landings": new, "mark": mark}) if new else None

    commit(store.spark, root, table, build, "rows")
    versions = [n for n, e in log_entries(store.spark, root, table).items() if e.get("mark") == mark]
    return read_versions(store.spark, root, table, None, versions) if versions else parse(store.read([]))
