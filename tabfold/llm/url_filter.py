"""URL filters by a sort-merge range join.

A host is written with its labels in reverse order, each closed by a separator,
so that a rule for a host covers one interval of keys: the host and all its
subdomains. Pages and rules are dealt out by ranges of that key and sorted; one
sweep over each range then keeps a stack of the rules whose interval is open,
which are nested, and looks a page's path up in them.

No range holds more than its share: the cut points come from a sample of the
keys, which contain the path, and a key that fills several ranges by itself is
spread over them by a hash of the row. A rule is copied to every range it
reaches into; across a cut point only nested hosts reach, so copies are few.

Defined results: a null url, or one without ``://``, has empty host and path. A
rule with a null in host, path or verdict fits nothing. Of the rules that fit,
the longest (host and path together) wins, then the one with the longer host,
then the block. A path that does not start with ``/`` fits only rules whose path
is a prefix of it. Repeated rows are judged one by one; an empty table gives an
empty result; columns not named in ``keep`` do not matter.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tabfold.llm.common import lower_ascii, shuffle_parts

URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# Closes a label; the next character bounds the interval of a host from above.
CLOSE, BEYOND = "\x01", "\x02"
SAMPLED_PER_PART = 50


def host_and_path(url: Column) -> tuple[Column, Column]:
    part = lambda i: F.coalesce(F.regexp_extract(url, URL_PARTS, i), F.lit(""))
    return lower_ascii(part(1)), part(2)


def host_key(host: Column) -> Column:
    """Labels in reverse order, each followed by the separator; empty for no host."""
    labels = F.reverse(F.split(host, r"\."))
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(labels, CLOSE), F.lit(CLOSE)))


class _Open:
    """A host on the stack, with its rules by path."""

    def __init__(self, host: str, key: str):
        self.host, self.end = host, key[:-1] + BEYOND if key else None
        self.rules: dict[str, tuple[str, str]] = {}
        self.lengths: list[int] = []

    def add(self, path: str, verdict: str) -> None:
        held = self.rules.get(path)
        if held is None or (held[1] != "block" and verdict == "block"):
            self.rules[path] = (self.host + path, verdict)
        self.lengths = sorted({len(p) for p in self.rules}, reverse=True)

    def fits(self, host: str) -> bool:
        return not self.host or host == self.host or host.endswith("." + self.host)

    def longest(self, path: str) -> tuple[str, str] | None:
        return next((r for n in self.lengths if (r := self.rules.get(path[:n])) and len(path) >= n), None)


def _sweep(default: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, stack = None, []
        for frame in frames:
            rules, verdicts = [], []
            for at, is_page, key, host, path, verdict in zip(
                frame["part"], frame["is_page"], frame["key"], frame["host"], frame["path"], frame["verdict"]
            ):
                if at != part:
                    part, stack = at, []
                while stack and stack[-1].end is not None and key >= stack[-1].end:
                    stack.pop()
                if not is_page:
                    if not stack or stack[-1].host != host:
                        stack.append(_Open(host, key))
                    stack[-1].add(path, verdict)
                    continue
                # Deeper hosts come first, so that they win between equal lengths.
                found = [r for o in reversed(stack) if o.fits(host) and (r := o.longest(path))]
                best = max(found, key=lambda r: len(r[0]), default=(None, default))
                rules.append(best[0])
                verdicts.append(best[1])
            pages = frame[frame["is_page"]].drop(columns=["part", "is_page", "key", "verdict"])
            yield pages.assign(rule=pd.array(rules, dtype=object), verdict=pd.array(verdicts, dtype=object))

    return run


def _cut_points(keys: DataFrame, parts: int) -> list[str]:
    """At most ``parts - 1`` cut points; the collected sample is bounded by ``parts``."""
    n = keys.count()
    wanted = SAMPLED_PER_PART * parts
    sample = keys if n <= wanted else keys.sample(min(1.0, 1.2 * wanted / n), seed=1)
    found = sorted(r[0] for r in sample.limit(2 * wanted).collect())
    return [found[len(found) * i // parts] for i in range(1, parts)] if found else []


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    *,
    url: str = "url",
    keep: Sequence[str] = (),
    default: str = "allow",
    parts: int | None = None,
) -> DataFrame:
    """The ``keep`` columns of every page with host, path, rule and verdict.

    ``rules`` has the string columns host, path and verdict (``allow`` or
    ``block``); ``rule`` is host and path of the winning rule, or null, and then
    the verdict is ``default``.
    """
    parts = parts or shuffle_parts(pages.sparkSession)
    host, path = host_and_path(F.col(f"`{url}`"))
    kept = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    asked = pages.select(*kept, host.alias("host"), path.alias("path"))
    asked = asked.withColumn("key", F.concat(host_key(F.col("host")), F.col("path")))
    cuts = _cut_points(asked.select("key"), parts)

    @F.pandas_udf("int")
    def part_of(key: pd.Series, spread: pd.Series) -> pd.Series:
        lows = [bisect_left(cuts, k) for k in key]
        highs = [bisect_right(cuts, k) for k in key]
        return pd.Series([a + s % (b - a + 1) for a, b, s in zip(lows, highs, spread)], dtype="int32")

    @F.pandas_udf("array<int>")
    def parts_of(low: pd.Series, high: pd.Series) -> pd.Series:
        return pd.Series(
            [list(range(bisect_left(cuts, a), bisect_right(cuts, b) + 1 if b else len(cuts) + 1)) for a, b in zip(low, high)]
        )

    # Any spread will do, as long as a row that is computed again falls the same way.
    spread = F.pmod(F.xxhash64(*[c for c in asked.columns if c != "key"]), F.lit(1 << 30))
    key = F.col("key")
    dealt = asked.withColumn("part", part_of(key, spread)).withColumns(
        {"is_page": F.lit(True), "verdict": F.lit(None).cast("string")}
    )
    given = (
        rules.select(lower_ascii(F.col("host")).alias("host"), "path", "verdict")
        .where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull())
        .withColumn("key", host_key(F.col("host")))
    )
    high = F.when(key == "", F.lit("")).otherwise(F.concat(F.expr("left(key, length(key) - 1)"), F.lit(BEYOND)))
    given = given.withColumn("part", F.explode(parts_of(key, high))).withColumn("is_page", F.lit(False))
    both = dealt.unionByName(given, allowMissingColumns=True)
    placed = both.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "key", "is_page", "host")
    fields = [f"k{i} {f}" for i, f in enumerate(pages.select(*[f"`{c}`" for c in keep]).schema[c].dataType.simpleString() for c in keep)]
    judged = placed.mapInPandas(
        _sweep(default), ", ".join([*fields, "host string, path string, rule string, verdict string"])
    )
    return judged.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "host", "path", "rule", "verdict"
    )
