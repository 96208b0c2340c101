"""URL filters: rules indexed by their rarest literal token.

Each rule is a regular expression over host and path with literal tokens that any match must hold
whole. A rule stands in the index under the token that is rarest among all URLs of the table (ties:
first in order). A URL's tokens fetch candidate rules, and only those run. Of domain rules that
match, the longest wins (ties: first in order); only where none matches do pattern rules decide, a
block before an allow; else the verdict is allow.

A null url, or one without ://, has an empty host and path, no rule and the verdict allow. Rows are
independent: repeated rows, ties and nulls in other columns change nothing, and an empty table gives
no rows. Rules are sent to the workers in blocks of a bounded size, one pass over the rows for each.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

TOKEN = re.compile(r"[a-z0-9]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
#: Rules that one pass broadcasts.
BLOCK_RULES = 50_000


@dataclass(frozen=True)
class Rule:
    """name is shown; domain rules have a length, which ranks them; pattern rules have none."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    length: int = 0


def domain_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits host and all its subdomains if the url's path starts with path, which may end within a token."""
    lowered = host.translate(_LOWER)
    literal = lowered + path
    whole = [m[0] for m in TOKEN.finditer(literal) if m.end() < len(literal)]  # the last may go on in the url
    return Rule(literal, verdict, r"(?:[^/?#]*\.)?" + re.escape(literal), tuple(dict.fromkeys(whole)), len(literal))


def pattern_rule(name: str, verdict: str, pattern: str, tokens: Sequence[str]) -> Rule:
    return Rule(name, verdict, f"(?s:.*?)(?:{pattern})", tuple(tokens))


#: The method's own rules for urls that no domain rule fits.
PATTERNS = (
    pattern_rule("ad server", "block", r"(?:^|\.)adserver\.", ("adserver",)),
    pattern_rule("doubleclick", "block", r"(?:^|\.)doubleclick\.", ("doubleclick",)),
    pattern_rule("casino", "block", r"(?:^|[./-])casino(?:[./-]|$)", ("casino",)),
    pattern_rule("porn", "block", r"(?:^|[./-])porn(?:[./-]|$)", ("porn",)),
    pattern_rule("xxx", "block", r"(?:^|[./-])xxx(?:[./-]|$)", ("xxx",)),
    pattern_rule("tracker", "block", r"/track(?:er|ing)?/pixel(?:[./]|$)", ("pixel",)),
)
DOMAINS = (
    domain_rule("org", "/", "allow"),
    domain_rule("example.org", "/es/", "block"),
    domain_rule("example.org", "/en/1", "block"),
    domain_rule("com", "/fr/", "allow"),
    domain_rule("com", "/de/", "block"),
)


def split(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, path = rest[:end], rest[end:]
    stop = min((i for i in map(path.find, "?#") if i >= 0), default=len(path))
    return host.translate(_LOWER), path[:stop]


@dataclass
class Index:
    """Rules by their rarest token; rules without a whole token are candidates always."""

    by_token: dict[str, list[tuple[int, Rule]]] = field(default_factory=lambda: defaultdict(list))
    always: list[tuple[int, Rule]] = field(default_factory=list)

    @classmethod
    def build(cls, rules: Sequence[tuple[int, Rule]], counts: dict[str, int]) -> Index:
        out = cls()
        for place, rule in rules:
            if rule.tokens:
                out.by_token[min(rule.tokens, key=lambda t: (counts.get(t, 0), rule.tokens.index(t)))].append((place, rule))
            else:
                out.always.append((place, rule))
        return out

    def __getstate__(self) -> tuple:
        return dict(self.by_token), self.always

    def __setstate__(self, state: tuple) -> None:
        self.by_token, self.always = state

    def matches(self, host: str, path: str) -> Iterator[tuple[int, Rule]]:
        target = host + path
        seen = {m[0] for m in TOKEN.finditer(target)}
        for held in (self.always, *(self.by_token[t] for t in seen if t in self.by_token)):
            for place, rule in held:
                if re.match(rule.pattern, target):
                    yield place, rule


def rank(found: tuple[int, int, str, str]) -> tuple:
    """Greater wins: place, length, name and verdict of a rule that fits."""
    place, length, _, verdict = found
    return (length > 0, length, verdict == "block", -place)


def judge(pages: DataFrame, keep: list[str], rules: Sequence[Rule] = (*DOMAINS, *PATTERNS), url: str = "url") -> DataFrame:
    """Per row: the columns in keep, host, path, rule (a domain rule's or null), verdict, pattern (a pattern rule's or null)."""
    spark = pages.sparkSession
    prepare(spark)
    wanted = sorted({t for r in rules for t in r.tokens})
    counts: dict[str, int] = {}
    for i in range(0, len(wanted), BLOCK_RULES):  # bounded by the rules' own tokens
        block = spark.createDataFrame([(t,) for t in wanted[i : i + BLOCK_RULES]], "token string")
        found = pages.select(F.explode(F.array_distinct(F.split(F.lower(url), "[^a-z0-9]+"))).alias("token")).groupBy("token").count().join(F.broadcast(block), "token", "left_semi")
        counts |= {r["token"]: r["count"] for r in found.collect()}
    numbered = list(enumerate(rules))
    won = "__place int, __length int, __name string, __verdict string"
    out = pages.select(*keep, F.col(url).alias("__url"), *[F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in won.split(", ")])
    width = len(out.columns)
    for i in range(0, max(1, len(numbered)), BLOCK_RULES):
        index = spark.sparkContext.broadcast(Index.build(numbered[i : i + BLOCK_RULES], counts))

        def better(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                told = list(zip(*(batch.column(k).to_pylist() for k in range(width - 4, width)), strict=True))
                for row, text in enumerate(batch.column("__url").to_pylist()):
                    found = [(p, r.length, r.name, r.verdict) for p, r in index.value.matches(*split(text))] if text else []
                    if told[row][0] is not None:
                        found.append(told[row])
                    if found:
                        told[row] = max(found, key=rank)
                columns = zip(*told, strict=True) if told else [[]] * 4
                yield pa.RecordBatch.from_arrays([*batch.columns[:-4], *(pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.string(), pa.string()), strict=True))], names=batch.schema.names)

        out = out.mapInArrow(better, out.schema)
    schema = pages.select(*keep).withColumns({k: F.lit(None).cast("string") for k in ("host", "path", "rule", "verdict", "pattern")}).schema

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [split(x) for x in batch.column("__url").to_pylist()]
            told = list(zip(*(batch.column(k).to_pylist() for k in range(width - 3, width)), strict=True))
            more = [[h for h, _ in parts], [p for _, p in parts], [n if length else None for length, n, _ in told], [v or "allow" for _, _, v in told], [n if length == 0 else None for length, n, _ in told]]
            yield pa.RecordBatch.from_arrays([*batch.columns[: width - 5], *(pa.array(x, pa.string()) for x in more)], names=schema.names)

    return out.mapInArrow(named, schema)
