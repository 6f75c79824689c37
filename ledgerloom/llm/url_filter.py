"""URL rules in a Bloom filter cascade, in DataFrame operations only.

A rule is a host and the beginning of a path. A URL's candidate keys are its host's suffixes, joined
with beginnings of its path, of the shapes (labels, characters) that the rules have. The first level
of a cascade encodes the listed keys, the second those other keys of the corpus that the first
lets through, the third the listed keys that the second lets through, and so on until none is left.
Over all candidate keys of the corpus, which the levels are built from, the cascade is exact: the
first level that does not hold a key tells whether it is listed. So each URL is judged by looking
at bits, without a join.

Level sizes follow the number of listed keys. A list too long for one cascade of bounded size is
cut by the hash of its keys into blocks, and the URLs pass one block after the other.

Defined results: a null URL, or one without ``://``, has an empty host and path, and no rule; rules
for a host hold for its subdomains; of the rules that fit, the one with the longest host and path
together wins, of equally long ones that with the longer host; a key that is both allowed and blocked is blocked; a URL that no rule fits is not
listed and gets ``otherwise``. Repeated rows are judged alike. Extra columns are kept by ``judge``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import lower_ascii, unused
from ledgerloom.session import spool

BITS_PER_KEY, HASHES = 8, 4
KEYS_PER_BLOCK = 4_000_000  # 4 MB of bits for the first level
_BLOCK_SALT = -1


@dataclass(frozen=True)
class Rule:
    verdict: str  # "allow" or "block"
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    authority = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(authority) + 1), "^[^?#]*", 0)
    return F.coalesce(lower_ascii(authority), F.lit("")), F.coalesce(path, F.lit(""))


def candidate_keys(host: Column, path: Column, shapes: Sequence[tuple[int, int]]) -> Column:
    """The URL's keys of the given shapes, longest first, of equally long ones that with the longer
    host."""
    known = F.array(*[F.struct(F.lit(n).alias("labels"), F.lit(m).alias("chars")) for n, m in shapes])
    labels = F.size(F.split(host, r"\."))
    fitting = F.filter(known, lambda s: (labels >= s.labels) & (F.length(path) >= s.chars))
    parts = F.transform(
        fitting,
        lambda s: F.struct(
            F.call_function("substring_index", host, F.lit("."), -s.labels).alias("host"),
            F.left(path, s.chars).alias("path"),
        ),
    )
    ranked = F.transform(
        parts,
        lambda p: F.struct(
            F.length(p.host) + F.length(p.path), F.length(p.host), F.concat(p.host, p.path).alias("key")
        ),
    )
    return F.transform(F.sort_array(ranked, asc=False), lambda r: r.key)


def _bits_at(key: Column, level: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level * HASHES + i)), F.lit(bits)) for i in range(HASHES)]


@dataclass(frozen=True)
class Level:
    """``words`` is a table of one row, the level's bits as ``array<bigint>``."""

    number: int
    bits: int
    words: DataFrame

    def holds(self, key: Column, words: Column) -> Column:
        held = F.lit(True)
        for at in _bits_at(key, self.number, self.bits):
            word = F.element_at(words, (F.floor(at / 64) + 1).cast("int"))
            held = held & (F.getbit(word, (at % 64).cast("int")) == 1)
        return held


def _level(keys: DataFrame, number: int) -> Level:
    """A Bloom filter of ``key``; its size follows their number."""
    n = keys.count()
    bits = max(64, -(-n * BITS_PER_KEY // 64) * 64)
    marked = (
        keys.select(F.explode(F.array(*_bits_at(F.col("key"), number, bits))).alias("at"))
        .groupBy(F.floor(F.col("at") / 64).alias("id"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("word"))
    )
    # Bounded by KEYS_PER_BLOCK: the words of one filter.
    words = (
        keys.sparkSession.range(bits // 64).join(marked, "id", "left")
        .agg(F.array_sort(F.collect_list(F.struct("id", F.coalesce("word", F.lit(0)).alias("word")))).alias("all"))
        .select(F.transform("all", lambda w: w.word).alias("words"))
    )
    return Level(number, bits, spool(words, "bloom"))


def cascade(universe: DataFrame) -> list[Level]:
    """Levels for ``universe``: distinct ``key`` with ``listed``, all keys that will be asked."""
    inside = universe.where("listed").select("key")
    outside = universe.where("not listed").select("key")
    levels: list[Level] = []
    while True:
        level = _level(inside, len(levels))
        levels.append(level)
        with_words = outside.withColumn("words", level.words.scalar())
        passing = spool(with_words.where(level.holds(F.col("key"), F.col("words"))).select("key"), "passing")
        if passing.isEmpty():
            return levels
        inside, outside = passing, inside


def _words_of(levels: list[Level]) -> Column:
    return F.array(*[level.words.scalar() for level in levels])


def listed(key: Column, levels: list[Level], words: Column) -> Column:
    """Whether a key of the universe is in the list. ``words``: the levels' words in order."""
    answer = F.lit(len(levels) % 2 == 1)
    for i in reversed(range(len(levels))):
        held = levels[i].holds(key, F.element_at(words, i + 1))
        answer = F.when(~held, F.lit(i % 2 == 1)).otherwise(answer)
    return answer


def judge(pages: DataFrame, rules: Sequence[Rule], otherwise: str = "allow", url: str = "url",
          keys_per_block: int = KEYS_PER_BLOCK) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` (null if none fits) and ``verdict`` to ``pages``.

    Columns of these names are replaced.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url))
    shapes = sorted({(r.host.count(".") + 1, len(r.path)) for r in rules})
    keys = candidate_keys(F.col("host"), F.col("path"), shapes) if shapes else F.array().cast("array<string>")
    asked = pages.select(F.col(url)).select(host.alias("host"), path.alias("path")).select(F.explode(keys).alias("key"))
    pairs = [F.struct(F.lit(r.key).alias("key"), F.lit(r.verdict).alias("verdict")) for r in rules]
    table = spark.range(1 if rules else 0).select(
        F.inline(F.array(*(pairs or [F.struct(F.lit("").alias("key"), F.lit("").alias("verdict"))])))
    )
    universe = spool(
        asked.select("key", F.lit(None).cast("string").alias("verdict")).union(table)
        .groupBy("key")
        .agg(F.coalesce(F.bool_or(F.col("verdict") == "block"), F.lit(False)).alias("block"),
             F.coalesce(F.bool_or(F.col("verdict") == "allow"), F.lit(False)).alias("allow")),
        "url-keys",
    )
    blocks = max(1, -(-len({r.key for r in rules}) // keys_per_block))
    all_keys, words = unused(pages, "_keys"), unused(pages, "_words")
    hits_of = {name: unused(pages, f"_{name}") for name in ("block", "allow")}
    none = F.array().cast("array<string>")
    judged = pages.withColumns({"host": host, "path": path}).withColumns(
        {all_keys: keys, **{c: none for c in hits_of.values()}}
    )
    for block in range(blocks):
        def own(key: Column) -> Column:
            return F.pmod(F.xxhash64(key, F.lit(_BLOCK_SALT)), F.lit(blocks)) == block

        for name in ("block", "allow"):
            levels = cascade(universe.where(own(F.col("key"))).select("key", F.col(name).alias("listed")))
            hits = F.filter(all_keys, lambda k: own(k) & listed(k, levels, F.col(words)))
            judged = (
                judged.withColumn(words, _words_of(levels))
                .withColumn(hits_of[name], F.concat(hits_of[name], hits)).drop(words)
            )
        if blocks > 1:
            judged = spool(judged, "judged")
    blocked, allowed = hits_of.values()
    longest = F.filter(all_keys, lambda k: F.array_contains(blocked, k) | F.array_contains(allowed, k))
    rule = F.try_element_at(longest, F.lit(1))
    return judged.withColumn("rule", rule).withColumn(
        "verdict",
        F.when(F.col("rule").isNull(), F.lit(otherwise))
        .when(F.array_contains(blocked, F.col("rule")), F.lit("block")).otherwise(F.lit("allow")),
    ).drop(all_keys, blocked, allowed)


def oracle(rules: Sequence[Rule], otherwise: str = "allow") -> str:
    rows = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in rules)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH rules(rule_verdict, rule_host, rule_path) AS (VALUES {rows}),
rest AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), cut AS (
    SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host,
           regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM rest
), urls AS (
    SELECT page_id, translate(raw_host, '{upper}', '{upper.lower()}') AS host, path FROM cut
), fitting AS (
    SELECT page_id, rule_host || rule_path AS rule, rule_verdict FROM urls JOIN rules
    ON ('.' || host) LIKE ('%.' || rule_host) AND starts_with(path, rule_path)
), best AS (
    SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(rule_verdict, length(rule)) AS rule_verdict
    FROM fitting GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, '{otherwise}') AS verdict
FROM urls LEFT JOIN best USING (page_id)
"""
